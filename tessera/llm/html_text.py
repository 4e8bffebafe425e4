"""Main text of HTML pages by composite text density.

A page becomes a tree of its elements (void elements, raw-text elements and
the usual implied end tags are known; an unclosed or stray tag never loses
text).  Elements that are never the article go first: scripts, styles, forms,
navigation, asides, page headers and footers, hidden elements, and elements whose
role names a menu, notice or the like.  A word of a class or id that names an
advert, notice, menu, sidebar or reader comments drops its elements only if all
of that name hold less than half of the text, or if the whole name is that word
and an `article` or `main` element with text lies outside; names like
`has-sidebar` tell what is inside and drop nothing.  Every other node gets its composite text density: characters per tag, adjusted by a
logarithm of its link-free share whose base depends on the link share of the
node and of the body.  The node whose children have the greatest sum of
densities is the article (an `article` or `main` element around it is taken
whole); the least density on its path to the body is the
threshold, and below every other node that reaches the threshold the subtree
of the greatest sum is taken too; headings beside the path are kept.

Defined cases: a null or empty page, and one without text, gives an empty
text; a page cut off in the middle gives what is there, a cut character
reference stays as it is written; rows that repeat an id each get their row.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tessera.llm.common import map_arrow

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead "
    "tr ul".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Opening one of these ends an open paragraph.
_ENDS_P = BLOCKS - {"body", "html", "tbody", "td", "tfoot", "th", "thead", "tr"}
#: Opening the key ends open elements of the values, up to the nearest element of the last set.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
#: Never part of an article.
DROPPED = frozenset("script style noscript template head title form nav aside footer button select option input "
                    "textarea iframe object embed svg canvas audio video map dialog menu".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu "
                          "menubar".split())
#: Words of a class or id that name something other than the article.
DROPPED_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr "
    "notice notices alert popup modal overlay newsletter subscribe subscription signup login nav navbar navigation menu "
    "menus breadcrumb breadcrumbs pagination pager sidebar aside widget widgets related recommended share sharing "
    "social footer masthead comment comments commentlist respond reply replies disqus discussion form search".split())

#: A quote opens a string straight after an equals sign only; elsewhere it is a character like any other.
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*(?:>|\Z)|<\?[^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)"
                    r"((?:[^>=]++|=\s*+(?:\"[^\"]*\"|'[^']*')?+)*+)(?:>|\Z)", re.S)
#: One attribute: name and value; found from left to right, so never inside a value.
_ATTR = re.compile(r"([^\s\"'<>/=][^\s/>=]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.S)
_READ = frozenset("class id role hidden aria-hidden".split())
#: First words of class names that tell what an element has, not what it is.
_STATES = frozenset("has have with without no not show shows hide hides".split())
_WORD = re.compile(r"[a-z]+")


class Node:
    __slots__ = ("tag", "parent", "children", "dropped", "names", "chars", "tags", "link_chars", "link_tags", "density", "total",
                 "block")

    def __init__(self, tag: str, parent: "Node | None"):
        self.tag, self.parent = tag, parent
        self.children: list = []  # nodes and text
        self.dropped = False
        self.names: list[str] = []  # classes and ids with a word of DROPPED_WORDS
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0
        self.block = tag in BLOCKS


class _Open:
    """The open elements, and how many there are of each tag."""

    def __init__(self, root: Node):
        self.stack, self.count = [root], Counter([root.tag])

    def push(self, node: Node) -> None:
        self.stack.append(node)
        self.count[node.tag] += 1

    def cut(self, at: int) -> None:
        for node in self.stack[at:]:
            self.count[node.tag] -= 1
        del self.stack[at:]

    def end(self, tags: set[str], stop: set[str]) -> None:
        """Close the nearest open element of ``tags`` unless one of ``stop`` is nearer."""
        if not any(self.count[t] for t in tags):
            return
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag in tags:
                self.cut(i)
                return
            if self.stack[i].tag in stop:
                return


def _is_dropped(tag: str, attributes: dict[str, str], opened: _Open) -> bool:
    if tag in DROPPED:
        return True
    if tag == "header" and not (opened.count["article"] or opened.count["main"]):
        return True
    return ("hidden" in attributes or attributes.get("aria-hidden", "").strip() == "true"
            or attributes.get("role", "").strip() in DROPPED_ROLES)


def _attributes(tag: str, text: str) -> dict[str, str]:
    """The attributes that can drop an element, lower-cased; the first of a name counts."""
    out: dict[str, str] = {}
    if text and tag not in ("html", "body", "article", "main"):
        for m in _ATTR.finditer(text):
            if m[1].lower() in _READ:
                value = m[2] or m[3] or m[4] or ""
                out.setdefault(m[1].lower(), (unescape(value) if "&" in value else value).lower())
    return out


def _names(attributes: dict[str, str]) -> list[str]:
    found = []
    for name in f"{attributes.get('class', '')} {attributes.get('id', '')}".split():
        words = _WORD.findall(name)
        if words and words[0] not in _STATES and not DROPPED_WORDS.isdisjoint(words):
            found.append(name)
    return found


def drop_named(root: Node) -> None:
    """Drops elements by the words of their classes and ids where that leaves the article."""
    nodes = _ordered(root)
    if not any(n.names for n in nodes):
        return
    chars: dict[int, int] = {}
    told: dict[int, int] = {}  # text in article and main elements
    for node in reversed(nodes):
        below = [c for c in node.children if isinstance(c, Node) and not c.dropped]
        chars[id(node)] = (sum(len("".join(c.split())) for c in node.children if not isinstance(c, Node))
                           + sum(chars[id(c)] for c in below))
        told[id(node)] = chars[id(node)] if node.tag in ("article", "main") else sum(told[id(c)] for c in below)
    held: dict[str, int] = {}
    above: dict[int, frozenset[str]] = {}
    for node in nodes:  # parents first: of nested elements of one name the outer one counts
        before = above[id(node.parent)] if id(node.parent) in above else frozenset()
        for name in set(node.names) - before:
            held[name] = held.get(name, 0) + chars[id(node)]
        above[id(node)] = before.union(node.names) if node.names else before
    inside = {id(root): _in_article(root)}
    for node in nodes:
        if node is not root:
            inside[id(node)] = inside[id(node.parent)] or node.tag in ("article", "main")
        lone = told[id(root)] > told[id(node)] and not inside[id(node)]
        node.dropped |= any(2 * held[name] < chars[id(root)] or (lone and name in DROPPED_WORDS) for name in node.names)


def _in_article(node: Node) -> bool:
    while node is not None and node.tag not in ("article", "main"):
        node = node.parent
    return node is not None


def parse(html: str) -> Node:
    """The page's tree; text is unescaped."""
    root = Node("html", None)
    opened, at, n = _Open(root), 0, len(html)
    stack = opened.stack
    while at < n:
        m = _TOKEN.search(html, at)
        text = html[at: m.start() if m else n]
        if text:
            stack[-1].children.append(unescape(text))
        if not m:
            break
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag or tag == "html":
            continue
        if m[1]:  # end tag: closes the nearest open element of its name, if there is one
            for i in range(len(stack) - 1, 0, -1) if opened.count[tag] else ():
                if stack[i].tag == tag:
                    opened.cut(i)
                    break
                if stack[i].tag in ("table", "article", "body") and tag not in BLOCKS:
                    break  # a stray inline end tag
            continue
        if tag in _ENDS_P:
            opened.end({"p"}, {"button", "table", "td", "th"})
        if tag in _ENDS:
            opened.end(*_ENDS[tag])
        if tag == "body":
            opened.end({"head"}, set())
        node = Node(tag, stack[-1])
        attributes = _attributes(tag, m[3])
        node.dropped = _is_dropped(tag, attributes, opened)
        node.names = _names(attributes)
        stack[-1].children.append(node)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(html, at)
            if not node.dropped:
                node.children.append(html[at: end.start() if end else n])
            at = end.end() if end else n
        elif tag not in VOID and not m[0].endswith("/>"):
            opened.push(node)
    return root


def _ordered(root: Node) -> list[Node]:
    """All nodes that are not dropped, parents before children."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out.append(node)
        todo += [c for c in reversed(node.children) if isinstance(c, Node) and not c.dropped]
    return out


def measure(root: Node) -> list[Node]:
    """Counts, densities and sums of all nodes below ``root``; inline elements belong to their block's density."""
    nodes = _ordered(root)
    for node in reversed(nodes):
        for c in node.children:
            if isinstance(c, Node):
                if not c.dropped:
                    node.chars += c.chars
                    node.tags += c.tags + 1
                    node.link_chars += c.link_chars
                    node.link_tags += c.link_tags + (c.tag == "a")
                    node.block |= c.block
            else:
                node.chars += len("".join(c.split()))
        if node.tag == "a":
            node.link_chars = node.chars
    body_share = root.link_chars / max(root.chars, 1)
    for node in reversed(nodes):
        c, t = node.chars, max(node.tags, 1)
        if c:
            lc, lt = max(node.link_chars, 1), max(node.link_tags, 1)
            base = math.log(c / max(c - node.link_chars, 1) * node.link_chars + body_share * c + math.e)
            adjusted = c / lc * t / lt
            node.density = c / t * (math.log(adjusted) / math.log(base) if base > 1.0 + 1e-9 else math.log(max(adjusted, 1.0)))
            node.density = max(node.density, 0.0)
        node.total = sum(k.density for k in node.children if isinstance(k, Node) and not k.dropped and k.block)
    return nodes


def select(root: Node) -> list[Node]:
    """The subtrees that are the article, in page order."""
    nodes = measure(root)
    if not root.chars:
        return []
    best = max(nodes, key=lambda n: n.total)
    node = best
    while node is not None:  # markup that names the article outranks the density inside it
        if node.tag in ("article", "main"):
            best = node
            break
        node = node.parent
    threshold, node = best.density, best
    while node is not None:
        threshold = min(threshold, node.density) if node.chars else threshold
        node = node.parent
    best_of: dict[int, Node] = {}
    for node in reversed(nodes):  # the greatest sum in each subtree; the upper node wins ties
        top = node
        for c in node.children:
            if isinstance(c, Node) and not c.dropped and best_of[id(c)].total > top.total:
                top = best_of[id(c)]
        best_of[id(node)] = top
    above, node = set(), best.parent
    while node is not None:
        above.add(id(node))
        node = node.parent
    chosen, todo = [], [root]
    while todo:  # from the body down: the path to the best node is opened, what is beside it stands for itself
        node = todo.pop()
        if node is best:
            chosen.append(node)
        elif id(node) in above:
            todo += [c for c in reversed(node.children) if isinstance(c, Node) and not c.dropped]
        elif node.tag in HEADINGS and node.parent is not root and node.chars:
            chosen.append(node)
        elif node.chars and node.density >= threshold:
            chosen.append(best_of[id(node)] if best_of[id(node)].total > 0 else node)
    return chosen


def blocks(node: Node) -> list[str]:
    """The block texts of a subtree, white space made one space."""
    out, run = [], []

    def flush():
        text = " ".join("".join(run).split())
        if text:
            out.append(text)
        run.clear()

    todo: list = [node]
    while todo:
        x = todo.pop()
        if x is None:
            flush()
        elif isinstance(x, str):
            run.append(x)
        elif not x.dropped or x is node:
            if x.tag == "br":
                run.append(" ")
            if x.tag in BLOCKS:
                flush()
                todo.append(None)
            todo += reversed(x.children)
    flush()
    return out


def main_text(html: str | None) -> str:
    if not html:
        return ""
    root = parse(html)
    body = next((c for c in root.children if isinstance(c, Node) and c.tag == "body"), root)
    drop_named(body)
    return "\n".join(t for node in select(body) for t in blocks(node))


def extract_pages(df: DataFrame, html_col: str = "html", text_col: str = "text", count_col: str = "n_chars",
                  keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The ``keep`` columns with each page's main text and its number of code points."""
    rows = df.select(*keep, html_col)
    schema = T.StructType([*(rows.schema[c] for c in keep), T.StructField(text_col, T.StringType()),
                           T.StructField(count_col, T.LongType())])

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(x.as_py()) for x in b.column(b.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())], names=schema.names)

    return map_arrow(rows, extract, schema)
