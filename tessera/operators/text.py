"""Text and document jobs (TXT-*).

Counting, search, line hygiene, token statistics and chat-history trimming
are built-in column expressions and windows.  Chunkers and the HTML walk run
per document in small Arrow batches (``cut_texts``): Spark partitions and
shuffles the documents; the Python helpers below only cut one text.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Sequence
from html.parser import HTMLParser

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.common import cut_texts

WORD_RE = r"[\p{L}\p{N}_]+"
TOKEN_RE = r"[^ \t\n\r\f]+"


def _whole_word(word: str) -> str:
    return rf"(^|[^\p{{L}}\p{{N}}_]){re.escape(word)}([^\p{{L}}\p{{N}}_]|$)"


def words(text: Column) -> Column:
    """Lower-cased words (runs of letters, digits and underscores of any script).  Extracting the
    matches is about twice as fast as splitting on the complement and needs
    no empty-string filter."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD_RE), 0)


def word_count(df: DataFrame, text: str, by: Sequence[str] = ()) -> DataFrame:
    """TXT-01: word frequencies (sort by count where a report needs it)."""
    return (df.select(*by, F.explode(words(F.col(text))).alias("word"))
              .groupBy(*by, "word").agg(F.count(F.lit(1)).alias("n")))


def repeated_words(df: DataFrame, text: str, by: Sequence[str] = ()) -> DataFrame:
    """TXT-02: words occurring more than once."""
    return word_count(df, text, by).filter("n > 1")


def find_replace(df: DataFrame, text: str, old: str, new: str, out: str = "replaced") -> DataFrame:
    """TXT-03: whole-word hits (a boundary is any character but letters,
    digits and underscores) and the text with the word replaced."""
    pat = _whole_word(old)
    return (df.withColumn("hits", F.regexp_count(F.col(text), F.lit(pat)))
              .withColumn(out, F.regexp_replace(F.col(text), pat, f"$1{new}$2")))


_CONTROL = "[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F\\x7F]"


def clean_lines(df: DataFrame, text: str, drop_blank: bool = True, reverse: bool = False,
                out: str = "clean") -> DataFrame:
    """TXT-04: strip control characters, drop blank lines, optionally reverse
    line order."""
    lines = F.split(F.regexp_replace(F.col(text), _CONTROL, ""), "\n")
    if drop_blank:
        lines = F.filter(lines, lambda x: F.trim(x) != "")
    if reverse:
        lines = F.reverse(lines)
    return df.withColumn(out, F.array_join(lines, "\n"))


def token_count(text: Column) -> Column:
    """Whitespace tokens (the default offline counter)."""
    return F.size(F.regexp_extract_all(text, F.lit(TOKEN_RE), 0))


def token_stats(df: DataFrame, by: Sequence[str], text: str, limit: int) -> DataFrame:
    """TXT-10: tokens, chars and tokens per char by group; over-limit docs."""
    d = df.withColumn("_tok", token_count(F.col(text))).withColumn("_chr", F.length(text))
    return d.groupBy(*by).agg(F.sum("_tok").alias("tokens"), F.sum("_chr").alias("chars"),
                              F.try_divide(F.sum("_tok"), F.sum("_chr")).alias("tokens_per_char"),
                              F.count_if(F.col("_tok") > limit).alias("over_limit"))


def trim_history(df: DataFrame, conv: str, turn: str, role: str, text: str, budget: int) -> DataFrame:
    """TXT-12: newest turns whose running token total fits ``budget``; the
    kept window must start on a user turn; system turns are always kept."""
    from tessera.operators.common import join_on, prefix_sum
    d = df.withColumn("_tok", token_count(F.col(text)))
    body = d.filter(F.col(role) != "system")
    # newest first: running tokens by descending turn, chunked by turn blocks
    body = prefix_sum(body.withColumn("_neg", -F.col(turn)), [conv], [F.col("_neg")], "_tok", "_run",
                      F.floor(F.col("_neg") / 1000)).drop("_neg").filter(F.col("_run") <= budget)
    first_user = body.filter(F.col(role) == "user").groupBy(conv).agg(F.min(turn).alias("_fu"))
    body = join_on(body, first_user, [conv]).filter(F.col(turn) >= F.col("_fu")).drop("_fu", "_run")
    return body.unionByName(d.filter(F.col(role) == "system")).drop("_tok")


def thread_stats(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """TXT-13: per conversation: turns, first role, alternation check, chars."""
    w = Window.partitionBy(conv).orderBy(turn)
    d = df.withColumn("_prev", F.lag(role).over(w))
    return d.groupBy(conv).agg(F.count(F.lit(1)).alias("turns"), F.min_by(role, turn).alias("first_role"),
                               F.bool_and(F.col("_prev").isNull() | (F.col("_prev") != F.col(role))).alias("alternates"),
                               F.sum(F.length(text)).alias("chars"))


def threads(df: DataFrame, conv: str, turn: str, role: str, text: str, turns_per_chunk: int = 1000) -> DataFrame:
    """TXT-13: the ordered thread of each conversation as ``role: text``
    lines with their character offset in the assembled thread (lines are
    joined by newlines).  Offsets are a chunked prefix sum over turns, so a
    very long conversation is neither gathered into one row nor one task;
    writing the lines in (conv, offset) order yields the thread text."""
    from tessera.operators.common import prefix_sum
    d = df.withColumn("line", F.concat(F.col(role), F.lit(": "), F.col(text))) \
          .withColumn("_len", F.length("line") + 1)
    d = prefix_sum(d, [conv], [F.col(turn)], "_len", "_end", F.floor(F.col(turn) / turns_per_chunk))
    return d.select(conv, turn, "line", (F.col("_end") - F.col("_len")).alias("char_offset"))


# ---------------------------------------------------------------- chunking

DEFAULT_SEPARATORS = ["\n\n", "\n", " ", ""]


def _measure(text: str, length: Callable[[str], int]) -> Callable[[int, int], int]:
    """``length(text[a:b])`` as a function of (a, b): constant time for
    characters, two binary searches over the token starts for tokens."""
    if length is len:
        return lambda a, b: b - a
    if length is _token_len:
        spans = [m.span() for m in re.finditer(TOKEN_RE, text)]
        starts, ends = [s for s, _ in spans], [e for _, e in spans]
        return lambda a, b: bisect_left(starts, b) - bisect_right(ends, a) if b > a else 0
    return lambda a, b: length(text[a:b])


def _pieces(text: str, start: int, end: int, seps: Sequence[str], size: int, measure) -> list[tuple[int, int]]:
    """Cut ``text[start:end]`` into contiguous pieces no longer than ``size``:
    split on the first separator present (separator kept at the end of its
    piece), go on in over-long pieces with the next separators; the empty
    separator cuts characters."""
    if measure(start, end) <= size:
        return [(start, end)]
    for i, sep in enumerate(seps):
        if sep == "":
            out, pos = [], start
            while pos < end:
                stop = pos + 1
                while stop < end and measure(pos, stop + 1) <= size:
                    stop += 1
                out.append((pos, stop))
                pos = stop
            return out
        if text.find(sep, start, end) >= 0:
            out, pos = [], start
            while pos < end:
                at = text.find(sep, pos, end)
                stop = at + len(sep) if at >= 0 else end
                out += [(pos, stop)] if measure(pos, stop) <= size else _pieces(text, pos, stop, seps[i + 1:], size, measure)
                pos = stop
            return out
    return [(start, end)]


def split_text(text: str, size: int, overlap: int, seps: Sequence[str] = DEFAULT_SEPARATORS,
               length: Callable[[str], int] = len) -> list[tuple[int, int, str]]:
    """Greedy merge of pieces into chunks of at most ``size`` (by ``length``);
    each next chunk starts with trailing pieces of the previous one worth at
    most ``overlap``, as far as they leave room for a piece beyond it, so no
    chunk lies inside another.  Returns (start, end, chunk) with
    chunk = text[start:end]."""
    if not text:
        return []
    measure = _measure(text, length)
    pieces = _pieces(text, 0, len(text), list(seps), size, measure)
    chunks, i, n = [], 0, len(pieces)
    while i < n:
        j = i
        while j + 1 < n and measure(pieces[i][0], pieces[j + 1][1]) <= size:
            j += 1
        s, e = pieces[i][0], pieces[j][1]
        chunks.append((s, e, text[s:e]))
        if j + 1 >= n:
            break
        k = j + 1
        while k - 1 > i and measure(pieces[k - 1][0], e) <= overlap:
            k -= 1
        while k <= j and measure(pieces[k][0], pieces[j + 1][1]) > size:
            k += 1  # this much overlap would leave no room for the next piece
        i = k
    return chunks


def _token_len(s: str) -> int:
    return len(re.findall(TOKEN_RE, s))


CHUNK_SCHEMA = "doc_id long, chunk_no int, start int, end int, chunk string"


def chunk_recursive(df: DataFrame, id_col: str, text: str, size: int, overlap: int,
                    seps: Sequence[str] = DEFAULT_SEPARATORS, counter: str = "chars") -> DataFrame:
    """TXT-05: recursive character chunking, one text at a time; output
    (doc_id, chunk_no, start, end, chunk)."""
    length = _token_len if counter == "tokens" else len
    seps = list(seps)

    def cut(t: str):
        for k, (s, e, c) in enumerate(split_text(t, size, overlap, seps, length)):
            yield k, s, e, c

    return cut_texts(df, id_col, text, cut, CHUNK_SCHEMA)


def chunk_fixed(df: DataFrame, id_col: str, text: str, sep: str, size: int, overlap: int) -> DataFrame:
    """TXT-06: one separator, size, overlap (pieces over the size stay whole
    when the separator cannot cut them further)."""
    return chunk_recursive(df, id_col, text, size, overlap, [sep], "chars")


def chunk_tokens(df: DataFrame, id_col: str, text: str, size: int, overlap: int) -> DataFrame:
    """TXT-07: size and overlap counted in tokens (whitespace tokens)."""
    return chunk_recursive(df, id_col, text, size, overlap, DEFAULT_SEPARATORS, "tokens")


def with_meta(chunks: DataFrame, docs: DataFrame, id_col: str, cols: Sequence[str]) -> DataFrame:
    """TXT-11: document metadata carried to each chunk as a map column."""
    meta = docs.select(F.col(id_col).alias("doc_id"),
                       F.create_map(*[x for c in cols for x in (F.lit(c), F.col(c).cast("string"))]).alias("metadata"))
    return chunks.join(meta, "doc_id", "left")


def chunk_audit(chunks: DataFrame, docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """TXT-14: per document: chunks rebuild the text (first starts at 0,
    last ends at the length, no gap between neighbours) and the overlap."""
    w = Window.partitionBy("doc_id").orderBy("chunk_no")
    c = chunks.withColumn("_next", F.lead("start").over(w))
    g = c.groupBy("doc_id").agg(F.min("start").alias("first_start"), F.max("end").alias("last_end"),
                                F.count_if(F.col("_next") > F.col("end")).alias("gaps"),
                                F.max(F.col("end") - F.col("_next")).alias("max_overlap"),
                                F.count(F.lit(1)).alias("chunks"))
    d = docs.select(F.col(id_col).alias("doc_id"), F.length(text).alias("length"))
    return d.join(g, "doc_id", "left").withColumn(
        "covered", (F.coalesce("first_start", F.lit(0)) == 0) & (F.coalesce("last_end", F.lit(0)) == F.col("length"))
        & (F.coalesce("gaps", F.lit(0)) == 0))


# ------------------------------------------------------------------- HTML

_SKIP = {"script", "style", "nav", "noscript", "template", "head"}
_HEADERS = ("h1", "h2", "h3")


class _Walker(HTMLParser):
    def __init__(self, headers, main_tags):
        super().__init__(convert_charrefs=True)
        self.headers, self.main_tags = headers, main_tags
        self.skip = 0
        self.path = {h: None for h in headers}
        self.cur_header = None
        self.sections, self.buf = [], []
        self.main_depth, self.main_text = 0, []

    def _flush(self):
        txt = " ".join(" ".join(self.buf).split())
        if txt:
            self.sections.append((*(self.path[h] for h in self.headers), txt))
        self.buf = []

    def handle_starttag(self, tag, attrs):
        if tag in _SKIP:
            self.skip += 1
        elif tag in self.headers:
            self._flush()
            self.cur_header = tag
            self.hbuf = []
        if tag in self.main_tags:
            self.main_depth += 1

    def handle_endtag(self, tag):
        if tag in _SKIP:
            self.skip = max(0, self.skip - 1)
        elif tag in self.headers and self.cur_header == tag:
            level = self.headers.index(tag)
            self.path[tag] = " ".join(" ".join(self.hbuf).split())
            for deeper in self.headers[level + 1:]:
                self.path[deeper] = None
            self.cur_header = None
        if tag in self.main_tags:
            self.main_depth = max(0, self.main_depth - 1)

    def handle_data(self, data):
        if self.skip:
            return
        if self.cur_header:
            self.hbuf.append(data)
        else:
            self.buf.append(data)
        if self.main_depth:
            self.main_text.append(data)


def split_html(html: str, headers=_HEADERS) -> list[tuple]:
    w = _Walker(tuple(headers), ())
    w.feed(html or "")
    w.close()
    w._flush()
    return w.sections


def extract_main(html: str, tags=("main", "article")) -> str:
    w = _Walker((), tuple(tags))
    w.feed(html or "")
    w.close()
    return " ".join(" ".join(w.main_text).split())


def chunk_html(df: DataFrame, id_col: str, html: str, headers: Sequence[str] = _HEADERS) -> DataFrame:
    """TXT-08: text under h1/h2/h3 with the header path as columns."""
    heads = list(headers)
    schema = f"{id_col} long, section_no int, " + ", ".join(f"{h} string" for h in heads) + ", text string"

    def cut(doc: str):
        for k, sec in enumerate(split_html(doc, heads)):
            yield k, *sec

    return cut_texts(df, id_col, html, cut, schema)


def main_text(df: DataFrame, id_col: str, html: str, tags: Sequence[str] = ("main", "article")) -> DataFrame:
    """TXT-09: text of main/article; scripts, styles and navigation dropped."""
    def cut(doc: str):
        yield (extract_main(doc, tuple(tags)),)

    return cut_texts(df, id_col, html, cut, f"{id_col} long, main_text string")
