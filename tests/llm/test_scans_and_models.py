import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import license_scan
from tessera.llm.html_text import extract_pages, main_text
from tessera.llm.language_id import add_language, fit, held_out, trigrams
from tessera.llm.topk_nra import top_k
from tessera.llm.url_filter import UrlFilter, segment, url_parts

RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"),
         ("com", "/de/", "block")]


def test_main_text():
    assert main_text(None) == main_text("") == main_text("<nav>a</nav>") == ""
    page = ('<!DOCTYPE html><html><head><title>T</title><script>var a="</p>";</script></head><body><header><h1>Site</h1></header>'
            '<nav><ul><li><a href=x>Home</a><li><a href=y>About</a></ul></nav><div class="cookie-notice">We use cookies here</div>'
            '<article><header><h1>Head &amp; line</h1></header><p><b>First <i>para</i>graph<br>goes &copy; on\n  here.<p>Second&nbsp;one '
            'with <a href=z>a link</a>.</p><ul><li>item one<li>item two</ul><table><tr><td>cell<td>next</table>'
            '<form><input><label>Mail</label></form></article>'
            '<section id="comments"><p>A reader says a lot of things that go on and on and on.</p></section>'
            '<aside><p>See also this long list of other things to read.</p></aside><footer>&copy; someone</footer></body></html>')
    assert main_text(page) == ("Head & line\nFirst paragraph goes © on here.\nSecond one with a link.\nitem one\nitem two\n"
                               "cell\nnext")
    plain = "<div><div id=top><a href=1>one</a> <a href=2>two</a> <a href=3>three</a></div><div><p>%s</p><p>%s</p></div></div>" % (
        "long text of the article " * 8, "and some more of this text " * 6)
    assert main_text(plain) == "\n".join([("long text of the article " * 8).strip(), ("and some more of this text " * 6).strip()])
    assert main_text("<p>cut off in a refer&am") == "cut off in a refer&am"
    assert main_text("just words, no tags &lt;b&gt;") == "just words, no tags <b>"
    assert main_text("<article><p>a</p>" + "<div>" * 3000 + "deep" + "</div>" * 3000 + "</article>") == "a\ndeep"
    assert main_text("<p>" + "word " * 200_000).count("word") == 200_000


def test_extract_rows(spark):
    df = spark.createDataFrame([(1, "u", "<p>Größe</p>", "x"), (1, "u", "<p>Größe</p>", "x"), (2, None, None, "x"), (None, "v", "", "x")],
                               "page_id long, url string, html string, text string")
    assert sorted(map(tuple, extract_pages(df).collect()), key=str) == sorted(
        [(1, "u", "Größe", 5), (1, "u", "Größe", 5), (2, None, "", 0), (None, "v", "", 0)], key=str)
    assert extract_pages(df.limit(0)).count() == 0


def _parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    return host.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")), re.match(r"[^?#]*", rest[len(host):]).group()


def test_url_filter(spark):
    urls = ["http://A.example.org/es/1?x", "https://example.org/en/12", "http://x.org", "http://x.org/", "http://casinowin.example.net/a",
            "http://shop.example.net/en/1", "nothing", None, "", "://", "a://b://c/d", "http://h?/x", "http://h#a/b", "http://t.com/fr/",
            "http://t.com/de/x\ny", "http://notcom/de/", "http://É.com/de/É", "http://" + "a" * 5000 + ".net/x"]
    urls += [f"http://blog{i}.example.net/en/{i}" for i in range(40)] + [f"http://casino{w}.example.net/spin/{w}" for w in ("win", "bets", "free") * 4]
    urls += ["http://blog1.example.net/en/1"] * 5
    df = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, host string")
    got = {r.page_id: r for r in UrlFilter(RULES).fit(df, "url").judge(df, "url").collect()}
    assert len(got) == len(urls)
    for i, u in enumerate(urls):
        host, path = _parts(u)
        assert (got[i].host, got[i].path) == (host, path), u
        fits = [(h + p, v) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        want = max(fits, key=lambda f: len(f[0])) if fits else (None, None)
        assert got[i].rule == want[0]
        assert got[i].verdict == (want[1] or ("block" if got[i].log_odds > 0 else "allow"))
    assert got[4].verdict == "block" and got[5].verdict == "allow" and "casino" in got[4].host_words
    assert UrlFilter(RULES).fit(df.limit(0), "url").judge(df.limit(0), "url").count() == 0
    df.select(*url_parts("url")).collect()


def test_segmentation_is_the_cheapest_split():
    cost = {"free": 2.0, "bets": 3.0, "freeb": 9.0, "ets": 4.0}
    assert segment("freebets", cost, 10.0) == ["free", "bets"]
    assert segment("zq", cost, 10.0) == ["zq"]
    assert segment("", cost, 10.0) == [""]


def _dice_by_hand(text, least=0.8):
    known = []
    norm = lambda t: re.sub(r"[^a-zà-ÿ0-9]+", " ", t.lower()).replace("licence", "license").split()
    for name, t in license_scan.TEMPLATES:
        w = norm(t)
        known.append((name, set(zip(w, w[1:]))))
    lines = (text or "").split("\n")
    hits = []
    for n, unit in enumerate(lines + ([text] if len(lines) > 1 else [])):
        w = norm(unit or "")
        a = set(zip(w, w[1:]))
        scores = [(2.0 * len(a & b) / (len(a) + len(b)) if a else 0.0, -k) for k, (_, b) in enumerate(known)]
        if max(scores)[0] >= least:
            hits.append((*max(scores), -n))
    best = max(hits, default=(0.0, None, 1))
    return (len(lines), len(hits), ",".join(sorted({known[-h[1]][0] for h in hits})), known[-best[1]][0] if hits else "",
            -best[2], best[0])


def test_license_scan(spark):
    long = license_scan.TEMPLATES[4][1]
    texts = [None, "", "x", "Licensed under CC BY-NC 4.0", "a line\nReleased under the MIT licence.\nmore", "released  under the mit license, really",
             long, long.replace(". ", ".\n"), "Copyright 2020\n" + long, "words " * 50_000, "Licensed under CC BY-NC 4.0.\n" * 3,
             "This work is licensed under the GNU General Public License, version 3", "this work is licensed"]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)] + [(3, texts[3], 1)], "doc_id long, text string, dice int")
    got = license_scan.scan(df).collect()
    assert len(got) == len(texts) + 1
    for r in got:
        assert tuple(r)[1:] == _dice_by_hand(texts[r.doc_id]), texts[r.doc_id]
    plan = license_scan.scan(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
    assert license_scan.scan(df.limit(0)).count() == 0


def test_size_bounds_are_exact():
    for t in license_scan.prepare(license_scan.TEMPLATES, 0.8):
        n = len(t.bigrams)
        for size in range(1, 5 * n):
            reach = 2.0 * min(size, n) / (size + n) >= 0.8
            assert reach == (t.low <= size <= t.high)


@pytest.mark.parametrize("dims", [8, 3])
def test_exact_top_k(spark, dims):
    rng = np.random.default_rng(dims)
    vectors = [(int(i), rng.normal(size=dims).round(2).tolist()) for i in range(3000)]
    vectors += [(3000 + i, vectors[20][1]) for i in range(200)]                      # ties
    vectors += [(4000, None), (4020, [float("nan")] * dims), (4040, [float("inf")] * dims), (4060, [None] * dims), (None, vectors[0][1])]
    vectors += [vectors[40], vectors[40], (4080, [1.0]), (4100, [2.0, 1.0][: 1]), (60, vectors[61][1])]
    df = spark.createDataFrame([(i, v, 0) for i, v in vectors], "vec_id long, embedding array<double>, score int")
    usable = [(i, [math.floor(64 * c) for c in v]) for i, v in vectors
              if i is not None and v is not None and all(c is not None and math.isfinite(c) for c in v)]
    want = []
    for at, (q, y) in enumerate(usable):
        if q % 20 == 0:
            best = sorted((-sum(a * b for a, b in zip(y, x)), i) for n, (i, x) in enumerate(usable) if n != at and len(x) == len(y))[:20]
            want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    got = top_k(df, F.col("vec_id") % 20 == 0, group_queries=64, slab_rows=1500)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert top_k(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_top_k_beyond_float_precision(spark):
    big = [(i, [float(2**24 + i), float(-(2**23) + 3 * i)]) for i in range(50)]
    df = spark.createDataFrame(big, "vec_id long, embedding array<double>")
    x = {i: [math.floor(64 * c) for c in v] for i, v in big}
    want = {(q, n + 1, i, -s) for q in x if q % 20 == 0 for n, (s, i) in enumerate(sorted(
        (-sum(a * b for a, b in zip(x[q], y)), i) for i, y in x.items() if i != q)[:20])}
    assert {tuple(r) for r in top_k(df, F.col("vec_id") % 20 == 0).collect()} == want


def test_language_of_held_out_documents(spark, sf):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = fit(docs.where(~held_out("doc_id")))
    rows = add_language(docs.withColumn("out", held_out("doc_id")), model).where("out").collect()
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.95
    assert all(0.0 <= r.score <= 1.0 for r in rows)
    assert sum(r.rejected for r in rows) / len(rows) < 0.01
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "123 --"), (4, "a"), (5, "the and of " * 100_000), (None, "le la les")],
                                "doc_id long, text string")
    got = {r.doc_id: r for r in add_language(odd, model).collect()}
    for i in (1, 2, 3):
        assert (got[i].lang_pred, got[i].score, got[i].rejected) == ("und", 0.0, True)
    assert all(got[i].lang_pred in {"en", "de", "fr", "es"} for i in (4, 5, None))
    assert add_language(odd.limit(0), model).count() == 0
    empty = fit(docs.limit(0))
    assert {r.lang_pred for r in add_language(odd, empty).collect()} == {"und"}
    junk = " ".join("".join(random.Random(n).choices("bcdfghjklmnpqrstvwxz", k=9)) for n in range(400))
    assert model.predict([junk])[0][2]


def test_trigrams_of_long_texts_are_those_of_their_parts():
    text = "wörter und " * 200_000
    places, counts, n = trigrams(text)
    assert n == counts.sum() and set(places) == set(trigrams("wörter und wörter und")[0])


def test_headline_outside_the_text_container():
    text = "this is a sentence of the article that goes on for a while, " * 4
    body = f"<h1>Short</h1><div class=text><p>{text}</p><p>Tiny.</p><p>{text}</p></div>"
    want = "\n".join(["Short", text.strip(), "Tiny.", text.strip()])
    assert main_text(f"<body><article>{body}</article></body>") == want
    assert main_text(f"<body><div id=page><div>{body}</div><div class=related><p>{text}</p></div></div></body>") == want


@pytest.mark.parametrize("attributes", [
    'style="overflow:hidden"', 'title="Hidden gems"', 'data-id="comment-4"', "data-x='a class=ad b'", "data-hidden", 'class="content has-sidebar"',
    'class="post with-comments"', 'class="elementor-widget"', "class=widget", 'id="social-history"', 'aria-hidden="false"'])
def test_the_article_stays_whatever_its_attributes_hold(attributes):
    text = "this is a sentence of the article that goes on for a while, " * 4
    rest = '<div class="sidebar"><p>%s</p></div>' % ("look at this, " * 5)
    want = "\n".join([text.strip()] * 2)
    assert main_text(f"<body><div {attributes}><p>{text}</p><p>{text}</p></div>{rest}</body>") == want
    assert main_text(f"<body><div {attributes}><p>{text}</p><p>{text}</p>{rest}</div></body>") == want


def test_hidden_and_named_elements_go():
    text = "this is a sentence of the article that goes on for a while, " * 4
    for attributes in ("hidden", 'hidden=""', 'HIDDEN="until-found" id=x', "data-x=y hidden", 'aria-hidden="true"', 'role="banner"',
                       'class="x cookie-notice"', "id='comments'", 'class="&#97;d"'):
        assert main_text(f"<body><div><p>{text}</p><p>{text}</p></div><div {attributes}><p>{text}</p></div></body>") == "\n".join([text.strip()] * 2)
    assert main_text(f"<body><article><p>{text}</p></article><div id=comments><p>{text}</p><p>{text}</p></div></body>") == text.strip()


def test_wrapped_and_embedded_notices(spark):
    def wrapped(n, width=9, mark="# "):
        w = license_scan.TEMPLATES[n][1].split()
        return "\n".join(mark + " ".join(w[i:i + width]) for i in range(0, len(w), width))

    code = "\n".join(f"def f{i}(a, b):\n    return a of the b in the {i}" for i in range(60))
    head = "Copyright 2020 someone\n"
    cases = [(head + wrapped(n) + "\n" + code, name) for n, name in ((1, "Apache-2.0"), (4, "MIT"), (6, "GPL-3.0"), (13, "ISC"), (14, "MPL-2.0"))]
    cases += [(code + "\n" + wrapped(4, 7, " * ").replace("THE AUTHORS OR", "THE AUTHORS, THE HOST, THE GUESTS OR") + "\n" + code, "MIT"),
              ("See the manual. Licensed under CC BY-NC 4.0. All other questions go to the editors of this page.", "CC-BY-NC-4.0"),
              ("Some words before it. This work is licensed under the GNU General\nPublic License, version 2. And some after it.", "GPL-2.0"),
              ("All of it is\nreleased under the\nMIT licence. Have a good day and tell us about it.", "MIT"),
              (head + wrapped(4) + "\n" + code + "\n" + wrapped(14), "MIT,MPL-2.0"),
              (code, ""), ("The license of the work is not under the control of the authors or the software.\n" * 5, "")]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "doc_id long, text string")
    got = {r.doc_id: r for r in license_scan.scan(df).collect()}
    for i, (text, name) in enumerate(cases):
        assert got[i].licenses == name, text
        assert (got[i].dice >= 0.8) == bool(name)
    assert [got[i].line for i in (0, 1, 2, 3, 4, 6, 7)] == [1, 1, 1, 1, 1, 0, 0] and got[5].line == 120
    assert [got[i].n_hits for i in (1, 2, 5, 6, 7, 8, 9, 10)] == [1, 1, 1, 1, 1, 1, 2, 0]


def _noisy(n, rng):
    """A template's words with a few exchanged."""
    words = license_scan.TEMPLATES[n][1].split()
    for at in rng.sample(range(len(words)), max(1, len(words) // 25)):
        words[at] = f"noise{rng.randint(0, 10**6)}"
    return words


def test_neighbouring_notices_count_each(spark):
    rng = random.Random(2)
    texts, want = [], []
    code = "\n".join(f"value_{i} = compute(value_{i + 1}, {i})" for i in range(400)) + "\n"
    for n, name in ((4, "MIT"), (16, "BSD-3-Clause"), (19, "Zlib")):
        for many in (1, 2, 5, 20):
            words = [w for _ in range(many) for w in _noisy(n, rng)]
            texts.append(code + "\n".join(" ".join(words[i: i + 9]) for i in range(0, len(words), 9)))
            want.append((many, name))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_hits, r.licenses) for r in license_scan.scan(df).collect()}
    assert [got[i] for i in range(len(texts))] == want


def test_every_template_finds_itself(spark):
    rows = []
    for n, (name, text) in enumerate(license_scan.TEMPLATES):
        words = text.split()
        rows += [(2 * n, text, name), (2 * n + 1, "# start of file\n" + "\n".join(
            " ".join(words[i: i + 8]) for i in range(0, len(words), 8)) + "\nint main(void) { return 0; }\n" * 40, name)]
    df = spark.createDataFrame(rows, "doc_id long, text string, name string")
    got = {r.doc_id: r for r in license_scan.scan(df).collect()}
    assert {i: got[i].licenses for i, _, _ in rows} == {i: name for i, _, name in rows}
    assert all(got[i].dice == 1.0 for i, _, _ in rows if i % 2 == 0)


def _windows_by_hand(text, templates, least):
    """Hits (dice, -template, -line) by the definition: lines, the whole text, windows from run to run, best first."""
    norm = lambda t: re.sub(r"[^a-z0-9]+", " ", t.lower()).split()
    pairs = lambda w: list(zip(w, w[1:]))
    known = [(name, pairs(norm(t))) for name, t in templates]
    lines = text.split("\n")
    hits = []
    for n, unit in enumerate(lines + ([text] if len(lines) > 1 else [])):
        a = set(pairs(norm(unit)))
        best = max((2.0 * len(a & set(b)) / (len(a) + len(set(b))) if a else 0.0, -k) for k, (_, b) in enumerate(known))
        if best[0] >= least:
            hits.append((*best, -n))
    at = [i for i, x in enumerate(lines) for _ in norm(x)]
    g = pairs([w for x in lines for w in norm(x)])
    found = []
    for k, (name, b) in enumerate(known):
        shared = [x in set(b) for x in g]
        starts = [i for i, x in enumerate(shared) if x and not (i and shared[i - 1])]
        ends = [i for i, x in enumerate(shared) if x and not (i + 1 < len(g) and shared[i + 1])]
        for s in starts:
            for e in ends:
                own = set(g[s: e + 1])
                again = sum(max(0, c - max(1, b.count(x))) for x, c in Counter(g[s: e + 1]).items())
                dice = 2.0 * len(own & set(b)) / (len(own) + again + len(set(b))) if e >= s else 0.0
                first, last = at[s], at[e + 1]
                opens, closes = s == 0 or at[s - 1] != first, e + 2 >= len(at) or at[e + 2] != last
                told = any(-h[2] < len(lines) and ((first == last == -h[2]) or (first == -h[2] and not opens) or
                                                   (last == -h[2] and not closes)) for h in hits)
                spare = max(x for x in range(1, 9 * len(b)) if 2.0 * len(set(b)) / (len(set(b)) + x) >= least) - len(set(b))
                far = len(b) - 1 - b[::-1].index(g[e]) - b.index(g[s]) + spare
                if dice >= least and e - s <= far and not told:
                    found.append((dice, e - s, -k, -first, -s, -e))
    kept = []
    for x in sorted(found, reverse=True):
        if all(-x[5] < -y[4] or -y[5] < -x[4] for y in kept):
            kept.append(x)
    whole = {known[-h[1]][0] for h in hits if -h[2] == len(lines)}
    return hits + [(x[0], *x[2:4]) for x in kept if known[-x[2]][0] not in whole]


def test_windows_against_all_windows(spark):
    rng = random.Random(9)
    templates = (("A", "a b c d e f g h"), ("B", "b c d x a b c d y z"), ("C", "p q r s t u v w x y z p q r"), ("A", "g h i j"))
    pieces = [t.split() for _, t in templates]
    texts = []
    for _ in range(400):
        words = []
        while len(words) < rng.randint(3, 60):
            words += [w if rng.random() > 0.06 else "n" for w in rng.choice(pieces)] if rng.random() < 0.7 else rng.choices("abcdnop", k=rng.randint(1, 5))
        texts.append("".join(w + rng.choice("    \n") for w in words).strip())
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in license_scan.scan(df, templates=templates).collect():
        hits = _windows_by_hand(texts[r.doc_id], templates, 0.8)
        best = max(hits, default=(0.0, 0, 1))
        assert (r.n_hits, r.licenses, r.dice, r.line) == (
            len(hits), ",".join(sorted({templates[-h[1]][0] for h in hits})), best[0], -best[2]), texts[r.doc_id]


def _cheapest(word, cost, unknown):
    """The cost of the cheapest split, over all splits."""
    best = [0.0]
    for end in range(1, len(word) + 1):
        best.append(min(best[a] + cost.get(word[a:end], unknown + 2.0 * (end - a)) for a in range(end)))
    return best[-1]


def test_segmentation_against_all_splits():
    rng = random.Random(7)
    for _ in range(300):
        cost = {"".join(rng.choices("abc", k=rng.randint(1, 6))): rng.uniform(0.5, 8) for _ in range(12)}
        word = "".join(rng.choices("abcd", k=rng.randint(2, 30)))
        got = segment(word, cost, 9.0)
        assert "".join(got) == word
        want = cost[word] if word in cost else _cheapest(word, cost, 9.0)
        assert sum(cost.get(p, 9.0 + 2.0 * len(p)) for p in got) == pytest.approx(want)


def test_url_verdicts_against_brute_force(spark):
    rng = random.Random(4)
    long_word = "verylongcompoundnamethatgoesonandonwithoutend"
    urls = [f"http://casino{w}.site{i % 7}.net/spin/spin/{w}/{i}" for i, w in enumerate(("win", "bets", "free", "slots") * 6)]
    urls += [f"http://{w}-garden.net/plants/{i}/{w}" for i, w in enumerate(("rose", "tulip", "oak", "herb") * 6)]
    # hosts without a word of the list, judged by what blocked hosts and their paths have beside it
    urls += ["http://luckyreel.net/spin/spin/spin", "http://rosetulip.net/plants/oak", "http://luckyreel.net/spin/spin/spin",
             f"http://shop.net/{long_word}/x", f"http://{'q' * 280}{long_word}rose{'z' * 300}.net/{'w' * 400}", "http://tuliprose.net/spin/plants/plants"]
    urls += ["http://" + "".join(rng.choices(["rose", "oak", "spin", "win", "x"], k=4)) + f".net/a{i}" for i in range(20)] + [None, "none"]
    words = ("casino", "win", "bets", "free", "slots")
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: r for r in UrlFilter([], block_words=words).fit(df, "url").judge(df).collect()}

    from tessera.llm.url_filter import PLAIN_WORDS
    cost = {}
    for host, path in map(_parts, urls):
        found = [w for label in host.split(".") if re.search("[^a-z]", label) for w in re.split("[^a-z]+", label)]
        for w in filter(None, found + re.split("[^a-z]+", path.lower())):
            cost[w] = cost.get(w, 0) + 1
    cost = {**cost, **{w: max(cost.get(w, 0), 1000) for w in {*words, *PLAIN_WORDS}}}
    total = sum(cost.values()) + 1
    cost = {w: math.log(total / n) for w, n in cost.items()}
    bags = []
    for host, path in map(_parts, urls):
        own = [x for w in re.findall(r"[a-z]+|[0-9]+", host) for x in (segment(w, cost, math.log(total) + 2.0) if w.isalpha() else [w])]
        bags.append((own, own + ["/" + w for w in re.findall(r"[a-z]+|[0-9]+", path.lower())]))
    bad = [bool(set(own) & set(words)) for own, _ in bags]
    sides = [[t for (_, bag), b in zip(bags, bad) if b == side for t in bag] for side in (False, True)]
    size = len({*sides[0], *sides[1]})
    for i, (own, bag) in enumerate(bags):
        odds = math.log((sum(bad) + 1) / (len(bad) - sum(bad) + 1)) + sum(
            math.log((sides[1].count(t) + 1) / (len(sides[1]) + size + 1)) - math.log((sides[0].count(t) + 1) / (len(sides[0]) + size + 1))
            for t in bag)
        assert got[i].host_words == own, urls[i]
        assert got[i].log_odds == pytest.approx(odds), urls[i]
        assert got[i].verdict == ("block" if odds > 0 else "allow")
    assert long_word in got[52].host_words and got[48].verdict == got[50].verdict == "block" and got[49].verdict == "allow"
    assert not set(got[48].host_words) & set(words)


def test_url_model_keeps_every_token(spark):
    urls = [f"http://blog{i}.example.net/en/{i}" for i in range(30)] + ["http://casinowin.example.net/spin/once"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    model = UrlFilter(RULES).fit(df, "url")
    got = {r.token: (r.allow, r.block) for r in model.model.collect()}
    assert got[""] == (30, 1) and got["/once"] == (0, 1) and got["/17"] == (1, 0) and got["casino"] == (0, 1)
    sums = [sum(v[i] for t, v in got.items() if t) + len(got) for i in (0, 1)]
    row = model.judge(df).where("page_id = 30").first()
    tokens = {"casino", "win", "example", "net", "/spin", "/once"}
    assert set(row.host_words) | {"/spin", "/once"} == tokens
    want = math.log(2 / 31) + sum(math.log((got[t][1] + 1) / sums[1]) - math.log((got[t][0] + 1) / sums[0]) for t in tokens)
    assert row.log_odds == pytest.approx(want)
