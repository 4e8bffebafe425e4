import random
import re

import numpy as np
import pyarrow as pa

from tessera.llm import jaccard_join
from tessera.llm.common import row_numbered
from tessera.llm.decontaminate import drop_contaminated, find_benchmark_words
from tessera.llm.jaccard_join import keep_one_of_each, near_duplicates
from tessera.llm.line_dedup import dedup_lines
from tessera.llm.words import ALNUM, NOT_SPACE, words_of

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TOKEN = re.compile(r"[^\x20\x09-\x0D]+")


def test_word_hashes_follow_the_words(words):
    rng = random.Random(1)
    texts = ["", None, "Ab ab AB", "é É", "x" * 3_000_000 + " y", "a\x0bb\x1cc", " " * 50] + [
        " ".join(words(rng) for _ in range(rng.randint(0, 4000))) for _ in range(60)]
    for classes, pattern in ((NOT_SPACE, TOKEN), (ALNUM, WORD)):
        hashes, counts = words_of(pa.array(texts), classes)
        want = [w for t in texts for w in pattern.findall((t or "").translate(LOW))]
        assert counts.tolist() == [len(pattern.findall((t or "").translate(LOW))) for t in texts]
        seen = {}
        for h, w in zip(hashes.tolist(), want):
            assert seen.setdefault(w, h) == h
        assert len(set(seen.values())) == len(seen)


def _lines_by_hand(rows):
    def key(line):
        k = line.strip(" \t\n\x0b\x0c\r").translate(LOW)
        return k if len(k) >= 20 else None

    docs = {}
    for i, t in rows:
        if i is not None:
            for line in (t or "").split("\n"):
                if key(line):
                    docs.setdefault(key(line), set()).add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        left = [x for x in lines if i is None or not key(x) or len(docs[key(x)]) < 3 or max(docs[key(x)]) == i]
        out.append((i, "\n".join(left) if t is not None else None, len(lines), len(lines) - len(left)))
    return sorted(out, key=str)


def test_line_dedup(saved, words):
    rng = random.Random(2)
    pool = [" ".join(words(rng) for _ in range(5)) for _ in range(40)] + ["short", "é" * 20, "é" * 19, "A" * 20, "a" * 20 + "\t"]
    rows = [(i, "\n".join(rng.choices(pool, k=rng.randint(0, 9)))) for i in range(60)]
    rows += [(5, rows[5][1]), (5, "another text"), (None, pool[0]), (70, None), (71, ""), (72, "\n\n"), (73, "\n".join(pool * 300))]
    df = saved([(*r, "kept") for r in rows], "doc_id long, text string, h string")
    got = dedup_lines(df)
    assert got.columns == ["doc_id", "text", "h", "n_lines", "n_dropped"]
    assert sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got.collect()), key=str) == _lines_by_hand(rows)
    assert dedup_lines(df.limit(0)).count() == 0


def _hits_by_hand(text, items):
    w = WORD.findall((text or "").translate(LOW))
    hit, found = set(), set()
    for item, t in items:
        q = WORD.findall((t or "").translate(LOW))
        n = min(10, len(q))
        if item is None or not n:
            continue
        wins = {tuple(q[i:i + n]) for i in range(len(q) - n + 1)}
        for i in range(len(w) - n + 1):
            if tuple(w[i:i + n]) in wins:
                hit |= set(range(i, i + n))
                found.add(str(item))
    return len(w), len(hit), sorted(found)


def test_decontamination(saved, words):
    rng = random.Random(4)
    few = [words(rng) for _ in range(12)]
    say = lambda n: [rng.choice(few) for _ in range(n)]
    items = [(i, " ".join(say(rng.randint(1, 30)))) for i in range(12)] + [(12, " ".join(few[:4])), (13, None), (14, " . "), (None, few[0])]
    items += [items[0], (15, items[1][1])]
    long = [words(rng) for _ in range(14)]
    items.append((16, " ".join(long)))
    rows = [(i, " ".join(say(rng.randint(0, 120)))) for i in range(30)]
    rows += [(31, None), (32, ""), (33, "-- " + ", ".join(long[2:12]).upper()), (34, " ".join(long[2:11])), (33, "x"), (33, "x"),
             (35, " ".join(long * 400)), (None, " ".join(long)), (36, " ".join(long[:10] + ["zz"] + long[4:14]))]
    df, bench = saved([(*r, 1) for r in rows], "doc_id long, text string, n int"), saved(items, "item_id long, text string")
    got = sorted(((r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in find_benchmark_words(df, bench).collect()), key=str)
    assert got == sorted(((i, *_hits_by_hand(t, items)) for i, t in rows), key=str)
    left = drop_contaminated(df, bench)
    assert left.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=str) == sorted(
        ((i, t) for i, t in rows if not _hits_by_hand(t, items)[1]), key=str)
    none = find_benchmark_words(df, bench.limit(0))
    assert none.count() == len(rows) and none.where("n_hit > 0").count() == 0
    assert find_benchmark_words(df.limit(0), bench).count() == 0


def _sets(text, k):
    w = TOKEN.findall((text or "").translate(LOW))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def _components(rows, k, percent):
    sets = [_sets(t, k) for _, t in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            n = len(sets[a] & sets[b])
            if n and 100 * n >= percent * len(sets[a] | sets[b]):
                up[find(a)] = find(b)
    least = {}
    for a, (i, _) in enumerate(rows):
        if i is not None:
            least[find(a)] = min(i, least.get(find(a), i))
    return [(i, len(s), least.get(find(a))) for a, ((i, _), s) in enumerate(zip(rows, sets))], [find(a) for a in range(len(rows))]


def _near_rows(words):
    rng = random.Random(6)
    rows = []
    shared = [words(rng) for _ in range(40)]
    for g in range(6):
        base = [words(rng) for _ in range(rng.randint(40, 120))] + (shared if g % 2 else [])
        for _ in range(rng.choice((3, 25))):
            copy = list(base)
            for _ in range(rng.randint(0, 5)):
                copy[rng.randrange(len(copy))] = words(rng)
            if rng.random() < 0.4:  # chains: the copy becomes the next base
                base = copy
            rows.append(" ".join(copy))
    rows += [" ".join(words(rng) for _ in range(rng.randint(1, 60))) for _ in range(40)]
    rows += ["one two", "ONE  two", "one", "", None, " \n ", None, "a b c d", "A b\tc d"]
    rng.shuffle(rows)
    out = list(zip(rng.sample(range(1000), len(rows)), rows))
    return out + [out[3], out[3], (None, out[4][1]), (None, "nobody else says this")]


def test_jaccard_join(saved, words):
    rows = _near_rows(words)
    df = saved([(*r, "x") for r in rows], "doc_id long, text string, label string")
    got = near_duplicates(df).collect()
    assert sorted(((r[0], r[1], r[2]) for r in got), key=str) == sorted(_components(rows, 4, 85)[0], key=str)
    assert near_duplicates(df.limit(0)).count() == 0


def test_one_of_each_group_stays(saved, words):
    rows = _near_rows(words)
    df = saved([(*r, "x") for r in rows], "doc_id long, text string, gone_row string")
    left = keep_one_of_each(df)
    assert left.columns == df.columns
    want, group = _components(rows, 5, 80)
    kept = {(i, g) for (i, _), g in zip(rows, group)}
    assert left.count() == len(set(group))
    least = {}
    for (i, t), g in zip(rows, group):
        least.setdefault(g, []).append((i is None, i if i is not None else 0))
    assert sorted(map(str, (r.doc_id for r in left.collect()))) == sorted(
        str(None if min(v)[0] else min(v)[1]) for v in least.values())
    assert kept


def test_long_text_and_many_copies(saved, words):
    rng = random.Random(9)
    long = " ".join(words(rng) for _ in range(30_000))
    rows = [(i, long) for i in range(8)] + [(100 + i, long + f" tail{i}") for i in range(8)] + [(200, "lonely words only here")]
    got = {r[0]: r[2] for r in near_duplicates(saved(rows, "doc_id long, text string")).collect()}
    assert got == {i: 0 if i < 200 else 200 for i, _ in rows}
    assert np.unique(list(got.values())).tolist() == [0, 200]


def test_row_numbers_do_not_depend_on_how_files_are_cut(spark, saved, words, monkeypatch):
    rows = _near_rows(words)
    df = saved([(*r, "x") for r in rows], "doc_id long, text string, label string", parts=3)
    bench = saved([(1, " ".join(rows[0][1].split()[:12]))], "item_id long, text string")
    key, cuts = "spark.sql.files.maxPartitionBytes", ["64m", "4k"]
    before = spark.conf.get(key)

    def recut(frame, name, step=iter(range(10**6)), through=jaccard_join.through_table):
        spark.conf.set(key, cuts[next(step) % 2])
        return through(frame, name)

    monkeypatch.setattr(jaccard_join, "through_table", recut)
    try:
        got = near_duplicates(df).collect()
        assert sorted(((r[0], r[1], r[2]) for r in got), key=str) == sorted(_components(rows, 4, 85)[0], key=str)
        for table in (df, row_numbered(df.union(df.limit(0)), "m")):  # a plain scan, and a frame that is none
            numbers = []
            for cut in cuts:
                spark.conf.set(key, cut)
                numbers.append(sorted(map(str, row_numbered(table, "n").collect())))
            assert numbers[0] == numbers[1] and len(set(numbers[0])) == len(rows)
        left = drop_contaminated(df, bench).collect()
        assert sorted(map(str, (r.doc_id for r in left))) == sorted(
            str(i) for i, t in rows if not _hits_by_hand(t, [(1, " ".join(rows[0][1].split()[:12]))])[1])
    finally:
        spark.conf.set(key, before)
