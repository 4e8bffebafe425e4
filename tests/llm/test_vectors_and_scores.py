"""Whitening, hard negatives and language-model scores against brute force."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import hard_negatives, lm_scoring
from tessera.llm.spectrum import Factors, leading_eigenpairs
from tessera.llm.whitening import whiten

VECTORS = "vec_id long, embedding array<float>, label int"


# ---- spectrum slicing -------------------------------------------------------------------------------


def _with_spectrum(values, seed=0):
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))
    a = q @ np.diag(values) @ q.T
    return (a + a.T) / 2


@pytest.mark.parametrize("values", [
    np.linspace(5, 1, 40), np.logspace(0, -10, 30), [3, 3, 2 + 1e-13, 2, 2, 1, 1, 0.5], [1e9, 1e8, *[1e-3] * 20], [1.0] * 12,
])
def test_eigenpairs(values):
    a = _with_spectrum(np.array(values, float))
    want = np.sort(np.linalg.eigvalsh(a))[::-1]
    got, x = leading_eigenpairs(a, 8, 1e-12 * np.trace(a))
    assert len(got) == min(8, int((want > 1e-12 * np.trace(a)).sum()))
    assert np.abs(got - want[: len(got)]).max() <= 1e-14 * want[0]
    assert np.abs(x.T @ x - np.eye(len(got))).max() < 1e-13
    assert np.abs(a @ x - x * got).max() <= 1e-13 * want[0]


def test_inertia_counts_and_solutions():
    rng = np.random.default_rng(1)
    a = rng.standard_normal((25, 25))
    a = a + a.T  # indefinite, so that pivots of two rows are needed
    a[0, 0] = a[1, 1] = 0
    values = np.linalg.eigvalsh(a)
    for shift in np.linspace(values[0] - 1, values[-1] + 1, 40):
        f = Factors(a, shift)
        assert f.positive() == (values > shift).sum()
        b = rng.standard_normal(25)
        assert np.allclose((a - shift * np.eye(25)) @ f.solve(b), b, atol=1e-8)


def test_eigenpairs_of_degenerate_matrices():
    assert len(leading_eigenpairs(np.zeros((5, 5)), 3)[0]) == 0
    assert leading_eigenpairs(np.ones((4, 4)), 3, 1e-9)[0] == pytest.approx([4])
    assert leading_eigenpairs(np.zeros((0, 0)), 3)[1].shape == (0, 0)


# ---- whitening --------------------------------------------------------------------------------------


def _white_by_hand(vectors, k=16):
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in np.array(v, np.float32).astype(float)] for v in vectors])
    fit = np.array(sorted({tuple(r) for r in x.tolist()}))
    n, s = len(fit), fit.sum(axis=0)
    y = (n * fit - s) / n
    values, axes = np.linalg.eigh(y.T @ y / n)
    values, axes = values[::-1][:k], axes[:, ::-1][:, :k]
    return n, [sum(int(n * c - t) ** 2 for c, t in zip(r, s)) for r in x.tolist()], ((n * x - s) / n) @ axes / np.sqrt(values), values


def test_whitening_against_dense_algebra(spark, saved):
    rng = np.random.default_rng(2)
    vectors = (rng.standard_normal((300, 20)) * np.linspace(1, 0.2, 20) + 3).astype(np.float32).tolist()
    vectors += [vectors[0]] * 150  # a third of the rows are copies of one vector
    rows = [(i, v, 0) for i, v in enumerate(vectors)]
    got = whiten(saved(rows, VECTORS)).orderBy("vec_id", "component").toPandas()
    n, deviation, white, values = _white_by_hand(vectors)
    assert len(got) == 450 * 16 and set(got.n) == {n} and n == 300
    w = got.whitened.to_numpy().reshape(-1, 16)
    signs = np.sign((w * white).sum(axis=0))
    assert np.abs(w - white * signs).max() < 1e-9
    assert [int(d) for d in got.deviation[::16]] == deviation
    assert got.identity_error.nunique() == 1 and got.identity_error[0] < 1e-10
    trace = np.trace(np.cov(np.unique(np.floor(64 * np.array(vectors, float)), axis=0).T, bias=True))
    assert np.allclose(got.explained[:16], values / trace)


def test_whitening_defined_cases(spark, saved):
    nan, inf = float("nan"), float("inf")
    good = [[1.0, 2.0, 3.0], [2.0, 1.0, 0.0], [0.0, 0.5, 2.0], [1.5, 1.5, -1.0]]
    rows = [(i, v, 0) for i, v in enumerate(good)]
    rows += [(None, good[0], None), (1, good[0], 3), (7, None, 1), (8, [1.0, None, 2.0], 1), (9, [nan, 1.0, 1.0], 1),
             (10, [1.0, inf, 1.0], 1), (11, [], 1), (12, [5.0, 5.0], 1), (13, [2.0 ** 41, 0.0, 0.0], 1)]
    df = saved(rows, VECTORS).withColumn("x", F.lit("clash")).withColumn("n", F.lit(1)).withColumn("component", F.lit(2))
    got = whiten(df).toPandas()
    assert sorted(got.vec_id.fillna(-1)) == sorted([i for i in (0, 1, 1, 2, 3, -1) for _ in range(3)])  # one pair of length 2 has no variance
    assert set(got.n) == {4} and set(got.component) == {1, 2, 3}
    assert got[got.vec_id.isna()].whitened.tolist() == got[got.vec_id == 0].whitened.tolist()
    assert whiten(saved([], VECTORS, parts=1)).count() == 0
    assert whiten(saved([(1, [1.0, 2.0], 0)] * 3, VECTORS)).count() == 0  # one distinct vector


def test_whitening_sums_are_exact_beyond_long(spark, saved):
    big = float(2 ** 39)
    rows = [(0, [big, 1.0], 0), (1, [-big, 2.0], 0), (2, [0.0, 5.0], 0)]
    got = {r.vec_id: int(r.deviation) for r in whiten(saved(rows, VECTORS)).where("component = 1").collect()}
    _, want, _, _ = _white_by_hand([r[1] for r in rows])
    assert [got[i] for i in range(3)] == want and want[0] > 1 << 62


# ---- hard negatives ---------------------------------------------------------------------------------


def _mined(rows, anchor_every, k=5):
    usable = [(i, v, lab) for i, v, lab in rows if i is not None and lab is not None and v
              and all(c is not None and math.isfinite(c) for c in v)]
    usable = [(i, [math.floor(256 * float(np.float32(c))) for c in v], lab) for i, v, lab in usable]
    out = []
    for a, (aid, ax, alab) in enumerate(usable):
        if aid % anchor_every:
            continue
        scores = [(-sum(p * q for p, q in zip(ax, x)), i, lab) for j, (i, x, lab) in enumerate(usable) if j != a and len(x) == len(ax)]
        for ps, pid, _ in sorted(s for s in scores if s[2] == alab)[:k]:
            fits = sorted(s for s in scores if s[2] != alab and 80 * -ps <= 100 * -s[0] <= 100 * -ps)[:k]
            out += [(aid, pid, r, nid, -ps, -ns) for r, (ns, nid, _) in enumerate(fits, 1)]
    return sorted(out)


def _mine(df, anchor_every, block=2048):
    got = hard_negatives.mine(df, F.col("vec_id") % anchor_every == 0, F.col("label"), block=block)
    return sorted(map(tuple, got.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()))


def test_strassen_equals_the_plain_product(monkeypatch):
    rng = np.random.default_rng(3)
    monkeypatch.setattr(hard_negatives, "PLAIN", 3)
    for shape in [(1, 1, 1), (7, 5, 9), (16, 16, 16), (33, 17, 50), (2, 64, 3), (40, 1, 40)]:
        a = rng.integers(-2 ** 62, 2 ** 62, shape[:2])  # sums wrap around, as in the plain product
        b = rng.integers(-2 ** 62, 2 ** 62, shape[1:])
        assert (hard_negatives.strassen(a, b) == a @ b).all()


@pytest.mark.parametrize("block", [16, 2048])
def test_hard_negatives_against_brute_force(spark, saved, block):
    rng = np.random.default_rng(4)
    vectors = np.round(rng.standard_normal((160, 6)), 1).astype(np.float32).tolist()  # many equal scores
    rows = [(i, v, int(rng.integers(0, 3))) for i, v in enumerate(vectors)]
    rows += [(200 + i, vectors[3], 1) for i in range(60)] + [(200, vectors[3], 1)] * 3  # a hot vector, and copies of whole rows
    assert _mine(saved(rows, VECTORS), 10, block) == _mined(rows, 10)


def test_hard_negatives_defined_cases(spark, saved):
    nan = float("nan")
    rows = [(0, [1.0, 0.5], 1), (0, [1.0, 0.5], 1), (1, [1.0, 0.4], 1), (2, [0.9, 0.5], 2), (3, [1.0, 0.5], None), (4, None, 2),
            (5, [1.0, None], 2), (6, [nan, 1.0], 2), (None, [1.0, 0.5], 2), (7, [], 2), (8, [1.0, 0.5, 0.1], 2), (10, [-1.0, 0.0], 7),
            (20, [0.0, 0.0], 2), (9, [2.0 ** 30, 0.0], 2), (30, [0.0, 0.0], 3), (31, [0.0, 1.0], 3)]
    want = _mined([r for r in rows if r[0] != 9], 10)  # too long a vector for scores that are longs
    df = saved(rows, VECTORS).withColumn("x", F.lit(1)).withColumn("copies", F.lit("clash")).withColumn("key", F.lit(0))
    assert _mine(df, 10) == want and want
    assert _mine(saved([], VECTORS, parts=1), 10) == []
    words = saved(rows, VECTORS).withColumn("label", F.concat(F.lit("class "), F.col("label")))
    assert _mine(words, 10) == want


# ---- language-model scores --------------------------------------------------------------------------

DOCS = "doc_id long, text string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)), "\n"]


def _held(i):
    return zlib.crc32(str(i).encode()) % 10 == 0


def _counts(texts, order):
    counts = [Counter() for _ in range(order)]
    for t in texts:
        w = ["<"] * (order - 1) + _tokens(t)
        for j in range(order - 1, len(w)):
            for k in range(order):
                counts[k][tuple(w[j - k: j + 1])] += 1
    return counts


def _scores(rows, weights, order):
    train = [t for i, t in rows if not _held(i)]
    counts, docs = _counts(train, order), len(train)
    n, v = sum(counts[0].values()), len(counts[0])
    out = []
    for i, text in rows:
        w = ["<"] * (order - 1) + _tokens(text)
        base = score = 0.0
        for j in range(order - 1, len(w)):
            f = 1 / (v + 1)
            parts = [f]
            for k in range(order):
                c = counts[k][tuple(w[j - k: j + 1])]
                before = tuple(w[j - k: j])
                whole = n if k == 0 else docs if set(before) == {"<"} else counts[k - 1][before]
                f = c / whole if whole else f
                parts.append(f)
            longest = whole if order > 1 else docs
            b = min(int(math.log2(longest)) + 1, lm_scoring.BUCKETS - 1) if longest else 0
            score += math.log10(sum(a * p for a, p in zip(weights[b], parts)))
            base += math.log10((counts[0][(w[j],)] + 0.1) / (n + 0.1 * (v + 1)))
        own = _tokens(text)
        out.append((i, _held(i), len(own), sum(counts[0][(t,)] > 0 for t in own), n, base, score))
    return out


@pytest.fixture()
def corpus(words):
    rng = random.Random(5)
    names = [words[0](rng) if isinstance(words, list) else words(rng) for _ in range(300)]
    texts = []
    for _ in range(400):  # words follow each other by a rule, so that pairs tell more than single words
        at, out = rng.randrange(300), []
        for _ in range(rng.randrange(1, 60)):
            out.append(names[at].upper() if rng.random() < 0.1 else names[at])
            at = (at * 7 + rng.choice([1, 2, 3])) % 300 if rng.random() < 0.8 else int(300 * rng.random() ** 2)
        texts.append(rng.choice([" ", "\n", "\t "]).join(out))
    texts += [texts[0]] * 200 + [None, "", "   ", "a " * 5000, " x É é"]
    return [(i, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("order,block_bytes,range_keys", [(2, 1 << 20, 1 << 20), (2, 2000, 64), (3, 5000, 200), (1, 3000, 100)])
def test_scores_against_brute_force(spark, saved, corpus, monkeypatch, order, block_bytes, range_keys):
    learned = []
    monkeypatch.setattr(lm_scoring, "RANGE_KEYS", range_keys)
    monkeypatch.setattr(lm_scoring, "learn_weights",
                        lambda *a, learn=lm_scoring.learn_weights: learned.append(learn(*a)) or learned[-1])
    df = saved(corpus, DOCS).withColumn("block", F.lit(1)).withColumn("half", F.lit("clash")).withColumn("id", F.lit(0))
    got = lm_scoring.score(df, F.crc32(F.col("doc_id").cast("string")) % 10 == 0, order=order, block_bytes=block_bytes)
    got = sorted(map(tuple, got.collect()))
    want = _scores(corpus, learned[0], order)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert [g[5:] for g in got] == [pytest.approx(w[5:], rel=1e-9) for w in want]
    assert np.allclose(learned[0].sum(axis=1), 1) and (learned[0] > 0).all()
    if order > 1:  # the mixture beats the smoothed single words on documents it has not seen
        held = [g for g in got if g[1]]
        assert sum(g[6] for g in held) > sum(g[5] for g in held)


def test_weights_are_near_those_of_unrounded_estimates(corpus):
    """Expectation-maximisation over the cells against the same over every held-out token."""
    texts = sorted({t for _, t in corpus if t})
    halves = texts[::2], texts[1::2]
    all_counts = _counts(texts, 2)
    types, mass, cells, exact = len(all_counts[0]), [], [], []
    for h in (0, 1):
        counts = _counts(halves[1 - h], 2)
        n = sum(counts[0].values())
        mass.append(sum(len(_tokens(t)) for t in halves[h]))
        for t in halves[h]:
            w = ["<", *_tokens(t)]
            for j in range(1, len(w)):
                whole = len(halves[1 - h]) if j == 1 else counts[0][(w[j - 1],)]
                one, two = counts[0][(w[j],)], counts[1][(w[j - 1], w[j])]
                bucket = lm_scoring.bucket_of(np.array([whole]))[0]
                code = lm_scoring._code(np.array([two]), np.array([whole]))[0]
                first = round(8 * math.log2(one)) + 2 if one else 1
                cells.append(((bucket + lm_scoring.BUCKETS * h) * 1024 + code) * 1024 + first)
                f1 = one / n
                exact.append((bucket, 1 / (types + 1), f1, two / whole if whole else f1))
    cells, n = np.unique(cells, return_counts=True)
    got = lm_scoring.learn_weights(cells, n, 2, types, tuple(mass))
    exact = np.array(exact)
    for b in np.unique(exact[:, 0]):
        f = exact[exact[:, 0] == b][:, 1:]
        weights = np.full(3, 1 / 3)
        for _ in range(500):
            parts = f * weights
            weights = ((parts / parts.sum(axis=1, keepdims=True)).sum(axis=0) + 1) / (len(f) + 3)
        assert np.abs(got[int(b)] - weights).max() < 0.05


def test_scores_defined_cases(spark, saved):
    held = F.crc32(F.col("doc_id").cast("string")) % 10 == 0
    assert lm_scoring.score(saved([], DOCS, parts=1), held).count() == 0
    alone = lm_scoring.score(saved([(1, "a b")], DOCS), F.lit(True)).collect()  # no training document
    assert [tuple(r) for r in alone] == [(1, True, 3, 0, 0, 0.0, 0.0)]
    rows = lm_scoring.score(saved([(None, "a b"), (7, "a b"), (7, "a b"), (8, None)], DOCS), held).collect()
    by = {(r.doc_id, r.held_out): r for r in rows}
    assert len(rows) == 4 and by[None, True].n_tokens == 3 and by[8, _held(8)].n_tokens == 1
    assert by[None, True].train_tokens == sum(3 for _ in range(2) if not _held(7)) + (0 if _held(8) else 1)
