"""Block and tile joins: vectors, lists, bands, splitters and the scoring rule against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import aggs, vectors
from tessera.operators import joins as J
from tessera.operators.common import borders_below, quantile_chunk

VECTORS = "vec_id long, embedding array<float>, label string"


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(1)
    v = np.round(rng.standard_normal((300, 8)), 1).astype(np.float32).tolist()
    rows = [(i, x, f"l{i % 4}") for i, x in enumerate(v)] + [(300 + i, v[7], "hot") for i in range(150)]  # a hot vector, a hot label
    return rows + [(600, None, "l1"), (601, [1.0, None], "l1"), (602, [0.0] * 8, "l2"), (603, [1.0, 2.0], "l2"), (604, v[3], None)]


def _score(metric, a, b):
    a, b = np.array(a, float), np.array(b, float)
    if metric == "l2":
        return float(np.sqrt(((a - b) ** 2).sum()))
    if metric == "ip":
        return float((a * b).sum())
    n = np.sqrt((a * a).sum()) * np.sqrt((b * b).sum())
    return float((a * b).sum() / n) if n > 0 else None


def _by_hand(queries, rows, k, metric, same_label=False):
    out = []
    for qid, q, qlab in queries:
        s = [(_score(metric, q, v), i) for i, v, lab in rows if v and None not in v and len(v) == len(q)
             and (not same_label or (lab is not None and lab == qlab))]
        s = sorted([(x if metric == "l2" else -x, i) for x, i in s if x is not None])[:k]
        out += [(qid, r, i) for r, (_, i) in enumerate(s, 1)]
    return sorted(out)


@pytest.mark.parametrize("limit,tile", [(2048, 4096), (0, 40)])
@pytest.mark.parametrize("metric", ["cosine", "ip", "l2"])
def test_topk_by_scan_and_by_tiles(spark, rows, monkeypatch, limit, tile, metric):
    monkeypatch.setattr(vectors, "QUERY_ROWS", limit)
    monkeypatch.setattr(vectors, "TILE_ROWS", tile)
    corpus = spark.createDataFrame(rows, VECTORS).repartition(3)
    some = [r for r in rows[::40] if r[1]]
    queries = spark.createDataFrame(some, "qid long, qvec array<float>, label string")
    got = vectors.topk(queries.drop("label"), corpus, 7, metric)
    assert sorted((r.qid, r["rank"], r.vec_id) for r in got.collect()) == _by_hand(some, rows, 7, metric)
    if metric == "cosine":
        got = vectors.topk_filtered(queries, corpus, 4, "label")
        assert sorted((r.qid, r["rank"], r.vec_id) for r in got.collect()) == _by_hand(some, rows, 4, metric, True)
        best = vectors.best_hits(queries.drop("label"), corpus, 0.2, "label").collect()
        want = {}
        for qid, q, _ in some:
            for i, v, lab in rows:
                s = _score(metric, q, v) if v and None not in v and len(v) == len(q) else None
                if s is not None and s >= 0.2:
                    want[qid, lab] = min(want.get((qid, lab), (9, 0)), (-s, i))
        assert {(r.qid, r.label): r.vec_id for r in best} == {k: i for k, (_, i) in want.items()}


@pytest.mark.parametrize("probes", [1, 3])
def test_list_search_misses_nothing(spark, rows, probes):
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((6, 8)) * 4  # rows in separate heaps, so that far lists are not read
    heaps = [(i, (centres[i % 6] + 0.2 * rng.standard_normal(8)).tolist(), "x") for i in range(600)]
    heaps += [(1000 + i, heaps[0][1], "hot") for i in range(300)] + [(2000, [0.0] * 8, "x"), (2001, None, "x")]
    corpus = spark.createDataFrame(heaps, VECTORS).repartition(4)
    some = heaps[:12]
    queries = spark.createDataFrame([(i, v) for i, v, _ in some], "qid long, qvec array<float>")
    index = vectors.build_ivf(corpus, lists=6, fit_rows=300)
    assert index.size.sum() == 900
    found, cost = vectors.search_ivf(queries, index, 5, probes)
    exact = vectors.topk(queries, corpus, 5)
    assert vectors.recall(found, exact).agg(F.min("recall")).first()[0] == 1.0
    assert {(r.qid, r["rank"]): round(r.score, 6) for r in found.collect()} == {(r.qid, r["rank"]): round(r.score, 6) for r in exact.collect()}
    cost = cost.collect()
    assert len(cost) == 12 and max(r.rows_read for r in cost) < 900 and max(r.probes for r in cost) < 6
    assert vectors.topk_ivf(queries, corpus.limit(0), 5, lists=4).count() == 0


# ---- splitters and bands ----------------------------------------------------------------------------


def test_borders_below_equals_a_scan(spark):
    df = spark.range(300).select((F.col("id") % 97).alias("v"))
    for n in (0, 1, 2, 7, 8, 9, 63, 64, 65):
        borders = sorted(random.Random(n).choices(range(97), k=n))
        b = F.array(*[F.lit(x) for x in borders]).cast("array<long>")
        got = df.withColumn("b", b).withColumn("at", borders_below("b", n, "v")).collect()
        assert all(r["at"] == sum(x < r.v for x in borders) for r in got)


@pytest.mark.parametrize("kind", ["v", "cast(v as string)", "date_add(date'2020-01-01', cast(v as int))", "struct(v as a, w as b)"])
def test_chunks_are_monotone_for_any_ordered_type(spark, kind):
    df = spark.range(2000).selectExpr("id % 500 as v", "id as w").selectExpr(f"{kind} as x", "w")
    got = [tuple(r) for r in quantile_chunk(df, "x", 16, "c").select("x", "c").collect()]
    order = sorted(got, key=lambda r: r[0])
    assert all(a[1] <= b[1] for a, b in zip(order, order[1:]))
    sizes = [sum(1 for r in got if r[1] == c) for c in {r[1] for r in got}]
    assert len(sizes) >= 12 and max(sizes) < 400


@pytest.mark.parametrize("leaves", [None, 128])
def test_bands_under_skew(spark, leaves):
    rng = random.Random(4)
    values = [(i, 1000 + rng.random() * 10 if rng.random() < 0.9 else rng.random() * 1000) for i in range(1500)]  # 90 % in 1 %
    values += [(5000 + i, 1005.0) for i in range(500)] + [(9000, None)]
    bands = [(b, rng.uniform(0, 500), rng.uniform(900, 1010)) for b in range(15)]  # all of them overlap
    bands += [(20, -5.0, 2000.0), (21, 1005.0, 1005.0), (22, 7.0, 3.0), (23, None, 5.0), (24, 3000.0, 4000.0)]
    d = spark.createDataFrame(values, "id long, v double")
    b = spark.createDataFrame(bands, "band int, lo double, hi double")
    got = sorted(map(tuple, J.band_join(d, b, "v", "lo", "hi", leaves).select("id", "band").collect()))
    assert got == sorted((i, n) for i, v in values for n, lo, hi in bands if None not in (v, lo, hi) and lo <= v <= hi)
    p = J.band_join(d, b, "v", "lo", "hi")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in p.split("_node", 1)[0] and "Cartesian" not in p


# ---- scoring rule -----------------------------------------------------------------------------------


@pytest.mark.parametrize("tile,block", [(2048, 256), (10, 3)])
def test_best_score_against_brute_force(spark, monkeypatch, tile, block):
    monkeypatch.setattr(aggs, "SCORE_TILE", tile)
    monkeypatch.setattr(aggs, "SCORE_BLOCK", block)
    rng = random.Random(6)
    have = [(c, s, rng.randint(1, 4)) for c in range(60) for s in rng.sample("abcdef", rng.randint(1, 6))]
    have += [(100 + c, s, 2) for c in range(40) for s in "ab"] + [(0, "a", 3)]  # many equal candidates; a skill held twice
    need = [(p, s, rng.randint(1, 4)) for p in range(80) for s in rng.choices("abcdef", k=rng.randint(1, 4))]
    need += [(200, "nobody", 1), (200, "a", 1), (201, "a", 4), (201, "a", 1)]
    got = aggs.best_score(spark.createDataFrame(have, "cand int, skill string, level int"),
                          spark.createDataFrame(need, "project int, skill string, importance int"),
                          "cand", "project", "skill", "level", "importance")
    levels = {}
    for c, s, v in have:
        levels.setdefault(c, {})[s] = max(v, levels.get(c, {}).get(s, 0))
    want = []
    for p in sorted({p for p, _, _ in need}):
        own = [(s, v) for q, s, v in need if q == p]
        fits = [(-(100 + sum(10 * (h[s] > v) - 5 * (h[s] < v) for s, v in own)), c) for c, h in levels.items() if all(s in h for s, _ in own)]
        if fits:
            want.append((p, min(fits)[1], -min(fits)[0]))
    assert sorted(map(tuple, got.collect())) == want
