"""Reducers that combine, partition reload, stored sketches, collation without groups."""

from __future__ import annotations

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import aggs, udfs, windows
from tessera.plans.q_udfs import SPREAD
from tessera.sources import loads


@pytest.mark.parametrize("parts,states", [(1, 100_000), (7, 100_000), (7, 3)])
def test_the_split_does_not_change_the_result(spark, monkeypatch, parts, states):
    monkeypatch.setattr(udfs, "STATES", states)
    rng = np.random.default_rng(8)
    rows = [("hot" if i % 3 else f"k{i % 40}" if i % 30 else None, None if i % 50 == 0 else float(x)) for i, x in enumerate(rng.normal(size=3000))]
    rows += [("empty", None)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(parts)
    got = {r.k: r.value for r in udfs.reduce_mergeable(df, "k", "v", SPREAD).collect()}
    by = {}
    for k, v in rows:
        by.setdefault(k, []).extend([] if v is None else [v])
    assert got.keys() == by.keys()
    for k, vs in by.items():
        assert (got[k] is None) if not vs else got[k] == pytest.approx(np.std(vs))


def test_a_hot_group_is_reduced_in_many_tasks(spark):
    tasks = udfs.Reducer("n long, parts array<long>", lambda v: (len(v), [len(v)]),
                         lambda a, b: (a[0] + b[0], [*a[1], *b[1]]), lambda s: len(s[1]))
    df = spark.range(4000).select(F.when(F.col("id") % 3 == 0, F.col("id") % 50).otherwise(-1).alias("k"), "id").repartition(6)
    got = {r.k: r.value for r in udfs.reduce_mergeable(df, "k", "id", tasks, "long").collect()}
    assert got[-1] >= 6  # one state for each task at least
    assert udfs.reduce_mergeable(df.limit(0), "k", "id", tasks, "long").count() == 0


def test_reload_touches_only_its_window(spark, tmp):
    path = f"{tmp}/t"
    base = spark.range(100).select("id", F.lit("base").alias("src"), (F.col("id") % 10).cast("int").alias("p"))
    base.write.partitionBy("p").parquet(path)
    files = lambda: {(d, f): os.stat(f"{d}/{f}").st_mtime_ns for d, _, fs in os.walk(path) for f in fs if "/p=" in d}
    before = files()
    stage = spark.range(5).select((F.col("id") + 1000).alias("id"), F.lit("stage").alias("src"),
                                  F.when(F.col("id") == 0, 2).otherwise(F.col("id") % 2 + 8).cast("int").alias("p"))
    for _ in range(2):  # a load that is run again gives the same table
        loads.reload_partitions(stage, path, "p", 7)
        got = spark.read.schema("id long, src string, p int").parquet(path)
        want = [tuple(r) for r in base.collect() if r.p < 7] + [tuple(r) for r in stage.collect() if r.p >= 7]
        assert sorted(map(tuple, got.collect())) == sorted(want)
    after = files()
    old = {k: v for k, v in before.items() if int(k[0].split("=")[1]) < 7}
    assert old and all(after[k] == v for k, v in old.items())  # the stage's row of partition 2 is outside the window
    assert not os.path.exists(f"{path}/p=7")


def test_sketches_merge(spark):
    df = spark.range(30_000).select((F.col("id") % 7).alias("day"), (F.col("id") % 4000).alias("u"), (F.col("id") % 3).alias("g"))
    stored = aggs.distinct_sketches(df, ["g", "day"], "u")
    for r in aggs.merged_distinct(stored, "g").collect():
        assert abs(r.approx_distinct - 4000) < 240
    assert abs(aggs.merged_distinct(stored).first()[0] - 4000) < 240


@pytest.mark.parametrize("by", [None, "g"])
def test_sorted_under_with_and_without_groups(spark, by):
    words = ["zebra", "yak", "apple", "banana", "bat", "zoo", "a", "aa"]
    rows = [(i, i % 2, words[i * 5 % 8]) for i in range(50)]
    alphabet = "zyxwvutsrqponmlkjihgfedcba"
    got = {r.i: r.in_order for r in windows.sorted_under(spark.createDataFrame(rows, "i int, g int, w string"), "w", "i", alphabet, by).collect()}
    key = lambda w: [alphabet.index(c) for c in w]
    for i, g, w in rows:
        prev = [x for j, h, x in rows if j < i and (by is None or h == g)]
        assert got[i] == (not prev or key(prev[-1]) <= key(w))
