"""Frames of any width without a per-key window, against the plain window."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import windows as W


@pytest.fixture(scope="module")
def events(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i), "hot" if i % 2 else ("a", "b", None)[i % 3], int(rng.integers(0, 40)),
             None if rng.random() < 0.1 else float(np.round(rng.normal(), 2))) for i in range(4000)]
    return spark.createDataFrame(rows, "id long, k string, day int, v double").repartition(5).cache()


@pytest.mark.parametrize("agg", ["sum", "avg", "count", "min", "max"])
@pytest.mark.parametrize("lo,hi", [(-1000, 0), (-2, 0), (-1, 1), (0, 3), (-150, 350), (0, 0)])
def test_frames_equal_the_plain_window(events, agg, lo, hi):
    got = W.framed_chunked(events, "k", ["day", "id"], "v", lo, hi, agg, "x", F.col("day"))
    want = W.framed(events, "k", ["day", "id"], "v", lo, hi, agg, "x")
    assert got.columns == [*events.columns, "x"]
    got, want = ({r.id: r.x for r in d.collect()} for d in (got, want))
    assert got.keys() == want.keys()
    for i, w in want.items():
        assert got[i] == w or math.isclose(got[i], w, abs_tol=1e-8), (i, got[i], w)


@pytest.mark.parametrize("agg", ["sum", "max"])
def test_no_window_over_the_rows_of_a_key(events, agg):
    d = W.framed_chunked(events, "k", ["day", "id"], "v", -1000, 0, agg, "x", F.col("day"))
    lines = d._jdf.queryExecution().optimizedPlan().toString().splitlines()
    for i, line in enumerate(lines):
        if "Window [" in line and "windowspecdefinition(__ps_q" not in line and "windowspecdefinition(__b" not in line:
            assert any("Aggregate [__ps_q" in x for x in lines[i: i + 3]), line  # over one row a chunk


def test_string_extremes_and_empty_tables(spark, events):
    d = events.withColumn("s", F.concat(F.lit("w"), F.col("v").cast("string")))
    got = {r.id: r.x for r in W.framed_chunked(d, "k", ["day", "id"], "s", -3, 2, "max", "x", F.col("day")).collect()}
    assert got == {r.id: r.x for r in W.framed(d, "k", ["day", "id"], "s", -3, 2, "max", "x").collect()}
    assert W.framed_chunked(events.limit(0), "k", ["day", "id"], "v", -3, 2, "sum", "x", F.col("day")).count() == 0


@pytest.mark.parametrize("full", [True, False])
def test_slides_chunks_and_positions_equal_plain_windows(events, full):
    from pyspark.sql import Window

    w = Window.partitionBy("k").orderBy("day", "id")
    plain = events.withColumn("n", F.row_number().over(w)).withColumn("s", F.collect_list("v").over(w.rowsBetween(0, 3)))
    plain = {r.id: r for r in plain.collect()}
    got = W.slide(events, "k", ["day", "id"], "v", 4, "s", full).collect()
    assert {r.id: r.s for r in got} == {i: r.s for i, r in plain.items() if not full or len(r.s) == 4}
    assert {r.id: r.n for r in W.positions(events, "k", ["day", "id"], "n").collect()} == {i: r.n for i, r in plain.items()}
    assert {r.id: r.c for r in W.chunk(events, "k", ["day", "id"], 7, "c").collect()} == {i: (r.n - 1) // 7 for i, r in plain.items()}


@pytest.mark.parametrize("n,lead,default", [(1, False, None), (2, True, 0.5), (500, False, None), (7, True, None)])
def test_shifts_equal_plain_windows(events, n, lead, default):
    a = W.shift(events, "k", ["day", "id"], "v", n, default, lead, "x", chunk=F.col("day"))
    b = W.shift(events, "k", ["day", "id"], "v", n, default, lead, "x")
    assert {r.id: r.x for r in a.collect()} == {r.id: r.x for r in b.collect()}
