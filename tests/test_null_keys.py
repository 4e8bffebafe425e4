"""NULL keys, NULL chunks and NULL values: the chunked forms equal the plain ones."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.functions.scalars import hash_key
from tessera.operators import aggs, joins, sampling, semi, sequences, versions, windows
from tessera.operators.common import dense_ids, global_prefix_sum, lag_chunked, prefix_sum, running_extreme, shift_many_chunked
from tessera.operators.text import _token_len, split_text

ROWS = [(k, o, v) for k in (None, "a", "b") for o, v in
        ((None, 4.0), (1, 5.0), (2, None), (3, 7.0), (11, None), (12, 1.0), (25, None))] + [("c", 1, None), ("c", 2, 3.0)]


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(ROWS, "k string, o int, v double")


def ch():
    return F.floor(F.col("o") / 10)


def same(a, b, cols):
    assert sorted(map(str, a.select(*cols).collect())) == sorted(map(str, b.select(*cols).collect()))


def test_prefix_sum(df):
    plain = windows.framed(df, "k", ["o"], "v", Window.unboundedPreceding, Window.currentRow, "sum", "r")
    same(prefix_sum(df, ["k"], ["o"], "v", "r", ch()), plain, ["k", "o", "r"])


@pytest.mark.parametrize("exclusive", [False, True])
def test_running_extreme(df, exclusive):
    plain = windows.framed(df, "k", ["o"], "v", Window.unboundedPreceding, -1 if exclusive else 0, "max", "r")
    same(running_extreme(df, ["k"], "o", "v", "r", ch(), "max", exclusive=exclusive), plain, ["k", "o", "r"])


def test_lag_and_shift(df):
    w = Window.partitionBy("k").orderBy("o")
    plain = df.withColumn("prev_v", F.lag("v").over(w)).withColumn("l2", F.lag("v", 2).over(w))
    same(lag_chunked(df, ["k"], "o", ["v"], ch()), plain, ["k", "o", "prev_v"])
    s = shift_many_chunked(df, ["k"], "o", "v", 2, ch(), "l")
    same(s, plain, ["k", "o", "l2"])


def test_group_forms(df):
    plain = df.withColumn("t", F.sum("v").over(Window.partitionBy("k")))
    same(windows.group_total(df, "k", "v", out="t"), plain, ["k", "o", "t"])
    w = Window.partitionBy("k").orderBy("o")
    second = df.withColumn("rn", F.row_number().over(w)).filter("rn = 2")
    same(windows.nth_else_only(df, "k", ["o"]), second, ["k", "o", "v"])
    assert windows.nth_or_last(df, "k", ["o"], 99).count() == 4
    for kind in ("row_number", "rank", "dense_rank"):
        same(windows.rank_rows_chunked(df, "k", "o", kind, "r", ch()), windows.rank_rows(df, "k", ["o"], kind, "r"), ["k", "o", "r"])


def test_sequences(df):
    filled = df.withColumn("f", F.last("v", ignorenulls=True).over(Window.partitionBy("k").orderBy("o")))
    same(sequences.fill_down(df, "o", "v", by=["k"], chunk=ch(), out="f"), filled, ["k", "o", "f"])
    flag = F.col("v").isNotNull()
    same(sequences.runs_of(df, "k", ["o"], flag, 2, chunk=ch()), sequences.runs_of(df, "k", ["o"], flag, 2), ["k", "o"])


def test_median_and_sample(df):
    want = df.groupBy("k").agg(F.median("v").alias("m"))
    same(aggs.median_by(df, ["k"], "v", "m"), want, ["k", "m"])
    assert aggs.median_by(df, None, "v", "m").collect() == df.agg(F.median("v").alias("m")).collect()
    got = sampling.sample_stratified(df, "k", "o", 0.5).groupBy("k").count().collect()
    assert {r.k: r["count"] for r in got} == {None: 4, "a": 4, "b": 4, "c": 1}


def test_hash_tells_null_empty_and_separators_apart(spark):
    d = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "a|b", "c"), (4, "a", "b|c"), (5, "1:a", "-"), (6, "a", None)],
                              "i int, p string, q string")
    assert d.select(hash_key(["p", "q"]).alias("h")).distinct().count() == 6
    old = spark.createDataFrame([(1, None), (2, "a|b")], "id int, p string")
    new = spark.createDataFrame([(1, ""), (2, "a|b")], "id int, p string")
    assert versions.diff(old, new, "id").count() == 2


def test_as_of_takes_all_columns_of_one_state(spark):
    facts = spark.createDataFrame([(1, 5), (1, 0), (None, 9)], "k int, t int")
    states = spark.createDataFrame([(1, 1, "a", "x"), (1, 3, "b", None), (None, 2, "c", "y")], "k int, e int, p string, q string")
    got = joins.as_of(facts, states, "k", "t", "e", ["p", "q"])
    assert sorted(map(str, ((r.k, r.t, r.p, r.q) for r in got.collect()))) == sorted(
        map(str, [(1, 5, "b", None), (1, 0, None, None), (None, 9, "c", "y")]))


def test_not_in(spark):
    a = spark.createDataFrame([(1,), (2,), (None,)], "x int")
    b = spark.createDataFrame([(1,)], "y int")
    rows = lambda d: sorted((r.x is None, r.x or 0) for r in d.collect())
    assert rows(joins.anti(a, b.limit(0), "x", "y", True)) == [(False, 1), (False, 2), (True, 0)]
    assert rows(joins.anti(a, b, "x", "y", True)) == [(False, 2)]
    assert rows(joins.anti(a, b.union(b.select(F.lit(None).cast("int"))), "x", "y", True)) == []


def test_band_join_and_cross(spark):
    d = spark.createDataFrame([(float(i),) for i in range(-5, 60)] + [(None,)], "v double")
    bands = spark.createDataFrame([(0.0, 9.5, "a"), (5.0, 50.0, "b"), (7.0, 7.0, "c"), (None, 1.0, "n")], "lo double, hi double, b string")
    want = [(v, b) for v in range(-5, 60) for lo, hi, b in ((0, 9.5, "a"), (5, 50, "b"), (7, 7, "c")) if lo <= v <= hi]
    assert sorted((r.v, r.b) for r in joins.band_join(d, bands, "v", "lo", "hi").collect()) == sorted(want)
    assert joins.cross(d, bands).count() == 66 * 4


def test_dense_ids(spark):
    d = spark.createDataFrame([(f"w{i:04d}",) for i in range(500)], "w string").repartition(7)
    assert sorted((r.w, r.n) for r in dense_ids(d, "n", 3).collect()) == [(f"w{i:04d}", i + 3) for i in range(500)]


def test_stable_hash_spreads_strided_keys(spark):
    kept = sampling.sample_stable(spark.range(0, 10_000_000, 10_000), "id", 0.1).count()
    assert 60 <= kept <= 140


def test_json_chunks_keep_the_limit_and_the_nesting(spark):
    import json
    doc = {"a": {"b": 1, "c": ["x" * 60, {"d": "y" * 60}]}, "e": "z" * 60, "f": "w" * 300}
    rows = [(1, json.dumps(doc)), (2, "{bad"), (3, None), (4, "{}")]
    got = semi.json_chunks(spark.createDataFrame(rows, "id int, j string"), "id", "j", 100).orderBy("id", "chunk_no").collect()
    one = [r for r in got if r.id == 1]
    assert [p for r in one for p in r.paths] == ["a.b", "a.c[0]", "a.c[1].d", "e", "f"]
    assert all(len(r.chunk) <= 100 or len(r.paths) == 1 for r in got)
    assert {r.id for r in got} <= {1, 4}
    assert spark.createDataFrame(rows, "id int, j string").select(semi.json_path("j", "$.a.b", "int").alias("x")).collect()[1].x is None


def test_no_chunk_lies_inside_another():
    text = "\n\n".join(" ".join("word%d" % (i * j % 17) for i in range(j % 23 + 1)) for j in range(60))
    for size, overlap, length in ((40, 25, len), (80, 70, len), (9, 7, _token_len)):
        chunks = split_text(text, size, overlap, length=length)
        assert all(length(c) <= size for _, _, c in chunks)
        assert all(b[1] > a[1] and b[0] > a[0] for a, b in zip(chunks, chunks[1:]))
        assert chunks[0][0] == 0 and chunks[-1][1] == len(text)
        assert all(b[0] <= a[1] for a, b in zip(chunks, chunks[1:]))


def test_global_prefix_sum_keeps_null_order_rows(spark):
    d = spark.createDataFrame([(None, 1), (1, 2), (2, None), (3, 4)], "o int, v int")
    got = {r.o: r.r for r in global_prefix_sum(d, "o", [], "v", "r", 4).collect()}
    assert got == {None: 1, 1: 3, 2: 3, 3: 7}
