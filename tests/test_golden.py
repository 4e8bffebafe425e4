"""Golden mini-tables for edge cases (our own values, hand-computed answers)."""

import datetime as dt

from pyspark.sql import functions as F

from tessera.functions import scalars as S
from tessera.operators import aggs, joins, sequences, sets, windows


def ts(s):
    return dt.datetime.fromisoformat(s)


def test_session_gap_boundary(spark):
    rows = [(1, 1, ts("2024-01-01 10:00:00")), (2, 1, ts("2024-01-01 10:30:00")),  # exactly 30 min: same session
            (3, 1, ts("2024-01-01 11:00:01")),  # 30 min 1 s: new session
            (4, 2, ts("2024-01-01 10:00:00"))]
    df = spark.createDataFrame(rows, "event_id long, user_id long, ts timestamp_ntz")
    out = sequences.sessionize(df, "user_id", "ts", 1800, id_col="event_id").orderBy("user_id", "session_no").collect()
    assert [(r.user_id, r.session_no, r.n_events) for r in out] == [(1, 1, 2), (1, 2, 1), (2, 1, 1)]


def test_session_chunks_across_midnight(spark):
    rows = [(1, 1, ts("2024-01-01 23:50:00")), (2, 1, ts("2024-01-02 00:10:00")), (3, 1, ts("2024-01-02 02:00:00"))]
    df = spark.createDataFrame(rows, "event_id long, user_id long, ts timestamp_ntz")
    out = sequences.sessionize(df, "user_id", "ts", 1800, id_col="event_id").orderBy("session_no").collect()
    assert [r.n_events for r in out] == [2, 1]


def test_not_in_with_null_is_empty(spark):
    a = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    b = spark.createDataFrame([(1,), (None,)], "k int")
    assert joins.anti(a, b.withColumnRenamed("k", "kb"), "k", "kb", null_aware=True).count() == 0
    assert sorted(r.k or -1 for r in joins.anti(a, b.withColumnRenamed("k", "kb"), "k", "kb").collect()) == [-1, 2]


def test_median_odd_even(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("a", 2.0), ("b", 1.0), ("b", 4.0)], "g string, v double")
    got = {r.g: r.median for r in aggs.median_by(df, "g", "v").collect()}
    assert got == {"a": 2.0, "b": 2.5}


def test_month_end_and_iso_week(spark):
    df = spark.createDataFrame([(dt.date(2020, 1, 31),), (dt.date(2024, 12, 30),)], "d date")
    r = df.select(S.add_months("d", 1).alias("m"), F.weekofyear("d").alias("w"),
                  F.expr("extract(YEAROFWEEK FROM d)").alias("y")).collect()
    assert r[0].m == dt.date(2020, 2, 29)
    assert (r[1].w, r[1].y) == (1, 2025)


def test_retention_across_year_end(spark):
    df = spark.createDataFrame([(1, dt.date(2023, 12, 5)), (1, dt.date(2024, 1, 7)), (2, dt.date(2023, 12, 9))],
                               "c long, d date")
    got = {r.m: (r.retained, r.churned) for r in sequences.retention(df, "c", "d").collect()}
    dec = 2023 * 12 + 11
    assert got[dec] == (1, 1)


def test_ties_in_top_n(spark):
    df = spark.createDataFrame([("x", 1, 5.0), ("x", 2, 5.0), ("x", 3, 4.0)], "g string, id int, v double")
    dense = windows.top_n_per(df, "g", [F.col("v").desc()], 1, "dense_rank").count()
    rown = windows.top_n_per(df, "g", [F.col("v").desc(), "id"], 1, "row_number").collect()
    assert dense == 2 and rown[0].id == 1


def test_merge_intervals_touching(spark):
    df = spark.createDataFrame([(1, 1, 3), (1, 3, 5), (1, 7, 8), (2, 1, 2)], "k int, s int, e int")
    got = sorted((r.k, r.start, r.end) for r in sequences.merge_intervals(df, "k", "s", "e").collect())
    assert got == [(1, 1, 5), (1, 7, 8), (2, 1, 2)]


def test_islands_and_first_missing(spark):
    df = spark.createDataFrame([(1, v) for v in [1, 2, 3, 5, 6, 9]], "k int, v int")
    got = sorted((r.start, r.end) for r in sequences.islands(df, "k", "v").collect())
    assert got == [(1, 3), (5, 6), (9, 9)]
    assert sequences.first_missing(df, "k", "v").first().first_missing == 4


def test_business_days_closed_form(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 5), dt.date(2024, 1, 15))], "a date, b date")  # Fri .. Mon
    hol = spark.createDataFrame([("2024-01-08",)], "holiday string")
    assert sequences.business_days_between(df, "a", "b", hol).first().business_days == 6


def test_as_of_prefers_latest_state(spark):
    facts = spark.createDataFrame([(1, ts("2024-01-02 00:00:00")), (1, ts("2024-01-05 00:00:00"))], "k int, t timestamp_ntz")
    st = spark.createDataFrame([(1, ts("2024-01-01 00:00:00"), "a"), (1, ts("2024-01-05 00:00:00"), "b")],
                               "k int, eff timestamp_ntz, rate string")
    got = [r.rate for r in joins.as_of(facts, st, "k", "t", "eff", ["rate"]).orderBy("t").collect()]
    assert got == ["a", "b"]


def test_near_join_buckets_no_duplicates(spark):
    a = spark.createDataFrame([(1, 1, ts("2024-01-01 00:00:00"))], "k int, ida int, ta timestamp_ntz")
    b = spark.createDataFrame([(1, i, ts(f"2024-01-01 00:{i:02d}:00")) for i in range(0, 30)], "k int, idb int, tb timestamp_ntz")
    got = joins.near_join(a, b, "k", "ta", "tb", 0, 900).count()
    assert got == 16  # minutes 0..15 inclusive


def test_symmetric_dedup_and_duplicates(spark):
    df = spark.createDataFrame([("A", "B", 100, 1), ("B", "A", 100, 2), ("A", "B", 200, 3)], "a string, b string, d int, o int")
    assert sets.dedup_symmetric(df, "a", "b", ["d"], ["o"]).count() == 2


def test_chunked_forms_equal_plain_forms(spark):
    rows = [(1, 1, 3), (1, 1, 3), (1, 3, 5), (1, 7, 8), (1, 8, 20), (1, 21, 22), (2, 1, 2), (2, 1, 9), (2, 30, 31)]
    df = spark.createDataFrame(rows, "k int, s int, e int")
    plain = sorted(tuple(r) for r in sequences.merge_intervals(df, "k", "s", "e").collect())
    chunked = sorted(tuple(r) for r in sequences.merge_intervals(df, "k", "s", "e", chunk=F.floor(F.col("s") / 4)).collect())
    assert plain == chunked == [(1, 1, 5), (1, 7, 20), (1, 21, 22), (2, 1, 9), (2, 30, 31)]
    ov_plain = {r.k: r.overlaps for r in sequences.overlap_count(df.withColumn("id", F.monotonically_increasing_id()),
                                                                  "k", "s", "e", "id").collect()}
    ov_chunk = {r.k: r.overlaps for r in sequences.overlap_count(df.withColumn("id", F.monotonically_increasing_id()),
                                                                  "k", "s", "e", "id", chunk=F.floor(F.col("s") / 4)).collect()}
    assert ov_plain == ov_chunk
    vals = spark.createDataFrame([(1, v) for v in [1, 2, 3, 5, 6, 9, 10, 11, 12]], "k int, v int")
    a = sorted(tuple(r) for r in sequences.islands(vals, "k", "v").collect())
    b = sorted(tuple(r) for r in sequences.islands(vals, "k", "v", chunk=F.floor(F.col("v") / 4)).collect())
    assert a == b == [(1, 1, 3, 3), (1, 5, 6, 2), (1, 9, 12, 4)]
    ev = spark.createDataFrame([(1, i, float(i * i)) for i in range(12)], "k int, t int, v double")
    p1 = sorted(tuple(r) for r in windows.shift(ev, "k", ["t"], "v", lead=True, out="nx").collect())
    p2 = sorted(tuple(r) for r in windows.shift(ev, "k", ["t"], "v", lead=True, out="nx", chunk=F.floor(F.col("t") / 5)).collect())
    assert p1 == p2


def test_chunked_frames_equal_plain_frames_with_tiny_chunks(spark):
    import random
    rnd = random.Random(5)
    rows = [(k, t, float(rnd.randint(-9, 9))) for k in (1, 2) for t in sorted(rnd.sample(range(200), 40))]
    df = spark.createDataFrame(rows, "k int, t int, v double")
    chunk = F.floor(F.col("t") / 7)  # many chunks with 0-3 rows: halo spans several chunks
    for lo, hi, agg in [(-3, 0, "sum"), (-1, 1, "avg"), (0, 3, "max"), (-2, 2, "min"), (0, 4, "count")]:
        plain = windows.framed(df, "k", ["t"], "v", lo, hi, agg, "x").select("k", "t", "x")
        chunked = windows.framed_chunked(df, "k", ["t"], "v", lo, hi, agg, "x", chunk).select("k", "t", "x")
        a = sorted((r.k, r.t, None if r.x is None else round(float(r.x), 9)) for r in plain.collect())
        b = sorted((r.k, r.t, None if r.x is None else round(float(r.x), 9)) for r in chunked.collect())
        assert a == b, (lo, hi, agg)


def test_chunked_fill_down_crosses_empty_chunks(spark):
    rows = [(1, 1, "a"), (1, 2, None), (1, 9, None), (1, 20, None), (1, 21, "b"), (1, 30, None), (2, 5, None)]
    df = spark.createDataFrame(rows, "k int, t int, c string")
    plain = sorted(tuple(r) for r in sequences.fill_down(df, "t", "c", by=["k"]).collect())
    chunked = sorted(tuple(r) for r in sequences.fill_down(df, "t", "c", by=["k"], chunk=F.floor(F.col("t") / 5)).collect())
    assert plain == chunked
    assert [r[2] for r in chunked if r[0] == 1] == ["a", "a", "a", "a", "b", "b"]


def test_sessionize_matches_python_reference_with_tiny_chunks(spark):
    import random
    rnd = random.Random(3)
    base = ts("2024-01-01 00:00:00")
    rows, eid = [], 0
    for user in (1, 2, 3):
        t = base
        for _ in range(60):
            t = t + dt.timedelta(seconds=rnd.choice([60, 600, 1799, 1800, 1801, 4000, 20000]))
            rows.append((eid, user, t))
            eid += 1
    df = spark.createDataFrame(rows, "event_id long, user_id long, ts timestamp_ntz")
    got = sorted((r.user_id, r.session_no, r.n_events) for r in
                 sequences.sessionize(df, "user_id", "ts", 1800, chunk=F.date_trunc("hour", "ts"), id_col="event_id").collect())
    want = []
    for user in (1, 2, 3):
        times = sorted(t for _, u, t in rows if u == user)
        n, size = 1, 1
        for a, b in zip(times, times[1:]):
            if (b - a).total_seconds() > 1800:
                want.append((user, n, size))
                n, size = n + 1, 1
            else:
                size += 1
        want.append((user, n, size))
    assert got == sorted(want)


def test_chunked_ranks_equal_plain_ranks(spark):
    import random
    rnd = random.Random(8)
    rows = [(k, i, rnd.randint(0, 30)) for k in (1, 2) for i in range(80)]
    df = spark.createDataFrame(rows, "k int, id int, v int")
    for kind in ("row_number", "rank", "dense_rank"):
        order = ["v", "id"] if kind == "row_number" else ["v"]
        plain = sorted(tuple(r) for r in windows.rank_rows(df, "k", order, kind, "r").select("k", "id", "v", "r").collect())
        chunked = sorted(tuple(r) for r in windows.rank_rows_chunked(df, "k", "v", kind, "r", F.floor(F.col("v") / 4),
                                                                     tie=["id"] if kind == "row_number" else ())
                         .select("k", "id", "v", "r").collect())
        assert plain == chunked, kind
        via = sorted(tuple(r) for r in windows.rank_rows(df, "k", order, kind, "r", chunk=F.floor(F.col("v") / 4))
                     .select("k", "id", "v", "r").collect())
        assert via == plain, kind
