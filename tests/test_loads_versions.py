"""File-based load jobs and table versions (LOAD-*, VER-*, SRC-*, LAY-*)."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators import layout, versions
from tessera.sources import loads, scans


def _orders_files(spark, sf, root):
    """Five CSV files: good; one bad number; >10% bad; wrong column count; empty."""
    o = spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey", "o_custkey", "o_totalprice").orderBy("o_orderkey")
    rows = [tuple(str(x) for x in r) for r in o.limit(100).collect()]
    files = {
        "f1.csv": rows[:20],
        "f2.csv": rows[20:40][:19] + [(rows[39][0], rows[39][1], "12.5x")],
        "f3.csv": [(a, b, "bad") if i < 5 else (a, b, c) for i, (a, b, c) in enumerate(rows[40:60])],
        "f4.csv": [(a, b) for a, b, c in rows[60:70]],
        "f5.csv": [],
    }
    os.makedirs(root, exist_ok=True)
    for name, rs in files.items():
        with open(os.path.join(root, name), "w") as fh:
            for r in rs:
                fh.write(",".join(r) + "\n")
    return files


def test_error_policies(spark, sf, tmp):
    _orders_files(spark, sf, tmp)
    schema = T.StructType.fromDDL("o_orderkey string, o_custkey string, o_totalprice string")
    raw = spark.read.schema(schema).csv(tmp).withColumn("file", F.col("_metadata.file_name"))
    bad = F.col("o_totalprice").try_cast("double").isNull()
    cont = loads.apply_error_policy(raw, "file", bad, "continue").count()
    skip = loads.apply_error_policy(raw, "file", bad, "skip_file").select("file").distinct().collect()
    pct = loads.apply_error_policy(raw, "file", bad, "skip_file_pct", 10).select("file").distinct().collect()
    assert cont == 20 + 19 + 15
    assert {r.file for r in skip} == {"f1.csv"}
    assert {r.file for r in pct} == {"f1.csv", "f2.csv"}
    with pytest.raises(ValueError):
        loads.apply_error_policy(raw, "file", bad, "abort")


def test_good_bad_partition_input(spark, sf):
    e = spark.read.parquet(f"{sf}/events.parquet").select(
        F.col("event_id").cast("string").alias("event_id"),
        F.when(F.col("event_type") == "error", F.lit("x")).otherwise(F.col("value").cast("string")).alias("value"))
    good, bad = loads.split_good_bad(e, T.StructType.fromDDL("event_id long, value double"), required=["event_id"])
    assert good.count() + bad.count() == e.count()
    assert bad.count() == e.filter(F.col("value") == "x").count()


def test_length_policy_four_ways(spark):
    df = spark.createDataFrame([("abc",), ("abcdef",)], "s string")
    g, r = loads.apply_length(df, {"s": 4}, truncate=False, enforce=True)
    assert (g.count(), r.count()) == (1, 1)
    g, r = loads.apply_length(df, {"s": 4}, truncate=True, enforce=True)
    assert (g.count(), r.count()) == (1, 1)
    g, _ = loads.apply_length(df, {"s": 4}, truncate=True, enforce=False)
    assert sorted(x.s for x in g.collect()) == ["abc", "abcd"]
    g, _ = loads.apply_length(df, {"s": 4}, truncate=False, enforce=False)
    assert sorted(x.s for x in g.collect()) == ["abc", "abcdef"]


def test_ledger_idempotent_and_force(spark, tmp):
    inv = spark.createDataFrame([("a.csv", 10, 1), ("b.csv", 20, 2)], "file string, bytes long, mtime long")
    ledger = spark.createDataFrame([("a.csv", 10, 1)], "file string, bytes long, mtime long")
    assert [r.file for r in loads.load_new_files(inv, ledger).collect()] == ["b.csv"]
    assert loads.load_new_files(inv, ledger, force=True).count() == 2
    changed = spark.createDataFrame([("a.csv", 11, 3)], "file string, bytes long, mtime long")
    assert loads.load_new_files(changed, ledger).count() == 0  # path-only identity misses an overwrite
    assert loads.load_new_files(changed, ledger, ["file", "bytes", "mtime"]).count() == 1


def test_versions_time_travel_restore_publish(spark, tmp):
    root = os.path.join(tmp, "tbl")
    v1 = spark.createDataFrame([(1, "a")], "k int, v string")
    v2 = spark.createDataFrame([(1, "b"), (2, "c")], "k int, v string")
    assert versions.write_version(v1, root, "2024-01-01 00:00:00") == 1
    assert versions.write_version(v2, root, "2024-01-02 00:00:00") == 2
    assert versions.read_at(spark, root, "2024-01-01 12:00:00").count() == 1
    assert versions.read_at(spark, root, "2024-01-02 00:00:00").count() == 2
    assert versions.read_at(spark, root, "2024-01-02 00:00:00", before=True).count() == 1
    assert versions.restore(spark, root, 1, "2024-01-03 00:00:00") == 3
    assert versions.read_at(spark, root, "2024-01-03 00:00:00").first().v == "a"
    res = versions.publish(v2, root, "2024-01-04 00:00:00").first()
    assert res.schema_match and res.version == 4
    with pytest.raises(ValueError):
        versions.publish(spark.createDataFrame([(1,)], "k int"), root, "2024-01-05 00:00:00")


def test_diff_then_apply_is_new_snapshot(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, v string")
    new = spark.createDataFrame([(1, "a"), (2, "B"), (3, "x"), (4, "d")], "k int, v string")
    ch = versions.diff(old, new, "k")
    acts = sorted((r.k, r._action, r._is_update) for r in ch.collect())
    assert acts == [(2, "DELETE", True), (2, "INSERT", True), (3, "DELETE", True), (3, "INSERT", True), (4, "INSERT", False)]
    applied = sorted(tuple(r) for r in versions.apply_changes(old, ch, "k").collect())
    assert applied == sorted(tuple(r) for r in new.collect())


def test_replay_is_idempotent(spark, tmp):
    root = os.path.join(tmp, "changes")
    base = spark.createDataFrame([(1, "a")], "k int, v string")
    c1 = versions.diff(base, spark.createDataFrame([(1, "b"), (2, "c")], "k int, v string"), "k")
    versions.write_version(c1, root, "2024-01-01 00:00:00")
    once = versions.replay(spark, root, 1, 1, base, "k")
    twice = versions.replay(spark, root, 1, 1, once, "k")
    assert sorted(tuple(r) for r in once.collect()) == sorted(tuple(r) for r in twice.collect()) == [(1, "b"), (2, "c")]


def test_cluster_layout_and_compaction(spark, sf, tmp):
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    p = os.path.join(tmp, "clustered")
    layout.cluster(li, ["l_shipdate"], p, 4)
    rep = layout.layout_report(spark, p, "l_shipdate").collect()
    assert len(rep) == 4 and max(r.overlaps for r in rep) <= 1
    assert all(r.depth == sum(x.lo <= r.lo <= x.hi for x in rep) for r in rep)
    at = layout.depth_at(spark, p, "l_shipdate", rep[0].hi).first()
    assert (at.depth, at.files) == (sum(x.lo <= rep[0].hi <= x.hi for x in rep), 4)
    small = os.path.join(tmp, "small")
    li.repartition(20).write.mode("overwrite").parquet(small)
    n = layout.compact(spark, small, os.path.join(tmp, "compact"), 64 << 20)
    assert n == 1 and spark.read.parquet(os.path.join(tmp, "compact")).count() == li.count()


def test_lookup_layout_prunes(spark, sf, tmp):
    o = spark.read.parquet(f"{sf}/orders.parquet")
    p = os.path.join(tmp, "lookup")
    layout.write_lookup(o, p, "o_orderkey", files=4)
    plan = spark.read.parquet(p).filter("o_orderkey = 42")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "o_orderkey" in plan
    assert spark.read.parquet(p).filter("o_orderkey = 42").count() == o.filter("o_orderkey = 42").count()


def test_split_merge_parts_keeps_order(spark, sf, tmp):
    d = spark.read.parquet(f"{sf}/region.parquet")
    p = os.path.join(tmp, "parts")
    scans.split_parts(d, p, 2, ["r_regionkey"])
    back = scans.merge_parts(spark, [p])
    assert [r.r_regionkey for r in back.collect()] == sorted(r.r_regionkey for r in d.collect())


def test_text_line_numbers_and_log_quarantine(spark, tmp):
    with open(os.path.join(tmp, "app.log"), "w") as fh:
        fh.write("2024-01-01 10:00:00,123 INFO [main] started\nnot a log line\n"
                 "2024-01-01 10:00:01,000 ERROR [worker-1] failed: x\n")
    lines = scans.lines_with_numbers(spark, tmp)
    assert [r.row_no for r in lines.orderBy("row_no").collect()] == [1, 2, 3]
    ok, bad = scans.parse_log(scans.scan_lines(spark, tmp))
    assert ok.count() == 2 and bad.count() == 1
    assert {r.level for r in ok.collect()} == {"INFO", "ERROR"}


def test_replace_all_and_publish_view(spark, sf, tmp):
    part = spark.read.parquet(f"{sf}/part.parquet")
    root = os.path.join(tmp, "part_tbl")
    assert loads.replace_all(part.limit(5), root, "2024-01-01 00:00:00") == 1
    assert loads.replace_all(part, root, "2024-01-02 00:00:00") == 2
    assert versions.read_at(spark, root, "2024-01-03 00:00:00").count() == part.count()
    v = scans.publish_view(part.filter("p_size > 10"), "big_parts", cached=True)
    assert spark.sql("SELECT count(*) FROM big_parts").first()[0] == v.count()
    spark.catalog.uncacheTable("big_parts")
