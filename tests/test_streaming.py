"""Structured Streaming jobs on file sources with availableNow triggers."""

import datetime as dt
import os
import shutil

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators import joins, sequences
from tessera.streaming import jobs


def _write_csv(path, rows):
    with open(path, "w") as fh:
        for r in rows:
            fh.write(",".join(str(x) for x in r) + "\n")


def test_ingest_once_restart_and_bad_rows(spark, tmp):
    src, out, ck = (os.path.join(tmp, x) for x in ("in", "out", "ck"))
    os.makedirs(src)
    schema = T.StructType.fromDDL("id long, amount double")
    _write_csv(os.path.join(src, "a.csv"), [(1, 1.5), (2, "oops"), (3, 2.0)])
    jobs.start_ingest(spark, src, schema, out, ck).awaitTermination()
    assert spark.read.parquet(f"{out}/data").count() == 2
    assert spark.read.parquet(f"{out}/_bad").count() == 1
    # restart with no new file: nothing new is written
    jobs.start_ingest(spark, src, schema, out, ck).awaitTermination()
    assert spark.read.parquet(f"{out}/data").count() == 2
    _write_csv(os.path.join(src, "b.csv"), [(4, 3.0)])
    jobs.start_ingest(spark, src, schema, out, ck).awaitTermination()
    assert spark.read.parquet(f"{out}/data").count() == 3
    audit = spark.read.parquet(f"{out}/_audit").agg(F.sum("rows"), F.sum("bad_rows")).first()
    assert tuple(audit) == (4, 1)


def test_fanout_and_consumers_offsets(spark, tmp):
    feed, ck1, ck2 = (os.path.join(tmp, x) for x in ("feed", "ck1", "ck2"))
    schema = T.StructType.fromDDL("k long, v string")
    spark.createDataFrame([(1, "a"), (2, "b")], schema).write.parquet(f"{feed}/part=1")
    q = jobs.consume(spark, feed, schema, ck1, os.path.join(tmp, "s1"), os.path.join(tmp, "p1"))
    q.awaitTermination()
    spark.createDataFrame([(3, "c")], schema).write.parquet(f"{feed}/part=2")
    jobs.consume(spark, feed, schema, ck1, os.path.join(tmp, "s1"), os.path.join(tmp, "p1")).awaitTermination()
    jobs.consume(spark, feed, schema, ck2, os.path.join(tmp, "s2")).awaitTermination()
    assert spark.read.parquet(os.path.join(tmp, "s1")).count() == 3  # each change once for consumer 1
    assert spark.read.parquet(os.path.join(tmp, "s2")).count() == 3  # and once for consumer 2
    stream = spark.readStream.schema(schema).parquet(feed)
    sinks = {"all": jobs.folder_sink(os.path.join(tmp, "fa")),
             "b_only": jobs.folder_sink(os.path.join(tmp, "fb"), lambda d: d.filter("v = 'b'"))}
    jobs.start_fanout(stream, sinks, os.path.join(tmp, "ck3")).awaitTermination()
    assert spark.read.parquet(os.path.join(tmp, "fa")).count() == 3
    assert spark.read.parquet(os.path.join(tmp, "fb")).count() == 1


def test_inventory_state(spark, tmp):
    src = os.path.join(tmp, "sales")
    schema = T.StructType.fromDDL("item long, qty double")
    spark.createDataFrame([(1, 10.0), (1, -4.0), (2, 5.0)], schema).coalesce(1).write.mode("append").parquet(src)
    spark.createDataFrame([(1, -3.0)], schema).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    q = (jobs.inventory(stream, "item", "qty", limit=5).writeStream.outputMode("update").format("memory")
         .queryName("inv").option("checkpointLocation", os.path.join(tmp, "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    last = {r.item: (r.stock, r.low_stock) for r in spark.sql("SELECT * FROM inv").orderBy("updates").collect()}
    assert last[1] == (3.0, True) and last[2] == (5.0, False)


def test_late_rows_go_aside_and_repeats_drop(spark, tmp):
    src = os.path.join(tmp, "ev")
    schema = T.StructType.fromDDL("id long, ts timestamp_ntz")
    d = dt.datetime
    spark.createDataFrame([(1, d(2024, 1, 1, 12)), (2, d(2024, 1, 1, 12, 5))], schema).coalesce(1).write.mode("append").parquet(src)
    spark.createDataFrame([(2, d(2024, 1, 1, 12, 6)), (3, d(2024, 1, 1, 9))], schema).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    out, late, hw = (os.path.join(tmp, x) for x in ("ok", "late", "hw"))
    jobs.start_dedup_late(stream, "id", "ts", 3600, out, late, hw, os.path.join(tmp, "ck")).awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == [1, 2]
    assert [r.id for r in spark.read.parquet(late).collect()] == [3]


def test_stream_stream_join_and_sessions_match_batch(spark, sf, tmp):
    e = spark.read.parquet(f"{sf}/events.parquet")
    src = os.path.join(tmp, "events")
    e.write.parquet(src)
    stream = spark.readStream.schema(e.schema).parquet(src)
    a = stream.filter("event_type = 'view'").select("user_id", F.col("event_id").alias("view_id"), F.col("ts").alias("ts_a"))
    b = stream.filter("event_type = 'purchase'").select("user_id", F.col("event_id").alias("purchase_id"), F.col("ts").alias("ts_b"))
    q = (jobs.near_join_stream(a, b, "user_id", "ts_a", "ts_b", 900).select("view_id", "purchase_id")
         .writeStream.format("memory").queryName("nj").option("checkpointLocation", os.path.join(tmp, "ck"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    got = sorted(tuple(r) for r in spark.sql("SELECT * FROM nj").collect())
    ba = e.filter("event_type = 'view'").select("user_id", F.col("event_id").alias("view_id"), F.col("ts").alias("ts_a"))
    bb = e.filter("event_type = 'purchase'").select("user_id", F.col("event_id").alias("purchase_id"), F.col("ts").alias("ts_b"))
    want = sorted(tuple(r) for r in joins.near_join(ba, bb, "user_id", "ts_a", "ts_b", 0, 900)
                  .select("view_id", "purchase_id").collect())
    assert got == want
    sess = jobs.sessions(e, "user_id", "ts", "30 minutes").count()
    assert sess == sequences.sessionize(e, "user_id", "ts", 1800, id_col="event_id").count()


def test_log_tail(spark, tmp):
    src, out = os.path.join(tmp, "logs"), os.path.join(tmp, "parsed")
    os.makedirs(src)
    with open(os.path.join(src, "a.log"), "w") as fh:
        fh.write("2024-01-01 10:00:00,000 INFO [main] hello\ngarbage\n")
    jobs.start_log_tail(spark, src, out, os.path.join(tmp, "ck")).awaitTermination()
    rows = spark.read.parquet(out).collect()
    assert sum(r._ok for r in rows) == 1 and len(rows) == 2
