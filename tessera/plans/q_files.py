"""Registered queries for file- and stream-based jobs: each runs the job on
a fresh folder under the session's checkpoint directory, reads the result
back, and is checked against SQL on the source table."""

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T_

from tessera.functions.scalars import date_str
from tessera.operators import layout, versions
from tessera.plans.registry import register
from tessera.session import load_table as T
from tessera.session import scratch_path
from tessera.sources import loads, scans
from tessera.streaming import jobs


def _fresh(spark, name):
    return scratch_path(spark, f"files/{name}-{uuid.uuid4().hex[:12]}")


_OLD = "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'"


@register("VER-04", "ver04_time_travel_read", _OLD)
def ver04(spark, sf):
    root = _fresh(spark, "versions")
    o = T(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    versions.write_version(o.filter(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")).drop("o_orderdate"),
                           root, "2024-01-01 00:00:00")
    versions.write_version(o.drop("o_orderdate"), root, "2024-02-01 00:00:00")
    return versions.read_at(spark, root, "2024-01-15 00:00:00")


@register("VER-05", "ver05_restore_version", _OLD)
def ver05(spark, sf):
    root = _fresh(spark, "restore")
    o = T(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    versions.write_version(o.filter(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")).drop("o_orderdate"),
                           root, "2024-01-01 00:00:00")
    versions.write_version(o.drop("o_orderdate"), root, "2024-02-01 00:00:00")
    versions.restore(spark, root, 1, "2024-03-01 00:00:00")
    return versions.read_at(spark, root, "2024-03-02 00:00:00")


@register("VER-06", "ver06_publish_refreshed_table", """
SELECT true AS schema_match, (SELECT count(*) FROM part WHERE p_size <= 25) AS current_rows, count(*) AS staged_rows,
       CAST(2 AS BIGINT) AS version FROM part""")
def ver06(spark, sf):
    root = _fresh(spark, "publish")
    p = T(spark, sf, "part")
    versions.write_version(p.filter("p_size <= 25"), root, "2024-01-01 00:00:00")
    return versions.publish(p, root, "2024-01-02 00:00:00")


@register("LOAD-11", "load11_partition_overwrite", """
WITH o AS (SELECT *, year(o_orderdate) * 100 + month(o_orderdate) AS ym FROM orders),
edge AS (SELECT max(ym) - 1 AS e FROM o WHERE o_orderstatus = 'O')
SELECT o_orderkey, 'base' AS src, CAST(ym AS INTEGER) AS ym FROM o, edge WHERE ym < e
UNION ALL
SELECT o_orderkey, 'stage', CAST(ym AS INTEGER) FROM o, edge WHERE o_orderstatus = 'O' AND ym >= e""")
def load11b(spark, sf):
    path = _fresh(spark, "partitions")
    ym = (F.year("o_orderdate") * 100 + F.month("o_orderdate")).alias("ym")
    o = T(spark, sf, "orders").select("o_orderkey", "o_orderstatus", ym)
    o.select("o_orderkey", F.lit("base").alias("src"), "ym").repartition("ym").write.partitionBy("ym").parquet(path)
    stage = o.filter("o_orderstatus = 'O'").select("o_orderkey", F.lit("stage").alias("src"), "ym")
    edge = stage.agg(F.max("ym")).first()[0] - 1  # one number
    loads.reload_partitions(stage.repartition("ym"), path, "ym", edge)
    return spark.read.schema("o_orderkey long, src string, ym int").parquet(path)


@register("LOAD-10", "load10_truncate_and_reload", """SELECT p_partkey, p_name FROM part""")
def load10(spark, sf):
    root = _fresh(spark, "reload")
    p = T(spark, sf, "part").select("p_partkey", "p_name")
    loads.replace_all(p.filter("p_size < 10"), root, "2024-01-01 00:00:00")
    loads.replace_all(p, root, "2024-01-02 00:00:00")
    return versions.read_at(spark, root, "2024-01-03 00:00:00")


@register("LOAD-02", "load02_error_policy_skip_file_pct", """
WITH f AS (SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, event_id, CASE WHEN event_type = 'error' AND day(ts) % 3 = 0 THEN NULL ELSE value END AS v FROM events),
 bad AS (SELECT day, count_if(v IS NULL) * 100.0 / count(*) AS pct FROM f GROUP BY 1)
SELECT f.event_id FROM f JOIN bad USING (day) WHERE bad.pct < 10 AND f.v IS NOT NULL""")
def load02(spark, sf):
    p = _fresh(spark, "daily_csv")
    e = T(spark, sf, "events")
    txt = F.when((F.col("event_type") == "error") & (F.dayofmonth("ts") % 3 == 0), F.lit("n/a")) \
           .otherwise(F.col("value").cast("string"))
    e.select(date_str("ts").alias("day"), "event_id", txt.alias("v")).write.partitionBy("day").mode("overwrite").csv(p)
    raw = spark.read.schema("event_id long, v string, day string").csv(p).withColumn("file", F.col("_metadata.file_path"))
    bad = F.col("v").try_cast("double").isNull()
    return loads.apply_error_policy(raw, "day", bad, "skip_file_pct", 10).select("event_id")


@register("LOAD-05", "load05_new_files_from_ledger", """
SELECT o_orderstatus AS status, CAST(count(*) AS BIGINT) AS rows FROM orders WHERE o_orderstatus <> 'F' GROUP BY 1""")
def load05(spark, sf):
    p = _fresh(spark, "landing")
    T(spark, sf, "orders").write.partitionBy("o_orderstatus").parquet(p)
    inv = layout.inventory(spark, p)
    ledger = inv.filter(F.col("file").contains("o_orderstatus=F")).select("file")
    new = loads.load_new_files(inv, ledger)
    return new.groupBy(F.regexp_extract("file", "o_orderstatus=([^/]*)", 1).alias("status")).agg(F.sum("rows").alias("rows"))


@register("SRC-18", "src18_split_and_merge_parts", """SELECT doc_id, n_chars FROM documents""")
def src18(spark, sf):
    p = _fresh(spark, "parts")
    d = T(spark, sf, "documents").select("doc_id", "n_chars")
    scans.split_parts(d, p, 100, ["doc_id"])
    return scans.merge_parts(spark, [p])


@register("SRC-19", "src19_session_view", """SELECT p_brand, count(*) AS n FROM part WHERE p_size > 30 GROUP BY 1""")
def src19(spark, sf):
    scans.publish_view(T(spark, sf, "part").filter("p_size > 30"), "tessera_big_parts")
    return spark.sql("SELECT p_brand, count(*) AS n FROM tessera_big_parts GROUP BY p_brand")


@register("LAY-01", "lay01_cluster_then_read", """
SELECT l_orderkey, l_linenumber, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S.%f') AS l_shipdate FROM lineitem""")
def lay01(spark, sf):
    p = _fresh(spark, "clustered")
    layout.cluster(T(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate"), ["l_shipdate"], p, 4)
    return spark.read.parquet(p).withColumn("l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


@register("LAY-05", "lay05_point_lookup_layout", """SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey IN (7, 42, 4242)""")
def lay05(spark, sf):
    p = _fresh(spark, "lookup")
    layout.write_lookup(T(spark, sf, "orders").select("o_orderkey", "o_custkey"), p, "o_orderkey", files=4)
    return spark.read.parquet(p).filter(F.col("o_orderkey").isin(7, 42, 4242))


@register("LAY-06", "lay06_compact_small_files", """SELECT count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders""")
def lay06(spark, sf):
    src, out = _fresh(spark, "small"), _fresh(spark, "compacted")
    T(spark, sf, "orders").repartition(16).write.parquet(src)
    layout.compact(spark, src, out, 128 << 20)
    return spark.read.parquet(out).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@register("STR-01", "str01_file_arrival_ingest", """
SELECT event_id, user_id, value FROM events WHERE event_type <> 'error'""")
def str01(spark, sf):
    src, out, ck = _fresh(spark, "arrivals"), _fresh(spark, "ingested"), _fresh(spark, "ingest_ck")
    e = T(spark, sf, "events")
    val = F.when(F.col("event_type") == "error", F.lit("bad")).otherwise(F.col("value").cast("string"))
    e.select("event_id", "user_id", val.alias("value")).write.csv(src)
    schema = T_.StructType.fromDDL("event_id long, user_id long, value double")
    jobs.start_ingest(spark, src, schema, out, ck).awaitTermination()
    return spark.read.parquet(f"{out}/data").select("event_id", "user_id", "value")


def _event_stream(spark, sf, parts=2):
    """The events as a stream of ``parts`` files in time order."""
    src = _fresh(spark, "event_files")
    e = T(spark, sf, "events").select("event_id", "ts", "value")
    e.repartitionByRange(parts, "ts").write.parquet(src)
    return spark.readStream.schema(e.schema).parquet(src)


@register("STR-02", "str02_daily_summary_stream", """
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, round(sum(value), 2) AS revenue, count(*) AS events FROM events GROUP BY 1""")
def str02_stream(spark, sf):
    out, ck = _fresh(spark, "days"), _fresh(spark, "days_ck")
    jobs.start_daily_summary(_event_stream(spark, sf, 1), "ts", "value", out, ck).awaitTermination()
    return jobs.latest_days(spark, out).select(F.date_format("day", "yyyy-MM-dd").alias("day"),
                                               F.round("revenue", 2).alias("revenue"), "events")


@register("STR-03", "str03_alert_stream", """
SELECT event_id, CASE WHEN value >= 45 THEN 'critical' WHEN value >= 35 THEN 'warning' END AS alert
FROM events WHERE value >= 35""")
def str03_stream(spark, sf):
    out, ck = _fresh(spark, "alerts"), _fresh(spark, "alerts_ck")
    jobs.start_alerts(_event_stream(spark, sf), "value", [(35, "warning"), (45, "critical")], out, ck).awaitTermination()
    return spark.read.parquet(out).select("event_id", "alert")


@register("STR-05", "str05_inventory_levels_batch_form", """
WITH m AS (SELECT CAST(json_extract(props, '$.k') AS BIGINT) AS item, ts, event_id,
                  CASE WHEN event_type = 'purchase' THEN -value WHEN event_type = 'signup' THEN value ELSE 0 END AS qty FROM events)
SELECT item, round(100 + sum(qty), 4) AS stock, 100 + sum(qty) < 20 AS low_stock, count(*) AS updates FROM m GROUP BY item""")
def str05(spark, sf):
    e = T(spark, sf, "events")
    qty = F.when(F.col("event_type") == "purchase", -F.col("value")).when(F.col("event_type") == "signup", F.col("value")) \
           .otherwise(F.lit(0.0))
    src = _fresh(spark, "movements")
    e.select(F.get_json_object("props", "$.k").cast("long").alias("item"), qty.alias("qty"), "ts").write.parquet(src)
    stream = spark.readStream.schema("item long, qty double, ts timestamp_ntz").parquet(src)
    out = _fresh(spark, "levels")
    (jobs.inventory(stream, "item", "qty", limit=20, opening=100).writeStream.outputMode("update")
     .foreachBatch(jobs.folder_sink(out)).option("checkpointLocation", _fresh(spark, "inv_ck"))
     .trigger(availableNow=True).start().awaitTermination())
    last = spark.read.parquet(out)
    return last.groupBy("item").agg(F.max_by(F.struct("stock", "low_stock", "updates"), "updates").alias("s")) \
               .select("item", F.round("s.stock", 4).alias("stock"), "s.low_stock", "s.updates")


@register("STR-09", "str09_stream_dedup_within_watermark", """
SELECT DISTINCT user_id, event_type, strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S.%f') AS hour FROM events""")
def str09(spark, sf):
    src = _fresh(spark, "dups")
    T(spark, sf, "events").select("event_id", "user_id", "event_type", "ts").write.parquet(src)
    stream = spark.readStream.schema("event_id long, user_id long, event_type string, ts timestamp_ntz").parquet(src)
    keyed = stream.withColumn("hour", F.date_trunc("hour", "ts")) \
                  .withColumn("dedup_key", F.concat_ws("|", "user_id", "event_type", F.col("hour").cast("string")))
    out = _fresh(spark, "unique")
    (jobs.dedup_within(keyed, "dedup_key", "ts", "2 hours").writeStream.foreachBatch(jobs.folder_sink(out))
     .option("checkpointLocation", _fresh(spark, "dedup_ck")).trigger(availableNow=True).start().awaitTermination())
    return spark.read.parquet(out).select("user_id", "event_type",
                                    F.date_format(F.col("hour").cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("hour"))


@register("STR-11", "str11_stream_join_batch_form", """
SELECT a.event_id AS view_id, b.event_id AS purchase_id
FROM events a JOIN events b ON a.user_id = b.user_id AND b.ts >= a.ts AND b.ts <= a.ts + INTERVAL 15 MINUTE
WHERE a.event_type = 'view' AND b.event_type = 'purchase'""")
def str11(spark, sf):
    e = T(spark, sf, "events")
    a = e.filter("event_type = 'view'").select("user_id", F.col("event_id").alias("view_id"), F.col("ts").alias("ts_a"))
    b = e.filter("event_type = 'purchase'").select("user_id", F.col("event_id").alias("purchase_id"), F.col("ts").alias("ts_b"))
    streams = []
    for d in (a, b):
        src = _fresh(spark, "moves")
        d.write.parquet(src)
        streams.append(spark.readStream.schema(d.schema).parquet(src))
    out = _fresh(spark, "near")
    (jobs.near_join_stream(*streams, "user_id", "ts_a", "ts_b", 900).select("view_id", "purchase_id")
     .writeStream.foreachBatch(jobs.folder_sink(out)).option("checkpointLocation", _fresh(spark, "near_ck"))
     .trigger(availableNow=True).start().awaitTermination())
    return spark.read.parquet(out).select("view_id", "purchase_id")


@register("STR-09", "str09_late_rows", """
SELECT event_id, ts < (SELECT max(ts) FROM events) - INTERVAL 2 DAY AS late FROM events""")
def str09b(spark, sf):
    """The newest event comes first; then all events, of which those two days
    older are late (the newest one itself is not repeated)."""
    src, out, late, hw, ck = (_fresh(spark, n) for n in ("late_src", "on_time", "late", "late_hw", "late_ck"))
    e = T(spark, sf, "events").select("event_id", "ts")
    newest = e.orderBy(F.desc("ts"), F.desc("event_id")).limit(1)
    for n, part in enumerate((newest, e)):
        part.write.parquet(f"{src}/part={n}")
        stream = spark.readStream.schema("event_id long, ts timestamp_ntz").parquet(src)
        jobs.start_dedup_late(stream, "event_id", "ts", 2 * 86_400, out, late, hw, ck).awaitTermination()
    return (spark.read.parquet(out).select("event_id", F.lit(False).alias("late"))
            .unionByName(spark.read.parquet(late).select("event_id", F.lit(True).alias("late"))))


@register("VER-08", "ver08_change_feed_consumer", """SELECT o_orderkey, o_orderstatus FROM orders""")
def ver08(spark, sf):
    feed, sink, ck = _fresh(spark, "feed"), _fresh(spark, "consumer"), _fresh(spark, "consumer_ck")
    o = T(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    schema = T_.StructType.fromDDL("o_orderkey long, o_orderstatus string")
    early = F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    o.filter(early).drop("o_orderdate").write.parquet(f"{feed}/part=1")
    jobs.consume(spark, feed, schema, ck, sink).awaitTermination()       # first run: first change file
    o.filter(~early).drop("o_orderdate").write.parquet(f"{feed}/part=2")
    jobs.consume(spark, feed, schema, ck, sink).awaitTermination()       # restart: only the new file
    return spark.read.parquet(sink).select("o_orderkey", "o_orderstatus")


@register("VER-09", "ver09_replay_changes", """
SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'O' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice
FROM orders WHERE o_orderdate >= TIMESTAMP '1995-06-01'""")
def ver09(spark, sf):
    root = _fresh(spark, "changes")
    o = T(spark, sf, "orders")
    old = o.filter(F.col("o_orderdate") < F.lit("2001-01-01").cast("timestamp_ntz")).select("o_orderkey", "o_orderstatus", "o_totalprice")
    new = o.filter(F.col("o_orderdate") >= F.lit("1995-06-01").cast("timestamp_ntz")).select(
        "o_orderkey", "o_orderstatus",
        F.when(F.col("o_orderstatus") == "O", F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")).alias("o_totalprice"))
    versions.write_version(versions.diff(old, new, "o_orderkey"), root, "2024-01-01 00:00:00")
    once = versions.replay(spark, root, 1, 1, old, "o_orderkey")
    return versions.replay(spark, root, 1, 1, once, "o_orderkey")  # replaying again changes nothing


@register("STR-04", "str04_one_feed_many_sinks", """
SELECT 'all' AS sink, count(*) AS n FROM events UNION ALL SELECT 'purchases', count(*) FROM events WHERE event_type = 'purchase'""")
def str04(spark, sf):
    src, a, b = _fresh(spark, "feed_events"), _fresh(spark, "sink_all"), _fresh(spark, "sink_purchases")
    T(spark, sf, "events").select("event_id", "event_type", "value").write.parquet(src)
    stream = spark.readStream.schema("event_id long, event_type string, value double").parquet(src)
    sinks = {"all": jobs.folder_sink(a), "purchases": jobs.folder_sink(b, lambda d: d.filter("event_type = 'purchase'"))}
    jobs.start_fanout(stream, sinks, _fresh(spark, "fanout_ck")).awaitTermination()
    return (spark.read.parquet(a).agg(F.count(F.lit(1)).alias("n")).withColumn("sink", F.lit("all"))
            .unionByName(spark.read.parquet(b).agg(F.count(F.lit(1)).alias("n")).withColumn("sink", F.lit("purchases"))))


@register("STR-12", "str12_log_tail", """
SELECT strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END AS level,
       'user-' || CAST(user_id AS VARCHAR) AS thread FROM events""")
def str12(spark, sf):
    src, out = _fresh(spark, "logs"), _fresh(spark, "parsed_logs")
    e = T(spark, sf, "events")
    e.select(F.format_string("%s %s [user-%d] %s value=%s", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"),
                             F.when(F.col("event_type") == "error", "ERROR").otherwise("INFO"), "user_id",
                             "event_type", F.col("value").cast("string")).alias("value")).write.text(src)
    jobs.start_log_tail(spark, src, out, _fresh(spark, "tail_ck")).awaitTermination()
    p = spark.read.parquet(out).filter("_ok")
    return p.select(F.date_format(F.col("ts").cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"), "level", "thread")
