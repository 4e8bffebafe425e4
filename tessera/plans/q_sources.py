"""Registered queries for sources and sinks (SRC-*).  Queries that need
files write them under the session's checkpoint folder (the shared folder
on a cluster) and read them back."""

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T_

from tessera.plans.registry import register
from tessera.session import load_table as T
from tessera.session import scratch_path
from tessera.sources import scans as S


def _scratch(spark, sf, name):
    return scratch_path(spark, f"src/{name}-{uuid.uuid4().hex[:12]}")


_CUST_DDL = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"


@register("SRC-01", "src01_delimited_profile_scan", """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN NULL ELSE c_mktsegment END AS c_mktsegment
FROM customer""")
def src01(spark, sf):
    c = T(spark, sf, "customer").withColumn(
        "c_mktsegment", F.when(F.col("c_mktsegment") == "HOUSEHOLD", F.lit("\\N")).otherwise(F.col("c_mktsegment")))
    p = _scratch(spark, sf, "customer_pipe")
    c.write.mode("overwrite").option("sep", "|").option("header", "false").csv(p)
    return S.scan_delimited(spark, p, T_.StructType.fromDDL(_CUST_DDL), "pipe")


@register("SRC-02", "src02_headerless_declared_schema", """SELECT p_partkey, p_size, p_retailprice FROM part""")
def src02(spark, sf):
    p = _scratch(spark, sf, "part_tab")
    T(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice").write.mode("overwrite") \
        .option("sep", "\t").csv(p)
    return S.scan_headerless(spark, p, T_.StructType.fromDDL("p_partkey bigint, p_size int, p_retailprice double"), "\t")


@register("SRC-03", "src03_inferred_schema", """SELECT p_partkey, p_size, p_retailprice FROM part""")
def src03(spark, sf):
    p = _scratch(spark, sf, "part_hdr")
    T(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice").write.mode("overwrite") \
        .option("header", "true").csv(p)
    d = S.scan_inferred(spark, p)
    return d.select(F.col("p_partkey").cast("bigint"), F.col("p_size").cast("int"), F.col("p_retailprice").cast("double"))


@register("SRC-04", "src04_text_lines", """
SELECT count(*) AS lines FROM (SELECT unnest(string_split(text, chr(10))) FROM documents)""")
def src04(spark, sf):
    p = _scratch(spark, sf, "doc_lines")
    d = T(spark, sf, "documents")
    d.select(F.explode(F.split("text", "\n")).alias("value")).write.mode("overwrite").text(p)
    return S.scan_lines(spark, p).agg(F.count(F.lit(1)).alias("lines"))


@register("SRC-05", "src05_jsonl_good_bad", """
SELECT event_type = 'error' AS bad, count(*) AS n FROM events GROUP BY 1""")
def src05(spark, sf):
    p = _scratch(spark, sf, "events_jsonl")
    e = T(spark, sf, "events")
    line = F.when(F.col("event_type") == "error", F.concat(F.lit("{\"event_id\": "), F.col("event_id").cast("string"), F.lit(", broken"))) \
            .otherwise(F.to_json(F.struct("event_id", "user_id", "event_type")))
    e.select(line.alias("value")).write.mode("overwrite").text(p)
    good, bad = S.scan_jsonl(spark, p, T_.StructType.fromDDL("event_id bigint, user_id bigint, event_type string"))
    return (good.agg(F.count(F.lit(1)).alias("n")).withColumn("bad", F.lit(False))
                .unionByName(bad.agg(F.count(F.lit(1)).alias("n")).withColumn("bad", F.lit(True))))


@register("SRC-06", "src06_json_array_file", """SELECT r_regionkey, r_name FROM region""")
def src06(spark, sf):
    p = _scratch(spark, sf, "region_array")
    r = T(spark, sf, "region")
    r.agg(F.to_json(F.collect_list(F.struct("r_regionkey", "r_name"))).alias("value")).write.mode("overwrite").text(p)
    return S.scan_json_array(spark, p, T_.StructType.fromDDL("r_regionkey int, r_name string"))


@register("SRC-07", "src07_parquet_pushdown", """
SELECT l_orderkey, l_extendedprice FROM lineitem WHERE l_shipdate >= TIMESTAMP '2000-06-01' AND l_quantity < 5""")
def src07(spark, sf):
    d = S.scan_parquet(spark, f"{sf}/lineitem.parquet")
    return d.filter((F.col("l_shipdate") >= F.lit("2000-06-01").cast("timestamp_ntz")) & (F.col("l_quantity") < 5)) \
            .select("l_orderkey", "l_extendedprice")


@register("SRC-08", "src08_xml_row_tag", """SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS name FROM nation""")
def src08(spark, sf):
    p = _scratch(spark, sf, "nation_xml")
    n = T(spark, sf, "nation")
    n.select(F.col("n_nationkey").alias("_id"), F.col("n_name").alias("name")).write.mode("overwrite") \
     .format("xml").option("rootTag", "nations").option("rowTag", "nation").save(p)
    d = S.scan_xml(spark, p, "nation", T_.StructType.fromDDL("_id long, name string"))
    return d.select(F.col("_id").alias("id"), "name")


@register("SRC-09", "src09_partitioned_folders_pruned", """
SELECT o_orderkey, o_totalprice FROM orders WHERE year(o_orderdate) = 1998 AND month(o_orderdate) IN (3, 4)""")
def src09(spark, sf):
    p = _scratch(spark, sf, "orders_by_month")
    o = T(spark, sf, "orders").withColumn("year", F.year("o_orderdate")).withColumn("month", F.month("o_orderdate"))
    S.write_partitioned(o.select("o_orderkey", "o_totalprice", "year", "month"), p, ["year", "month"])
    d = S.scan_parquet(spark, p)
    return d.filter((F.col("year") == 1998) & F.col("month").isin(3, 4)).select("o_orderkey", "o_totalprice")


@register("SRC-10", "src10_pick_files_by_regex", """SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P'""")
def src10(spark, sf):
    p = _scratch(spark, sf, "orders_by_status")
    T(spark, sf, "orders").select("o_orderkey", "o_orderstatus").write.mode("overwrite").partitionBy("o_orderstatus").parquet(p)
    return S.pick_files(spark, p, regex=r"^(?!.*o_orderstatus=P/).*$").select("o_orderkey")


@register("SRC-11", "src11_row_provenance", """SELECT count(*) AS n, count(DISTINCT l_orderkey * 10 + l_linenumber) AS keys FROM lineitem""")
def src11(spark, sf):
    d = S.with_provenance(S.scan_parquet(spark, f"{sf}/lineitem.parquet"))
    return d.agg(F.count("_row_no").alias("n"), F.count_distinct(F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("keys"))


@register("SRC-13", "src13_schema_drift_superset", """
SELECT n_nationkey, n_name, CAST(CASE WHEN n_regionkey >= 2 THEN n_regionkey END AS DOUBLE) AS n_regionkey FROM nation""")
def src13(spark, sf):
    p = _scratch(spark, sf, "nation_gens")
    n = T(spark, sf, "nation")
    n.filter("n_regionkey < 2").select("n_nationkey", "n_name").write.mode("overwrite").parquet(f"{p}/gen=1")
    n.filter("n_regionkey >= 2").select("n_nationkey", "n_name", "n_regionkey").write.mode("overwrite").parquet(f"{p}/gen=2")
    return S.scan_evolved(spark, p).select("n_nationkey", "n_name", F.col("n_regionkey").cast("double").alias("n_regionkey"))


@register("SRC-14", "src14_positional_projection", """
SELECT CAST(l_suppkey AS INTEGER) AS supplier, l_orderkey AS order_id, CAST(l_quantity AS INTEGER) AS qty FROM lineitem""")
def src14(spark, sf):
    li = T(spark, sf, "lineitem")
    return S.project_positional(li, [3, 1, 5], ["supplier", "order_id", "qty"], ["int", "bigint", "int"])


@register("SRC-15", "src15_partitioned_unload", """
SELECT o_orderkey, o_orderstatus, o_totalprice, strftime(o_orderdate, 'm%Y-%m') AS order_month FROM orders""")
def src15(spark, sf):
    p = _scratch(spark, sf, "unload_parquet")
    o = T(spark, sf, "orders").withColumn("order_month", F.date_format("o_orderdate", "'m'yyyy-MM"))
    out = S.unload_parquet(o, p, ["order_month"], "r1")
    return spark.read.parquet(out).select("o_orderkey", "o_orderstatus", "o_totalprice", "order_month")


@register("SRC-16", "src16_csv_unload_gzip", """SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders""")
def src16(spark, sf):
    p = _scratch(spark, sf, "unload_csv")
    S.unload_csv(T(spark, sf, "orders"), p, True, "gzip", 4000)
    d = spark.read.option("header", "true").csv(p)
    return d.select(F.col("o_orderkey").cast("bigint"), "o_orderstatus", "o_orderpriority")


@register("SRC-17", "src17_unload_reconciliation", """
SELECT count(*) AS expected, count(*) AS written, count(*) AS reread, true AS ok FROM orders""")
def src17(spark, sf):
    return S.reconcile_unload(T(spark, sf, "orders"), _scratch(spark, sf, "recon"))


@register("SRC-20", "src20_log_line_parse", """
SELECT strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END AS level, 'user-' || CAST(user_id AS VARCHAR) AS thread,
       event_type || ' value=' || CAST(value AS VARCHAR) AS message FROM events""")
def src20(spark, sf):
    e = T(spark, sf, "events")
    lines = e.select(F.format_string("%s %s [user-%d] %s value=%s", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"),
                                     F.when(F.col("event_type") == "error", "ERROR").otherwise("INFO"), "user_id",
                                     "event_type", F.col("value").cast("string")).alias("value"))
    parsed, _ = S.parse_log(lines)
    return parsed.withColumn("ts", F.date_format(F.col("ts").cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss.SSSSSS"))


@register("SRC-21", "src21_orc_scan", """SELECT p_partkey, p_name, p_size FROM part WHERE p_size > 40""")
def src21(spark, sf):
    p = _scratch(spark, sf, "part_orc")
    T(spark, sf, "part").write.mode("overwrite").orc(p)
    return S.scan_orc(spark, p).filter("p_size > 40").select("p_partkey", "p_name", "p_size")


@register("SRC-22", "src22_query_files_in_place", """
SELECT o.o_orderkey, c.c_name FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey WHERE o.o_totalprice > 400000""")
def src22(spark, sf):
    p = _scratch(spark, sf, "orders_csv")
    T(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice").write.mode("overwrite").option("header", "true").csv(p)
    v = S.file_view(spark, p, T_.StructType.fromDDL("o_orderkey bigint, o_custkey bigint, o_totalprice double"),
                    "csv", F.col("o_totalprice") > 400000)
    c = T(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return v.join(c, "o_custkey").select("o_orderkey", "c_name")
