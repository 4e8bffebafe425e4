"""Registered queries for load audit (LOAD-*)."""

from pyspark.sql import functions as F
from pyspark.sql import types as T_

from tessera.functions.scalars import date_str
from tessera.plans.registry import register
from tessera.session import load_table as T
from tessera.sources import loads as L

_LI_SCHEMA = T_.StructType([T_.StructField("l_quantity", T_.DoubleType()), T_.StructField("l_shipdate", T_.DateType()),
                            T_.StructField("l_linenumber", T_.IntegerType())])


def _damaged_lineitem(spark, sf):
    """lineitem landed as text with damage derived from the data: quantities
    of returned lines written with a unit, ship dates of line 7 garbled."""
    li = T(spark, sf, "lineitem")
    return li.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("row_id"),
        F.when(F.col("l_returnflag") == "R", F.concat(F.col("l_quantity").cast("string"), F.lit(" pcs")))
         .otherwise(F.col("l_quantity").cast("string")).alias("l_quantity"),
        F.when(F.col("l_linenumber") == 7, F.lit("31/02/1999")).otherwise(date_str("l_shipdate")).alias("l_shipdate"),
        F.col("l_linenumber").cast("string").alias("l_linenumber"))


_DAMAGED_SQL = """(SELECT l_orderkey * 10 + l_linenumber AS row_id,
  CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS VARCHAR) || ' pcs' ELSE CAST(l_quantity AS VARCHAR) END AS l_quantity,
  CASE WHEN l_linenumber = 7 THEN '31/02/1999' ELSE CAST(CAST(l_shipdate AS DATE) AS VARCHAR) END AS l_shipdate FROM lineitem)"""


@register("LOAD-01", "load01_dry_run_validation", f"""
SELECT row_id, 'l_quantity' AS column, l_quantity AS value, 'not a valid double' AS error FROM {_DAMAGED_SQL} d
WHERE TRY_CAST(l_quantity AS DOUBLE) IS NULL
UNION ALL
SELECT row_id, 'l_shipdate', l_shipdate, 'not a valid date' FROM {_DAMAGED_SQL} d WHERE TRY_CAST(l_shipdate AS DATE) IS NULL""")
def load01(spark, sf):
    return L.validate_load(_damaged_lineitem(spark, sf), _LI_SCHEMA, "row_id")


@register("LOAD-03", "load03_good_bad_split_counts", f"""
SELECT TRY_CAST(l_quantity AS DOUBLE) IS NOT NULL AND TRY_CAST(l_shipdate AS DATE) IS NOT NULL AS good, count(*) AS n
FROM {_DAMAGED_SQL} GROUP BY 1""")
def load03(spark, sf):
    good, bad = L.split_good_bad(_damaged_lineitem(spark, sf), _LI_SCHEMA)
    return (good.agg(F.count(F.lit(1)).alias("n")).withColumn("good", F.lit(True))
                .unionByName(bad.agg(F.count(F.lit(1)).alias("n")).withColumn("good", F.lit(False))))


@register("LOAD-04", "load04_length_enforce", """SELECT c_custkey, c_name FROM customer WHERE length(c_mktsegment) <= 9""")
def load04(spark, sf):
    good, _ = L.apply_length(T(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment"),
                             {"c_mktsegment": 9}, truncate=True, enforce=True)
    return good.select("c_custkey", "c_name")


@register("LOAD-04", "load04_length_truncate", """SELECT c_custkey, substring(c_mktsegment, 1, 5) AS c_mktsegment FROM customer""")
def load04b(spark, sf):
    good, _ = L.apply_length(T(spark, sf, "customer").select("c_custkey", "c_mktsegment"),
                             {"c_mktsegment": 5}, truncate=True, enforce=False)
    return good


@register("LOAD-06", "load06_load_history_per_file", """
WITH r AS (SELECT 'events_' || strftime(ts, '%Y%m%d') || '.csv' AS file, event_id AS row_no,
                  CASE WHEN value > 49 THEN 'value out of range' END AS error FROM events)
SELECT file, count(*) AS rows_seen, count(error) AS errors,
       arg_min(error, CASE WHEN error IS NOT NULL THEN row_no END) AS first_error,
       CASE WHEN count(error) = 0 THEN 'LOADED' WHEN count(error) < count(*) THEN 'PARTIALLY_LOADED' ELSE 'LOAD_FAILED' END AS status
FROM r GROUP BY 1""")
def load06(spark, sf):
    e = T(spark, sf, "events")
    rows = e.select(F.concat(F.lit("events_"), F.date_format("ts", "yyyyMMdd"), F.lit(".csv")).alias("file"),
                    F.col("event_id").alias("row_no"),
                    F.when(F.col("value") > 49, F.lit("value out of range")).alias("error"))
    return L.load_history(rows, "file", "row_no", "error")


@register("LOAD-07", "load07_load_alerts", """
WITH h AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n, max(ts) AS last_load FROM events WHERE event_type <> 'view' OR day(ts) <> 15 GROUP BY 1),
 ex AS (SELECT CAST(x AS DATE) AS day FROM generate_series(DATE '2024-01-01', DATE '2024-01-31', INTERVAL 1 DAY) t(x))
SELECT CAST(day AS VARCHAR) AS day, 'missing' AS alert FROM ex WHERE day NOT IN (SELECT day FROM h)
UNION ALL SELECT CAST(day AS VARCHAR), 'low_rows' FROM h WHERE n < 300""")
def load07(spark, sf):
    e = T(spark, sf, "events").filter((F.col("event_type") != "view") | (F.dayofmonth("ts") != 15))
    hist = e.groupBy(F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"), F.max("ts").alias("last_load"))
    expected = spark.range(1).select(F.explode(F.sequence(F.lit("2024-01-01").cast("date"), F.lit("2024-01-31").cast("date"),
                                                          F.expr("INTERVAL 1 DAY"))).alias("day"))
    a = L.load_alerts(hist, expected, "day", "n", 300, "last_load", 24 * 365)
    return a.select(date_str("day").alias("day"), "alert")


@register("LOAD-08", "load08_append_one_day", """
SELECT o_orderkey, o_custkey FROM orders WHERE CAST(o_orderdate AS DATE) = (SELECT CAST(max(o_orderdate) AS DATE) FROM orders)""")
def load08(spark, sf):
    return L.append_latest_day(T(spark, sf, "orders"), "o_orderdate").select("o_orderkey", "o_custkey")


@register("LOAD-08", "load08_append_given_day", """
SELECT o_orderkey, o_custkey FROM orders WHERE CAST(o_orderdate AS DATE) = DATE '1998-03-15'""")
def load08b(spark, sf):
    return L.append_day(T(spark, sf, "orders"), "o_orderdate", "1998-03-15").select("o_orderkey", "o_custkey")


@register("LOAD-11", "load11_rolling_window_reload", """
WITH edge AS (SELECT CAST(max(o_orderdate) AS DATE) - 89 AS e FROM orders WHERE o_orderstatus = 'O')
SELECT o_orderkey, o_totalprice, 'base' AS src FROM orders, edge WHERE CAST(o_orderdate AS DATE) < e
UNION ALL
SELECT o_orderkey, o_totalprice * 1.1, 'stage' FROM orders, edge WHERE o_orderstatus = 'O' AND CAST(o_orderdate AS DATE) >= e""")
def load11(spark, sf):
    o = T(spark, sf, "orders")
    base = o.select("o_orderkey", "o_totalprice", "o_orderdate", F.lit("base").alias("src"))
    stage = o.filter("o_orderstatus = 'O'").select("o_orderkey", (F.col("o_totalprice") * 1.1).alias("o_totalprice"),
                                                   "o_orderdate", F.lit("stage").alias("src"))
    return L.rolling_reload(base, stage, "o_orderdate", 90).drop("o_orderdate")
