"""Registered queries for data quality and feature preparation (DQ-*)."""

from pyspark.sql import functions as F

from tessera.operators import quality as Qy
from tessera.plans.registry import register
from tessera.session import load_table as T

_HOLES = """(SELECT o_orderkey, nullif(o_orderstatus, 'P') AS o_orderstatus, nullif(o_orderpriority, '5-LOW') AS o_orderpriority,
  o_totalprice FROM orders)"""


def _holes(spark, sf):
    o = T(spark, sf, "orders")
    return o.select("o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus"),
                    F.nullif("o_orderpriority", F.lit("5-LOW")).alias("o_orderpriority"), "o_totalprice")


@register("DQ-01", "dq01_missing_value_report", f"""
SELECT "column", CAST(nulls AS BIGINT) AS nulls FROM (SELECT 'o_orderstatus' AS "column", count_if(o_orderstatus IS NULL) AS nulls FROM {_HOLES}
 UNION ALL SELECT 'o_orderpriority', count_if(o_orderpriority IS NULL) FROM {_HOLES}
 UNION ALL SELECT 'o_orderkey', count_if(o_orderkey IS NULL) FROM {_HOLES}
 UNION ALL SELECT 'o_totalprice', count_if(o_totalprice IS NULL) FROM {_HOLES}) WHERE nulls > 0""")
def dq01(spark, sf):
    return Qy.null_report(_holes(spark, sf))


_STR_LI = """(SELECT CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS VARCHAR) || ' pcs' ELSE CAST(l_quantity AS VARCHAR) END AS qty,
  CASE WHEN l_linenumber = 7 THEN 'n/a' ELSE CAST(l_linenumber AS VARCHAR) END AS line FROM lineitem)"""


def _str_li(spark, sf):
    li = T(spark, sf, "lineitem")
    return li.select(F.when(F.col("l_returnflag") == "R", F.concat(F.col("l_quantity").cast("string"), F.lit(" pcs")))
                     .otherwise(F.col("l_quantity").cast("string")).alias("qty"),
                     F.when(F.col("l_linenumber") == 7, F.lit("n/a")).otherwise(F.col("l_linenumber").cast("string")).alias("line"))


@register("DQ-02", "dq02_type_report", f"""
SELECT 'qty' AS "column", 'double' AS expected, 'string' AS actual, CAST(count_if(TRY_CAST(qty AS DOUBLE) IS NULL) AS BIGINT) AS failures FROM {_STR_LI}
UNION ALL SELECT 'line', 'int', 'string', CAST(count_if(TRY_CAST(line AS INTEGER) IS NULL) AS BIGINT) FROM {_STR_LI}""")
def dq02(spark, sf):
    return Qy.type_report(_str_li(spark, sf), {"qty": "double", "line": "int"})


@register("DQ-03", "dq03_combined_quality_report", f"""
SELECT 'type' AS "check", 'qty' AS "column", CAST(count_if(TRY_CAST(qty AS DOUBLE) IS NULL) AS BIGINT) AS n FROM {_STR_LI}
UNION ALL SELECT 'type', 'line', CAST(count_if(TRY_CAST(line AS INTEGER) IS NULL) AS BIGINT) FROM {_STR_LI}
UNION ALL SELECT 'duplicate_rows', '*', CAST(coalesce(sum(c - 1), 0) AS BIGINT) FROM (SELECT qty, line, count(*) AS c FROM {_STR_LI} GROUP BY qty, line HAVING count(*) > 1)""")
def dq03(spark, sf):
    return Qy.quality_report(_str_li(spark, sf), {"qty": "double", "line": "int"})


@register("DQ-04", "dq04_impute_mean_median_mode", """
WITH h AS (SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_quantity END AS q,
                  CASE WHEN l_linestatus = 'O' THEN NULL ELSE l_discount END AS d FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, round(coalesce(q, (SELECT avg(q) FROM h)), 4) AS q_mean,
       coalesce(d, (SELECT median(d) FROM h)) AS d_median FROM h""")
def dq04(spark, sf):
    li = T(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.when(F.col("l_returnflag") == "R", F.lit(None)).otherwise(F.col("l_quantity")).alias("q_mean"),
        F.when(F.col("l_linestatus") == "O", F.lit(None)).otherwise(F.col("l_discount")).alias("d_median"))
    d = Qy.impute(Qy.impute(li, ["q_mean"], "mean"), ["d_median"], "median")
    return d.withColumn("q_mean", F.round("q_mean", 4))


@register("DQ-05", "dq05_minmax_scaling", """
SELECT l_orderkey, l_linenumber, l_partkey, round((l_extendedprice - (SELECT min(l_extendedprice) FROM lineitem)) /
  ((SELECT max(l_extendedprice) FROM lineitem) - (SELECT min(l_extendedprice) FROM lineitem)), 6) AS l_extendedprice FROM lineitem""")
def dq05(spark, sf):
    li = T(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return Qy.minmax(li, ["l_extendedprice"]).withColumn("l_extendedprice", F.round("l_extendedprice", 6))


@register("DQ-06", "dq06_standard_scaling", """
SELECT l_orderkey, l_linenumber, l_partkey, round((l_quantity - (SELECT avg(l_quantity) FROM lineitem)) / (SELECT stddev_pop(l_quantity) FROM lineitem), 6) AS l_quantity
FROM lineitem""")
def dq06(spark, sf):
    li = T(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return Qy.standardise(li, ["l_quantity"]).withColumn("l_quantity", F.round("l_quantity", 6))


@register("DQ-07", "dq07_label_encoding", """
SELECT o_orderkey, CAST(dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS BIGINT) AS o_orderpriority_code FROM orders""")
def dq07(spark, sf):
    return Qy.label_encode(T(spark, sf, "orders").select("o_orderkey", "o_orderpriority"), "o_orderpriority") \
             .select("o_orderkey", "o_orderpriority_code")


@register("DQ-08", "dq08_row_validity_rules", """
SELECT o_orderkey, array_to_string(list_filter([CASE WHEN NOT (o_totalprice > 1000) THEN 'positive_amount' END,
  CASE WHEN NOT (o_orderstatus IN ('F', 'O')) THEN 'known_status' END,
  CASE WHEN NOT (o_orderdate < TIMESTAMP '2001-06-01') THEN 'date_range' END], lambda x: x IS NOT NULL), ',') AS failures
FROM orders""")
def dq08(spark, sf):
    o = T(spark, sf, "orders")
    d = Qy.validate(o, {"positive_amount": F.col("o_totalprice") > 1000,
                        "known_status": F.col("o_orderstatus").isin("F", "O"),
                        "date_range": F.col("o_orderdate") < F.lit("2001-06-01").cast("timestamp_ntz")})
    return d.select("o_orderkey", F.array_join("failures", ",").alias("failures"))


_CONTRACT = {
    "c_name": {"required": True, "pattern": "^Customer#[0-9]{9}$", "min_len": 18, "max_len": 18},
    "c_acctbal": {"type": "double", "min": -500, "max": 9000},
    "c_mktsegment": {"allowed": ["AUTOMOBILE", "BUILDING", "FURNITURE", "MACHINERY"]},
}


@register("DQ-09", "dq09_record_contract", """
SELECT c_custkey, array_to_string(list_filter([
  CASE WHEN NOT (c_name IS NOT NULL) THEN 'c_name:required' END,
  CASE WHEN NOT (c_name IS NULL OR length(c_name) >= 18) THEN 'c_name:min_len' END,
  CASE WHEN NOT (c_name IS NULL OR length(c_name) <= 18) THEN 'c_name:max_len' END,
  CASE WHEN NOT (c_name IS NULL OR regexp_matches(c_name, '^Customer#[0-9]{9}$')) THEN 'c_name:pattern' END,
  CASE WHEN NOT (c_acctbal IS NULL OR TRY_CAST(c_acctbal AS DOUBLE) IS NOT NULL) THEN 'c_acctbal:type' END,
  CASE WHEN NOT (c_acctbal IS NULL OR c_acctbal >= -500) THEN 'c_acctbal:min' END,
  CASE WHEN NOT (c_acctbal IS NULL OR c_acctbal <= 9000) THEN 'c_acctbal:max' END,
  CASE WHEN NOT (c_mktsegment IS NULL OR c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'MACHINERY')) THEN 'c_mktsegment:allowed' END
  ], lambda x: x IS NOT NULL), ',') AS failures FROM customer""")
def dq09(spark, sf):
    d = Qy.check_contract(T(spark, sf, "customer"), _CONTRACT)
    return d.select("c_custkey", F.array_join("failures", ",").alias("failures"))


@register("DQ-10", "dq10_sample_drift", """
WITH s AS (SELECT event_type FROM events WHERE CAST('0x' || substr(md5(CAST(event_id AS VARCHAR) || ':1'), 1, 8) AS BIGINT) % 10000 < 1000),
 a AS (SELECT event_type, count(*) / (SELECT count(*) FROM s) AS share_a FROM s GROUP BY 1),
 b AS (SELECT event_type, count(*) / (SELECT count(*) FROM events) AS share_b FROM events GROUP BY 1)
SELECT event_type, coalesce(share_a, 0) AS share_a, coalesce(share_b, 0) AS share_b, abs(coalesce(share_a, 0) - coalesce(share_b, 0)) AS abs_diff
FROM a FULL JOIN b USING (event_type)""")
def dq10(spark, sf):
    from tessera.operators.sampling import sample_stable
    e = T(spark, sf, "events")
    return Qy.sample_drift(sample_stable(e, "event_id", 0.1, 1), e, "event_type")
