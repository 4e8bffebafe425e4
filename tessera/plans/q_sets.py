"""Registered queries for set operations (SET-*)."""

from pyspark.sql import functions as F

from tessera.operators import sets as S
from tessera.plans.registry import register
from tessera.session import load_table as T


@register("SET-01", "set01_union_all_and_distinct", """
SELECT k, count(*) AS n_all, count(DISTINCT src) AS n_sources FROM (
  SELECT c_nationkey AS k, 'customer' AS src FROM customer UNION ALL SELECT s_nationkey, 'supplier' FROM supplier)
GROUP BY k""")
def set01(spark, sf):
    c = T(spark, sf, "customer").select(F.col("c_nationkey").alias("k"), F.lit("customer").alias("src"))
    s = T(spark, sf, "supplier").select(F.col("s_nationkey").alias("k"), F.lit("supplier").alias("src"))
    a = S.union(c, s).groupBy("k").agg(F.count(F.lit(1)).alias("n_all"))
    d = S.union(c, s, distinct=True).groupBy("k").agg(F.count(F.lit(1)).alias("n_sources"))
    return a.join(d, "k")


@register("SET-02", "set02_intersect", """
SELECT user_id FROM events WHERE event_type = 'view'
INTERSECT SELECT user_id FROM events WHERE event_type = 'purchase'""")
def set02(spark, sf):
    e = T(spark, sf, "events")
    return S.intersect(e.filter("event_type = 'view'").select("user_id"),
                       e.filter("event_type = 'purchase'").select("user_id"))


@register("SET-03", "set03_except_all_snapshots", """
SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01'
EXCEPT ALL SELECT o_orderkey, o_orderstatus FROM orders WHERE o_totalprice > 100000""")
def set03(spark, sf):
    o = T(spark, sf, "orders")
    old = o.filter(F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp_ntz")).select("o_orderkey", "o_orderstatus")
    new = o.filter("o_totalprice > 100000").select("o_orderkey", "o_orderstatus")
    return S.except_all(old, new)


@register("SET-04", "set04_distinct", """SELECT DISTINCT o_custkey, o_orderstatus FROM orders""")
def set04(spark, sf):
    return S.distinct(T(spark, sf, "orders"), ["o_custkey", "o_orderstatus"])


@register("SET-04", "set04_distinct_on_first", """
SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn
FROM orders) WHERE rn = 1""")
def set04b(spark, sf):
    o = T(spark, sf, "orders")
    return S.first_per(o, "o_custkey", ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey", "o_totalprice")


@register("SET-05", "set05_dedup_keep_latest", """
SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn
FROM events) WHERE rn = 1""")
def set05(spark, sf):
    e = T(spark, sf, "events")
    return S.dedup_latest(e, ["user_id", "event_type"], "ts", "event_id").select("user_id", "event_id", "event_type")


@register("SET-06", "set06_symmetric_dedup", """
WITH r AS (SELECT l_partkey % 40 AS a, l_suppkey % 40 AS b, l_quantity AS dist, l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem)
SELECT a, b, dist, l_orderkey, l_linenumber FROM (
  SELECT *, row_number() OVER (PARTITION BY least(a, b), greatest(a, b), dist ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) AS rn FROM r)
WHERE rn = 1""")
def set06(spark, sf):
    li = T(spark, sf, "lineitem").select((F.col("l_partkey") % 40).alias("a"), (F.col("l_suppkey") % 40).alias("b"),
                                         F.col("l_quantity").alias("dist"), "l_orderkey", "l_linenumber",
                                         "l_partkey", "l_suppkey")
    d = S.dedup_symmetric(li, "a", "b", ["dist"], ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])
    return d.select("a", "b", "dist", "l_orderkey", "l_linenumber")


@register("SET-07", "set07_ordered_distinct_list", """
WITH x AS (SELECT l_orderkey, l_partkey % 10 AS v, min(l_linenumber * 1000000 + l_partkey) AS first_pos FROM lineitem GROUP BY 1, 2)
SELECT l_orderkey, string_agg(CAST(v AS VARCHAR), ',' ORDER BY first_pos) AS items FROM x GROUP BY 1""")
def set07(spark, sf):
    li = T(spark, sf, "lineitem")
    lists = li.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct(
        (F.col("l_linenumber") * 1000000 + F.col("l_partkey")).alias("p"), (F.col("l_partkey") % 10).alias("v")))).alias("s"))
    return lists.select("l_orderkey", F.array_join(S.ordered_distinct(F.transform("s", lambda x: x["v"].cast("string"))),
                                                   ",").alias("items"))


@register("SET-08", "set08_duplicate_rows", """
SELECT l_partkey, l_suppkey, l_returnflag, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1""")
def set08(spark, sf):
    li = T(spark, sf, "lineitem").select("l_partkey", "l_suppkey", "l_returnflag")
    return S.duplicate_rows(li)
