"""Flagship: top 3 parts by revenue per supplier nation."""

from pyspark.sql import functions as F

from tessera.operators import aggs, joins, windows
from tessera.plans.registry import register
from tessera.session import load_table


def top_parts_by_nation(spark, sf):
    li = load_table(spark, sf, "lineitem")
    sup = load_table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    nat = load_table(spark, sf, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    # pre-aggregate the fact on (supplier, part) before any join
    rev = aggs.aggregate(
        li.select("l_suppkey", "l_partkey",
                  (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("rev")),
        ["l_suppkey", "l_partkey"], [F.sum("rev").alias("rev")])
    j = joins.join_inner(rev.withColumnRenamed("l_suppkey", "s_suppkey"), sup, "s_suppkey")
    # nation is a fixed 25-row domain table: the planner broadcasts it from
    # its file size (and AQE from runtime size); no extra count job needed
    j = joins.join_inner(j, nat, "s_nationkey")
    per = aggs.aggregate(j, ["n_name", "l_partkey"], [F.round(F.sum("rev"), 2).alias("revenue")])
    top = windows.top_n_per(per, ["n_name"], [F.col("revenue").desc(), F.col("l_partkey")], 3)
    return top.select("n_name", F.col("l_partkey").alias("p_partkey"), "revenue",
                      F.col("rn").cast("bigint").alias("rn"))


register("WIN-02", "flagship_top_parts_by_nation", """
WITH per AS (
  SELECT n.n_name, l.l_partkey, round(sum(l.l_extendedprice * (1 - l.l_discount)), 2) AS revenue
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey
  GROUP BY n.n_name, l.l_partkey)
SELECT n_name, l_partkey AS p_partkey, revenue, rn FROM (
  SELECT *, row_number() OVER (PARTITION BY n_name ORDER BY revenue DESC, l_partkey) AS rn FROM per)
WHERE rn <= 3
""")(top_parts_by_nation)
