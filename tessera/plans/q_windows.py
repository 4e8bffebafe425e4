"""Registered queries for windows, sort and limit (WIN-*)."""

from pyspark.sql import functions as F

from tessera.functions.scalars import round_half_up as r2
from tessera.operators import windows as W
from tessera.plans.registry import register
from tessera.session import load_table as T


@register("WIN-01", "win01_row_number_rank_dense", """
SELECT l_orderkey, l_linenumber,
  row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity DESC, l_linenumber) AS rn,
  rank() OVER (PARTITION BY l_orderkey ORDER BY l_quantity DESC) AS rk,
  dense_rank() OVER (PARTITION BY l_orderkey ORDER BY l_quantity DESC) AS drk
FROM lineitem""")
def win01(spark, sf):
    li = T(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    d = W.rank_rows(li, "l_orderkey", [F.col("l_quantity").desc(), "l_linenumber"], "row_number", "rn")
    d = W.rank_rows(d, "l_orderkey", [F.col("l_quantity").desc()], "rank", "rk")
    d = W.rank_rows(d, "l_orderkey", [F.col("l_quantity").desc()], "dense_rank", "drk")
    return d.select("l_orderkey", "l_linenumber", *[F.col(c).cast("bigint").alias(c) for c in ("rn", "rk", "drk")])


@register("WIN-02", "win02_dense_rank_top_n", """
SELECT l_partkey, l_orderkey, l_linenumber FROM (
  SELECT *, dense_rank() OVER (PARTITION BY l_partkey ORDER BY l_quantity DESC) AS r FROM lineitem) WHERE r <= 2""")
def win02(spark, sf):
    li = T(spark, sf, "lineitem")
    return W.top_n_per(li, "l_partkey", [F.col("l_quantity").desc()], 2, "dense_rank") \
            .select("l_partkey", "l_orderkey", "l_linenumber")


@register("WIN-03", "win03_nth_else_last", """
SELECT s_nationkey, s_suppkey, s_acctbal FROM (
  SELECT *, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal DESC, s_suppkey) AS rn,
            count(*) OVER (PARTITION BY s_nationkey) AS cnt FROM supplier)
WHERE rn = 3 OR (cnt < 3 AND rn = cnt)""")
def win03(spark, sf):
    s = T(spark, sf, "supplier").select("s_nationkey", "s_suppkey", "s_acctbal")
    return W.nth_or_last(s, "s_nationkey", [F.col("s_acctbal").desc(), "s_suppkey"], 3)


@register("WIN-04", "win04_lag_lead_default", """
SELECT event_id, coalesce(lag(value) OVER w, value) AS prev_value, lead(value, 2) OVER w AS next2_value
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def win04(spark, sf):
    e = T(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    d = W.shift(e, "user_id", ["ts", "event_id"], "value", 1, default=F.col("value"), out="prev_value",
                chunk=F.to_date("ts"))
    d = W.shift(d, "user_id", ["ts", "event_id"], "value", 2, lead=True, out="next2_value", chunk=F.to_date("ts"))
    return d.select("event_id", "prev_value", "next2_value")


@register("WIN-05", "win05_running_total_chunked", """
SELECT o_orderkey, round(CAST(sum(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DECIMAL(38,9)), 2)::DOUBLE AS running
FROM orders""")
def win05(spark, sf):
    o = T(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    d = W.running_sum(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], "o_totalprice", "running",
                      chunk=F.year("o_orderdate"))
    return d.select("o_orderkey", r2(F.col("running")).alias("running"))


@register("WIN-06", "win06_trailing_window", """
SELECT event_id, round(avg(value) OVER (PARTITION BY user_id ORDER BY ts, event_id
       ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 4) AS avg3 FROM events""")
def win06(spark, sf):
    e = T(spark, sf, "events")
    d = W.framed_chunked(e, "user_id", ["ts", "event_id"], "value", -2, 0, "avg", "avg3", F.to_date("ts"))
    return d.select("event_id", F.round("avg3", 4).alias("avg3"))


@register("WIN-07", "win07_centred_window", """
SELECT event_id, round(sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id
       ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING), 4) AS sum3 FROM events""")
def win07(spark, sf):
    e = T(spark, sf, "events")
    d = W.framed_chunked(e, "user_id", ["ts", "event_id"], "value", -1, 1, "sum", "sum3", F.to_date("ts"))
    return d.select("event_id", F.round("sum3", 4).alias("sum3"))


@register("WIN-08", "win08_partition_total", """
SELECT o_orderkey, round(o_totalprice / sum(o_totalprice) OVER (PARTITION BY o_custkey), 6) AS share
FROM orders""")
def win08(spark, sf):
    o = T(spark, sf, "orders")
    return W.group_total(o, "o_custkey", "o_totalprice", "sum", "_tot") \
            .select("o_orderkey", F.round(F.col("o_totalprice") / F.col("_tot"), 6).alias("share"))


@register("WIN-09", "win09_range_frame_peers", """
SELECT l_orderkey, l_linenumber, sum(l_quantity) OVER (PARTITION BY l_partkey ORDER BY l_shipdate
       RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running FROM lineitem""")
def win09(spark, sf):
    li = T(spark, sf, "lineitem")
    return W.range_running_chunked(li, "l_partkey", "l_shipdate", "l_quantity", "running", F.year("l_shipdate")) \
            .select("l_orderkey", "l_linenumber", "running")


@register("WIN-10", "win10_reverse_running", """
SELECT l_orderkey, l_linenumber, l_partkey, sum(l_quantity) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity
       ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS remaining FROM lineitem""")
def win10(spark, sf):
    li = T(spark, sf, "lineitem")
    return W.reverse_running_chunked(li, "l_orderkey", ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity"],
                                     "l_quantity", "remaining", F.col("l_linenumber")) \
            .select("l_orderkey", "l_linenumber", "l_partkey", "remaining")


@register("WIN-11", "win11_look_ahead", """
SELECT event_id, max(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING) AS max_next,
       count(*) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING) AS n_next
FROM events""")
def win11(spark, sf):
    e = T(spark, sf, "events")
    d = W.framed_chunked(e, "user_id", ["ts", "event_id"], "value", 0, 3, "max", "max_next", F.to_date("ts"))
    d = W.framed_chunked(d, "user_id", ["ts", "event_id"], "event_id", 0, 3, "count", "n_next", F.to_date("ts"))
    return d.select("event_id", "max_next", "n_next")


@register("WIN-12", "win12_max_before", """
SELECT event_id, max(value) OVER (PARTITION BY user_id ORDER BY ts, event_id
       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS max_before FROM events""")
def win12(spark, sf):
    e = T(spark, sf, "events")
    return W.max_before_chunked(e, "user_id", ["ts", "event_id"], "value", "max_before", F.to_date("ts")) \
            .select("event_id", "max_before")


@register("WIN-13", "win13_first_last_value", """
SELECT user_id, arg_min(value, (ts, event_id)) AS first_value, arg_max(value, (ts, event_id)) AS last_value
FROM events GROUP BY 1""")
def win13(spark, sf):
    e = T(spark, sf, "events").withColumn("_o", F.struct("ts", "event_id"))
    return W.first_last(e, "user_id", "_o", "value").select(
        "user_id", F.col("first_value").alias("first_value"), F.col("last_value").alias("last_value"))


@register("WIN-14", "win14_pareto_80", """
WITH p AS (SELECT l_partkey, sum(l_extendedprice) AS total FROM lineitem GROUP BY 1),
 r AS (SELECT l_partkey, total, sum(total) OVER (ORDER BY total DESC, l_partkey ROWS UNBOUNDED PRECEDING) AS running,
              sum(total) OVER () AS grand FROM p)
SELECT l_partkey FROM r WHERE running - total < 0.8 * grand""")
def win14(spark, sf):
    li = T(spark, sf, "lineitem")
    return W.pareto(li, "l_partkey", "l_extendedprice", 0.8).select("l_partkey")


@register("WIN-15", "win15_budget_packing", """
WITH s AS (SELECT s_suppkey, CASE WHEN s_nationkey < 12 THEN 'senior' ELSE 'junior' END AS cls,
                  round(abs(s_acctbal)) AS cost FROM supplier),
 r AS (SELECT *, sum(cost) OVER (PARTITION BY cls ORDER BY cost, s_suppkey ROWS UNBOUNDED PRECEDING) AS run FROM s),
 sen AS (SELECT * FROM r WHERE cls = 'senior' AND run <= 60000),
 jun AS (SELECT * FROM r WHERE cls = 'junior' AND run <= 60000 - (SELECT coalesce(sum(cost), 0) FROM sen))
SELECT s_suppkey, cls FROM sen UNION ALL SELECT s_suppkey, cls FROM jun""")
def win15(spark, sf):
    s = T(spark, sf, "supplier").select(
        "s_suppkey", F.when(F.col("s_nationkey") < 12, "senior").otherwise("junior").alias("cls"),
        F.round(F.abs("s_acctbal")).alias("cost"))
    return W.pack_budget(s, "cls", "cost", "s_suppkey", 60000, ["senior", "junior"]).select("s_suppkey", "cls")


@register("WIN-16", "win16_every_nth", """
SELECT o_orderkey FROM (SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn
FROM orders) WHERE rn % 3 = 0""")
def win16(spark, sf):
    o = T(spark, sf, "orders")
    return W.every_nth(o, "o_custkey", ["o_orderdate", "o_orderkey"], 3, chunk=F.year("o_orderdate")).select("o_orderkey")


@register("WIN-17", "win17_fixed_size_teams", """
WITH t AS (SELECT c_custkey, c_nationkey, (row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1) // 3 AS team_in_group
           FROM customer),
 g AS (SELECT c_nationkey, max(team_in_group) + 1 AS n FROM t GROUP BY 1),
 b AS (SELECT c_nationkey, sum(n) OVER (ORDER BY c_nationkey ROWS UNBOUNDED PRECEDING) - n AS base FROM g)
SELECT t.c_custkey, CAST(t.team_in_group AS BIGINT) AS team_in_group, CAST(b.base + t.team_in_group + 1 AS BIGINT) AS team_no
FROM t JOIN b USING (c_nationkey)""")
def win17(spark, sf):
    c = T(spark, sf, "customer").select("c_custkey", "c_nationkey")
    d = W.form_teams(c, "c_nationkey", ["c_custkey"], 3)
    return d.select("c_custkey", F.col("team_in_group").cast("bigint").alias("team_in_group"),
                    F.col("team_no").cast("bigint").alias("team_no"))


@register("WIN-18", "win18_second_else_only", """
SELECT event_id FROM (SELECT event_id, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn,
  count(*) OVER (PARTITION BY user_id, event_type) AS cnt FROM events) WHERE rn = 2 OR cnt = 1""")
def win18(spark, sf):
    e = T(spark, sf, "events")
    return W.nth_else_only(e, ["user_id", "event_type"], ["ts", "event_id"], 2).select("event_id")


@register("WIN-19", "win19_second_row_matches", """
WITH n AS (SELECT o_custkey, o_orderstatus FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn
           FROM orders) WHERE rn = 2)
SELECT c.c_custkey, CASE WHEN n.o_orderstatus = 'F' THEN 'Yes' ELSE 'No' END AS matches
FROM customer c LEFT JOIN n ON n.o_custkey = c.c_custkey""")
def win19(spark, sf):
    c = T(spark, sf, "customer").select("c_custkey")
    o = T(spark, sf, "orders").withColumnRenamed("o_custkey", "c_custkey")
    return W.nth_matches(c, o, "c_custkey", ["o_orderdate", "o_orderkey"], 2, F.col("o_orderstatus") == "F")


@register("WIN-20", "win20_best_spread", """
SELECT user_id, round(max(gain), 4) AS best_spread FROM (
  SELECT user_id, value - min(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS gain
  FROM events) GROUP BY user_id""")
def win20(spark, sf):
    e = T(spark, sf, "events")
    return W.best_spread_chunked(e, "user_id", ["ts", "event_id"], "value", F.to_date("ts")) \
            .withColumn("best_spread", F.round("best_spread", 4))


@register("WIN-21", "win21_repeat_within_k", """
SELECT event_id, user_id FROM (SELECT event_id, user_id, lag(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS prev FROM events)
WHERE event_id - prev <= 5""")
def win21(spark, sf):
    e = T(spark, sf, "events").select("event_id", "user_id")
    return W.repeat_within(e, None, "event_id", "user_id", 5, chunk=F.floor(F.col("event_id") / 1000)) \
            .select("event_id", "user_id")


@register("WIN-22", "win22_product_except_self", """
WITH z AS (SELECT n_regionkey, n_nationkey, count_if(n_nationkey = 0) OVER (PARTITION BY n_regionkey) AS zeros,
                  product(CASE WHEN n_nationkey <> 0 THEN n_nationkey ELSE 1 END) OVER (PARTITION BY n_regionkey) AS prod
           FROM nation)
SELECT n_nationkey, CASE WHEN zeros > 1 THEN 0.0 WHEN zeros = 1 THEN (CASE WHEN n_nationkey = 0 THEN prod ELSE 0.0 END)
                         ELSE prod / n_nationkey END AS product_except_self FROM z""")
def win22(spark, sf):
    n = T(spark, sf, "nation").select("n_regionkey", "n_nationkey")
    return W.product_except_self(n, "n_regionkey", "n_nationkey").select("n_nationkey", "product_except_self")


@register("WIN-23", "win23_sort_limit_offset", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10 OFFSET 5""")
def win23(spark, sf):
    o = T(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return W.sort_limit(o, [F.col("o_totalprice").desc(), "o_orderkey"], 10, 5)


@register("WIN-24", "win24_page", """
SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'O' ORDER BY o_orderkey LIMIT 20 OFFSET 40""")
def win24(spark, sf):
    o = T(spark, sf, "orders")
    return W.page(o, ["o_orderkey"], 3, 20, F.col("o_orderstatus") == "O").select("o_orderkey", "o_custkey")


@register("WIN-24", "win24_keyset_page", """
SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'O' AND o_orderkey > 1000 ORDER BY o_orderkey LIMIT 20""")
def win24b(spark, sf):
    o = T(spark, sf, "orders")
    return W.page_after(o, "o_orderkey", 1000, 20, F.col("o_orderstatus") == "O").select("o_orderkey", "o_custkey")


@register("WIN-25", "win25_sliding_and_chunks", """
SELECT event_id, CAST((row_number() OVER w - 1) // 5 AS BIGINT) AS chunk_no,
       array_to_string(list(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING), ',') AS next3
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def win25(spark, sf):
    e = T(spark, sf, "events")
    d = W.chunk(e, "user_id", ["ts", "event_id"], 5)
    d = W.slide(d.withColumn("eid", F.col("event_id").cast("string")), "user_id", ["ts", "event_id"], "eid", 3, "next3", full=False)
    return d.select("event_id", "chunk_no", F.array_join("next3", ",").alias("next3"))


@register("WIN-25", "win25_full_slides", """
SELECT event_id, array_to_string(s, ',') AS window_vals FROM (
  SELECT event_id, list(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING) AS s
  FROM events) WHERE len(s) = 4""")
def win25b(spark, sf):
    e = T(spark, sf, "events").withColumn("eid", F.col("event_id").cast("string"))
    d = W.slide(e, "user_id", ["ts", "event_id"], "eid", 4)
    return d.select("event_id", F.array_join("window_vals", ",").alias("window_vals"))


_ALPHA = "zyxwvutsrqponmlkjihgfedcba"


@register("WIN-26", "win26_custom_collation", f"""
WITH k AS (SELECT p_brand, p_partkey, translate(p_name, '{_ALPHA}',
   '{"".join(chr(0x4E00 + i) for i in range(26))}') AS key FROM part)
SELECT p_partkey, coalesce(lag(key) OVER (PARTITION BY p_brand ORDER BY p_partkey) <= key, true) AS in_order FROM k""")
def win26(spark, sf):
    p = T(spark, sf, "part").select("p_brand", "p_partkey", "p_name")
    return W.sorted_under(p, "p_name", "p_partkey", _ALPHA, by="p_brand").select("p_partkey", "in_order")
