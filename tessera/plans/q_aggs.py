"""Registered queries for aggregation (AGG-*)."""

from pyspark.sql import functions as F

from tessera.functions.scalars import date_str, round_half_up as r2
from tessera.operators import aggs as A
from tessera.operators.common import join_on, written
from tessera.plans.registry import register
from tessera.session import load_table as T

R2 = "round(CAST({} AS DECIMAL(38,9)), 2)::DOUBLE"


@register("AGG-01", "agg01_pricing_summary", f"""
SELECT l_returnflag, l_linestatus, {R2.format('sum(l_quantity)')} AS sum_qty,
       {R2.format('sum(l_extendedprice)')} AS sum_base_price,
       {R2.format('sum(l_extendedprice * (1 - l_discount))')} AS sum_disc_price,
       {R2.format('sum(l_extendedprice * (1 - l_discount) * (1 + l_tax))')} AS sum_charge,
       round(avg(l_quantity), 4) AS avg_qty, round(avg(l_discount), 6) AS avg_disc, count(*) AS count_order
FROM lineitem WHERE l_shipdate <= TIMESTAMP '2001-06-01' GROUP BY 1, 2""")
def agg01(spark, sf):
    li = T(spark, sf, "lineitem").filter(F.col("l_shipdate") <= F.lit("2001-06-01").cast("timestamp_ntz"))
    disc = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return A.aggregate(li, ["l_returnflag", "l_linestatus"], [
        r2(F.sum("l_quantity")).alias("sum_qty"), r2(F.sum("l_extendedprice")).alias("sum_base_price"),
        r2(F.sum(disc)).alias("sum_disc_price"), r2(F.sum(disc * (1 + F.col("l_tax")))).alias("sum_charge"),
        F.round(F.avg("l_quantity"), 4).alias("avg_qty"), F.round(F.avg("l_discount"), 6).alias("avg_disc"),
        F.count(F.lit(1)).alias("count_order")])


@register("AGG-02", "agg02_having", f"""
SELECT o_custkey, count(*) AS n_orders, {R2.format('sum(o_totalprice)')} AS total
FROM orders GROUP BY o_custkey HAVING count(*) >= 12 AND sum(o_totalprice) > 2500000""")
def agg02(spark, sf):
    o = T(spark, sf, "orders")
    return A.aggregate(o, ["o_custkey"], [F.count(F.lit(1)).alias("n_orders"), F.sum("o_totalprice").alias("_t")],
                       having=(F.col("n_orders") >= 12) & (F.col("_t") > 2500000)) \
            .select("o_custkey", "n_orders", r2(F.col("_t")).alias("total"))


@register("AGG-03", "agg03_pair_reduce_mean", """
SELECT event_type, round(avg(value), 4) AS avg_value FROM events GROUP BY 1""")
def agg03(spark, sf):
    return A.mean_by(T(spark, sf, "events"), "event_type", "value").withColumn("avg_value", F.round("avg_value", 4))


@register("AGG-04", "agg04_keyed_min_filtered", """
SELECT user_id, round(min(value * 1.8 + 32), 4) AS min_value FROM events WHERE event_type = 'error' GROUP BY 1""")
def agg04(spark, sf):
    e = T(spark, sf, "events")
    return A.min_by_key(e, "user_id", F.col("value") * 1.8 + 32, F.col("event_type") == "error") \
            .withColumn("min_value", F.round("min_value", 4))


@register("AGG-05", "agg05_histogram", """SELECT l_quantity, count(*) AS n FROM lineitem GROUP BY 1""")
def agg05(spark, sf):
    return A.histogram(T(spark, sf, "lineitem"), "l_quantity")


@register("AGG-06", "agg06_conditional_distinct", """
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(DISTINCT user_id) AS users,
       count(DISTINCT CASE WHEN event_type = 'purchase' THEN user_id END) AS buyers
FROM events GROUP BY 1""")
def agg06(spark, sf):
    e = T(spark, sf, "events").withColumn("day", date_str("ts"))
    a = A.distinct_count(e, "day", "user_id", out="users")
    b = A.distinct_count(e, "day", "user_id", when=F.col("event_type") == "purchase", out="buyers")
    return a.join(b, "day")


@register("AGG-07", "agg07_approx_distinct")
def agg07(spark, sf):
    return A.approx_distinct(T(spark, sf, "events"), ["user_id", "event_type", "props"], 0.02)


@register("AGG-07", "agg07_merged_sketches", """
SELECT event_type, count(DISTINCT user_id) AS users, true AS near FROM events GROUP BY 1""")
def agg07b(spark, sf):
    e = T(spark, sf, "events")
    stored = written(A.distinct_sketches(e, ["event_type", F.to_date("ts").alias("day")], "user_id"), "daily-sketches")
    exact = e.groupBy("event_type").agg(F.count_distinct("user_id").alias("users"))
    near = F.abs(F.col("approx_distinct") - F.col("users")) <= F.greatest(0.06 * F.col("users"), F.lit(1.0))
    return join_on(A.merged_distinct(stored, "event_type"), exact, ["event_type"]).select("event_type", "users", near.alias("near"))


@register("AGG-08", "agg08_sum_of_case", f"""
SELECT o_orderpriority, CAST(count_if(o_orderstatus = 'F') AS BIGINT) AS n_f, CAST(count_if(o_orderstatus = 'O') AS BIGINT) AS n_o,
       CAST(count_if(o_orderstatus = 'P') AS BIGINT) AS n_p,
       {R2.format("sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0 END)")} AS f_total
FROM orders GROUP BY 1""")
def agg08(spark, sf):
    o = T(spark, sf, "orders")
    st = F.col("o_orderstatus")
    counts = A.sum_if(o, "o_orderpriority", {"n_f": st == "F", "n_o": st == "O", "n_p": st == "P"})
    tot = A.sum_if(o, "o_orderpriority", {"f_total": st == "F"}, "o_totalprice")
    return counts.join(tot, "o_orderpriority").withColumn("f_total", r2(F.col("f_total")))


@register("AGG-09", "agg09_filter_clause", f"""
SELECT CAST(year(o_orderdate) AS BIGINT) AS year,
       {R2.format("sum(o_totalprice) FILTER (WHERE o_orderstatus = 'O')")} AS open_total
FROM orders GROUP BY 1""")
def agg09(spark, sf):
    o = T(spark, sf, "orders").withColumn("year", F.year("o_orderdate").cast("bigint"))
    return A.agg_filter(o, "year", F.col("o_totalprice"), F.col("o_orderstatus") == "O", out="open_total") \
            .withColumn("open_total", r2(F.col("open_total")))


_PIVOT_SQL = """
SELECT CAST(year(o_orderdate) AS BIGINT) AS year, count(*) FILTER (WHERE o_orderstatus = 'F') AS "F",
       count(*) FILTER (WHERE o_orderstatus = 'O') AS "O", count(*) FILTER (WHERE o_orderstatus = 'P') AS "P"
FROM orders GROUP BY 1"""


@register("AGG-10", "agg10_pivot_known_values", _PIVOT_SQL)
def agg10(spark, sf):
    o = T(spark, sf, "orders").withColumn("year", F.year("o_orderdate").cast("bigint"))
    p = A.pivot(o.withColumn("one", F.lit(1)), "year", "o_orderstatus", "one", values=["F", "O", "P"], fn="count")
    return p.fillna(0, ["F", "O", "P"])


@register("AGG-10", "agg10_pivot_data_driven", _PIVOT_SQL)
def agg10b(spark, sf):
    o = T(spark, sf, "orders").withColumn("year", F.year("o_orderdate").cast("bigint"))
    p = A.pivot(o.withColumn("one", F.lit(1)), "year", "o_orderstatus", "one", fn="count")
    return p.fillna(0, [c for c in p.columns if c != "year"])


@register("AGG-11", "agg11_unpivot", """
SELECT l_orderkey, l_linenumber, measure, value FROM
  (SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_tax FROM lineitem)
  UNPIVOT (value FOR measure IN (l_quantity, l_discount, l_tax))""")
def agg11(spark, sf):
    li = T(spark, sf, "lineitem")
    return A.unpivot(li, ["l_orderkey", "l_linenumber"], ["l_quantity", "l_discount", "l_tax"], "measure", "value")


@register("AGG-12", "agg12_ordered_string_agg", """
SELECT o_custkey, string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority) AS items
FROM orders GROUP BY 1""")
def agg12(spark, sf):
    return A.list_agg(T(spark, sf, "orders"), "o_custkey", "o_orderpriority", ",", distinct=True)


_MATCHES_SQL = """
WITH m AS (SELECT 'S' || CAST(a.l_suppkey AS VARCHAR) AS team_1, 'S' || CAST(b.l_suppkey AS VARCHAR) AS team_2,
                  CASE WHEN a.l_quantity > b.l_quantity THEN 'S' || CAST(a.l_suppkey AS VARCHAR)
                       WHEN b.l_quantity > a.l_quantity THEN 'S' || CAST(b.l_suppkey AS VARCHAR) END AS winner
           FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey
             AND a.l_linenumber % 2 = 1 AND b.l_linenumber = a.l_linenumber + 1)"""


def _matches(spark, sf):
    li = T(spark, sf, "lineitem")
    a = li.filter("l_linenumber % 2 = 1").select("l_orderkey", (F.col("l_linenumber") + 1).alias("_next"), F.concat(F.lit("S"), F.col("l_suppkey").cast("string"))
                                             .alias("team_1"), F.col("l_quantity").alias("qa"))
    b = li.filter("l_linenumber % 2 = 0").select("l_orderkey", F.col("l_linenumber").alias("_next"), F.concat(F.lit("S"), F.col("l_suppkey").cast("string"))
                                             .alias("team_2"), F.col("l_quantity").alias("qb"))
    m = a.join(b, ["l_orderkey", "_next"])
    return m.select("team_1", "team_2", F.when(F.col("qa") > F.col("qb"), F.col("team_1"))
                    .when(F.col("qb") > F.col("qa"), F.col("team_2")).alias("winner"))


@register("AGG-13", "agg13_standings", _MATCHES_SQL + """
SELECT team, count(*) AS played, CAST(count_if(won) AS BIGINT) AS won, CAST(count_if(NOT draw AND NOT coalesce(won, false)) AS BIGINT) AS lost
FROM (SELECT team_1 AS team, winner = team_1 AS won, winner IS NULL AS draw FROM m
      UNION ALL SELECT team_2, winner = team_2, winner IS NULL FROM m) GROUP BY team""")
def agg13(spark, sf):
    return A.standings(_matches(spark, sf), "team_1", "team_2", "winner")


@register("AGG-14", "agg14_busiest_route_round_trip", """
WITH r AS (SELECT s.s_nationkey AS src, c.c_nationkey AS dst, l.l_returnflag AS kind
           FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
           JOIN supplier s ON l.l_suppkey = s.s_suppkey),
 d AS (SELECT src, dst FROM r UNION ALL SELECT dst, src FROM r WHERE kind = 'R')
SELECT CAST(src AS BIGINT) AS src, CAST(dst AS BIGINT) AS dst, count(*) AS trips
FROM d GROUP BY 1, 2 ORDER BY trips DESC, src, dst LIMIT 1""")
def agg14(spark, sf):
    li = T(spark, sf, "lineitem").select("l_orderkey", "l_suppkey", "l_returnflag")
    o = T(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    c = T(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("dst"))
    s = T(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("src"))
    r = li.join(o, "l_orderkey").join(c, "o_custkey").join(s, "l_suppkey")
    return A.busiest_route(r, "src", "dst", F.col("l_returnflag") == "R", 1)


@register("AGG-15", "agg15_share_of_total", f"""
SELECT o_orderpriority, round(sum(o_totalprice) * 100.0 / (SELECT sum(o_totalprice) FROM orders), 2) AS share_pct
FROM orders GROUP BY 1""")
def agg15(spark, sf):
    return A.share_of_total(T(spark, sf, "orders"), "o_orderpriority", "o_totalprice").drop("_part")


@register("AGG-16", "agg16_rate", """
SELECT CAST(year(o_orderdate) AS BIGINT) AS year, round(count_if(o_orderstatus = 'F') * 100.0 / count(*), 2) AS rate_pct
FROM orders WHERE o_orderpriority <> '5-LOW' GROUP BY 1""")
def agg16(spark, sf):
    o = T(spark, sf, "orders").withColumn("year", F.year("o_orderdate").cast("bigint"))
    return A.rate(o, "year", F.col("o_orderstatus") == "F", F.col("o_orderpriority") != "5-LOW")


@register("AGG-17", "agg17_exclusive_usage", """
WITH u AS (SELECT user_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day,
                  CASE WHEN count(DISTINCT event_type) = 2 THEN 'both' ELSE min(event_type) END AS platform,
                  sum(value) AS amount
           FROM events WHERE event_type IN ('click', 'view') GROUP BY 1, 2),
 grid AS (SELECT DISTINCT day, p.platform FROM u, (VALUES ('click'), ('view'), ('both')) p(platform))
SELECT g.day, g.platform, round(coalesce(sum(u.amount), 0), 2) AS total_amount, count(u.user_id) AS total_users
FROM grid g LEFT JOIN u ON g.day = u.day AND g.platform = u.platform GROUP BY 1, 2""")
def agg17(spark, sf):
    e = T(spark, sf, "events").filter(F.col("event_type").isin("click", "view")).withColumn("day", date_str("ts"))
    return A.exclusive_usage(e, "user_id", "day", "event_type", "value", ["click", "view"])


@register("AGG-18", "agg18_has_all_of_set", """
SELECT user_id FROM events WHERE event_type IN ('signup', 'purchase', 'error')
GROUP BY user_id HAVING count(DISTINCT event_type) = 3""")
def agg18(spark, sf):
    return A.has_all(T(spark, sf, "events"), "user_id", "event_type", ["signup", "purchase", "error"])


@register("AGG-19", "agg19_only_ever", """
SELECT o_custkey FROM orders GROUP BY o_custkey HAVING bool_and(o_orderstatus = 'F')""")
def agg19(spark, sf):
    return A.only_ever(T(spark, sf, "orders"), "o_custkey", "o_orderstatus", "F")


@register("AGG-20", "agg20_never_repeated_items", """
WITH b AS (SELECT o.o_custkey, l.l_partkey, CAST(o.o_orderdate AS DATE) AS d
           FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
 act AS (SELECT o_custkey FROM b GROUP BY 1 HAVING count(DISTINCT d) > 1)
SELECT o_custkey, l_partkey FROM b WHERE o_custkey IN (SELECT o_custkey FROM act)
GROUP BY 1, 2 HAVING count(DISTINCT d) = 1""")
def agg20(spark, sf):
    li = T(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey")
    o = T(spark, sf, "orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("d"))
    return A.never_repeat(li.join(o, "o_orderkey"), "o_custkey", "l_partkey", "d")


@register("AGG-21", "agg21_arg_extremes", """
SELECT c_nationkey,
  (SELECT min(c2.c_name) FROM customer c2 WHERE c2.c_nationkey = c.c_nationkey
     AND c2.c_acctbal = max(c.c_acctbal)) AS top_c_name,
  (SELECT min(c2.c_name) FROM customer c2 WHERE c2.c_nationkey = c.c_nationkey
     AND c2.c_acctbal = min(c.c_acctbal)) AS bottom_c_name
FROM customer c GROUP BY c_nationkey""")
def agg21(spark, sf):
    return A.arg_extremes(T(spark, sf, "customer"), "c_nationkey", "c_name", "c_acctbal")


@register("AGG-22", "agg22_leave_one_out_mean", """
SELECT c_mktsegment, round(avg(c_acctbal), 4) AS group_avg,
  round(((SELECT sum(c_acctbal) FROM customer) - sum(c_acctbal)) / ((SELECT count(*) FROM customer) - count(*)), 4) AS others_avg
FROM customer GROUP BY 1""")
def agg22(spark, sf):
    d = A.leave_one_out_mean(T(spark, sf, "customer"), "c_mktsegment", "c_acctbal")
    return d.select("c_mktsegment", F.round("group_avg", 4).alias("group_avg"), F.round("others_avg", 4).alias("others_avg"))


@register("AGG-23", "agg23_mode_with_tie_rule", """
WITH b AS (SELECT o.o_custkey, p.p_brand, count(*) AS n, max(o.o_orderdate) AS latest
           FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey
           GROUP BY 1, 2)
SELECT o_custkey, p_brand, n FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, latest DESC, p_brand) AS rn FROM b)
WHERE rn = 1""")
def agg23(spark, sf):
    li = T(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_partkey").alias("p_partkey"))
    o = T(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    p = T(spark, sf, "part").select("p_partkey", "p_brand")
    d = li.join(o, "o_orderkey").join(p, "p_partkey")
    m = A.mode_by(d, "o_custkey", "p_brand", {"latest": F.max("o_orderdate")},
                  [F.col("latest").desc(), F.col("p_brand")])
    return m.select("o_custkey", "p_brand", "n")


@register("AGG-24", "agg24_exact_median", """
SELECT l_returnflag, l_linestatus, median(l_quantity) AS median_qty, round(median(l_extendedprice), 4) AS median_price
FROM lineitem GROUP BY 1, 2""")
def agg24(spark, sf):
    li = T(spark, sf, "lineitem")
    a = A.median_by(li, ["l_returnflag", "l_linestatus"], "l_quantity", "median_qty")
    b = A.median_by(li, ["l_returnflag", "l_linestatus"], "l_extendedprice", "median_price")
    return a.join(b, ["l_returnflag", "l_linestatus"]).withColumn("median_price", F.round("median_price", 4))


@register("AGG-25", "agg25_half_year_gain", """
SELECT o_custkey, CAST(year(o_orderdate) AS BIGINT) AS year,
       round(avg(o_totalprice) FILTER (WHERE month(o_orderdate) <= 6), 4) AS h1_avg,
       round(avg(o_totalprice) FILTER (WHERE month(o_orderdate) > 6), 4) AS h2_avg
FROM orders GROUP BY 1, 2
HAVING avg(o_totalprice) FILTER (WHERE month(o_orderdate) > 6) > avg(o_totalprice) FILTER (WHERE month(o_orderdate) <= 6)""")
def agg25(spark, sf):
    o = T(spark, sf, "orders").withColumn("year", F.year("o_orderdate").cast("bigint"))
    return A.half_year_gain(o, ["o_custkey", "year"], "o_orderdate", "o_totalprice")


@register("AGG-26", "agg26_two_fact_month", """
WITH a AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS approved,
                  round(sum(o_totalprice), 2) AS approved_amount FROM orders WHERE o_orderstatus = 'F' GROUP BY 1),
 b AS (SELECT strftime(l_shipdate, '%Y-%m') AS month, count(*) AS returns FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1)
SELECT coalesce(a.month, b.month) AS month, coalesce(approved, 0) AS approved,
       coalesce(approved_amount, 0) AS approved_amount, coalesce(returns, 0) AS returns
FROM a FULL JOIN b ON a.month = b.month
WHERE coalesce(approved, 0) + coalesce(returns, 0) > 0""")
def agg26(spark, sf):
    o = T(spark, sf, "orders").filter("o_orderstatus = 'F'").withColumn("month", F.date_format("o_orderdate", "yyyy-MM"))
    li = T(spark, sf, "lineitem").filter("l_returnflag = 'R'").withColumn("month", F.date_format("l_shipdate", "yyyy-MM"))
    a = o.groupBy("month").agg(F.count(F.lit(1)).alias("approved"), F.round(F.sum("o_totalprice"), 2).alias("approved_amount"))
    b = li.groupBy("month").agg(F.count(F.lit(1)).alias("returns"))
    return A.two_fact_month(a, b, "month")


@register("AGG-27", "agg27_missing_members", """
SELECT c.o_custkey, p.o_orderpriority
FROM (SELECT DISTINCT o_custkey FROM orders) c, (SELECT DISTINCT o_orderpriority FROM orders) p
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.o_custkey AND o.o_orderpriority = p.o_orderpriority)""")
def agg27(spark, sf):
    o = T(spark, sf, "orders")
    return A.missing_members(o, "o_custkey", "o_orderpriority")


@register("AGG-28", "agg28_proportional_payout", """
WITH s AS (SELECT l_orderkey, l_suppkey, l_returnflag = 'N' AS won, l_quantity AS stake FROM lineitem),
 t AS (SELECT l_orderkey, sum(stake) FILTER (WHERE won) AS win_pot, sum(stake) FILTER (WHERE NOT won) AS lose_pot
       FROM s GROUP BY 1)
SELECT s.l_orderkey, s.l_suppkey, round(s.stake + coalesce(t.lose_pot, 0) * s.stake / t.win_pot, 4) AS payout
FROM s JOIN t USING (l_orderkey) WHERE s.won""")
def agg28(spark, sf):
    li = T(spark, sf, "lineitem").select("l_orderkey", "l_suppkey", (F.col("l_returnflag") == "N").alias("won"),
                                         F.col("l_quantity").alias("stake"))
    return A.payout(li, "l_orderkey", "won", "stake").select(
        "l_orderkey", "l_suppkey", F.round("payout", 4).alias("payout"))


@register("AGG-30", "agg30_rollup", f"""
SELECT r.r_name, n.n_name, c.c_mktsegment, {R2.format('sum(c.c_acctbal)')} AS acctbal, count(*) AS n,
       CAST(grouping(r.r_name, n.n_name, c.c_mktsegment) AS BIGINT) AS gid
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
GROUP BY ROLLUP (r.r_name, n.n_name, c.c_mktsegment)""")
def agg30(spark, sf):
    d = _geo(spark, sf)
    return A.rollup(d, ["r_name", "n_name", "c_mktsegment"],
                    [r2(F.sum("c_acctbal")).alias("acctbal"), F.count(F.lit(1)).alias("n")])


@register("AGG-30", "agg30_cube", f"""
SELECT r.r_name, c.c_mktsegment, {R2.format('sum(c.c_acctbal)')} AS acctbal, count(*) AS n,
       CAST(grouping(r.r_name, c.c_mktsegment) AS BIGINT) AS gid
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
GROUP BY CUBE (r.r_name, c.c_mktsegment)""")
def agg30b(spark, sf):
    d = _geo(spark, sf)
    return A.cube(d, ["r_name", "c_mktsegment"], [r2(F.sum("c_acctbal")).alias("acctbal"), F.count(F.lit(1)).alias("n")])


def _geo(spark, sf):
    c = T(spark, sf, "customer").select(F.col("c_nationkey").alias("n_nationkey"), "c_mktsegment", "c_acctbal")
    n = T(spark, sf, "nation").select("n_nationkey", "n_name", F.col("n_regionkey").alias("r_regionkey"))
    r = T(spark, sf, "region")
    return c.join(n, "n_nationkey").join(r, "r_regionkey")


@register("AGG-31", "agg31_top_k_frequent", """
SELECT user_id, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, user_id LIMIT 3""")
def agg31(spark, sf):
    return A.top_k(T(spark, sf, "events"), "user_id", 3)


@register("AGG-32", "agg32_anagram_groups", """
WITH w AS (SELECT DISTINCT unnest(regexp_split_to_array(lower(text), '[^a-z]+')) AS word FROM documents),
 s AS (SELECT word, array_to_string(list_sort(string_split(word, '')), '') AS signature FROM w WHERE word <> '')
SELECT signature, count(*) AS n_words, min(word) AS first_word FROM s GROUP BY 1 HAVING count(*) > 1""")
def agg32(spark, sf):
    d = T(spark, sf, "documents")
    w = d.select(F.explode(F.split(F.lower("text"), "[^a-z]+")).alias("word")).filter("word <> ''").distinct()
    s = A.group_by_signature(w, "word")
    return s.groupBy("signature").agg(F.count(F.lit(1)).alias("n_words"), F.min("word").alias("first_word")) \
            .filter("n_words > 1")


@register("AGG-33", "agg33_duplicate_value_test", """
SELECT l_orderkey, count(l_partkey) > count(DISTINCT l_partkey) AS has_duplicates FROM lineitem GROUP BY 1""")
def agg33(spark, sf):
    return A.has_duplicates(T(spark, sf, "lineitem"), "l_partkey", ["l_orderkey"])


@register("AGG-34", "agg34_loyalty_score", f"""
SELECT o_custkey, {R2.format('count(*) * 10 + sum(o_totalprice) / 100')} AS loyalty FROM orders GROUP BY 1""")
def agg34(spark, sf):
    return A.loyalty(T(spark, sf, "orders"), "o_custkey", "o_totalprice")


@register("AGG-35", "agg35_category_difference", """
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day,
       round(sum(CASE WHEN event_type = 'purchase' THEN value ELSE -value END), 2) AS diff
FROM events WHERE event_type IN ('purchase', 'error') GROUP BY 1""")
def agg35(spark, sf):
    e = T(spark, sf, "events").withColumn("day", date_str("ts"))
    return A.category_diff(e, "day", "event_type", "purchase", "error", "value") \
            .withColumn("diff", F.round("diff", 2))


@register("AGG-36", "agg36_max_above_all_means", """
WITH o AS (SELECT l_orderkey, max(l_quantity) AS mx, avg(l_quantity) AS av FROM lineitem GROUP BY 1)
SELECT l_orderkey FROM o WHERE mx > (SELECT max(av) FROM o)""")
def agg36(spark, sf):
    return A.above_all_means(T(spark, sf, "lineitem"), "l_orderkey", "l_quantity")


@register("AGG-37", "agg37_heavy_weeks", """
WITH w AS (SELECT user_id, date_trunc('week', ts) AS wk, sum(value) AS total FROM events GROUP BY 1, 2)
SELECT user_id, count(*) AS heavy_weeks FROM w WHERE total > 250 GROUP BY 1 HAVING count(*) >= 2""")
def agg37(spark, sf):
    return A.heavy_weeks(T(spark, sf, "events"), "user_id", "ts", "value", 250, 2)


@register("AGG-38", "agg38_join_and_threshold", f"""
SELECT c.c_custkey, c.c_name, {R2.format('sum(o.o_totalprice)')} AS total
FROM customer c JOIN orders o ON o.o_custkey = c.c_custkey GROUP BY 1, 2 HAVING sum(o.o_totalprice) > 3000000""")
def agg38(spark, sf):
    c = T(spark, sf, "customer").select("c_custkey", "c_name")
    o = T(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_totalprice")
    return A.aggregate(o, "c_custkey", [F.sum("o_totalprice").alias("_t")], having=F.col("_t") > 3000000) \
            .join(c, "c_custkey").select("c_custkey", "c_name", r2(F.col("_t")).alias("total"))
