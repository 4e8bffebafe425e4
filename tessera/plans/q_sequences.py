"""Registered queries for sequence analytics (SEQ-*)."""

from pyspark.sql import functions as F

from tessera.functions.scalars import date_str, round_half_up as r2, ts_str
from tessera.operators import sequences as Q
from tessera.operators.common import quantile_chunk, spread, task_count
from tessera.plans.registry import register
from tessera.session import load_table as T


@register("SEQ-01", "seq01_islands_consecutive_days", """
WITH d AS (SELECT DISTINCT user_id, CAST(day(ts) AS BIGINT) AS dn FROM events),
 g AS (SELECT user_id, dn, dn - dense_rank() OVER (PARTITION BY user_id ORDER BY dn) AS isl FROM d)
SELECT user_id, min(dn) AS start, max(dn) AS "end", count(*) AS n FROM g GROUP BY user_id, isl""")
def seq01(spark, sf):
    e = T(spark, sf, "events").select(
        "user_id", F.dayofmonth("ts").cast("bigint").alias("dn"))
    return Q.islands(e, "user_id", "dn", chunk=F.floor(F.col("dn") / 7))


@register("SEQ-02", "seq02_date_gap_islands", """
WITH d AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS d FROM events),
 f AS (SELECT *, CASE WHEN lag(d) OVER w IS NULL OR d - lag(d) OVER w > 1 THEN 1 ELSE 0 END AS s FROM d
       WINDOW w AS (PARTITION BY user_id ORDER BY d)),
 g AS (SELECT *, sum(s) OVER (PARTITION BY user_id ORDER BY d ROWS UNBOUNDED PRECEDING) AS grp FROM f)
SELECT user_id, CAST(min(d) AS VARCHAR) AS start, CAST(max(d) AS VARCHAR) AS "end", count(*) AS n_days
FROM g GROUP BY user_id, grp HAVING count(*) >= 2""")
def seq02(spark, sf):
    d = Q.date_islands(T(spark, sf, "events"), "user_id", "ts", 1, 2, chunk_days=7)
    return d.select("user_id", date_str("start").alias("start"), date_str("end").alias("end"), "n_days")


@register("SEQ-03", "seq03_runs_of_at_least_k", """
WITH f AS (SELECT event_id, user_id, value > 25 AS f,
                  row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) -
                  row_number() OVER (PARTITION BY user_id, value > 25 ORDER BY ts, event_id) AS isl FROM events),
 r AS (SELECT *, count(*) OVER (PARTITION BY user_id, f, isl) AS len FROM f)
SELECT event_id FROM r WHERE f AND len >= 3""")
def seq03(spark, sf):
    e = T(spark, sf, "events")
    return Q.runs_of(e, "user_id", ["ts", "event_id"], F.col("value") > 25, 3, chunk=F.to_date("ts")).select("event_id")


@register("SEQ-04", "seq04_free_seat_blocks", """
WITH s AS (SELECT l_orderkey AS seat_row, l_linenumber AS seat FROM lineitem GROUP BY 1, 2
           HAVING bool_and(l_returnflag <> 'R')),
 g AS (SELECT *, seat - row_number() OVER (PARTITION BY seat_row ORDER BY seat) AS isl FROM s)
SELECT seat_row, seat FROM (SELECT *, count(*) OVER (PARTITION BY seat_row, isl) AS len FROM g) WHERE len >= 3""")
def seq04(spark, sf):
    li = T(spark, sf, "lineitem")
    s = li.groupBy(F.col("l_orderkey").alias("seat_row"), F.col("l_linenumber").alias("seat")) \
          .agg(F.bool_and(F.col("l_returnflag") != "R").alias("free"))
    return Q.free_blocks(s, "seat_row", "seat", F.col("free"), 3)


@register("SEQ-05", "seq05_on_off_runs", """
WITH s AS (SELECT user_id, ts, event_type IN ('view', 'click') AS on_ FROM events),
 c AS (SELECT *, CASE WHEN lag(on_) OVER w IS NULL OR lag(on_) OVER w <> on_ THEN 1 ELSE 0 END AS chg FROM s
       WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
 g AS (SELECT *, sum(chg) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS grp FROM c),
 r AS (SELECT user_id, grp, first(on_) AS on_, min(ts) AS start, count(*) AS on_count FROM g GROUP BY 1, 2),
 l AS (SELECT *, lead(start) OVER (PARTITION BY user_id ORDER BY grp) AS logout FROM r)
SELECT user_id, strftime(start, '%Y-%m-%d %H:%M:%S.%f') AS login, strftime(logout, '%Y-%m-%d %H:%M:%S.%f') AS logout, on_count FROM l WHERE on_""")
def seq05(spark, sf):
    e = T(spark, sf, "events")
    d = Q.on_off_runs(e, "user_id", "ts", F.col("event_type").isin("view", "click"), chunk=F.to_date("ts"))
    return d.withColumn("login", ts_str("login")).withColumn("logout", ts_str("logout"))


@register("SEQ-06", "seq06_sessionize_30min", """
WITH f AS (SELECT user_id, ts, CASE WHEN lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w > INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS s
           FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
 g AS (SELECT *, sum(s) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS session_no FROM f)
SELECT user_id, CAST(session_no AS BIGINT) AS session_no, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS start,
       strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS "end", count(*) AS n_events,
       round((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6, 3) AS duration_s
FROM g GROUP BY 1, 2""")
def seq06(spark, sf):
    e = T(spark, sf, "events")
    d = Q.sessionize(e, "user_id", "ts", 1800, id_col="event_id")
    return d.withColumn("duration_s", F.round("duration_s", 3)).withColumn("session_no", F.col("session_no").cast("bigint")) \
            .withColumn("start", ts_str("start")).withColumn("end", ts_str("end"))


_IV = """(SELECT l_partkey, l_orderkey * 10 + l_linenumber AS id, l_shipdate AS s,
        l_shipdate + to_days(CAST(l_quantity AS INTEGER)) AS e FROM lineitem)"""


def _intervals(spark, sf):
    li = T(spark, sf, "lineitem")
    return li.select("l_partkey", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
                     F.col("l_shipdate").alias("s"),
                     F.timestamp_add("DAY", F.col("l_quantity").cast("int"), F.col("l_shipdate")).alias("e"))


@register("SEQ-07", "seq07_overlap_count", f"""
SELECT l_partkey, CAST(count_if(mx > s) AS BIGINT) AS overlaps FROM (
  SELECT *, max(e) OVER (PARTITION BY l_partkey ORDER BY s, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mx
  FROM {_IV}) GROUP BY 1""")
def seq07(spark, sf):
    return Q.overlap_count(_intervals(spark, sf), "l_partkey", "s", "e", "id", chunk=F.year("s"))


@register("SEQ-08", "seq08_merge_intervals", f"""
WITH m AS (SELECT *, max(e) OVER (PARTITION BY l_partkey ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mx
           FROM {_IV}),
 g AS (SELECT *, sum(CASE WHEN mx IS NULL OR s > mx THEN 1 ELSE 0 END)
                 OVER (PARTITION BY l_partkey ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS grp FROM m)
SELECT l_partkey, strftime(min(s), '%Y-%m-%d %H:%M:%S.%f') AS start, strftime(max(e), '%Y-%m-%d %H:%M:%S.%f') AS "end"
FROM g GROUP BY l_partkey, grp""")
def seq08(spark, sf):
    d = Q.merge_intervals(_intervals(spark, sf), "l_partkey", "s", "e", chunk=F.year("s"))
    return d.withColumn("start", ts_str("start")).withColumn("end", ts_str("end"))


@register("SEQ-09", "seq09_always_rising", """
SELECT o_custkey FROM (SELECT o_custkey, o_totalprice,
  lead(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS nxt FROM orders)
GROUP BY 1 HAVING bool_and(nxt IS NULL OR nxt > o_totalprice)""")
def seq09(spark, sf):
    return Q.always_rising(T(spark, sf, "orders"), "o_custkey", ["o_orderdate", "o_orderkey"], "o_totalprice",
                           chunk=F.year("o_orderdate"))


@register("SEQ-10", "seq10_next_event_latency", """
SELECT event_id, round(latency_s, 3) AS latency_s, CAST(latency_s > 3600 AS DOUBLE) AS long_gap FROM (
  SELECT event_id, (epoch_us(lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) - epoch_us(ts)) / 1e6 AS latency_s
  FROM events)""")
def seq10(spark, sf):
    e = T(spark, sf, "events")
    d = Q.next_latency(e, "user_id", ["ts", "event_id"], "ts", 3600, chunk=F.to_date("ts"))
    return d.select("event_id", F.round("latency_s", 3).alias("latency_s"), F.col("long_gap").cast("double").alias("long_gap"))


@register("SEQ-11", "seq11_chained_rides", """
SELECT l_orderkey, count(*) FILTER (WHERE chained) AS chained_legs FROM (
  SELECT l_orderkey, l_suppkey % 7 = lead(l_partkey % 7) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS chained
  FROM lineitem) GROUP BY 1""")
def seq11(spark, sf):
    li = T(spark, sf, "lineitem").withColumn("start_loc", F.col("l_partkey") % 7).withColumn("end_loc", F.col("l_suppkey") % 7)
    d = Q.chained(li, "l_orderkey", ["l_linenumber", "l_partkey", "l_suppkey"], "start_loc", "end_loc")
    return d.groupBy("l_orderkey").agg(F.count_if("chained").alias("chained_legs"))


@register("SEQ-12", "seq12_first_last_same", """
SELECT user_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, arg_min(event_type, (ts, event_id)) AS event_type
FROM events GROUP BY 1, 2 HAVING arg_min(event_type, (ts, event_id)) = arg_max(event_type, (ts, event_id))""")
def seq12(spark, sf):
    e = T(spark, sf, "events").withColumn("day", date_str("ts")).withColumn("_o", F.struct("ts", "event_id"))
    return Q.first_last_same(e, ["user_id", "day"], "_o", "event_type")


@register("SEQ-13", "seq13_trip_endpoints", """
SELECT DISTINCT l_suppkey AS node, 'origin' AS kind FROM lineitem WHERE l_suppkey NOT IN (SELECT l_partkey FROM lineitem)
UNION ALL
SELECT DISTINCT l_partkey, 'terminus' FROM lineitem WHERE l_partkey NOT IN (SELECT l_suppkey FROM lineitem)""")
def seq13(spark, sf):
    return Q.endpoints(T(spark, sf, "lineitem"), "l_suppkey", "l_partkey")


@register("SEQ-14", "seq14_new_vs_repeat", """
WITH f AS (SELECT o_custkey, min(o_orderdate) AS fd FROM orders GROUP BY 1),
 d AS (SELECT DISTINCT o_custkey, o_orderdate FROM orders)
SELECT strftime(d.o_orderdate, '%Y-%m-%d %H:%M:%S.%f') AS o_orderdate, CAST(count_if(d.o_orderdate = f.fd) AS BIGINT) AS new_users,
       CAST(count_if(d.o_orderdate > f.fd) AS BIGINT) AS repeat_users
FROM d JOIN f USING (o_custkey) GROUP BY 1""")
def seq14(spark, sf):
    return Q.new_vs_repeat(T(spark, sf, "orders"), "o_custkey", "o_orderdate").withColumn("o_orderdate", ts_str("o_orderdate"))


@register("SEQ-15", "seq15_first_seen_by_year", """
SELECT CAST(year AS INTEGER) AS year, count(*) AS new_entities FROM (
  SELECT c.c_nationkey, year(min(o.o_orderdate)) AS year FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY 1)
GROUP BY 1""")
def seq15(spark, sf):
    o = T(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderdate")
    c = T(spark, sf, "customer").select("c_custkey", "c_nationkey")
    return Q.first_seen_by_year(o.join(c, "c_custkey"), "c_nationkey", "o_orderdate")


@register("SEQ-16", "seq16_retention_churn", """
WITH a AS (SELECT DISTINCT o_custkey, year(o_orderdate) * 12 + month(o_orderdate) - 1 AS m FROM orders)
SELECT a.m, CAST(count_if(b.o_custkey IS NOT NULL) AS BIGINT) AS retained, CAST(count_if(b.o_custkey IS NULL) AS BIGINT) AS churned
FROM a LEFT JOIN a b ON a.o_custkey = b.o_custkey AND b.m = a.m + 1 GROUP BY a.m""")
def seq16(spark, sf):
    return Q.retention(T(spark, sf, "orders"), "o_custkey", "o_orderdate").withColumn("m", F.col("m").cast("bigint"))


@register("SEQ-17", "seq17_next_day_return_rate", """
WITH d AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS d FROM events WHERE event_type = 'purchase'),
 f AS (SELECT user_id, min(d) AS fd FROM d GROUP BY 1)
SELECT round(count(d.user_id) / (SELECT count(*) FROM f), 2) AS fraction
FROM f LEFT JOIN d ON d.user_id = f.user_id AND d.d = f.fd + 1""")
def seq17(spark, sf):
    e = T(spark, sf, "events").filter("event_type = 'purchase'")
    return Q.next_day_rate(e, "user_id", "ts")


@register("SEQ-18", "seq18_same_day_conversion", """
WITH d AS (SELECT user_id, CAST(ts AS DATE) AS day, event_type FROM events),
 b AS (SELECT day, count(*) AS converted FROM (SELECT user_id, day FROM d WHERE event_type IN ('signup', 'purchase')
       GROUP BY 1, 2 HAVING count(DISTINCT event_type) = 2) GROUP BY 1)
SELECT CAST(x.day AS VARCHAR) AS day, coalesce(b.converted, 0) AS converted FROM (SELECT DISTINCT day FROM d) x LEFT JOIN b USING (day)""")
def seq18(spark, sf):
    d = Q.same_day_conversion(T(spark, sf, "events"), "user_id", "ts", "event_type", "signup", "purchase")
    return d.withColumn("day", date_str("day"))


@register("SEQ-19", "seq19_conversion_within_days", """
WITH f AS (SELECT user_id, min(ts) AS t0 FROM events WHERE event_type = 'signup' GROUP BY 1),
 h AS (SELECT DISTINCT e.user_id FROM events e JOIN f USING (user_id)
       WHERE e.event_type = 'purchase' AND e.ts >= f.t0 AND e.ts <= f.t0 + INTERVAL 3 DAY)
SELECT round((SELECT count(*) FROM h) * 100.0 / (SELECT count(*) FROM f), 2) AS pct""")
def seq19(spark, sf):
    return Q.conversion_within(T(spark, sf, "events"), "user_id", "ts", "event_type", "signup", "purchase", 3)


@register("SEQ-20", "seq20_campaign_success", """
WITH b AS (SELECT o.o_custkey, CAST(o.o_orderdate AS DATE) AS d, l.l_partkey FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
 f AS (SELECT o_custkey, min(d) AS fd FROM b GROUP BY 1)
SELECT DISTINCT b.o_custkey FROM b JOIN f USING (o_custkey) WHERE b.d > f.fd
  AND NOT EXISTS (SELECT 1 FROM b b1 WHERE b1.o_custkey = b.o_custkey AND b1.d = f.fd AND b1.l_partkey = b.l_partkey)""")
def seq20(spark, sf):
    li = T(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey")
    o = T(spark, sf, "orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("d"))
    tasks = task_count(li)
    both = spread(li, "o_orderkey", tasks=tasks).join(spread(o, "o_orderkey", tasks=tasks), "o_orderkey")
    return Q.campaign_success(both, "o_custkey", "d", "l_partkey")


@register("SEQ-21", "seq21_lapsed_customers", """
WITH g AS (SELECT o_custkey, min(o_orderdate) AS f, max(o_orderdate) AS l FROM orders GROUP BY 1),
 n AS (SELECT max(o_orderdate) AS now FROM orders)
SELECT o_custkey FROM g, n WHERE date_diff('day', l, now) > 180 AND date_diff('day', f, now) > 1095""")
def seq21(spark, sf):
    return Q.lapsed(T(spark, sf, "orders"), "o_custkey", "o_orderdate", 180, 1095)


@register("SEQ-22", "seq22_one_order_cohort", """
SELECT cohort, count(*) AS one_order_customers FROM (
  SELECT o_custkey, strftime(min(o_orderdate), '%Y-%m') AS cohort, count(*) AS n FROM orders GROUP BY 1) WHERE n = 1 GROUP BY 1""")
def seq22(spark, sf):
    return Q.one_order_cohort(T(spark, sf, "orders"), "o_custkey", "o_orderdate")


@register("SEQ-23", "seq23_organic_share", """
SELECT strftime(first_d, '%Y-%m') AS cohort, round(count_if(NOT promo) * 100.0 / count(*), 2) AS organic_pct FROM (
  SELECT o_custkey, arg_min(o_orderpriority = '1-URGENT', (o_orderdate, o_orderkey)) AS promo, min(o_orderdate) AS first_d
  FROM orders GROUP BY 1) GROUP BY 1""")
def seq23(spark, sf):
    o = T(spark, sf, "orders")
    return Q.organic_share(o, "o_custkey", ["o_orderdate", "o_orderkey"], "o_orderdate", F.col("o_orderpriority") == "1-URGENT")


@register("SEQ-24", "seq24_daily_survivors_and_leader", """
WITH d AS (SELECT user_id, CAST(ts AS DATE) AS day FROM events),
 a AS (SELECT DISTINCT user_id, day FROM d), d0 AS (SELECT min(day) AS d0 FROM d),
 k AS (SELECT user_id, day, row_number() OVER (PARTITION BY user_id ORDER BY day) AS k FROM a),
 s AS (SELECT day, count(*) AS survivors FROM k, d0 WHERE k = date_diff('day', d0, day) + 1 GROUP BY 1),
 p AS (SELECT day, user_id, count(*) AS n FROM d GROUP BY 1, 2),
 l AS (SELECT day, user_id AS leader FROM (SELECT *, row_number() OVER (PARTITION BY day ORDER BY n DESC, user_id) AS r FROM p) WHERE r = 1)
SELECT CAST(l.day AS VARCHAR) AS day, l.leader, coalesce(s.survivors, 0) AS survivors FROM l LEFT JOIN s USING (day)""")
def seq24(spark, sf):
    e = T(spark, sf, "events").select("user_id", F.to_date("ts").alias("day"))
    d = Q.survivors_and_leader(e, "user_id", "day", "user_id")
    return d.withColumn("day", date_str("day"))


@register("SEQ-25", "seq25_currently_inside", """
SELECT user_id FROM events GROUP BY 1
HAVING max(ts) FILTER (WHERE event_type = 'signup') IS NOT NULL
   AND (max(ts) FILTER (WHERE event_type = 'error') IS NULL
        OR max(ts) FILTER (WHERE event_type = 'signup') > max(ts) FILTER (WHERE event_type = 'error'))""")
def seq25(spark, sf):
    return Q.inside_now(T(spark, sf, "events"), "user_id", "ts", "event_type", "signup", "error")


@register("SEQ-26", "seq26_active_membership_at", """
WITH e AS (SELECT * FROM events WHERE ts <= TIMESTAMP '2024-01-20 00:00:00'),
 l AS (SELECT user_id, max(ts) AS s FROM e WHERE event_type = 'signup' GROUP BY 1),
 live AS (SELECT * FROM l WHERE s + INTERVAL 1 MONTH > TIMESTAMP '2024-01-20 00:00:00')
SELECT user_id FROM live WHERE NOT EXISTS (
  SELECT 1 FROM e WHERE e.user_id = live.user_id AND e.event_type = 'error' AND e.ts > live.s)""")
def seq26(spark, sf):
    return Q.active_at(T(spark, sf, "events"), "user_id", "ts", "event_type", "signup", "error", 1, "2024-01-20 00:00:00")


@register("SEQ-27", "seq27_recovery_days", """
WITH p AS (SELECT user_id, min(ts) AS p FROM events WHERE event_type = 'error' GROUP BY 1)
SELECT p.user_id, CAST(date_diff('day', CAST(p.p AS DATE), CAST(min(e.ts) AS DATE)) AS INTEGER) AS recovery_days
FROM p JOIN events e ON e.user_id = p.user_id AND e.event_type = 'purchase' AND e.ts > p.p GROUP BY p.user_id, p.p""")
def seq27(spark, sf):
    return Q.recovery_days(T(spark, sf, "events"), "user_id", "ts", "event_type", "error", "purchase")


@register("SEQ-28", "seq28_fill_down_global", """
SELECT event_id, last_value(nullif(event_type, 'view') IGNORE NULLS) OVER (ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS category
FROM events""")
def seq28(spark, sf):
    e = T(spark, sf, "events").select("event_id", F.nullif(F.col("event_type"), F.lit("view")).alias("category"))
    e = quantile_chunk(e, "event_id", out="_q")
    return Q.fill_down(e, "event_id", "category", chunk="_q").select("event_id", "category")


@register("SEQ-29", "seq29_expand_numbers", """
SELECT p_partkey, CAST(k AS INTEGER) AS k FROM part, range(1, p_size + 1) t(k)""")
def seq29(spark, sf):
    p = T(spark, sf, "part").select("p_partkey", "p_size")
    return Q.expand_numbers(p, "p_size").select("p_partkey", "k")


@register("SEQ-29", "seq29_expand_dates", """
WITH u AS (SELECT user_id, CAST(min(ts) AS DATE) AS a, CAST(max(ts) AS DATE) AS b FROM events GROUP BY 1)
SELECT user_id, CAST(CAST(d AS DATE) AS VARCHAR) AS day FROM u, generate_series(a, b, INTERVAL 1 DAY) t(d)""")
def seq29b(spark, sf):
    u = T(spark, sf, "events").groupBy("user_id").agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    return Q.expand_dates(u, "a", "b").select("user_id", date_str("day").alias("day"))


@register("SEQ-30", "seq30_prorate_by_year", """
WITH p AS (SELECT CAST(o.o_orderdate AS DATE) AS s, CAST(l.l_shipdate AS DATE) AS e, l.l_extendedprice AS amt
           FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey WHERE l.l_shipdate >= o.o_orderdate),
 y AS (SELECT p.*, yr FROM p, range(year(s), year(e) + 1) t(yr))
SELECT CAST(yr AS INTEGER) AS year, round(CAST(sum(amt * (date_diff('day', greatest(s, make_date(yr, 1, 1)), least(e, make_date(yr, 12, 31))) + 1)
       / (date_diff('day', s, e) + 1)) AS DECIMAL(38,9)), 2)::DOUBLE AS prorated FROM y GROUP BY 1""")
def seq30(spark, sf):
    li = T(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_shipdate", "l_extendedprice")
    o = T(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    p = li.join(o, "o_orderkey").filter(F.col("l_shipdate") >= F.col("o_orderdate"))
    d = Q.prorate_by_year(p, "o_orderdate", "l_shipdate", "l_extendedprice")
    return d.groupBy("year").agg(r2(F.sum("prorated")).alias("prorated"))


_HOLIDAYS = [f"{y}-01-01" for y in range(1994, 2003)] + [f"{y}-12-25" for y in range(1994, 2003)]


@register("SEQ-31", "seq31_business_days", f"""
WITH p AS (SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, CAST(o.o_orderdate AS DATE) AS a, CAST(l.l_shipdate AS DATE) AS b
           FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey WHERE l.l_shipdate >= o.o_orderdate),
 h AS (SELECT CAST(x AS DATE) AS h FROM (VALUES {", ".join(f"('{d}')" for d in _HOLIDAYS)}) v(x))
SELECT l_orderkey, l_linenumber, l_partkey,
  (SELECT count(*) FROM generate_series(a, b, INTERVAL 1 DAY) t(d) WHERE isodow(d) <= 5)
  - (SELECT count(*) FROM h WHERE h BETWEEN a AND b AND isodow(h) <= 5) AS business_days
FROM p""")
def seq31(spark, sf):
    li = T(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey", "l_shipdate")
    o = T(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    p = li.join(o, "o_orderkey").filter(F.col("l_shipdate") >= F.col("o_orderdate"))
    hol = spark.createDataFrame([(d,) for d in _HOLIDAYS], "holiday string")
    d = Q.business_days_between(p, "o_orderdate", "l_shipdate", hol)
    return d.select(F.col("o_orderkey").alias("l_orderkey"), "l_linenumber", "l_partkey", "business_days")


@register("SEQ-32", "seq32_first_missing_positive", """
WITH v AS (SELECT DISTINCT p_brand, p_size FROM part WHERE p_size > 0),
 c AS (SELECT p_brand, count(*) AS n FROM v GROUP BY 1),
 k AS (SELECT p_brand, CAST(k AS INTEGER) AS k FROM c, range(1, n + 2) t(k))
SELECT p_brand, CAST(min(k) AS BIGINT) AS first_missing FROM k WHERE NOT EXISTS (SELECT 1 FROM v WHERE v.p_brand = k.p_brand AND v.p_size = k.k)
GROUP BY 1""")
def seq32(spark, sf):
    return Q.first_missing(T(spark, sf, "part"), "p_brand", "p_size").withColumn("first_missing", F.col("first_missing").cast("bigint"))


@register("SEQ-33", "seq33_adjacent_pairing", """
WITH p AS (SELECT a.o_custkey AS seller, b.o_custkey AS buyer FROM orders a JOIN orders b ON b.o_orderkey = a.o_orderkey + 1
           WHERE a.o_orderkey % 2 = 1),
 both_ AS (SELECT seller AS u FROM p INTERSECT SELECT buyer FROM p)
SELECT seller, buyer FROM p WHERE seller NOT IN (SELECT u FROM both_) AND buyer NOT IN (SELECT u FROM both_)""")
def seq33(spark, sf):
    return Q.pair_adjacent(T(spark, sf, "orders"), "o_orderkey", "o_custkey")


@register("SEQ-34", "seq34_team_eligibility", """
SELECT c_nationkey, c_custkey, c_acctbal > 5000 AND c_mktsegment IN ('BUILDING', 'MACHINERY') AS member_ok,
  CAST(count_if(c_acctbal > 5000 AND c_mktsegment IN ('BUILDING', 'MACHINERY')) OVER (PARTITION BY c_nationkey) AS BIGINT) AS qualified_members,
  count_if(c_acctbal > 5000 AND c_mktsegment IN ('BUILDING', 'MACHINERY')) OVER (PARTITION BY c_nationkey) >= 2 AS team_qualifies
FROM customer""")
def seq34(spark, sf):
    c = T(spark, sf, "customer")
    return Q.team_eligibility(c, "c_nationkey", "c_custkey", F.col("c_acctbal") > 5000,
                              F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), 2)
