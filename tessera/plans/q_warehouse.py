"""Registered queries for warehouse modelling (DWH-*) and upsert (LOAD-09)."""

from pyspark.sql import functions as F

from tessera.functions.scalars import date_str, round_half_up as r2, ts_str
from tessera.operators import warehouse as D
from tessera.plans.registry import hash_sql, register
from tessera.session import load_table as T
from tessera.sources.loads import upsert

DIM = "(SELECT c_custkey, c_mktsegment, c_nationkey FROM customer WHERE c_acctbal > 0)"
DELTA = ("(SELECT c_custkey, c_mktsegment, CASE WHEN c_acctbal > 5000 THEN (c_nationkey + 1) % 25 ELSE c_nationkey END"
         " AS c_nationkey FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY'))")
HK = hash_sql("{0}", "{1}")


def _dim_delta(spark, sf):
    c = T(spark, sf, "customer")
    dim = c.filter("c_acctbal > 0").select("c_custkey", "c_mktsegment", "c_nationkey")
    delta = c.filter(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")).select(
        "c_custkey", "c_mktsegment",
        F.when(F.col("c_acctbal") > 5000, (F.col("c_nationkey") + 1) % 25).otherwise(F.col("c_nationkey")).alias("c_nationkey"))
    return dim, delta


def _scd2(spark, sf):
    dim, delta = _dim_delta(spark, sf)
    v1 = D.scd2_init(dim, "c_custkey", ["c_mktsegment", "c_nationkey"], "2024-01-01")
    return D.scd2(v1, delta, "c_custkey", ["c_mktsegment", "c_nationkey"], "2024-02-01")


_SCD2_SQL = f"""
WITH d AS {DIM}, x AS {DELTA},
 ch AS (SELECT x.c_custkey FROM x JOIN d USING (c_custkey)
        WHERE {HK.format('x.c_mktsegment', 'x.c_nationkey')} <> {HK.format('d.c_mktsegment', 'd.c_nationkey')}),
 nw AS (SELECT c_custkey FROM x WHERE c_custkey NOT IN (SELECT c_custkey FROM d)),
 v AS (
  SELECT c_custkey, c_mktsegment, c_nationkey, DATE '2024-01-01' AS valid_from,
         CASE WHEN c_custkey IN (SELECT c_custkey FROM ch) THEN DATE '2024-01-31' END AS valid_to,
         c_custkey NOT IN (SELECT c_custkey FROM ch) AS is_current FROM d
  UNION ALL
  SELECT c_custkey, c_mktsegment, c_nationkey, DATE '2024-02-01', NULL, true FROM x
  WHERE c_custkey IN (SELECT c_custkey FROM ch) OR c_custkey IN (SELECT c_custkey FROM nw))"""


def _scd2_out(v):
    return v.select("c_custkey", "c_mktsegment", "c_nationkey", date_str("valid_from").alias("valid_from"),
                    date_str("valid_to").alias("valid_to"), "is_current", "sk")


@register("DWH-01", "dwh01_date_dimension", """
WITH r AS (SELECT CAST(min(o_orderdate) AS DATE) AS a, CAST(max(o_orderdate) AS DATE) AS b FROM orders),
 d AS (SELECT CAST(x AS DATE) AS date FROM r, generate_series(a, b, INTERVAL 1 DAY) t(x))
SELECT CAST(strftime(date, '%Y%m%d') AS INTEGER) AS date_key, CAST(year(date) AS INTEGER) AS year,
       CAST(quarter(date) AS INTEGER) AS quarter, monthname(date) AS month_name, dayname(date) AS day_name,
       isodow(date) >= 6 AS is_weekend, CAST(year(date) + CASE WHEN month(date) >= 4 THEN 1 ELSE 0 END AS INTEGER) AS fiscal_year,
       CAST(CAST(date_trunc('month', date) AS DATE) AS VARCHAR) AS month_start, CAST(last_day(date) AS VARCHAR) AS month_end,
       (month(date) = 1 AND day(date) = 1) OR (month(date) = 12 AND day(date) = 25) AS is_holiday
FROM d""")
def dwh01(spark, sf):
    o = T(spark, sf, "orders")
    hol = o.select(F.year("o_orderdate").alias("y")).distinct().select(
        F.explode(F.array(F.make_date("y", F.lit(1), F.lit(1)), F.make_date("y", F.lit(12), F.lit(25)))).alias("holiday"))
    d = D.date_dim(o, "o_orderdate", fiscal_start_month=4, holidays=hol)
    return d.select("date_key", "year", "quarter", "month_name", "day_name", "is_weekend", "fiscal_year",
                    date_str("month_start").alias("month_start"), date_str("month_end").alias("month_end"), "is_holiday")


@register("DWH-02", "dwh02_time_of_day", """
SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour, CAST(minute(ts) AS INTEGER) AS minute,
  CASE WHEN hour(ts) BETWEEN 5 AND 11 THEN 'morning' WHEN hour(ts) BETWEEN 12 AND 16 THEN 'afternoon'
       WHEN hour(ts) BETWEEN 17 AND 20 THEN 'evening' ELSE 'night' END AS part_of_day,
  CASE WHEN month(ts) IN (12, 1, 2) THEN 'winter' WHEN month(ts) IN (3, 4, 5) THEN 'spring'
       WHEN month(ts) IN (6, 7, 8) THEN 'summer' ELSE 'autumn' END AS season
FROM events""")
def dwh02(spark, sf):
    return D.time_attrs(T(spark, sf, "events").select("event_id", "ts"), "ts").drop("ts")


@register("DWH-03", "dwh03_surrogate_hash", f"""
SELECT c_custkey, {hash_sql('c_custkey')} AS sk FROM customer""")
def dwh03(spark, sf):
    return D.surrogate_key(T(spark, sf, "customer").select("c_custkey"), ["c_custkey"])


@register("DWH-03", "dwh03_surrogate_dense", """
SELECT p_brand, p_type, row_number() OVER (ORDER BY p_brand, p_type) + 100 AS sk FROM (SELECT DISTINCT p_brand, p_type FROM part)""")
def dwh03b(spark, sf):
    p = T(spark, sf, "part").select("p_brand", "p_type").distinct()
    return D.surrogate_key(p, ["p_brand", "p_type"], mode="dense", start=101)


@register("DWH-04", "dwh04_scd0", f"""
SELECT * FROM {DIM} UNION ALL SELECT * FROM {DELTA} x WHERE x.c_custkey NOT IN (SELECT c_custkey FROM {DIM})""")
def dwh04(spark, sf):
    dim, delta = _dim_delta(spark, sf)
    return D.scd0(dim, delta, "c_custkey")


@register("DWH-05", "dwh05_scd1_overwrite", f"""
SELECT coalesce(x.c_custkey, d.c_custkey) AS c_custkey,
  CASE WHEN x.c_custkey IS NOT NULL THEN x.c_mktsegment ELSE d.c_mktsegment END AS c_mktsegment,
  CASE WHEN x.c_custkey IS NOT NULL THEN x.c_nationkey ELSE d.c_nationkey END AS c_nationkey
FROM {DIM} d FULL JOIN {DELTA} x ON d.c_custkey = x.c_custkey""")
def dwh05(spark, sf):
    dim, delta = _dim_delta(spark, sf)
    return D.scd1(dim, delta, "c_custkey")


@register("DWH-06", "dwh06_scd2_history", _SCD2_SQL + f"""
SELECT c_custkey, c_mktsegment, c_nationkey, CAST(valid_from AS VARCHAR) AS valid_from, CAST(valid_to AS VARCHAR) AS valid_to,
       is_current, {HK.format('c_custkey', 'valid_from')} AS sk FROM v""")
def dwh06(spark, sf):
    return _scd2_out(_scd2(spark, sf))


@register("DWH-07", "dwh07_scd3_previous_column", f"""
SELECT coalesce(d.c_custkey, x.c_custkey) AS c_custkey, coalesce(x.c_nationkey, d.c_nationkey) AS c_nationkey,
  CAST(CASE WHEN d.c_nationkey IS NOT NULL AND x.c_nationkey IS NOT NULL AND d.c_nationkey <> x.c_nationkey THEN d.c_nationkey END AS DOUBLE) AS prev_c_nationkey
FROM {DIM} d FULL JOIN {DELTA} x ON d.c_custkey = x.c_custkey""")
def dwh07(spark, sf):
    dim, delta = _dim_delta(spark, sf)
    d = D.scd3(dim.select("c_custkey", "c_nationkey"), delta, "c_custkey", "c_nationkey")
    return d.withColumn("prev_c_nationkey", F.col("prev_c_nationkey").cast("double"))


@register("DWH-08", "dwh08_scd4_history_table", f"""
SELECT d.c_custkey, d.c_mktsegment, d.c_nationkey, '2024-02-01' AS changed_on
FROM {DIM} d JOIN {DELTA} x ON d.c_custkey = x.c_custkey
WHERE {HK.format('x.c_mktsegment', 'x.c_nationkey')} <> {HK.format('d.c_mktsegment', 'd.c_nationkey')}""")
def dwh08(spark, sf):
    dim, delta = _dim_delta(spark, sf)
    _, hist = D.scd4(dim, None, delta, "c_custkey", ["c_mktsegment", "c_nationkey"], "2024-02-01")
    return hist.withColumn("changed_on", date_str("changed_on"))


@register("DWH-09", "dwh09_scd6_hybrid", _SCD2_SQL + f"""
SELECT v.c_custkey, v.c_mktsegment, v.c_nationkey, CAST(v.valid_from AS VARCHAR) AS valid_from,
       CAST(v.valid_to AS VARCHAR) AS valid_to, v.is_current, {HK.format('v.c_custkey', 'v.valid_from')} AS sk,
       c.c_mktsegment AS current_c_mktsegment, c.c_nationkey AS current_c_nationkey
FROM v JOIN (SELECT * FROM v WHERE is_current) c ON c.c_custkey = v.c_custkey""")
def dwh09(spark, sf):
    dim, delta = _dim_delta(spark, sf)
    v1 = D.scd2_init(dim, "c_custkey", ["c_mktsegment", "c_nationkey"], "2024-01-01")
    v = D.scd6(v1, delta, "c_custkey", ["c_mktsegment", "c_nationkey"], "2024-02-01")
    return _scd2_out(v).join(v.select("c_custkey", "sk", "current_c_mktsegment", "current_c_nationkey"), ["c_custkey", "sk"])


@register("DWH-10", "dwh10_point_in_time_lookup", _SCD2_SQL + """
SELECT c_custkey, c_nationkey FROM v WHERE valid_from <= DATE '2024-01-31' AND (valid_to IS NULL OR valid_to >= DATE '2024-01-31')""")
def dwh10(spark, sf):
    return D.dim_at(_scd2(spark, sf), "2024-01-31").select("c_custkey", "c_nationkey")


@register("DWH-11", "dwh11_star_query", """
SELECT p.p_brand, n.n_name, CAST(year(o.o_orderdate) AS INTEGER) AS year,
       round(CAST(sum(l.l_extendedprice * (1 - l.l_discount)) AS DECIMAL(38,9)), 2)::DOUBLE AS revenue
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY 1, 2, 3""")
def dwh11(spark, sf):
    li = T(spark, sf, "lineitem").select(F.col("l_partkey").alias("p_partkey"), F.col("l_suppkey").alias("s_suppkey"),
                                         F.col("l_orderkey").alias("o_orderkey"),
                                         (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("rev"))
    p = T(spark, sf, "part").select("p_partkey", "p_brand")
    s = T(spark, sf, "supplier").select("s_suppkey", F.col("s_nationkey").alias("n_nationkey"))
    n = T(spark, sf, "nation").select("n_nationkey", "n_name")
    o = T(spark, sf, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"))
    return D.star_query(li, [(p, "p_partkey"), (s, "s_suppkey"), (n, "n_nationkey"), (o, "o_orderkey")],
                        ["p_brand", "n_name", "year"], [r2(F.sum("rev")).alias("revenue")])


@register("DWH-12", "dwh12_denormalise_hierarchy", """
SELECT c.c_custkey, n.n_name, r.r_name FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""")
def dwh12(spark, sf):
    c = T(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    n = T(spark, sf, "nation").select("n_nationkey", "n_name", F.col("n_regionkey").alias("r_regionkey"))
    r = T(spark, sf, "region")
    return D.denormalise([(c, None), (n, "n_nationkey"), (r, "r_regionkey")]).select("c_custkey", "n_name", "r_name")


@register("DWH-12", "dwh12_normalise_levels", """
WITH f AS (SELECT c.c_custkey, n.n_nationkey, n.n_name, r.r_regionkey, r.r_name FROM customer c
           JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey)
SELECT 'nation' AS level, count(*) AS n FROM (SELECT DISTINCT n_nationkey, n_name, r_regionkey FROM f)
UNION ALL SELECT 'region', count(*) FROM (SELECT DISTINCT r_regionkey, r_name FROM f)""")
def dwh12b(spark, sf):
    flat = dwh12(spark, sf)
    c = T(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    n = T(spark, sf, "nation").select("n_nationkey", "n_name", F.col("n_regionkey").alias("r_regionkey"))
    r = T(spark, sf, "region")
    flat = c.join(n, "n_nationkey").join(r, "r_regionkey")
    nat, reg = D.normalise(flat, [["n_nationkey", "n_name", "r_regionkey"], ["r_regionkey", "r_name"]])
    return (nat.agg(F.count(F.lit(1)).alias("n")).withColumn("level", F.lit("nation"))
               .unionByName(reg.agg(F.count(F.lit(1)).alias("n")).withColumn("level", F.lit("region"))))


@register("DWH-13", "dwh13_role_playing_dates", """
SELECT CAST(quarter(o.o_orderdate) AS INTEGER) AS order_quarter, CAST(quarter(l.l_shipdate) AS INTEGER) AS ship_quarter, count(*) AS n
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY 1, 2""")
def dwh13(spark, sf):
    li = T(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.to_date("l_shipdate").alias("ship_d"))
    o = T(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("order_d"))
    f = li.join(o, "o_orderkey")
    cal = D.date_dim(T(spark, sf, "lineitem").select(F.col("l_shipdate").alias("d")).unionByName(
        T(spark, sf, "orders").select(F.col("o_orderdate").alias("d"))), "d")
    r = D.role_join(f, cal, "date", {"order": "order_d", "ship": "ship_d"}, ["quarter"])
    return r.groupBy("order_quarter", "ship_quarter").agg(F.count(F.lit(1)).alias("n"))


@register("DWH-14", "dwh14_junk_dimension", f"""
SELECT DISTINCT l_returnflag, l_linestatus, {hash_sql('l_returnflag', 'l_linestatus')} AS junk_key
FROM lineitem""")
def dwh14(spark, sf):
    _, dim = D.junk_dim(T(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"])
    return dim


@register("DWH-15", "dwh15_degenerate_dimension", """
SELECT l_orderkey AS txn_no, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM lineitem""")
def dwh15(spark, sf):
    return D.degenerate(T(spark, sf, "lineitem"), "l_orderkey", ["l_partkey", "l_suppkey"], ["l_quantity", "l_extendedprice"])


_BAND = "CASE WHEN c_acctbal < 0 THEN 'negative' WHEN c_acctbal < 5000 THEN 'low' ELSE 'high' END"


@register("DWH-16", "dwh16_mini_dimension", f"""
SELECT DISTINCT {_BAND} AS bal_band, c_mktsegment AS segment, {hash_sql(_BAND, 'c_mktsegment')} AS mini_key
FROM customer""")
def dwh16(spark, sf):
    c = T(spark, sf, "customer")
    band = F.when(F.col("c_acctbal") < 0, "negative").when(F.col("c_acctbal") < 5000, "low").otherwise("high")
    _, mini = D.mini_dim(c, "c_custkey", {"bal_band": band, "segment": F.col("c_mktsegment")})
    return mini


@register("DWH-17", "dwh17_conformed_check", """
WITH a AS (SELECT c_custkey, c_nationkey FROM customer),
 b AS (SELECT DISTINCT c.c_custkey, c.c_nationkey FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey)
SELECT (SELECT count(*) FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)) AS only_in_a,
       (SELECT count(*) FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)) AS only_in_b""")
def dwh17(spark, sf):
    c = T(spark, sf, "customer").select("c_custkey", "c_nationkey")
    o = T(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"))
    b = o.join(c, "c_custkey").distinct()
    return D.conformed_check(c, b, ["c_custkey", "c_nationkey"])


@register("DWH-18", "dwh18_transaction_fact", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS ship_day,
       l_quantity, round(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(38,9)), 2)::DOUBLE AS net FROM lineitem""")
def dwh18(spark, sf):
    li = T(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", date_str("l_shipdate").alias("ship_day"),
                     "l_quantity", r2(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net"))


@register("DWH-19", "dwh19_periodic_snapshot", """
WITH d AS (SELECT user_id, CAST(ts AS DATE) AS day, sum(value) AS v FROM events GROUP BY 1, 2),
 cal AS (SELECT CAST(x AS DATE) AS day FROM (SELECT min(day) a, max(day) b FROM d), generate_series(a, b, INTERVAL 1 DAY) t(x)),
 g AS (SELECT u.user_id, cal.day FROM (SELECT DISTINCT user_id FROM d) u, cal)
SELECT g.user_id, CAST(g.day AS VARCHAR) AS day,
       round(sum(coalesce(d.v, 0)) OVER (PARTITION BY g.user_id ORDER BY g.day ROWS UNBOUNDED PRECEDING), 2) AS balance
FROM g LEFT JOIN d USING (user_id, day)""")
def dwh19(spark, sf):
    s = D.snapshot_fact(T(spark, sf, "events"), "user_id", "ts", "value")
    return s.select("user_id", date_str("day").alias("day"), F.round("balance", 2).alias("balance"))


@register("DWH-20", "dwh20_accumulating_snapshot", """
SELECT user_id, strftime(min(ts) FILTER (WHERE event_type = 'signup'), '%Y-%m-%d %H:%M:%S.%f') AS signup_at,
  strftime(min(ts) FILTER (WHERE event_type = 'view'), '%Y-%m-%d %H:%M:%S.%f') AS view_at,
  strftime(min(ts) FILTER (WHERE event_type = 'purchase'), '%Y-%m-%d %H:%M:%S.%f') AS purchase_at,
  round((epoch_us(min(ts) FILTER (WHERE event_type = 'view')) - epoch_us(min(ts) FILTER (WHERE event_type = 'signup'))) / 1e6, 3) AS signup_to_view_s,
  round((epoch_us(min(ts) FILTER (WHERE event_type = 'purchase')) - epoch_us(min(ts) FILTER (WHERE event_type = 'view'))) / 1e6, 3) AS view_to_purchase_s
FROM events GROUP BY 1""")
def dwh20(spark, sf):
    e = T(spark, sf, "events").withColumn("ts", F.col("ts"))
    d = D.accumulating_fact(e, "user_id", "ts", "event_type", ["signup", "view", "purchase"])
    for c in ("signup_at", "view_at", "purchase_at"):
        d = d.withColumn(c, ts_str(c))
    return d.withColumn("signup_to_view_s", F.round("signup_to_view_s", 3)) \
            .withColumn("view_to_purchase_s", F.round("view_to_purchase_s", 3))


@register("DWH-21", "dwh21_what_did_not_happen", """
SELECT u.user_id, t.event_type FROM (SELECT DISTINCT user_id FROM events) u, (SELECT DISTINCT event_type FROM events) t
WHERE NOT EXISTS (SELECT 1 FROM events e WHERE e.user_id = u.user_id AND e.event_type = t.event_type AND e.value > 48)""")
def dwh21(spark, sf):
    from tessera.operators.joins import cross
    e = T(spark, sf, "events")
    grid = cross(e.select("user_id").distinct(), e.select("event_type").distinct())
    fact = D.factless(e.filter("value > 48"), ["user_id", "event_type"])
    return D.not_happened(grid, fact, ["user_id", "event_type"])


@register("DWH-22", "dwh22_derived_ratios", """
SELECT l_returnflag, round(sum(l_extendedprice * (1 - l_discount)) / sum(l_extendedprice), 6) AS net_ratio,
       round(sum(l_discount) / count(*), 6) AS avg_discount, round(sum(l_tax) / nullif(sum(0.0), 0), 6) AS never
FROM lineitem GROUP BY 1""")
def dwh22(spark, sf):
    li = T(spark, sf, "lineitem")
    r = D.ratios(li, "l_returnflag", {
        "net_ratio": (F.col("l_extendedprice") * (1 - F.col("l_discount")), F.col("l_extendedprice")),
        "avg_discount": (F.col("l_discount"), F.lit(1.0)),
        "never": (F.col("l_tax"), F.lit(0.0))})
    return r.select("l_returnflag", *[F.round(c, 6).alias(c) for c in ("net_ratio", "avg_discount", "never")])


@register("DWH-23", "dwh23_incremental_summary_refresh", """
SELECT strftime(l_shipdate, '%Y-%m') AS month, count(*) AS n, round(sum(l_quantity), 2) AS qty FROM lineitem GROUP BY 1""")
def dwh23(spark, sf):
    li = T(spark, sf, "lineitem").withColumn("month", F.date_format("l_shipdate", "yyyy-MM"))
    aggs = [F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("qty")]
    stored = li.filter("l_returnflag <> 'R'").groupBy("month").agg(*aggs)  # summary before the new rows
    changed = li.filter("l_returnflag = 'R'")  # rows that arrived since
    return D.refresh_summary(stored, li, changed, ["month"], aggs)


@register("DWH-24", "dwh24_harmonise_formats", """
SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_date FROM orders""")
def dwh24(spark, sf):
    o = T(spark, sf, "orders")
    fmt = F.col("o_orderkey") % 3
    raw = o.select("o_orderkey", F.when(fmt == 0, F.date_format("o_orderdate", "yyyy-MM-dd"))
                   .when(fmt == 1, F.date_format("o_orderdate", "dd/MM/yyyy"))
                   .otherwise(F.date_format("o_orderdate", "yyyyMMdd")).alias("raw"))
    h = D.harmonise(raw, "raw", ["yyyy-MM-dd", "dd/MM/yyyy", "yyyyMMdd"], "order_date")
    return h.select("o_orderkey", date_str("order_date").alias("order_date"))


@register("DWH-25", "dwh25_drop_with_log", """
SELECT c_custkey, c_nationkey, c_mktsegment FROM customer WHERE c_acctbal >= 0 AND c_mktsegment <> 'AUTOMOBILE'""")
def dwh25(spark, sf):
    c = T(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment", "c_acctbal")
    kept, _ = D.drop_with_log(c, "c_custkey", ["c_name", "c_acctbal"],
                              {"negative_balance": F.col("c_acctbal") >= 0,
                               "excluded_segment": F.col("c_mktsegment") != "AUTOMOBILE"})
    return kept


@register("DWH-25", "dwh25_drop_log_rows", """
SELECT c_custkey, concat_ws(',', CASE WHEN c_acctbal < 0 THEN 'negative_balance' END,
                            CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 'excluded_segment' END) AS reasons
FROM customer WHERE c_acctbal < 0 OR c_mktsegment = 'AUTOMOBILE'""")
def dwh25b(spark, sf):
    c = T(spark, sf, "customer")
    _, log = D.drop_with_log(c, "c_custkey", ["c_name"],
                             {"negative_balance": F.col("c_acctbal") >= 0,
                              "excluded_segment": F.col("c_mktsegment") != "AUTOMOBILE"})
    return log


@register("DWH-26", "dwh26_layered_staging_clean_mart", """
SELECT l_returnflag, count(*) AS n, round(sum(l_quantity), 2) AS qty FROM lineitem
WHERE l_quantity > 0 AND l_discount BETWEEN 0 AND 0.1 GROUP BY 1""")
def dwh26(spark, sf):
    raw = T(spark, sf, "lineitem")
    steps = [lambda d: d.select("l_returnflag", "l_quantity", "l_discount"),
             lambda d: d.filter((F.col("l_quantity") > 0) & F.col("l_discount").between(0, 0.1)),
             lambda d: d.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("qty"))]
    return D.run_layers(raw, steps)


@register("DWH-27", "dwh27_mart_slice", """
SELECT c_custkey, sha256(c_name) AS c_name, c_acctbal FROM customer WHERE c_mktsegment = 'BUILDING'""")
def dwh27(spark, sf):
    return D.mart_slice(T(spark, sf, "customer"), ["c_custkey", "c_name", "c_acctbal"],
                        F.col("c_mktsegment") == "BUILDING", masked=["c_name"])


@register("DWH-28", "dwh28_functional_dependency", """
SELECT l_orderkey, count(DISTINCT l_shipdate) AS n_values FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_shipdate) > 1""")
def dwh28(spark, sf):
    return D.fd_audit(T(spark, sf, "lineitem"), ["l_orderkey"], "l_shipdate")


@register("DWH-28", "dwh28_multivalued_dependency", """
SELECT l_orderkey, count(*) AS pairs, count(DISTINCT l_partkey) AS n_a, count(DISTINCT l_suppkey) AS n_b,
       count(*) = count(DISTINCT l_partkey) * count(DISTINCT l_suppkey) AS independent
FROM (SELECT DISTINCT l_orderkey, l_partkey, l_suppkey FROM lineitem) GROUP BY 1""")
def dwh28b(spark, sf):
    return D.mvd_audit(T(spark, sf, "lineitem"), "l_orderkey", "l_partkey", "l_suppkey")


@register("DWH-29", "dwh29_primary_key_audit", """
SELECT count(*) AS rows, count(DISTINCT (l_orderkey, l_linenumber)) AS distinct_keys,
       CAST(count_if(l_orderkey IS NULL OR l_linenumber IS NULL) AS BIGINT) AS null_keys,
       count(*) = count(DISTINCT (l_orderkey, l_linenumber)) AND count_if(l_orderkey IS NULL OR l_linenumber IS NULL) = 0 AS is_key
FROM lineitem""")
def dwh29(spark, sf):
    return D.key_audit(T(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("LOAD-09", "load09_upsert_with_delete", f"""
WITH x AS (SELECT *, c_nationkey = 0 AS del FROM {DELTA})
SELECT coalesce(x.c_custkey, d.c_custkey) AS c_custkey,
  CASE WHEN x.c_custkey IS NOT NULL THEN x.c_mktsegment ELSE d.c_mktsegment END AS c_mktsegment,
  CASE WHEN x.c_custkey IS NOT NULL THEN x.c_nationkey ELSE d.c_nationkey END AS c_nationkey
FROM {DIM} d FULL JOIN x ON d.c_custkey = x.c_custkey WHERE NOT coalesce(x.del, false)""")
def load09(spark, sf):
    dim, delta = _dim_delta(spark, sf)
    return upsert(dim, delta.withColumn("del", F.col("c_nationkey") == 0), ["c_custkey"], delete_flag="del")
