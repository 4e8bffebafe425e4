"""Registered queries for joins (JOIN-*)."""

from pyspark.sql import functions as F

from tessera.functions.scalars import round_half_up as r2
from tessera.operators import joins as J
from tessera.plans.registry import register
from tessera.session import load_table as T


@register("JOIN-01", "join01_three_way_inner", """
SELECT c.c_mktsegment, o.o_orderpriority, count(*) AS n_lines,
       round(CAST(sum(l.l_extendedprice) AS DECIMAL(38,9)), 2)::DOUBLE AS gross
FROM customer c JOIN orders o ON c.c_custkey = o.o_custkey JOIN lineitem l ON l.l_orderkey = o.o_orderkey
GROUP BY 1, 2""")
def join01(spark, sf):
    c = T(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    o = T(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    li = T(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_extendedprice")
    j = J.join_inner(J.join_inner(li, o, "o_orderkey"), c, "o_custkey")
    return j.groupBy("c_mktsegment", "o_orderpriority").agg(
        F.count(F.lit(1)).alias("n_lines"), r2(F.sum("l_extendedprice")).alias("gross"))


@register("JOIN-02", "join02_left_outer_counts", """
SELECT c.c_custkey, count(o.o_orderkey) AS n_orders, count(o.o_orderkey) = 0 AS no_orders
FROM customer c LEFT JOIN orders o ON c.c_custkey = o.o_custkey GROUP BY c.c_custkey""")
def join02(spark, sf):
    c = T(spark, sf, "customer").select("c_custkey")
    o = T(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey")
    return J.join_left(c, o, "c_custkey").groupBy("c_custkey").agg(
        F.count("o_orderkey").alias("n_orders"), (F.count("o_orderkey") == 0).alias("no_orders"))


@register("JOIN-03", "join03_right_outer", """
SELECT n.n_name, count(s.s_suppkey) AS n_suppliers
FROM supplier s RIGHT JOIN nation n ON s.s_nationkey = n.n_nationkey GROUP BY n.n_name""")
def join03(spark, sf):
    s = T(spark, sf, "supplier").select("s_suppkey", F.col("s_nationkey").alias("n_nationkey"))
    n = T(spark, sf, "nation").select("n_nationkey", "n_name")
    return J.join_right(s, n, "n_nationkey").groupBy("n_name").agg(F.count("s_suppkey").alias("n_suppliers"))


_SRC_PART = "(SELECT * FROM part WHERE p_size <= 45)"
_TGT_PART = ("(SELECT p_partkey, p_name, CASE WHEN p_brand = 'Brand#1' THEN p_retailprice + 1 ELSE p_retailprice END"
             " AS p_retailprice FROM part WHERE p_size >= 5)")


def _part_snapshots(spark, sf):
    p = T(spark, sf, "part")
    src = p.filter("p_size <= 45").select("p_partkey", "p_name", "p_retailprice")
    tgt = p.filter("p_size >= 5").select(
        "p_partkey", "p_name",
        F.when(F.col("p_brand") == "Brand#1", F.col("p_retailprice") + 1)
         .otherwise(F.col("p_retailprice")).alias("p_retailprice"))
    return src, tgt


@register("JOIN-04", "join04_full_outer_reconcile", f"""
SELECT coalesce(s.p_partkey, t.p_partkey) AS p_partkey,
       CASE WHEN t.p_partkey IS NULL THEN 'new_in_source' WHEN s.p_partkey IS NULL THEN 'new_in_target'
            ELSE 'mismatch' END AS comment
FROM {_SRC_PART} s FULL JOIN {_TGT_PART} t ON s.p_partkey = t.p_partkey
WHERE s.p_partkey IS NULL OR t.p_partkey IS NULL
   OR s.p_name IS DISTINCT FROM t.p_name OR s.p_retailprice IS DISTINCT FROM t.p_retailprice""")
def join04(spark, sf):
    src, tgt = _part_snapshots(spark, sf)
    return J.reconcile(src, tgt, "p_partkey", ["p_name", "p_retailprice"])


@register("JOIN-05", "join05_cross_small", """
SELECT n.n_name, r.r_name, n.n_regionkey = r.r_regionkey AS home_region FROM nation n CROSS JOIN region r""")
def join05(spark, sf):
    n = T(spark, sf, "nation").select("n_name", "n_regionkey")
    r = T(spark, sf, "region").select("r_name", "r_regionkey")
    return J.cross(n, r).select(
        "n_name", "r_name", (F.col("n_regionkey") == F.col("r_regionkey")).alias("home_region"))


@register("JOIN-06", "join06_self_join_hierarchy", """
SELECT e.c_custkey, e.c_name AS name_1, m.c_name AS name_2, g.c_name AS name_3
FROM customer e LEFT JOIN customer m ON m.c_custkey = e.c_custkey // 7
LEFT JOIN customer g ON g.c_custkey = m.c_custkey // 7""")
def join06(spark, sf):
    c = T(spark, sf, "customer").select("c_custkey", "c_name",
                                        F.expr("c_custkey div 7").alias("manager"))
    return J.hierarchy(c, "c_custkey", "manager", "c_name", levels=3)


@register("JOIN-07", "join07_semi_exists", """
SELECT c_custkey, c_name FROM customer c
WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderstatus = 'P')""")
def join07(spark, sf):
    c = T(spark, sf, "customer").select("c_custkey", "c_name")
    o = T(spark, sf, "orders").filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return J.semi(c, o, "c_custkey")


@register("JOIN-08", "join08_anti_not_exists", """
SELECT c_custkey FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderpriority = '1-URGENT')""")
def join08(spark, sf):
    c = T(spark, sf, "customer").select("c_custkey")
    o = T(spark, sf, "orders").filter("o_orderpriority = '1-URGENT'").select("o_custkey")
    return J.anti(c, o, "c_custkey", "o_custkey")


@register("JOIN-08", "join08_anti_not_in_with_null", """
SELECT s_suppkey FROM supplier
WHERE s_suppkey NOT IN (SELECT CASE WHEN s_acctbal < 0 THEN NULL ELSE s_suppkey END FROM supplier WHERE s_nationkey < 3)""")
def join08b(spark, sf):
    s = T(spark, sf, "supplier")
    lst = s.filter("s_nationkey < 3").select(
        F.when(F.col("s_acctbal") < 0, F.lit(None)).otherwise(F.col("s_suppkey")).alias("k"))
    return J.anti(s.select("s_suppkey"), lst, "s_suppkey", "k", null_aware=True)


@register("JOIN-08", "join08_anti_not_in_no_null", """
SELECT s_suppkey FROM supplier
WHERE s_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 0)""")
def join08c(spark, sf):
    s = T(spark, sf, "supplier")
    lst = s.filter("s_acctbal < 0").select(F.col("s_suppkey").alias("k"))
    return J.anti(s.select("s_suppkey"), lst, "s_suppkey", "k", null_aware=True)


@register("JOIN-09", "join09_tuple_in_not_in", """
SELECT l_orderkey, l_linenumber,
       (l_partkey, l_suppkey) IN (SELECT (l_partkey, l_suppkey) FROM lineitem WHERE l_returnflag = 'R') AS pair_returned
FROM lineitem""")
def join09(spark, sf):
    li = T(spark, sf, "lineitem")
    keys = ["l_partkey", "l_suppkey"]
    ret = li.filter("l_returnflag = 'R'").select(*keys).distinct()
    base = li.select("l_orderkey", "l_linenumber", *keys)
    yes = J.tuple_semi(base, ret, keys).withColumn("pair_returned", F.lit(True))
    no = J.tuple_anti(base, ret, keys).withColumn("pair_returned", F.lit(False))
    return yes.unionByName(no).drop(*keys)


@register("JOIN-10", "join10_theta_inequality", """
SELECT c.c_custkey, count(s.s_suppkey) AS n_poorer_suppliers
FROM customer c LEFT JOIN supplier s ON c.c_nationkey = s.s_nationkey AND s.s_acctbal < c.c_acctbal
GROUP BY c.c_custkey""")
def join10(spark, sf):
    c = T(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    s = T(spark, sf, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal")
    d = J.count_below(c, s.withColumnRenamed("s_nationkey", "c_nationkey"), "c_nationkey", "c_acctbal", "s_acctbal",
                      "n_poorer_suppliers")
    return d.select("c_custkey", "n_poorer_suppliers")


@register("JOIN-10", "join10_theta_small_side", """
SELECT r.r_name, n.n_name FROM region r JOIN nation n ON n.n_regionkey < r.r_regionkey""")
def join10b(spark, sf):
    r = T(spark, sf, "region")
    n = T(spark, sf, "nation").select("n_name", "n_regionkey")
    return J.theta(r, n, F.col("n_regionkey") < F.col("r_regionkey")).select("r_name", "n_name")


@register("JOIN-11", "join11_band_between", """
WITH bands AS (SELECT p_brand AS band, min(p_retailprice) AS lo, max(p_retailprice) AS hi FROM part GROUP BY p_brand)
SELECT p.p_partkey, count(*) AS n_bands FROM part p JOIN bands b ON p.p_retailprice BETWEEN b.lo AND b.hi
GROUP BY p.p_partkey""")
def join11(spark, sf):
    p = T(spark, sf, "part")
    bands = p.groupBy(F.col("p_brand").alias("band")).agg(F.min("p_retailprice").alias("lo"),
                                                          F.max("p_retailprice").alias("hi"))
    return J.band_join(p.select("p_partkey", "p_retailprice"), bands, "p_retailprice", "lo", "hi") \
            .groupBy("p_partkey").agg(F.count(F.lit(1)).alias("n_bands"))


@register("JOIN-12", "join12_interval_overlap_pairs", """
WITH iv AS (SELECT l_partkey, l_orderkey * 10 + l_linenumber AS id, l_shipdate AS s,
                   l_shipdate + to_days(CAST(l_quantity AS INTEGER)) AS e FROM lineitem)
SELECT a.l_partkey, least(a.id, b.id) AS id_1, greatest(a.id, b.id) AS id_2
FROM iv a JOIN iv b ON a.l_partkey = b.l_partkey AND a.id < b.id AND a.s < b.e AND b.s < a.e""")
def join12(spark, sf):
    li = T(spark, sf, "lineitem")
    iv = li.select("l_partkey", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
                   F.col("l_shipdate").alias("s"),
                   F.timestamp_add("DAY", F.col("l_quantity").cast("int"), F.col("l_shipdate")).alias("e"))
    return J.overlap_pairs(iv, "l_partkey", "id", "s", "e", bucket_days=16)


@register("JOIN-13", "join13_time_proximity", """
SELECT a.user_id, a.event_id AS view_id, b.event_id AS purchase_id
FROM events a JOIN events b ON a.user_id = b.user_id
 AND b.ts >= a.ts AND b.ts <= a.ts + INTERVAL 15 MINUTE
WHERE a.event_type = 'view' AND b.event_type = 'purchase'""")
def join13(spark, sf):
    e = T(spark, sf, "events")
    a = e.filter("event_type = 'view'").select("user_id", F.col("event_id").alias("view_id"), F.col("ts").alias("ts_a"))
    b = e.filter("event_type = 'purchase'").select("user_id", F.col("event_id").alias("purchase_id"),
                                                   F.col("ts").alias("ts_b"))
    return J.near_join(a, b, "user_id", "ts_a", "ts_b", before_s=0, after_s=900) \
            .select("user_id", "view_id", "purchase_id")


@register("JOIN-14", "join14_as_of_state", """
WITH p AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'),
     s AS (SELECT user_id, ts, event_id, value FROM events WHERE event_type = 'signup')
SELECT p.event_id, p.user_id, arg_max(s.value, (s.ts, s.event_id)) AS state_value
FROM p LEFT JOIN s ON p.user_id = s.user_id AND s.ts <= p.ts
GROUP BY p.event_id, p.user_id""")
def join14(spark, sf):
    e = T(spark, sf, "events")
    facts = e.filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    states = e.filter("event_type = 'signup'").select("user_id", F.col("ts").alias("eff_ts"),
                                                      F.col("event_id").alias("_tie"),
                                                      F.col("value").alias("state_value"))
    return J.as_of(facts, states, "user_id", "ts", "eff_ts", ["state_value"], tie="_tie", chunk_days=3) \
            .select("event_id", "user_id", "state_value")


@register("JOIN-15", "join15_pair_by_rank", """
WITH a AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k
           FROM events WHERE event_type = 'signup'),
     b AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k
           FROM events WHERE event_type = 'purchase')
SELECT a.user_id, a.k, a.event_id AS signup_id, b.event_id AS purchase_id FROM a JOIN b USING (user_id, k)""")
def join15(spark, sf):
    e = T(spark, sf, "events")
    a = e.filter("event_type = 'signup'").select("user_id", F.col("event_id").alias("signup_id"),
                                                 F.struct("ts", "event_id").alias("oa"))
    b = e.filter("event_type = 'purchase'").select("user_id", F.col("event_id").alias("purchase_id"),
                                                   F.struct("ts", "event_id").alias("ob"))
    return J.pair_by_rank(a, b, "user_id", "oa", "ob", F.to_date("oa.ts"), F.to_date("ob.ts")).select(
        "user_id", F.col("_k").cast("bigint").alias("k"), "signup_id", "purchase_id")


@register("JOIN-16", "join16_conditional_key_swap", """
WITH m AS (SELECT max(c_custkey) AS mx FROM customer)
SELECT c.c_custkey, coalesce(n.c_name, c.c_name) AS seat_name
FROM customer c CROSS JOIN m
LEFT JOIN customer n ON n.c_custkey = CASE WHEN c.c_custkey % 2 = 0 AND c.c_custkey < m.mx THEN c.c_custkey + 1
                                           WHEN c.c_custkey % 2 = 1 THEN c.c_custkey - 1 ELSE c.c_custkey END""")
def join16(spark, sf):
    from tessera.operators.common import attach_scalars
    c = T(spark, sf, "customer").select("c_custkey", "c_name")
    d = attach_scalars(c, c.agg(F.max("c_custkey").alias("mx")))
    key = (F.when((F.col("c_custkey") % 2 == 0) & (F.col("c_custkey") < F.col("mx")), F.col("c_custkey") + 1)
            .when(F.col("c_custkey") % 2 == 1, F.col("c_custkey") - 1).otherwise(F.col("c_custkey")))
    other = c.select(F.col("c_custkey").alias("n_key"), F.col("c_name").alias("n_name"))
    j = J.join_on_expr(d, other, key, "n_key", "left")
    return j.select("c_custkey", F.coalesce("n_name", "c_name").alias("seat_name"))


@register("JOIN-17", "join17_json_key_join", """
SELECT e.event_id, p.p_name FROM events e JOIN part p ON p.p_partkey = CAST(json_extract(e.props, '$.k') AS BIGINT)""")
def join17(spark, sf):
    e = T(spark, sf, "events").select("event_id", "props")
    p = T(spark, sf, "part").select("p_partkey", "p_name")
    return J.join_json(p, e, "p_partkey", "props", "$.k", "bigint").select("event_id", "p_name")


@register("JOIN-18", "join18_dimension_lookup", """
SELECT l.l_orderkey, l.l_linenumber, d.part_sk
FROM lineitem l LEFT JOIN (SELECT p_partkey, md5(CAST(p_partkey AS VARCHAR) || '|' || p_name) AS part_sk FROM part) d
ON l.l_partkey = d.p_partkey""")
def join18(spark, sf):
    li = T(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("p_partkey"))
    dim = T(spark, sf, "part").select("p_partkey", F.md5(F.concat_ws("|", F.col("p_partkey").cast("string"),
                                                                     "p_name")).alias("part_sk"))
    return J.lookup_dim(li, dim, "p_partkey", "part_sk").drop("p_partkey")


@register("JOIN-19", "join19_orphan_keys", """
SELECT o_orderkey, o_custkey FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""")
def join19(spark, sf):
    o = T(spark, sf, "orders").select("o_orderkey", "o_custkey")
    c = T(spark, sf, "customer").filter("c_acctbal > 0").select("c_custkey")
    return J.orphans(o, c, "o_custkey", "c_custkey")


@register("JOIN-20", "join20_salted_skew_join", """
SELECT c.c_mktsegment, count(*) AS n_events, round(sum(e.value), 2) AS value
FROM events e JOIN customer c ON e.user_id = c.c_custkey GROUP BY 1""")
def join20(spark, sf):
    e = T(spark, sf, "events").select(F.col("user_id").alias("c_custkey"), "value")
    c = T(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    j = J.salted_join(e, c, "c_custkey", buckets=8)
    return j.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n_events"), F.round(F.sum("value"), 2).alias("value"))


@register("JOIN-21", "join21_preaggregate_then_join", """
SELECT o.o_orderpriority, count(*) AS n_orders, round(sum(t.qty), 2) AS qty
FROM (SELECT l_orderkey, sum(l_quantity) AS qty FROM lineitem GROUP BY 1) t
JOIN orders o ON o.o_orderkey = t.l_orderkey GROUP BY 1""")
def join21(spark, sf):
    li = T(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_quantity")
    o = T(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    j = J.preagg_join(li, "o_orderkey", [F.sum("l_quantity").alias("qty")], o)
    return j.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n_orders"), F.round(F.sum("qty"), 2).alias("qty"))


@register("JOIN-22", "join22_broadcast_small_dim", """
SELECT n.n_name, count(*) AS n_orders FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey GROUP BY 1""")
def join22(spark, sf):
    o = T(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"))
    c = T(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    n = T(spark, sf, "nation").select("n_nationkey", "n_name")
    return J.broadcast_join(J.join_inner(o, c, "c_custkey"), n, "n_nationkey") \
            .groupBy("n_name").agg(F.count(F.lit(1)).alias("n_orders"))


@register("JOIN-25", "join25_two_sum_pair_counts", """
WITH c AS (SELECT p_size AS v, count(*) AS n FROM part GROUP BY 1)
SELECT a.v AS v_a, b.v AS v_b,
       CASE WHEN a.v = b.v THEN a.n * (a.n - 1) // 2 ELSE a.n * b.n END AS n_pairs
FROM c a JOIN c b ON a.v + b.v = 50 AND a.v <= b.v
WHERE CASE WHEN a.v = b.v THEN a.n * (a.n - 1) // 2 ELSE a.n * b.n END > 0""")
def join25(spark, sf):
    p = T(spark, sf, "part")
    return J.pair_counts_with_sum(p, "p_size", 50)


@register("JOIN-28", "join28_relational_division", """
SELECT o_custkey FROM orders GROUP BY o_custkey
HAVING count(DISTINCT o_orderstatus) = (SELECT count(DISTINCT o_orderstatus) FROM orders)""")
def join28(spark, sf):
    o = T(spark, sf, "orders").select("o_custkey", "o_orderstatus")
    need = o.select("o_orderstatus").distinct()
    return J.match_all(o, need, "o_custkey", "o_orderstatus")


@register("JOIN-29", "join29_decompose_rejoin", """
WITH base AS (SELECT DISTINCT l_orderkey, l_partkey, l_suppkey FROM lineitem),
 a AS (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem),
 b AS (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem),
 c AS (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem),
 back AS (SELECT a.l_orderkey, a.l_partkey, b.l_suppkey FROM a JOIN b USING (l_orderkey)
          JOIN c ON c.l_partkey = a.l_partkey AND c.l_suppkey = b.l_suppkey)
SELECT (SELECT count(*) FROM (SELECT * FROM base EXCEPT ALL SELECT * FROM back)) AS lost,
       (SELECT count(*) FROM (SELECT * FROM back EXCEPT ALL SELECT * FROM base)) AS spurious""")
def join29(spark, sf):
    li = T(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey")
    return J.rejoin_check(li, [["l_orderkey", "l_partkey"], ["l_orderkey", "l_suppkey"], ["l_partkey", "l_suppkey"]])
