"""Registered queries for change capture (VER-*)."""

from pyspark.sql import functions as F

from tessera.operators import versions as V
from tessera.plans.registry import hash_sql, register
from tessera.session import load_table as T

OLD = "(SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderdate < TIMESTAMP '2001-01-01')"
NEW = ("(SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'O' THEN o_totalprice + 1 ELSE o_totalprice END"
       " AS o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '1995-06-01')")
HK = hash_sql("{0}.o_orderstatus", "{0}.o_totalprice")


def _snaps(spark, sf):
    o = T(spark, sf, "orders")
    old = o.filter(F.col("o_orderdate") < F.lit("2001-01-01").cast("timestamp_ntz")).select("o_orderkey", "o_orderstatus", "o_totalprice")
    new = o.filter(F.col("o_orderdate") >= F.lit("1995-06-01").cast("timestamp_ntz")).select(
        "o_orderkey", "o_orderstatus",
        F.when(F.col("o_orderstatus") == "O", F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")).alias("o_totalprice"))
    return old, new


_DIFF_SQL = f"""
WITH o AS {OLD}, n AS {NEW},
 j AS (SELECT coalesce(o.o_orderkey, n.o_orderkey) AS k, o.o_orderstatus AS os, o.o_totalprice AS op,
              n.o_orderstatus AS ns, n.o_totalprice AS np, o.o_orderkey IS NOT NULL AS in_o, n.o_orderkey IS NOT NULL AS in_n,
              o.o_orderkey IS NOT NULL AND n.o_orderkey IS NOT NULL AND {HK.format('o')} <> {HK.format('n')} AS upd
       FROM o FULL JOIN n ON o.o_orderkey = n.o_orderkey),
 c AS (SELECT k AS o_orderkey, os AS o_orderstatus, op AS o_totalprice, 'DELETE' AS _action, upd AS _is_update, k AS _row_id
       FROM j WHERE (in_o AND NOT in_n) OR upd
       UNION ALL
       SELECT k, ns, np, 'INSERT', upd, k FROM j WHERE (in_n AND NOT in_o) OR upd)"""


@register("VER-01", "ver01_snapshot_diff", _DIFF_SQL + " SELECT * FROM c")
def ver01(spark, sf):
    old, new = _snaps(spark, sf)
    return V.diff(old, new, "o_orderkey")


@register("VER-02", "ver02_append_only_feed", f"""
SELECT n.*, 'INSERT' AS _action FROM {NEW} n WHERE n.o_orderkey NOT IN (SELECT o_orderkey FROM {OLD})""")
def ver02(spark, sf):
    old, new = _snaps(spark, sf)
    return V.new_rows(old, new, "o_orderkey")


@register("VER-03", "ver03_before_after_pairs", f"""
SELECT o.o_orderkey, o.o_totalprice AS before_o_totalprice, n.o_totalprice AS after_o_totalprice
FROM {OLD} o JOIN {NEW} n USING (o_orderkey) WHERE {HK.format('o')} <> {HK.format('n')}""")
def ver03(spark, sf):
    old, new = _snaps(spark, sf)
    return V.before_after(V.diff(old, new, "o_orderkey"), "o_orderkey", ["o_totalprice"])


@register("VER-10", "ver10_apply_changes_equals_new", f"SELECT * FROM {NEW}")
def ver10(spark, sf):
    old, new = _snaps(spark, sf)
    return V.apply_changes(old, V.diff(old, new, "o_orderkey"), "o_orderkey")


@register("VER-11", "ver11_bootstrap_then_follow", _DIFF_SQL + f"""
SELECT _phase, _action, count(*) AS n FROM (
  SELECT 'snapshot' AS _phase, 'INSERT' AS _action FROM {OLD} UNION ALL SELECT 'feed', _action FROM c) GROUP BY 1, 2""")
def ver11(spark, sf):
    old, new = _snaps(spark, sf)
    b = V.bootstrap(old, V.diff(old, new, "o_orderkey"))
    return b.groupBy("_phase", "_action").agg(F.count(F.lit(1)).alias("n"))


@register("VER-12", "ver12_change_audit_rows", f"""
SELECT coalesce(o.o_orderkey, n.o_orderkey) AS o_orderkey,
  CASE WHEN o.o_orderkey IS NULL THEN 'INSERT' WHEN n.o_orderkey IS NULL THEN 'DELETE' ELSE 'UPDATE' END AS action
FROM {OLD} o FULL JOIN {NEW} n ON o.o_orderkey = n.o_orderkey
WHERE o.o_orderkey IS NULL OR n.o_orderkey IS NULL OR o.o_totalprice <> n.o_totalprice OR o.o_orderstatus <> n.o_orderstatus""")
def ver12(spark, sf):
    old, new = _snaps(spark, sf)
    return V.audit_rows(old, new, "o_orderkey", "2024-02-01 00:00:00").select("o_orderkey", "action")


@register("VER-13", "ver13_net_change_per_hour", _DIFF_SQL + """
SELECT c.o_orderstatus, strftime(date_trunc('hour', o.o_orderdate), '%Y-%m-%d %H:%M:%S.%f') AS hour,
       round(sum(CASE WHEN _action = 'INSERT' THEN c.o_totalprice ELSE -c.o_totalprice END), 2) AS net_qty
FROM c JOIN orders o ON o.o_orderkey = c.o_orderkey GROUP BY 1, 2""")
def ver13(spark, sf):
    old, new = _snaps(spark, sf)
    ch = V.diff(old, new, "o_orderkey").join(T(spark, sf, "orders").select("o_orderkey", "o_orderdate"), "o_orderkey")
    return V.net_change(ch, "o_orderstatus", "o_orderdate", "o_totalprice").withColumn("net_qty", F.round("net_qty", 2)) \
            .withColumn("hour", F.date_format(F.col("hour").cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss.SSSSSS"))


@register("VER-14", "ver14_soft_delete_current_view", f"SELECT * FROM {NEW}")
def ver14(spark, sf):
    old, new = _snaps(spark, sf)
    hist = V.sync_soft(None, V.diff(old.limit(0), old, "o_orderkey"), "o_orderkey", "2024-01-01 00:00:00")
    hist = V.sync_soft(hist, V.diff(old, new, "o_orderkey"), "o_orderkey", "2024-02-01 00:00:00")
    return V.current_view(hist, "o_orderkey")
