"""Registered queries for layout reports (LAY-*)."""

from tessera.operators import layout as Y
from tessera.plans.registry import register
from tessera.session import load_table as T


@register("LAY-03", "lay03_cluster_key_advisor", """
SELECT 'l_returnflag' AS "column", count(*) AS distinct_values, round(max(n) / (SELECT count(*) FROM lineitem), 6) AS top_share
FROM (SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY 1)
UNION ALL SELECT 'l_suppkey', count(*), round(max(n) / (SELECT count(*) FROM lineitem), 6) FROM (SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY 1)
UNION ALL SELECT 'l_shipdate', count(*), round(max(n) / (SELECT count(*) FROM lineitem), 6) FROM (SELECT l_shipdate, count(*) AS n FROM lineitem GROUP BY 1)""")
def lay03(spark, sf):
    return Y.key_advisor(T(spark, sf, "lineitem"), ["l_returnflag", "l_suppkey", "l_shipdate"])


@register("LAY-04", "lay04_skew_report", """
WITH p AS (SELECT user_id, count(*) AS rows FROM events GROUP BY 1)
SELECT max(rows) AS max_rows, median(rows) AS median_rows, count(*) AS keys,
       (SELECT count(*) FROM p WHERE rows > (SELECT sum(rows) FROM p) * 0.008) AS hot_keys,
       max(rows) / median(rows) AS max_over_median FROM p""")
def lay04(spark, sf):
    return Y.skew_report(T(spark, sf, "events"), "user_id", 0.008)


@register("LAY-02", "lay02_layout_health")
def lay02(spark, sf):
    return Y.layout_report(spark, f"{sf}/lineitem.parquet", "l_shipdate")


@register("SRC-12", "src12_file_inventory")
def src12(spark, sf):
    return Y.inventory(spark, f"{sf}/lineitem.parquet")
