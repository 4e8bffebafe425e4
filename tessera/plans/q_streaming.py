"""Registered batch forms of the streaming transforms (STR-*): the same
functions the streaming queries run, checked on the whole table."""

from pyspark.sql import functions as F

from tessera.plans.registry import register
from tessera.session import load_table as T
from tessera.streaming import jobs as J


@register("STR-02", "str02_daily_summary_batch_form", """
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, round(sum(value), 2) AS revenue, count(*) AS events FROM events GROUP BY 1""")
def str02(spark, sf):
    d = J.daily_summary(T(spark, sf, "events"), "ts", "value")
    return d.select(F.to_date("day").alias("day"), F.round("revenue", 2).alias("revenue"), "events") \
            .withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@register("STR-03", "str03_alert_bands", """
SELECT event_id, CASE WHEN value >= 45 THEN 'critical' WHEN value >= 35 THEN 'warning' END AS alert
FROM events WHERE value >= 35""")
def str03(spark, sf):
    return J.alerts(T(spark, sf, "events"), "value", [(35, "warning"), (45, "critical")]).select("event_id", "alert")


@register("STR-07", "str07_sliding_windows", """
WITH s AS (SELECT event_type, time_bucket(INTERVAL 5 MINUTE, ts) AS b FROM events),
 w AS (SELECT event_type, b AS window_start FROM s UNION ALL SELECT event_type, b - INTERVAL 5 MINUTE FROM s)
SELECT strftime(window_start, '%Y-%m-%d %H:%M:%S.%f') AS window_start,
       strftime(window_start + INTERVAL 10 MINUTE, '%Y-%m-%d %H:%M:%S.%f') AS window_end, event_type, count(*) AS n
FROM w GROUP BY window_start, event_type""")
def str07(spark, sf):
    d = J.windowed(T(spark, sf, "events"), "ts", "10 minutes", "5 minutes", ["event_type"])
    return d.select(F.date_format(F.col("window_start").cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("window_start"),
                    F.date_format(F.col("window_end").cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("window_end"),
                    "event_type", "n")


@register("STR-08", "str08_session_windows", """
WITH f AS (SELECT user_id, ts, CASE WHEN lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w > INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS s
           FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
 g AS (SELECT *, sum(s) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS session_no FROM f)
SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS start, strftime(max(ts) + INTERVAL 30 MINUTE, '%Y-%m-%d %H:%M:%S.%f') AS "end",
       count(*) AS n_events FROM g GROUP BY user_id, session_no""")
def str08(spark, sf):
    d = J.sessions(T(spark, sf, "events"), "user_id", "ts", "30 minutes")
    return d.select("user_id", F.date_format(F.col("start").cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("start"),
                    F.date_format(F.col("end").cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("end"), "n_events")


@register("STR-10", "str10_enrich_with_dimension", """
SELECT e.event_id, c.c_mktsegment FROM events e LEFT JOIN customer c ON c.c_custkey = e.user_id""")
def str10(spark, sf):
    c = T(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"), "c_mktsegment")
    return J.enrich(T(spark, sf, "events").select("event_id", "user_id"), c, "user_id").select("event_id", "c_mktsegment")


@register("STR-13", "str13_recover_from_last_success", """
SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-25 00:00:00' AND NOT (event_type = 'view' AND value > 25)""")
def str13(spark, sf):
    e = T(spark, sf, "events")
    done = e.filter((F.col("event_type") == "view") & (F.col("value") > 25)).select("event_id")
    return J.recover(e, done, "event_id", "ts", "2024-01-25 00:00:00").select("event_id")


@register("STR-14", "str14_consumer_lag_report", """
WITH p AS (SELECT event_type AS consumer, max(event_id) AS committed, max(ts) AS last_success FROM events WHERE value < 45 GROUP BY 1),
 h AS (SELECT max(event_id) AS head, max(ts) AS now FROM events)
SELECT consumer, committed, head - committed AS behind, round((epoch_us(now) - epoch_us(last_success)) / 1e6, 3) AS age_s,
       head - committed > 5 AS lagging FROM p, h""")
def str14(spark, sf):
    e = T(spark, sf, "events")
    prog = e.filter("value < 45").select(F.col("event_type").alias("consumer"), F.col("event_id").alias("v"), "ts")
    r = J.lag_report(e.select(F.col("event_id").alias("v"), "ts"), prog, "consumer", "v", "ts", 5)
    return r.select("consumer", "committed", "behind", F.round("age_s", 3).alias("age_s"), "lagging")
