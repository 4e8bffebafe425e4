"""Registered queries for sampling (SMP-*)."""

from pyspark.sql import functions as F

from tessera.operators import sampling as S
from tessera.plans.registry import register
from tessera.session import load_table as T

_H = "(CAST('0x' || substr(md5(CAST(event_id AS VARCHAR) || ':{seed}'), 1, 8) AS BIGINT) % 10000)"


@register("SMP-01", "smp01_bernoulli_rows")
def smp01(spark, sf):
    return S.sample_rows(T(spark, sf, "events"), 0.1, 42)


@register("SMP-02", "smp02_block_sample")
def smp02(spark, sf):
    return S.sample_blocks(T(spark, sf, "lineitem"), 0.5, 7)


@register("SMP-03", "smp03_repeatable_hash_sample", f"""
SELECT event_id, user_id FROM events WHERE {_H.format(seed=3)} < 1500""")
def smp03(spark, sf):
    return S.sample_stable(T(spark, sf, "events"), "event_id", 0.15, 3).select("event_id", "user_id")


@register("SMP-04", "smp04_stratified_sample", f"""
SELECT event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY {_H.format(seed=5)}, event_id) AS r,
  count(*) OVER (PARTITION BY event_type) AS n FROM events) WHERE r <= greatest(1, ceil(n * 0.05))""")
def smp04(spark, sf):
    return S.sample_stratified(T(spark, sf, "events"), "event_type", "event_id", 0.05, 5).select("event_id", "event_type")


@register("SMP-05", "smp05_kfold_by_position", """
SELECT event_id, CAST((row_number() OVER (ORDER BY ts, event_id) - 1) * 5 // count(*) OVER () AS INTEGER) AS fold FROM events""")
def smp05(spark, sf):
    e = T(spark, sf, "events").select("event_id", "ts", F.unix_micros(F.col("ts").cast("timestamp")).alias("_t"))
    return S.kfold(e, "_t", 5, tie="event_id").select("event_id", "fold")


@register("SMP-05", "smp05_per_user_holdout", """
SELECT event_id, rn BETWEEN 11 AND 20 AS is_test FROM (SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events)""")
def smp05b(spark, sf):
    return S.holdout(T(spark, sf, "events"), "user_id", ["ts", "event_id"], 11, 20, chunk=F.to_date("ts")) \
            .select("event_id", "is_test")
