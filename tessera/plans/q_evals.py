"""Registered queries for evaluation jobs (EVL-*)."""

from pyspark.sql import functions as F

from tessera.operators import evals as E
from tessera.plans.registry import register
from tessera.session import load_table as T

_W = "list_distinct(list_filter(regexp_split_to_array(lower({}), '[^\\p{{L}}\\p{{N}}_]+'), lambda w: w <> ''))"


def _answers(spark, sf):
    """Model answers (assistant turns) paired with expected benchmark text by id."""
    c = T(spark, sf, "conversations").filter("role = 'assistant'").select("conv_id", "turn", F.col("text").alias("got"))
    b = T(spark, sf, "benchmark").select(F.col("item_id").alias("conv_id"), F.col("text").alias("want"))
    return c.join(b, "conv_id")


@register("EVL-01", "evl01_exact_match", """
SELECT c.conv_id, c.turn, CAST(lower(trim(c.text)) = lower(trim(b.text)) AS INTEGER) AS score,
       CASE WHEN lower(trim(c.text)) = lower(trim(b.text)) THEN 'exact match' ELSE 'differs' END AS reason
FROM conversations c JOIN benchmark b ON b.item_id = c.conv_id WHERE c.role = 'assistant'""")
def evl01(spark, sf):
    return E.score_exact(_answers(spark, sf), "got", "want").select("conv_id", "turn", "score", "reason")


@register("EVL-01", "evl01_keyword_scorer", f"""
SELECT conv_id, turn, len(list_intersect({_W.format('text')}, ['the', 'and', 'le'])) AS keyword_hits,
       CAST(len(list_intersect({_W.format('text')}, ['the', 'and', 'le'])) = 3 AS INTEGER) AS score
FROM conversations WHERE role = 'assistant'""")
def evl01b(spark, sf):
    c = T(spark, sf, "conversations").filter("role = 'assistant'")
    return E.score_keywords(c, "text", ["the", "and", "le"]).select(
        "conv_id", "turn", F.col("keyword_hits").cast("bigint").alias("keyword_hits"), "score")


@register("EVL-02", "evl02_overlap_scorer", f"""
SELECT d.doc_id, round(len(list_intersect({_W.format('d.text')}, {_W.format('b.text')})) /
       len(list_distinct(list_concat({_W.format('d.text')}, {_W.format('b.text')}))), 6) AS overlap
FROM documents d JOIN benchmark b ON b.item_id = d.doc_id""")
def evl02(spark, sf):
    d = T(spark, sf, "documents").select("doc_id", F.col("text").alias("got"))
    b = T(spark, sf, "benchmark").select(F.col("item_id").alias("doc_id"), F.col("text").alias("want"))
    s = E.score_overlap(d.join(b, "doc_id"), "got", "want", 0.2)
    return s.select("doc_id", F.round("overlap", 6).alias("overlap"))


@register("EVL-03", "evl03_pairwise_compare", """
SELECT CASE WHEN quality > 1 - toxic THEN 'A' WHEN 1 - toxic > quality THEN 'B' ELSE 'tie' END AS winner, count(*) AS n,
       count(*) / (SELECT count(*) FROM labels) AS rate
FROM labels GROUP BY 1""")
def evl03(spark, sf):
    l = T(spark, sf, "labels").withColumn("b", 1 - F.col("toxic"))
    return E.pairwise(l, "doc_id", "quality", "b")


@register("EVL-04", "evl04_experiment_summary", """
WITH r AS (SELECT d.lang AS experiment, d.source AS example, l.quality AS score FROM labels l JOIN documents d USING (doc_id)),
 b AS (SELECT example, avg(score) AS base FROM r WHERE experiment = 'en' GROUP BY example)
SELECT experiment, round(avg(score), 6) AS mean, round(stddev_pop(score), 6) AS spread,
       round(avg(CASE WHEN score >= 1 THEN 1.0 ELSE 0.0 END), 6) AS pass_rate, CAST(count_if(score < base) AS BIGINT) AS regressions
FROM r LEFT JOIN b USING (example) GROUP BY 1""")
def evl04(spark, sf):
    l = T(spark, sf, "labels")
    d = T(spark, sf, "documents").select("doc_id", F.col("lang").alias("experiment"), F.col("source").alias("example"))
    r = l.join(d, "doc_id").select("experiment", "example", F.col("quality").alias("score"))
    s = E.experiment_summary(r, "experiment", "example", "score", "en", 1)
    return s.select("experiment", *[F.round(c, 6).alias(c) for c in ("mean", "spread", "pass_rate")], "regressions")
