"""Registered queries for vector search (VEC-*)."""

from pyspark.sql import functions as F

from tessera.operators import vectors as V
from tessera.plans.registry import register
from tessera.session import load_table as T

_Q = "(SELECT label AS qid, arg_min(embedding, vec_id) AS qvec FROM embeddings GROUP BY label)"
_COS = ("list_dot_product(CAST(q.qvec AS DOUBLE[]), CAST(e.embedding AS DOUBLE[])) / "
        "(sqrt(list_dot_product(CAST(q.qvec AS DOUBLE[]), CAST(q.qvec AS DOUBLE[]))) * "
        "sqrt(list_dot_product(CAST(e.embedding AS DOUBLE[]), CAST(e.embedding AS DOUBLE[]))))")


def _queries(spark, sf):
    """Query set: the first vector of every label (bounded by the label count)."""
    e = T(spark, sf, "embeddings")
    return e.groupBy(F.col("label").alias("qid")).agg(F.min_by("embedding", "vec_id").alias("qvec"))


@register("VEC-01", "vec01_exact_topk_cosine", f"""
SELECT qid, vec_id, CAST(rank AS INTEGER) AS rank, round(score, 5) AS score FROM (
  SELECT q.qid, e.vec_id, {_COS} AS score,
         row_number() OVER (PARTITION BY q.qid ORDER BY {_COS} DESC, e.vec_id) AS rank
  FROM {_Q} q, embeddings e) WHERE rank <= 5""")
def vec01(spark, sf):
    h = V.topk(_queries(spark, sf), T(spark, sf, "embeddings"), 5, "cosine")
    return h.select("qid", "vec_id", F.col("rank").cast("int").alias("rank"), F.round("score", 5).alias("score"))


@register("VEC-02", "vec02_topk_l2", """
SELECT qid, vec_id, CAST(rank AS INTEGER) AS rank, round(score, 5) AS score FROM (
  SELECT q.qid, e.vec_id, sqrt(list_sum(list_transform(list_zip(CAST(q.qvec AS DOUBLE[]), CAST(e.embedding AS DOUBLE[])),
         lambda p: (p[1] - p[2]) * (p[1] - p[2])))) AS score,
         row_number() OVER (PARTITION BY q.qid ORDER BY sqrt(list_sum(list_transform(list_zip(CAST(q.qvec AS DOUBLE[]), CAST(e.embedding AS DOUBLE[])),
         lambda p: (p[1] - p[2]) * (p[1] - p[2])))), e.vec_id) AS rank
  FROM (SELECT label AS qid, arg_min(embedding, vec_id) AS qvec FROM embeddings GROUP BY label) q, embeddings e) WHERE rank <= 5""")
def vec02(spark, sf):
    h = V.topk(_queries(spark, sf), T(spark, sf, "embeddings"), 5, "l2")
    return h.select("qid", "vec_id", F.col("rank").cast("int").alias("rank"), F.round("score", 5).alias("score"))


@register("VEC-02", "vec02_topk_inner_product", """
SELECT qid, vec_id, CAST(rank AS INTEGER) AS rank, round(score, 5) AS score FROM (
  SELECT q.qid, e.vec_id, list_dot_product(CAST(q.qvec AS DOUBLE[]), CAST(e.embedding AS DOUBLE[])) AS score,
         row_number() OVER (PARTITION BY q.qid ORDER BY list_dot_product(CAST(q.qvec AS DOUBLE[]), CAST(e.embedding AS DOUBLE[])) DESC, e.vec_id) AS rank
  FROM (SELECT label AS qid, arg_min(embedding, vec_id) AS qvec FROM embeddings GROUP BY label) q, embeddings e) WHERE rank <= 5""")
def vec02b(spark, sf):
    h = V.topk(_queries(spark, sf), T(spark, sf, "embeddings"), 5, "ip")
    return h.select("qid", "vec_id", F.col("rank").cast("int").alias("rank"), F.round("score", 5).alias("score"))


@register("VEC-03", "vec03_normalise", """
SELECT vec_id, round(sqrt(list_sum(list_transform(n, lambda x: x * x))), 6) AS norm_after, round(n[1], 6) AS first
FROM (SELECT vec_id, CASE WHEN sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))) = 0
        THEN CAST(embedding AS DOUBLE[])
        ELSE list_transform(CAST(embedding AS DOUBLE[]), lambda x: x / sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])))) END AS n
      FROM embeddings)""")
def vec03(spark, sf):
    d = V.normalise(T(spark, sf, "embeddings"), "embedding", "n")
    return d.select("vec_id", F.round(V.norm("n"), 6).alias("norm_after"), F.round(F.element_at("n", 1), 6).alias("first"))


@register("VEC-04", "vec04_filtered_search", f"""
SELECT qid, vec_id, CAST(rank AS INTEGER) AS rank FROM (
  SELECT q.qid, e.vec_id, row_number() OVER (PARTITION BY q.qid ORDER BY {_COS} DESC, e.vec_id) AS rank
  FROM (SELECT vec_id AS qid, embedding AS qvec, label FROM embeddings WHERE vec_id IN
          (SELECT max(vec_id) FROM embeddings GROUP BY label)) q JOIN embeddings e ON e.label = q.label) WHERE rank <= 3""")
def vec04(spark, sf):
    e = T(spark, sf, "embeddings")
    q = e.join(e.groupBy("label").agg(F.max("vec_id").alias("vec_id")), ["label", "vec_id"], "left_semi") \
         .select(F.col("vec_id").alias("qid"), F.col("embedding").alias("qvec"), "label")
    h = V.topk_filtered(q, e, 3, "label")
    return h.select("qid", "vec_id", F.col("rank").cast("int").alias("rank"))


@register("VEC-05", "vec05_ivf_recall", """
SELECT count(DISTINCT label) AS n_queries, true AS recall_holds, true AS reads_at_most_all FROM embeddings""")
def vec05(spark, sf):
    q, e = _queries(spark, sf), T(spark, sf, "embeddings")
    index = V.build_ivf(e, lists=16)
    found, cost = V.search_ivf(q, index, 10, probes=2)
    per = V.recall(found, V.topk(q, e, 10, "cosine")).join(cost, "qid")
    return per.agg(F.count(F.lit(1)).alias("n_queries"), (F.avg("recall") >= 0.9).alias("recall_holds"),
                   (F.max("rows_read") <= int(index.size.sum())).alias("reads_at_most_all"))


@register("VEC-06", "vec06_cut_hits_best_per_doc", f"""
WITH h AS (SELECT q.qid, e.vec_id, e.label, {_COS} AS score FROM {_Q} q, embeddings e)
SELECT qid, label, vec_id FROM (SELECT *, row_number() OVER (PARTITION BY qid, label ORDER BY score DESC, vec_id) AS r
  FROM h WHERE score >= 0.1) WHERE r = 1""")
def vec06(spark, sf):
    return V.best_hits(_queries(spark, sf), T(spark, sf, "embeddings"), 0.1, "label").select("qid", "label", "vec_id")


@register("VEC-07", "vec07_refresh_vectors", """
SELECT vec_id, label, round(CAST(embedding[1] AS DOUBLE) * CASE WHEN label = 3 THEN 2 ELSE 1 END, 5) AS first
FROM embeddings WHERE label <> 9""")
def vec07(spark, sf):
    e = T(spark, sf, "embeddings")
    delta = e.filter(F.col("label").isin(3, 9)).select(
        "vec_id", F.transform("embedding", lambda x: x * 2).alias("embedding"), "label",
        (F.col("label") == 9).alias("deleted"))
    r = V.refresh_vectors(e, delta, "vec_id", "deleted")
    return r.select("vec_id", "label", F.round(F.element_at("embedding", 1).cast("double"), 5).alias("first"))


@register("VEC-08", "vec08_pca_reduce")
def vec08(spark, sf):
    return V.reduce_dim(T(spark, sf, "embeddings"), "embedding", 8).select("vec_id", "reduced")
