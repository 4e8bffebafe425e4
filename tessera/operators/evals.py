"""Evaluation jobs over model outputs (EVL-*)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.common import attach_scalars
from tessera.operators.text import words


def score_exact(df: DataFrame, got: str, want: str) -> DataFrame:
    """EVL-01: 1/0 exact match after trim and case fold, with a reason."""
    ok = F.lower(F.trim(F.col(got))) == F.lower(F.trim(F.col(want)))
    return df.withColumn("score", ok.cast("int")).withColumn(
        "reason", F.when(ok, "exact match").otherwise("differs"))


def score_keywords(df: DataFrame, got: str, keywords: Sequence[str]) -> DataFrame:
    """EVL-01: share of keywords present as words, and 1 when all are."""
    ws = F.array_distinct(words(F.col(got)))
    kw = F.array(*[F.lit(k.lower()) for k in keywords])
    hit = F.size(F.array_intersect(ws, kw))
    return df.withColumn("keyword_hits", hit).withColumn("score", (hit == len(set(keywords))).cast("int"))


def score_overlap(df: DataFrame, got: str, want: str, min_score: float) -> DataFrame:
    """EVL-02: Jaccard overlap of the word sets, pass at ``min_score``."""
    a, b = F.array_distinct(words(F.col(got))), F.array_distinct(words(F.col(want)))
    j = F.try_divide(F.size(F.array_intersect(a, b)).cast("double"), F.size(F.array_union(a, b)).cast("double"))
    return df.withColumn("overlap", j).withColumn("passed", F.coalesce(j >= min_score, F.lit(False)))


def pairwise(df: DataFrame, key: str, score_a: str, score_b: str) -> DataFrame:
    """EVL-03: per example A wins / B wins / tie; plus win rates."""
    res = (F.when(F.col(score_a) > F.col(score_b), "A").when(F.col(score_b) > F.col(score_a), "B").otherwise("tie"))
    d = df.select(key, res.alias("winner"))
    n = d.groupBy("winner").agg(F.count(F.lit(1)).alias("n"))
    return attach_scalars(n, n.agg(F.sum("n").alias("_all"))).withColumn("rate", F.col("n") / F.col("_all")).drop("_all")


def experiment_summary(df: DataFrame, experiment: str, example: str, score: str, baseline, pass_at: float
                       ) -> DataFrame:
    """EVL-04: per experiment mean, spread, pass rate and the number of
    examples that regressed against the baseline experiment."""
    # one baseline row per example, however often the example was scored
    base = df.filter(F.col(experiment) == F.lit(baseline)).groupBy(example).agg(F.avg(score).alias("_base"))
    j = df.join(base, example, "left")
    return j.groupBy(experiment).agg(
        F.avg(score).alias("mean"), F.stddev_pop(score).alias("spread"),
        F.avg((F.col(score) >= pass_at).cast("double")).alias("pass_rate"),
        F.count_if(F.col(score) < F.col("_base")).alias("regressions"))


def scorer(expr_fn) -> callable:
    """UDF-04: wrap a Column-expression scorer so it can be applied by name:
    ``scorer(lambda got, want: ...)(df, "got", "want")``."""
    def apply(df: DataFrame, got: str, want: str, out: str = "score") -> DataFrame:
        return df.withColumn(out, expr_fn(F.col(got), F.col(want)))
    return apply
