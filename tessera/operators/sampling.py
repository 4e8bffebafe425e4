"""Sampling (SMP-*).  Repeatable samples use an MD5 hash of the key, so the
same rows are chosen on every run, whatever the partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.common import _cols, join_on, prefix_sum, quantile_chunk


def stable_hash(key, seed: int = 0, buckets: int = 10_000) -> Column:
    """Hash in [0, buckets): the first 32 bits of md5(key ':' seed) modulo
    ``buckets``; keys with a common stride spread like any others, and every
    SQL engine can reproduce it.  A NULL key hashes like ''."""
    k = F.col(key) if isinstance(key, str) else key
    text = F.concat(F.coalesce(k.cast("string"), F.lit("")), F.lit(f":{seed}"))
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint"), F.lit(buckets))


def sample_rows(df: DataFrame, p: float, seed: int) -> DataFrame:
    """SMP-01: each row kept with probability p (seeded Bernoulli)."""
    return df.sample(withReplacement=False, fraction=p, seed=seed)


def sample_blocks(df: DataFrame, p: float, seed: int, block_rows: int = 1_000) -> DataFrame:
    """SMP-02: blocks of ``block_rows`` neighbouring rows of a file kept or
    dropped together (hash of the file's name and the block's number)."""
    block = F.floor(F.col("_metadata.row_index") / block_rows)
    h = F.pmod(F.xxhash64(F.col("_metadata.file_name"), block, F.lit(seed)), F.lit(10_000))
    return df.filter(h < int(p * 10_000))


def sample_stable(df: DataFrame, key: str, p: float, seed: int = 0) -> DataFrame:
    """SMP-03: repeatable sample by key hash."""
    return df.filter(stable_hash(key, seed) < int(round(p * 10_000)))


def sample_stratified(df: DataFrame, by, key: str, p: float, seed: int = 0, buckets: int = 10_000) -> DataFrame:
    """SMP-04: exactly ceil(p * n) rows of every group (at least one): the
    rows with the smallest (key hash, key).

    No window spans a whole group: a histogram of hash buckets per group
    (groups x buckets rows) gives, per group, the bucket where the quota is
    reached; rows below it are taken, and only rows inside that one boundary
    bucket are ranked (a bucket holds about n / buckets rows of a group)."""
    h = stable_hash(key, seed, buckets)
    d = df.withColumn("_h", h)
    g = _cols(by)
    hist = d.groupBy(*g, "_h").agg(F.count(F.lit(1)).alias("_c"))
    w = Window.partitionBy(*g).orderBy("_h").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hist = hist.withColumn("_cum", F.sum("_c").over(w)) \
               .withColumn("_n", F.sum("_c").over(Window.partitionBy(*g)))
    hist = hist.withColumn("_k", F.greatest(F.lit(1), F.ceil(F.col("_n") * p)))
    # boundary bucket: first bucket whose cumulative count reaches the quota
    bound = hist.filter(F.col("_cum") >= F.col("_k")).groupBy(*g).agg(
        F.min_by(F.struct("_h", (F.col("_k") - (F.col("_cum") - F.col("_c"))).alias("_need")), "_h").alias("_b"))
    bound = bound.select(*g, F.col("_b._h").alias("_bh"), F.col("_b._need").alias("_need"))
    j = join_on(d, bound, list(by) if isinstance(by, (list, tuple)) else [by])
    below = j.filter(F.col("_h") < F.col("_bh"))
    edge = j.filter(F.col("_h") == F.col("_bh"))
    wr = Window.partitionBy(*g, "_h").orderBy(F.col(key))
    edge = edge.withColumn("_r", F.row_number().over(wr)).filter(F.col("_r") <= F.col("_need")).drop("_r")
    return below.unionByName(edge).drop("_h", "_bh", "_need")


def kfold(df: DataFrame, order: str, k: int, tie: str | None = None, out: str = "fold") -> DataFrame:
    """SMP-05: k disjoint folds by position: fold = (rank - 1) * k div n.
    The global position is a chunked prefix count (quantile chunks of the
    order column), never a single-partition window."""
    d = quantile_chunk(df, order, out="_qc").withColumn("_one", F.lit(1)).withColumn("_k", F.lit(0))
    d = prefix_sum(d, ["_k"], [F.col(order), *([F.col(tie)] if tie else [])], "_one", "_pos", "_qc")
    n = df.agg(F.count(F.lit(1)).alias("_cnt"))
    from tessera.operators.common import attach_scalars
    d = attach_scalars(d, n)
    return d.withColumn(out, F.expr(f"(_pos - 1) * {k} div _cnt").cast("int")).drop("_qc", "_one", "_k", "_pos", "_cnt")


def holdout(df: DataFrame, user: str, order, lo: int, hi: int, out: str = "is_test", chunk=None) -> DataFrame:
    """SMP-05: rows lo..hi (1-based, by order) of every user are test rows
    (position is a chunked prefix count when ``chunk`` is given)."""
    if chunk is None:
        w = Window.partitionBy(user).orderBy(*_cols(order))
        d = df.withColumn("_rn", F.row_number().over(w))
    else:
        d = prefix_sum(df.withColumn("_one", F.lit(1)).withColumn("_ch", chunk), [user], order, "_one", "_rn", "_ch") \
            .drop("_one", "_ch")
    return d.withColumn(out, F.col("_rn").between(lo, hi)).drop("_rn")
