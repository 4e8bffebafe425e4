"""Storage-layout jobs (LAY-*): clustering, layout health, key advice, skew,
point-lookup layout, compaction.  All are ordinary writes and aggregates
over file metadata columns; no storage engine is involved."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.operators.aggs import median_by
from tessera.operators.common import TASK_BYTES, attach_scalars, input_bytes


#: Bytes of the tables' files whose rows go to one clustered file.
FILE_BYTES = 4 * TASK_BYTES


def cluster(df: DataFrame, cols: Sequence[str], path: str, files: int) -> None:
    """LAY-01: range-partition by the clustering columns and sort inside
    each file, so per-file min/max ranges barely overlap.  ``files`` is the
    least number of files; beyond FILE_BYTES of input to a file there are
    more, so what one task sorts does not grow with the table."""
    files = max(files, -(-(input_bytes(df) or 0) // FILE_BYTES))
    (df.repartitionByRange(files, *cols).sortWithinPartitions(*cols)
       .write.mode("overwrite").parquet(path))


def _file_ranges(spark: SparkSession, path: str, col: str) -> DataFrame:
    d = spark.read.parquet(path).select(F.col("_metadata.file_path").alias("file"), col)
    return d.groupBy("file").agg(F.min(col).alias("lo"), F.max(col).alias("hi"), F.count(F.lit(1)).alias("rows"))


def depth_at(spark: SparkSession, path: str, col: str, value) -> DataFrame:
    """LAY-02: depth at a point: files (and their rows) that a lookup of
    ``value`` has to read, of all files."""
    hit = F.lit(value).between(F.col("lo"), F.col("hi"))
    return _file_ranges(spark, path, col).agg(F.count_if(hit).alias("depth"), F.count(F.lit(1)).alias("files"),
                                              F.coalesce(F.sum(F.when(hit, F.col("rows"))), F.lit(0)).alias("rows"))


def layout_report(spark: SparkSession, path: str, col: str) -> DataFrame:
    """LAY-02: per file min/max of ``col``, how many other files' ranges
    overlap it, and the depth at its first value (files whose range holds that
    value, itself included); computed with a sweep over the sorted range end
    points (no file pairs)."""
    files = _file_ranges(spark, path, col)
    # overlaps of file f = files whose lo <= f.hi minus files whose hi < f.lo, minus itself
    ev = files.select(F.col("lo").alias("v"), F.lit(1).alias("is_lo"), F.lit(0).alias("is_hi")) \
              .unionByName(files.select(F.col("hi").alias("v"), F.lit(0).alias("is_lo"), F.lit(1).alias("is_hi")))
    w = Window.orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # the event table has two rows per file (bounded by the file count)
    cum = ev.groupBy("v").agg(F.sum("is_lo").alias("n_lo"), F.sum("is_hi").alias("n_hi")) \
            .withColumn("lo_upto", F.sum("n_lo").over(w)).withColumn("hi_upto", F.sum("n_hi").over(w))
    a = files.join(cum.select(F.col("v").alias("hi"), "lo_upto"), "hi")
    b = cum.select(F.col("v").alias("lo"), (F.col("hi_upto") - F.col("n_hi")).alias("hi_before"),
                   (F.col("lo_upto") - F.col("hi_upto") + F.col("n_hi")).alias("depth"))
    return a.join(b, "lo").withColumn("overlaps", F.col("lo_upto") - F.col("hi_before") - 1) \
            .drop("lo_upto", "hi_before")


def key_advisor(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """LAY-03: per candidate column: distinct values and the share of the
    most frequent value (skew)."""
    out = None
    total = df.agg(F.count(F.lit(1)).alias("_t"))
    for c in cols:
        top = df.groupBy(c).agg(F.count(F.lit(1)).alias("_n")).agg(
            F.count(F.lit(1)).alias("distinct_values"), F.max("_n").alias("_top"))
        r = attach_scalars(top, total).select(F.lit(c).alias("column"), "distinct_values",
                                              F.round(F.col("_top") / F.col("_t"), 6).alias("top_share"))
        out = r if out is None else out.unionByName(r)
    return out


def skew_report(df: DataFrame, key: str, hot_share: float = 0.01) -> DataFrame:
    """LAY-04: rows per key, max/median ratio, hot keys over a share."""
    per = df.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    stats = per.agg(F.max("rows").alias("max_rows"), F.sum("rows").alias("_total"), F.count(F.lit(1)).alias("keys"))
    stats = attach_scalars(stats, median_by(per, None, "rows", "median_rows"))
    hot = attach_scalars(per, stats.select("_total")).filter(F.col("rows") > F.col("_total") * hot_share) \
        .agg(F.count(F.lit(1)).alias("hot_keys"))
    return attach_scalars(stats, hot).withColumn("max_over_median", F.col("max_rows") / F.col("median_rows")).drop("_total")


def write_lookup(df: DataFrame, path: str, key: str, rows_per_file: int = 4_000_000, files: int | None = None) -> None:
    """LAY-05: layout for id lookups: files sorted by key (tight min/max for
    row-group skipping) with a Parquet Bloom filter on the key.  The file
    count and the filter's size follow the table's row count."""
    n = df.count()
    files = files or max(1, -(-n // rows_per_file))
    (df.repartitionByRange(files, key).sortWithinPartitions(key).write.mode("overwrite")
       .option(f"parquet.bloom.filter.enabled#{key}", "true")
       .option("parquet.bloom.filter.expected.ndv", str(max(1, -(-n // files)))).parquet(path))


def compact(spark: SparkSession, path: str, out: str, target_bytes: int) -> int:
    """LAY-06: rewrite many small files into files of about ``target_bytes``
    (file count from the input size); returns the number of output files."""
    sizes = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet") \
                 .option("recursiveFileLookup", "true").load(path).select("length")
    total = sizes.agg(F.sum("length")).first()[0] or 0
    n = max(1, -(-int(total) // target_bytes))
    spark.read.parquet(path).repartition(n).write.mode("overwrite").parquet(out)
    return n


def inventory(spark: SparkSession, path: str) -> DataFrame:
    """SRC-12: file, bytes, modified time and row count per data file."""
    meta = spark.read.format("binaryFile").option("recursiveFileLookup", "true") \
                .option("pathGlobFilter", "*.parquet").load(path).select(
        F.col("path").alias("file"), F.col("length").alias("bytes"), F.col("modificationTime").alias("mtime"))
    rows = spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("file")) \
                .agg(F.count(F.lit(1)).alias("rows"))
    return meta.join(rows, "file", "left")
