"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLE_NAMES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One given table, read through Spark only (the path may be in any store Spark knows)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder for one run's intermediate tables under the session's checkpoint folder.

    The folder is the one ``spark.checkpoint.dir`` names; only a local session
    without that setting gets a folder of its own.
    """
    from tessera.session import checkpoint_dir

    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def through_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage with files that outlive executors; a lost executor costs
    only its running tasks.
    """
    spark = df.sparkSession
    path = shared_folder(spark, name)
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


#: Rows of an Arrow batch: a row may be a very long text, and a batch is in memory on both sides.
ARROW_ROWS = 256


def map_arrow(df: DataFrame, fn: Callable, schema) -> DataFrame:
    """``mapInArrow`` in batches of at most ARROW_ROWS rows.

    The session's batch size is lowered to that if it is higher; a task gives
    the memory that Arrow has pooled back when its rows are done.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(key)) <= ARROW_ROWS:
        conf.set(key, str(ARROW_ROWS))

    def run(batches):
        yield from fn(batches)
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def tokenizer_path(name_or_path: str) -> str:
    """A vocabulary file: a path that exists, or a name that ``public_tokenizers`` knows."""
    if os.path.exists(name_or_path):
        return name_or_path
    import public_tokenizers

    return public_tokenizers.path(name_or_path)


def ascii_lower(col):
    """Lower-case A-Z only."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fresh_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have."""
    names = {c.lower() for c in df.columns}
    name = stem
    while name.lower() in names:
        name = "_" + name
    return name


def numbered(df: DataFrame, name: str) -> DataFrame:
    """Row numbers that hold within one plan; another plan over the same files may cut them otherwise."""
    return df.withColumn(name, F.monotonically_increasing_id())


def _plain_parquet_scan(df: DataFrame) -> bool:
    """Whether ``df`` is rows of Parquet files, each at most once."""
    plan = df._jdf.queryExecution().analyzed()
    if not plan.deterministic():
        return False
    while plan.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        plan = plan.children().apply(0)
    if plan.nodeName() != "LogicalRelation" or plan.relation().getClass().getSimpleName() != "HadoopFsRelation":
        return False
    relation = plan.relation()
    files = relation.location().allFiles()
    return relation.fileFormat().toString() == "Parquet" and files.distinct().size() == files.size()


def row_numbered(df: DataFrame, name: str) -> DataFrame:
    """``df`` with row numbers that are the same in every plan, however its files are cut into tasks.

    A row of Parquet files gets the number of its file (by path) and its place
    in the file; any other ``df`` is numbered once and written.
    """
    if not _plain_parquet_scan(df):
        return through_table(numbered(df, name), "numbered")
    meta, path, place, number = df.metadataColumn("_metadata"), *(fresh_name(df, f"{name}_{x}") for x in ("path", "place", "file"))
    paths = sorted(r[0] for r in df.select(meta["file_path"]).distinct().collect())  # as many as the driver has listed
    files = df.sparkSession.createDataFrame(list(zip(paths, range(len(paths)))), f"`{path}` string, `{number}` long")
    rows = df.select("*", meta["file_path"].alias(path), meta["row_index"].alias(place)).join(F.broadcast(files), path)
    return rows.withColumn(name, F.shiftleft(number, 40) + F.col(place)).drop(path, place, number)


def bitmap_of(df: DataFrame, col: str, bits: int) -> bytes:
    """Bitmap of a column of 64-bit hashes by their lowest bits.

    Its size is ``bits`` / 8 bytes, however many rows there are; the more rows,
    the more values it wrongly holds, but it never lacks one.
    """
    bit = F.col(col).bitwiseAND(bits - 1)
    parts = (df.select(bit.alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("bucket"))
             .agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("part")).collect())
    out = np.zeros(bits // 8, np.uint8)
    for bucket, part in parts:  # bucket b > 0 holds the values from (b - 1) * 32768 + 1 on, bucket 0 the value 0
        values = np.flatnonzero(np.unpackbits(np.frombuffer(part, np.uint8), bitorder="little"))
        values = values + ((bucket - 1) * 32768 + 1 if bucket > 0 else 0)
        np.bitwise_or.at(out, values >> 3, (1 << (values & 7)).astype(np.uint8))
    return out.tobytes()


def in_bitmap(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of the unsigned 64-bit hashes the bitmap (bytes) holds."""
    bit = hashes & np.uint64(len(bitmap) * 8 - 1)
    return (bitmap[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, label) of every node of the edges (a, b): label is the least node it reaches.

    Each round hooks every label onto its least neighbour, follows the hooks to
    their ends and contracts the edges; edges between labels at least halve.
    """
    edges = edges.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = through_table(edges, name)
    labels = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct().withColumn("label", F.col("node"))
    while not edges.isEmpty():
        hooks = through_table(edges.groupBy(F.col("a").alias("from")).agg(F.min("b").alias("to")), name)
        while True:  # pointer jumping: every hook ends at a label that hooks nowhere
            further = hooks.select(F.col("from").alias("to"), F.col("to").alias("end"))
            jumped = through_table(hooks.join(further, "to", "left").select(
                "from", F.coalesce("end", "to").alias("to"), F.col("end").isNotNull().alias("moved")), name)
            hooks = jumped.select("from", "to")
            if jumped.where("moved").isEmpty():
                break
        labels = through_table(labels.join(hooks.withColumnRenamed("from", "label"), "label", "left").select(
            "node", F.coalesce("to", "label").alias("label")), name)
        ha, hb = hooks.toDF("a", "ta"), hooks.toDF("b", "tb")
        edges = edges.join(ha, "a", "left").join(hb, "b", "left").select(
            F.coalesce("ta", "a").alias("a"), F.coalesce("tb", "b").alias("b"))
        edges = through_table(edges.where(F.col("a") != F.col("b")).select(
            F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    return labels
