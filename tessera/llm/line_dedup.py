"""Line dedup over levelled sorted runs of line hashes.

``LineRuns`` keeps the line hashes of all documents seen so far as runs:
Parquet tables of (hash, number of documents, largest document), each sorted
by hash.  Documents come in batches, largest ids first.  A new batch is
merge-anti-joined against the runs: keys that are settled there (found in
``min_docs`` documents, so that neither the decision nor the keeper can
change) fall away, and what is left is added as the batch's own run.  When a
level holds ``fanout`` runs they are compacted into one run of the next level,
so that ever fewer and longer runs are read.

A line's key is the line without white space at both ends, A-Z lower-cased;
keys shorter than ``min_points`` code points are never dropped.  Keys found in
at least ``min_docs`` documents lose their lines everywhere but in the
largest id that holds them.  Hashes have 128 bits.

Defined cases: a null or empty text is one empty line and stays as it is; rows that repeat an id
are one document, and the keeper's rows all keep the line; rows with a null id
are not counted and keep all their lines; ids are numbers, as their quantiles
set the batches; an empty table gives no rows; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import fresh_name, map_arrow, shared_folder

_SPACE = b" \t\n\x0b\x0c\r"


def line_key(line: bytes, min_points: int) -> bytes | None:
    """128-bit hash of a line's key, or None for a short key."""
    key = line.strip(_SPACE).lower()  # bytes.lower() touches A-Z only
    if len(key) < min_points or (len(key) < 4 * min_points and len(key.decode("utf-8", "replace")) < min_points):
        return None
    return xxhash.xxh3_128_digest(key)


def line_hashes(df: DataFrame, id_col: str, text_col: str, min_points: int) -> DataFrame:
    """Distinct (hash, id) of every line long enough."""
    rows = df.select(id_col, text_col).where(F.col(id_col).isNotNull())
    id_type = rows.schema[0].dataType

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            owner, hashes = [], []
            for i, text in enumerate(b.column(1)):
                keys = {line_key(x, min_points) for x in (text.as_py() or "").encode().split(b"\n")}
                keys.discard(None)
                owner += [i] * len(keys)
                hashes += keys
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes, pa.binary()), b.column(0).take(pa.array(owner, pa.int64()))], names=["h", "id"])

    return map_arrow(rows, cut, T.StructType([T.StructField("h", T.BinaryType()), T.StructField("id", id_type)])).distinct()


class LineRuns:
    """Levelled sorted runs of (h, n_docs, top): top is the largest id that holds the line."""

    def __init__(self, spark: SparkSession, folder: str, min_docs: int = 3, fanout: int = 2):
        self.spark, self.folder, self.min_docs, self.fanout = spark, folder, min_docs, fanout
        self.levels: list[list[str]] = [[]]
        self.written = 0

    def _write(self, run: DataFrame, level: int) -> None:
        path = f"{self.folder}/run-{self.written:05d}-level-{level}"
        self.written += 1
        run.sortWithinPartitions("h").write.parquet(path)
        self.levels[level].append(path)

    def _merge(self, paths: list[str]) -> DataFrame:
        return (self.spark.read.parquet(*paths).groupBy("h")
                .agg(F.sum("n_docs").alias("n_docs"), F.max("top").alias("top")))

    def settled(self) -> DataFrame | None:
        """Keys found in ``min_docs`` documents or more, with their keeper."""
        paths = [p for level in self.levels for p in level]
        return self._merge(paths).where(F.col("n_docs") >= self.min_docs) if paths else None

    def add(self, lines: DataFrame) -> None:
        """Add a batch of distinct (h, id); its ids are below those of all batches before."""
        known = self.settled()
        if known is not None:
            lines = lines.join(known.select("h").hint("merge"), "h", "left_anti")
        self._write(lines.groupBy("h").agg(F.count("*").alias("n_docs"), F.max("id").alias("top")), 0)
        level = 0
        while len(self.levels[level]) >= self.fanout:
            if level + 1 == len(self.levels):
                self.levels.append([])
            self._write(self._merge(self.levels[level]), level + 1)
            self.levels[level] = []
            level += 1


def repeated_lines(df: DataFrame, id_col: str, text_col: str, min_points: int, min_docs: int,
                   batches: int, fanout: int) -> DataFrame:
    """(id, h) of every line to drop."""
    spark = df.sparkSession
    folder = shared_folder(spark, "lines")
    cuts = sorted(set(df.stat.approxQuantile(id_col, [i / batches for i in range(1, batches)], 0.01)), reverse=True)
    # batch 0 has the largest ids; the number of batches is a parameter, so the work stays linear
    part = F.lit(len(cuts))
    for n, cut in reversed(list(enumerate(cuts))):
        part = F.when(F.col("id") > cut, F.lit(n)).otherwise(part)
    lines = line_hashes(df, id_col, text_col, min_points)
    schema = T.StructType([*lines.schema.fields, T.StructField("part", T.IntegerType())])
    lines.withColumn("part", part).write.partitionBy("part").parquet(f"{folder}/lines")
    lines = spark.read.schema(schema).parquet(f"{folder}/lines")
    runs = LineRuns(spark, folder, min_docs, fanout)
    for n in range(len(cuts) + 1):
        runs.add(lines.where(F.col("part") == n).select("h", "id"))
    return lines.join(runs.settled(), "h").where(F.col("id") != F.col("top")).select("id", "h")


def dedup_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_points: int = 20,
                min_docs: int = 3, batches: int = 4, fanout: int = 2,
                counts: tuple[str, str] = ("n_lines", "n_dropped")) -> DataFrame:
    """``df`` with the kept lines as its text, and per row the lines before and those dropped.

    ``counts`` names the two new columns; ``df`` must not have them.
    """
    drops = (repeated_lines(df, id_col, text_col, min_points, min_docs, batches, fanout)
             .groupBy("id").agg(F.collect_list("h").alias("hs")))  # at most the lines of one document
    mine = fresh_name(df, "dropped_hashes")
    drops = drops.select(F.col("id").alias(fresh_name(df, "dropped_id")), F.col("hs").alias(mine))
    joined = (df.join(drops.hint("shuffle_hash"), df[id_col] == drops[drops.columns[0]], "left")
              .drop(drops.columns[0]))
    at = df.columns.index(text_col)
    schema = T.StructType([*df.schema.fields, T.StructField(counts[0], T.LongType()),
                           T.StructField(counts[1], T.LongType())])
    schema[text_col].nullable = True

    def keep(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches_:
            kept, before, gone = [], [], []
            for text, hashes in zip(b.column(at), b.column(b.num_columns - 1)):
                lines = (text.as_py() or "").encode().split(b"\n")
                left = lines
                if hashes.is_valid:
                    drop = set(hashes.as_py())
                    left = [x for x in lines if line_key(x, min_points) not in drop]
                kept.append(b"\n".join(left).decode() if text.is_valid else None)
                before.append(len(lines))
                gone.append(len(lines) - len(left))
            columns = list(b.columns[:-1])
            columns[at] = pa.array(kept, columns[at].type)
            yield pa.RecordBatch.from_arrays([*columns, pa.array(before, pa.int64()), pa.array(gone, pa.int64())],
                                             names=schema.names)

    return map_arrow(joined, keep, schema)
