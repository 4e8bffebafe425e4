"""Benchmark decontamination by winnowing.

A window is ``span`` consecutive words of a benchmark item (a shorter item is
one window of its own length n).  For each window length n the texts of both
sides are cut into k-grams, k = (n + 1) // 2, and the least k-gram hash of
every n - k + 1 consecutive k-grams is kept, with the rightmost of equal ones.
Two texts that share n words then share a kept hash at the same place of the
shared words, whatever surrounds them.  The kept hashes of both sides are
joined, and each hit is extended word by word to both sides; a hit whose
shared words number n or more is an occurrence of a window, every other hit
falls away.

Before the join the documents' hashes pass a bitmap of the benchmark's hashes
(``filter_bits`` bits, its size is fixed): it only lets through too much, never
too little.  The join is salted, so that a passage which a third of the
documents hold is spread over ``salts`` tasks for each hash.

Defined cases: a null text has no words; rows that repeat an id are reported
one by one; items that repeat an item id count once; a null item id is left
out; empty tables give no hits; a text of any length is fingerprinted whole, in
one row of a batch; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import bitmap_of, fresh_name, in_bitmap, map_arrow, numbered, row_numbered
from tessera.llm.words import ALNUM, grams, mix, steps, words_of

_PRINT = T.StructType([
    T.StructField("n", T.IntegerType()), T.StructField("fp", T.LongType()), T.StructField("pos", T.LongType()),
    T.StructField("left", T.ArrayType(T.LongType())), T.StructField("right", T.ArrayType(T.LongType())),
])
_LIST = pa.list_(pa.int64())
_PRINTS = pa.struct([("n", pa.int32()), ("fp", pa.int64()), ("pos", pa.int64()), ("left", _LIST), ("right", _LIST)])


def gram_length(n: int) -> int:
    return (n + 1) // 2


def winnow(hashes: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """Places of the least hash of each window of n words; ``row``: the text of each word."""
    w = n - gram_length(n) + 1
    m = len(row) - n + 1
    if m <= 0:
        return np.empty(0, np.int64)
    least, where = hashes[:m].copy(), np.zeros(m, np.int64)
    for j in range(1, w):
        later = hashes[j: m + j]
        lower = later <= least
        least[lower] = later[lower]
        where[lower] = j
    whole = row[:m] == row[n - 1:]
    kept = np.zeros(len(hashes), bool)
    kept[(where + np.arange(m))[whole]] = True
    return np.flatnonzero(kept)


def _beside(words: np.ndarray, row: np.ndarray, at: np.ndarray, first: int, step: int, count: int,
            outside: int) -> np.ndarray:
    """Hash of the 1, 2, .. ``count`` words beside each place, from ``at + first`` on in direction ``step``."""
    out = np.empty((len(at), count), np.uint64)
    so_far = np.zeros(len(at), np.uint64)
    for j in range(count):
        p = at + first + step * j
        here = (p >= 0) & (p < len(words))
        p = np.where(here, p, 0)
        word = np.where(here & (row[p] == row[at]), words[p], np.uint64(outside))
        so_far = mix(so_far * np.uint64(0xD6E8FEB86659FD93) + word)
        out[:, j] = so_far
    return out


def _lists(x: np.ndarray) -> pa.Array:
    n, k = x.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * k), pa.array(x.reshape(-1).view(np.int64)))


def _fingerprints(texts: pa.Array, lengths: list[int], outside: int, bitmap: np.ndarray | None,
                  own_length: int | None = None) -> tuple[np.ndarray, pa.Array]:
    """Words per text, and per text the list of its fingerprints for the windows of ``lengths`` words.

    ``own_length``: each text has windows of that many words or, if shorter, of its whole length only.
    """
    words, counts = words_of(texts, ALNUM)
    row = np.repeat(np.arange(len(counts)), counts)
    begin = np.concatenate([[0], np.cumsum(counts)])
    parts = []
    for n in lengths:
        k = gram_length(n)
        hashes = grams(words, k)
        at = winnow(hashes, row, n)
        if own_length is not None:
            at = at[np.minimum(counts[row[at]], own_length) == n]
        fp = hashes[at]
        if bitmap is not None:
            known = in_bitmap(bitmap, fp)
            at, fp = at[known], fp[known]
        parts.append((row[at], pa.StructArray.from_arrays(
            [pa.array(np.full(len(at), n, np.int32)), pa.array(fp.view(np.int64)), pa.array(at - begin[row[at]]),
             _lists(_beside(words, row, at, -1, -1, n - k, outside)),
             _lists(_beside(words, row, at, k, 1, n - k, outside))], fields=list(_PRINTS))))
    of = np.concatenate([p[0] for p in parts]) if parts else np.empty(0, np.int64)
    prints = pa.concat_arrays([p[1] for p in parts]) if parts else pa.array([], _PRINTS)
    order = np.argsort(of, kind="stable")
    offsets = np.searchsorted(of[order], np.arange(len(counts) + 1)).astype(np.int32)
    return counts, pa.ListArray.from_arrays(pa.array(offsets), prints.take(pa.array(order)))


def fingerprints(df: DataFrame, text_col: str, lengths: list[int], outside: int, bitmap: bytes | None = None,
                 own_length: int | None = None) -> DataFrame:
    """``df`` without its text (the last column), with n_words and prints."""
    schema = T.StructType([*(f for f in df.schema if f.name != text_col), T.StructField("n_words", T.LongType()),
                           T.StructField("prints", T.ArrayType(_PRINT))])
    assert df.columns[-1] == text_col
    held = df.sparkSession.sparkContext.broadcast(bitmap) if bitmap is not None else None

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.frombuffer(held.value, np.uint8) if held is not None else None
        for b in batches:
            for at, texts in steps(b.column(b.num_columns - 1)):
                counts, prints = _fingerprints(texts, lengths, outside, known, own_length)
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(at, len(texts)) for c in b.columns[:-1]), pa.array(counts, pa.int64()), prints],
                    names=schema.names)

    return map_arrow(df, cut, schema)


def _covered(spans):
    """Words covered by spans sorted by their start."""
    zero = F.struct(F.lit(0).cast("long").alias("sum"), F.lit(0).cast("long").alias("reach"))

    def step(acc, s):
        low = F.greatest(acc["reach"], s["from"])
        return F.struct((acc["sum"] + F.greatest(F.lit(0).cast("long"), s["to"] - low)).alias("sum"),
                        F.greatest(acc["reach"], s["to"]).alias("reach"))

    return F.aggregate(F.array_sort(spans), zero, step, lambda acc: acc["sum"])


def find_benchmark_words(df: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         item_col: str = "item_id", item_text_col: str = "text", span: int = 10,
                         filter_bits: int = 1 << 24, salts: int = 16, row_col: str | None = None) -> DataFrame:
    """Per row of ``df``: ``id_col``, n_words, n_hit (words inside occurrences), items (sorted ids as text), spans.

    The first column is ``row_col``, a column of ``row_numbered`` to join by; without it a number of this plan only.
    """
    spark = df.sparkSession
    lengths = list(range(1, span + 1))
    known = items.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).alias("text"))
    known = known.where(F.col("item").isNotNull())
    bench = (fingerprints(known, "text", lengths, 2, own_length=span)
             .select("item", F.explode("prints").alias("p")).select("item", "p.*"))
    bench = (bench.groupBy("n", "fp", "left", "right").agg(F.sort_array(F.collect_set("item")).alias("items")))
    present = sorted(r.n for r in bench.select("n").distinct().collect())  # at most ``span`` numbers
    bitmap = bitmap_of(bench, "fp", filter_bits)

    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *([F.col(row_col).alias("row")] if row_col else []))
    rows = rows if row_col else numbered(rows, "row")
    found = fingerprints(rows.select("row", "id", "text"), "text", present, 1, bitmap)
    one = found.select("row", "id", "n_words", F.explode_outer("prints").alias("p")).select("row", "id", "n_words", "p.*")
    one = one.withColumn("salt", F.when(F.col("fp").isNull(), F.xxhash64("row"))
                         .otherwise(F.pmod(F.xxhash64("row", "pos"), F.lit(salts))))
    bench = bench.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    b = bench.select("salt", F.col("n").alias("bn"), F.col("fp").alias("bfp"), F.col("left").alias("bleft"),
                     F.col("right").alias("bright"), "items")
    hits = one.join(b, (one.salt == b.salt) & (one.n == b.bn) & (one.fp == b.bfp), "left")

    def same(x, y):
        return F.size(F.filter(F.zip_with(x, y, lambda p, q: p == q), lambda z: z))

    k = F.floor((F.col("n") + 1) / 2).cast("long")
    start = F.col("pos") - same(F.col("left"), F.col("bleft"))
    stop = F.col("pos") + k + same(F.col("right"), F.col("bright"))
    hit = F.col("items").isNotNull() & (stop - start >= F.col("n"))
    hits = hits.select("row", "id", "n_words", F.when(hit, F.struct(start.alias("from"), stop.alias("to"))).alias("span"),
                       F.when(hit, F.col("items")).alias("items"))
    out = hits.groupBy("row").agg(F.first("id").alias("id"), F.first("n_words").alias("n_words"),
                                  F.collect_set("span").alias("spans"), F.collect_set("items").alias("items"))
    return out.select(
        F.col("row").alias(fresh_name(df, "row")), F.col("id").alias(id_col), "n_words", _covered(F.col("spans")).alias("n_hit"),
        F.sort_array(F.array_distinct(F.flatten("items"))).alias("items"), F.array_sort("spans").alias("spans"))


def drop_contaminated(df: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The rows of ``df`` without any word inside an occurrence of a benchmark window."""
    rows = row_numbered(df, fresh_name(df, "row"))
    found = find_benchmark_words(rows, items, row_col=rows.columns[-1], **options)
    bad = found.where(F.col("n_hit") > 0).select(F.col(found.columns[0]).alias(fresh_name(df, "bad_row")))
    return rows.join(bad.hint("shuffle_hash"), rows[rows.columns[-1]] == bad[bad.columns[0]], "left_anti").drop(rows.columns[-1])
