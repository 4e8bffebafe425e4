"""Hard negatives of anchor rows, from exact integer scores by Strassen's multiplication.

Components become integers, floor(scale * c); equal rows (id, label, vector)
are one row with its number of copies.  Anchors and rows are dealt by hash into
groups of about ``block`` and every anchor group meets every row group once:
such a tile's scores are one int64 product of Strassen's recursion.  Positives
only meet rows of their own label.  A tile keeps, for each anchor, a heap of
its best positives, or for each anchor and positive score a heap of the best
negatives inside the window; the heaps of all tiles merge in a rank filter.
The windows need the final positives, so tiles are multiplied a second time
for them, which costs less than keeping all scores.

A row's score is its inner product with the anchor; higher scores come first,
ties by smaller id.  An anchor's positives are its first ``positives`` other
rows of its label.  A negative has another label and a score s between ``low``
and ``high`` percent of the positive's score p: low * p <= 100 * s <= high * p,
which nothing satisfies for a negative p.

Defined cases: rows with a null id, label or vector, or a null or non-finite
component take no part, nor do vectors whose squared length after scaling is
2^56 or more (their scores would not fit a long) or that are empty; only
vectors of equal length are compared.  Every row counts: a copy of the anchor
row is another row of its label, copies of an anchor are asked as often as
they occur, and copies of a positive each give their negatives.  Anchors
without positives, and positives without negatives, give no rows; an empty
table gives none.  Labels of any type are compared, and rows told apart, by
64-bit hashes.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import through_table
from tessera.llm.vectors import scaled, usable

#: Products with a side below this are multiplied plainly.
PLAIN = 16
LEAST = np.iinfo(np.int64).min


def _padded(a: np.ndarray) -> np.ndarray:
    """Zeros to even sides."""
    return np.pad(a, [(0, n % 2) for n in a.shape]) if a.shape[0] % 2 or a.shape[1] % 2 else a


def strassen(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b for int64 matrices: seven products of half the size.

    Sums wrap around like every int64 sum, so a result that fits is exact
    whatever the sums in between.
    """
    n, m = a.shape[0], b.shape[1]
    if min(n, a.shape[1], m) < PLAIN:
        return a @ b
    a, b = _padded(a), _padded(b)
    i, j, k = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :j], a[:i, j:], a[i:, :j], a[i:, j:]
    b11, b12, b21, b22 = b[:j, :k], b[:j, k:], b[j:, :k], b[j:, k:]
    out = np.empty((2 * i, 2 * k), np.int64)
    c11, c12, c21, c22 = out[:i, :k], out[:i, k:], out[i:, :k], out[i:, k:]
    p = strassen(a11 + a22, b11 + b22)
    c11[...] = p
    c22[...] = p
    p = strassen(a21 + a22, b11)
    c21[...] = p
    c22 -= p
    p = strassen(a11, b12 - b22)
    c12[...] = p
    c22 += p
    p = strassen(a22, b21 - b11)
    c11 += p
    c21 += p
    p = strassen(a11 + a12, b22)
    c11 -= p
    c12 += p
    c22 += strassen(a21 - a11, b11 + b12)
    c11 += strassen(a12 - a22, b21 + b22)
    return out[:n, :m]


def heap_of(scores: np.ndarray, fits: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the first k of each row's fitting scores: greatest first, then the leftmost."""
    masked = np.where(fits, scores, LEAST)
    if masked.shape[1] > k:
        floor = np.partition(masked, masked.shape[1] - k, axis=1)[:, masked.shape[1] - k]
        fits = fits & (masked >= floor[:, None])
    row, col = np.nonzero(fits)
    order = np.lexsort((col, -masked[row, col], row))
    row, col = row[order], col[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    return row[place < k], col[place < k]


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _tile(anchors: pa.Table, rows: pa.Table, keep: Callable, strip: int = 256):
    """Scores of a tile in strips of anchors, candidates by id; ``keep(first anchor, scores)`` is yielded from."""
    dim = len(anchors["x"][0])
    a, b = _matrix(anchors["x"], dim), np.ascontiguousarray(_matrix(rows["x"], dim).T)
    for at in range(0, len(a), strip):
        yield from keep(at, strassen(a[at: at + strip], b))


def _dealt(anchors: DataFrame, rows: DataFrame, keys: list[str], block: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``keys``, gr and sl: every group of about ``block`` anchors of a key meets every slab of its rows once."""
    sizes = (anchors.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("groups"))
             .join(rows.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("slabs")), keys))
    sizes = through_table(sizes, "tile-sizes")

    def deal(side: DataFrame, own: str, own_n: str, other: str, other_n: str) -> DataFrame:
        mine = F.pmod(F.xxhash64("vec_id", "x"), F.col(own_n)).cast("int")
        every = F.sequence(F.lit(0), F.col(other_n) - 1)
        return (side.join(sizes, keys).withColumn(own, mine).withColumn(other, F.explode(every))
                .drop(own_n, other_n))

    return deal(anchors, "gr", "groups", "sl", "slabs"), deal(rows, "sl", "slabs", "gr", "groups")


def _meet(anchors: DataFrame, rows: DataFrame, keys: list[str], block: int, heaps: Callable, schema: str) -> DataFrame:
    """``heaps(anchors, rows)`` of every tile; both as Arrow tables, rows by id."""
    a, r = _dealt(anchors, rows, keys, block)
    tile = [*keys, "gr", "sl"]
    nothing = pa.table({c.split()[0]: pa.array([], pa.int64()) for c in schema.split(", ")})

    def one(left: pa.Table, right: pa.Table) -> pa.Table:
        return heaps(left, right.sort_by("vec_id")) if left.num_rows and right.num_rows else nothing

    a, r = a.toDF(*a.columns), r.toDF(*r.columns)  # both come from one table
    return a.groupBy(*tile).cogroup(r.groupBy(*tile)).applyInArrow(one, schema)


def mine(df: DataFrame, is_anchor: Column, label: Column, id_col: str = "vec_id", vec_col: str = "embedding",
         scale: int = 256, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100,
         block: int = 2048) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score); ``is_anchor`` and ``label`` are columns of ``df``."""
    x = scaled(F.col(vec_col), scale)
    length2 = F.aggregate("x", F.lit(0.0), lambda acc, c: acc + c.cast("double") * c)
    rows = (df.where(usable(F.col(vec_col))).select(F.col(id_col).cast("long").alias("vec_id"), F.when(label.isNotNull(), F.xxhash64(label)).alias("label"),
                                                    F.coalesce(is_anchor, F.lit(False)).alias("anchor"), x.alias("x"))
            .where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("x") > 0) & (length2 < float(1 << 56)))
            .groupBy("vec_id", "label", "x").agg(F.count(F.lit(1)).alias("copies"), F.max("anchor").alias("anchor"))
            .withColumn("dim", F.size("x")).withColumn("key", F.xxhash64("vec_id", "label", "x")))
    rows = through_table(rows, "usable")
    anchors = rows.where("anchor").select("key", "vec_id", "label", "dim", "x", F.col("copies").alias("asked"))
    rows = rows.drop("anchor")

    def positive_heaps(left: pa.Table, right: pa.Table) -> pa.Table:
        """Each anchor's best rows of this tile; a row that is the anchor itself has one copy less."""
        own, ids, keys, copies = (right[c].to_numpy() for c in ("label", "vec_id", "key", "copies"))
        akeys = left["key"].to_numpy()

        def keep(at: int, scores: np.ndarray):
            mine = akeys[at: at + len(scores)]
            others = copies[None, :] - (mine[:, None] == keys[None, :])
            r, c = heap_of(scores, others > 0, positives)
            yield mine[r], ids[c], scores[r, c], np.minimum(others[r, c], positives)

        key, pid, score, n = (np.concatenate(p) for p in zip(*_tile(left, right, keep)))
        return pa.table({"key": np.repeat(key, n), "positive_id": np.repeat(pid, n), "positive_score": np.repeat(score, n)})

    found = _meet(anchors, rows, ["label", "dim"], block, positive_heaps, "key long, positive_id long, positive_score long")
    first = Window.partitionBy("key").orderBy(F.desc("positive_score"), "positive_id")
    found = found.withColumn("place", F.row_number().over(first)).where(F.col("place") <= positives)
    found = through_table(found, "positives")
    # the scores of an anchor's positives, one window for each; at most ``positives`` of them
    windows = found.groupBy("key").agg(F.sort_array(F.collect_set("positive_score")).alias("scores"))
    asked = anchors.join(windows, "key")

    def window_heaps(left: pa.Table, right: pa.Table) -> pa.Table:
        """The best rows of this tile inside each window of an anchor."""
        labels, ids, copies = (right[c].to_numpy() for c in ("label", "vec_id", "copies"))
        akeys, alabels = left["key"].to_numpy(), left["label"].to_numpy()
        bounds = np.full((len(left), positives), LEAST)
        for i, scores in enumerate(left["scores"].to_pylist()):
            bounds[i, : len(scores)] = scores

        def keep(at: int, scores: np.ndarray):
            mine, end = akeys[at: at + len(scores)], at + len(scores)
            differs = alabels[at:end, None] != labels[None, :]
            hundred = scores * 100
            for w in range(positives):
                p = bounds[at:end, w]
                open_ = p >= 0  # a negative score has no window
                top = np.where(open_, p, 0)[:, None]
                fits = differs & (hundred <= high * top) & (hundred >= low * top) & open_[:, None]
                r, c = heap_of(scores, fits, negatives)
                yield mine[r], p[r], ids[c], scores[r, c], np.minimum(copies[c], negatives)

        key, p, nid, score, n = (np.concatenate(q) for q in zip(*_tile(left, right, keep)))
        return pa.table({k: np.repeat(v, n) for k, v in (("key", key), ("positive_score", p), ("negative_id", nid),
                                                         ("negative_score", score))})

    hits = _meet(asked, rows, ["dim"], block, window_heaps,
                 "key long, positive_score long, negative_id long, negative_score long")
    best = Window.partitionBy("key", "positive_score").orderBy(F.desc("negative_score"), "negative_id")
    hits = hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= negatives)
    named = found.join(anchors.select("key", F.col("vec_id").alias("anchor_id"), "asked"), "key")
    out = named.join(hits, ["key", "positive_score"]).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "asked")))
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score",
                      "negative_score")
