"""Exact top-k by inner product without random access.

Components become integers, floor(scale * x).  The rows are dealt by hash into
slabs and the queries into groups; each (group, slab) is one stream that sees
its queries first and then its rows, block by block.  A block keeps one sorted
list per dimension.  For a query, list d is read from its greatest value down
if the query's component is positive, from its least value up if it is
negative.  What has been read gives every row a lower bound (unread components
at the far end of their list) and an upper bound (unread components at the
last value read).  Reading stops when no outsider's upper bound reaches the
k-th lower bound, or the k-th score of earlier blocks; until so few rows are
left that their final scores can be resolved, all lists are read deeper.  The
bounds of all queries and rows of a block are one matrix product over the
positive and negative parts of the queries.  The streams' answers meet in one
rank filter per query.

Defined cases: vectors that are null or hold a null, NaN or infinite component
take no part, nor do null ids; rows that repeat an id are rows of their own, as
candidates and as queries (a query meets the other rows of its id); only vectors
of equal length are compared; ties go to the smaller id; other columns are not
read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import map_arrow, through_table

#: Shares of each list that are read before the bounds are looked at.
DEPTHS = (0.75, 0.9375, 1.0)
#: Rows of a block; a stream's first block is small and read to its end, which gives the first k-th scores.
FIRST_BLOCK, BLOCK = 1024, 2048
#: Share of a block's scores that may be left to resolve.
RESOLVE = 0.05


def as_integers(df: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """(vec_id, x, dim, key): the usable rows, with their components as integers and a number of their own."""
    usable = F.col(vec_col).isNotNull() & F.col(id_col).isNotNull() & ~F.exists(
        F.col(vec_col), lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    x = F.transform(F.col(vec_col), lambda c: F.floor(c.cast("double") * scale))
    return (df.where(usable).select(F.col(id_col).alias("vec_id"), x.alias("x"))
            .withColumn("dim", F.size("x")).withColumn("key", F.monotonically_increasing_id()))


class Stream:
    """The k best rows so far of each query of one group."""

    def __init__(self, ids: np.ndarray, keys: np.ndarray, queries: np.ndarray, k: int):
        self.ids, self.keys, self.queries, self.k = ids, keys, queries, k
        n = len(ids)
        self.scores = np.full((n, k), np.iinfo(np.int64).min)
        self.found = np.full((n, k), np.iinfo(np.int64).max)
        self.seen = np.zeros(n, np.int64)

    def _kind(self, rows: np.ndarray):
        """The first type that holds every sum exactly: float32, float64, int64."""
        most = lambda a: int(np.abs(a).max()) if a.size else 0
        bound = most(self.queries) * most(rows) * max(rows.shape[1], 1)
        return np.float32 if bound < 1 << 24 else np.float64 if bound < 1 << 53 else np.int64

    def add(self, ids: np.ndarray, keys: np.ndarray, rows: np.ndarray) -> None:
        kind = self._kind(rows)
        wide, never = (np.int64, np.iinfo(np.int64).min) if kind is np.int64 else (np.float64, -np.inf)
        n, k = len(ids), self.k
        order = np.sort(rows, axis=0)
        rank = np.empty(rows.shape, np.int32)
        np.put_along_axis(rank, np.argsort(rows, axis=0, kind="stable"), np.arange(n, dtype=np.int32)[:, None], axis=0)
        queries = np.hstack([np.maximum(self.queries, 0), np.minimum(self.queries, 0)]).astype(kind)
        own_q, own_r = np.nonzero(self.keys[:, None] == keys[None, :])
        full = self.seen >= k
        last = np.where(full, self.scores[:, -1], never).astype(wide)
        last_id = np.where(full, self.found[:, -1], np.iinfo(np.int64).max)
        depths = (1.0,) if not self.seen.any() else DEPTHS
        for depth in depths:
            read = n if depth == 1.0 else max(1, int(depth * n))
            from_top, from_bottom = rank >= n - read, rank < read
            upper = queries @ np.hstack([np.where(from_top, rows, order[n - read]),
                                         np.where(from_bottom, rows, order[read - 1])]).astype(kind).T
            upper[own_q, own_r] = never
            floor = last
            if read == n:
                lower = upper
            else:
                lower = queries @ np.hstack([np.where(from_top, rows, order[0]),
                                             np.where(from_bottom, rows, order[-1])]).astype(kind).T
                lower[own_q, own_r] = never
            if n > k:
                floor = np.maximum(floor, np.partition(lower, n - k, axis=1)[:, n - k].astype(wide))
            upper_bound = upper.astype(np.float64) if kind is np.float64 else upper
            can = upper_bound >= floor[:, None].astype(upper_bound.dtype)
            # a row that only ties with the k-th score so far needs the smaller id
            can &= (upper_bound > last[:, None].astype(upper_bound.dtype)) | (ids[None, :] < last_id[:, None])
            can &= upper_bound > never
            if read == n or np.count_nonzero(can) <= max(RESOLVE * can.size, 4 * k * len(self.ids)):
                break
        q, r = np.nonzero(can)
        for at in range(0, len(q), 1 << 18):
            a, b = q[at: at + (1 << 18)], r[at: at + (1 << 18)]
            exact = upper[a, b].astype(np.int64) if read == n else np.einsum("ij,ij->i", self.queries[a], rows[b])
            self._merge(a, ids[b], exact)

    def _merge(self, q: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        if not len(q):
            return
        touched = np.unique(q)
        held_q, held_at = np.nonzero(np.arange(self.k)[None, :] < self.seen[touched, None])
        held_q = touched[held_q]
        q = np.concatenate([q, held_q])
        ids = np.concatenate([ids, self.found[held_q, held_at]])
        scores = np.concatenate([scores, self.scores[held_q, held_at]])
        order = np.lexsort((ids, -scores, q))
        q, ids, scores = q[order], ids[order], scores[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        keep = place < self.k
        q, ids, scores, place = q[keep], ids[keep], scores[keep], place[keep]
        self.found[q, place], self.scores[q, place] = ids, scores
        self.seen[touched] = np.bincount(np.searchsorted(touched, q), minlength=len(touched))

    def result(self) -> pa.RecordBatch:
        q, at = np.nonzero(np.arange(self.k)[None, :] < self.seen[:, None])
        return pa.RecordBatch.from_arrays([pa.array(self.keys[q]), pa.array(self.ids[q]), pa.array(self.found[q, at]), pa.array(self.scores[q, at])],
                                          names=["key", "query_id", "vec_id", "score"])


def _streams(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows arrive sorted by stream (part, dim), queries (kind 0) before rows (kind 1)."""
        now, stream, held_rows, size = None, None, [], 0

        def block():
            nonlocal held_rows, size
            out = tuple(map(np.concatenate, zip(*held_rows))) if held_rows else None
            held_rows, size = [], 0
            return out

        def begin():
            """The queries are complete."""
            held = block()
            return Stream(*held, k) if held is not None else None

        def feed():
            held = block()
            if stream is not None and held is not None:
                for at in range(0, len(held[0]), BLOCK):
                    stream.add(*(x[at: at + BLOCK] for x in held))

        kind_now = 0
        for b in batches:
            part, dim, kind = (b.column(i).to_numpy() for i in range(3))
            cuts = np.flatnonzero((np.diff(part) != 0) | (np.diff(dim) != 0) | (np.diff(kind) != 0)) + 1
            for a, z in zip([0, *cuts], [*cuts, len(b)]):
                if a == z:
                    continue
                key = (part[a], dim[a])
                if key != now:
                    if kind_now == 1:
                        feed()
                        if stream is not None:
                            yield stream.result()
                    block()  # queries without rows
                    now, stream, kind_now = key, None, 0
                if kind[a] == 1 and kind_now == 0:
                    stream, kind_now = begin(), 1
                values = b.column(4).slice(a, z - a).flatten().to_numpy(zero_copy_only=False).reshape(z - a, int(dim[a]))
                own = b.column(3).slice(a, z - a).to_numpy()
                keys = b.column(5).slice(a, z - a).to_numpy()
                if kind_now == 0:
                    held_rows.append((own, keys, values))
                    continue
                at = 0
                while at < len(own):
                    most = FIRST_BLOCK if stream is not None and not stream.seen.any() else BLOCK
                    step = min(len(own) - at, most - size)
                    held_rows.append(tuple(x[at: at + step] for x in (own, keys, values)))
                    size += step
                    at += step
                    if size >= most:
                        feed()
        if kind_now == 1:
            feed()
            if stream is not None:
                yield stream.result()

    return run


def top_k(df: DataFrame, is_query, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 20, scale: int = 64,
          group_queries: int = 2048, slab_rows: int = 8192) -> DataFrame:
    """The k best rows of every query: query_id, rank (from 1), vec_id, score.

    ``is_query``: a condition on ``vec_id``.  A query meets every row but its own; each row of a repeated id is a query.
    """
    rows = through_table(as_integers(df, id_col, vec_col, scale), "vectors")
    queries = rows.where(is_query)
    groups = max(1, math.ceil(queries.count() / group_queries))
    slabs = max(1, math.ceil(rows.count() / slab_rows))

    def all_of(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    q = (queries.withColumn("g", F.pmod(F.xxhash64("key", F.lit(1)), F.lit(groups)).cast("int"))
         .withColumn("s", all_of(slabs)).withColumn("kind", F.lit(0)))
    r = (rows.withColumn("s", F.pmod(F.xxhash64("key", F.lit(2)), F.lit(slabs)).cast("int"))
         .withColumn("g", all_of(groups)).withColumn("kind", F.lit(1)))
    both = q.unionByName(r).select((F.col("g").cast("long") * slabs + F.col("s")).alias("part"), "dim", "kind", "vec_id", "x", "key")
    both = both.repartition(groups * slabs, "part").sortWithinPartitions("part", "dim", "kind", "vec_id")
    streams = map_arrow(both, _streams(k), "key long, query_id long, vec_id long, score long")
    best = Window.partitionBy("key").orderBy(F.desc("score"), "vec_id")
    return (streams.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
