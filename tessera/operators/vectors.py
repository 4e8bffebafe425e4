"""Vector search jobs (VEC-*) over stored embeddings.

Exact search: blocks of the corpus are matrices in Arrow; a block's scores are
one product, of which it keeps the k best of every query, and the blocks'
hits meet in a rank filter.  Search over lists partitions the corpus by nearest
centroid and reads, for every query, the lists that can hold a better hit.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.common import empty_arrow, join_on, meet_tiles, written
from tessera.operators.joins import cross


def _dbl(v) -> Column:
    c = F.col(v) if isinstance(v, str) else v
    return F.transform(c, lambda x: x.cast("double"))


def dot(a, b) -> Column:
    return F.aggregate(F.zip_with(_dbl(a), _dbl(b), lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def norm(a) -> Column:
    return F.sqrt(dot(a, a))


def l2(a, b) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(_dbl(a), _dbl(b), lambda x, y: (x - y) * (x - y)),
                              F.lit(0.0), lambda acc, x: acc + x))


def normalise(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """VEC-03: unit length; the zero vector stays all zeros."""
    n = norm(col)
    return df.withColumn(out or col, F.when(n == 0, _dbl(col)).otherwise(
        F.transform(_dbl(col), lambda x: x / n)))


#: Queries up to this number (and QUERY_BYTES) go to every task of the corpus scan as one matrix; more meet it in tiles.
QUERY_ROWS, QUERY_BYTES = 2048, 64 << 20
#: Rows of a tile's side.
TILE_ROWS = 4096


def _side(df: DataFrame, vec: str, name: str) -> DataFrame:
    """``df`` with usable vectors only, as doubles in column ``name``: neither the vector nor a component is NULL."""
    ok = F.col(vec).isNotNull() & ~F.exists(F.col(vec), lambda x: x.isNull())
    d = df.filter(F.coalesce(ok, F.lit(False))).withColumn("__v", _dbl(vec))
    return d.drop(vec).withColumnRenamed("__v", name)


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    return np.asarray(column.combine_chunks().flatten()).reshape(-1, dim)


def _product(metric: str, q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Scores of all pairs by one matrix product, high = close; undefined scores are -inf."""
    if metric == "l2":
        return -np.sqrt(np.maximum((q * q).sum(1)[:, None] + (c * c).sum(1)[None, :] - 2 * (q @ c.T), 0))
    s = q @ c.T
    if metric == "cosine":
        norms = np.sqrt((q * q).sum(1))[:, None] * np.sqrt((c * c).sum(1))[None, :]
        s = np.where(norms > 0, s / np.where(norms > 0, norms, 1), -np.inf)
    return np.where(np.isnan(s), -np.inf, s)


def _one_by_one(metric: str, q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Scores of pairs of rows, the same for equal rows wherever they stand; high = close."""
    if metric == "l2":
        return -np.sqrt(((q - c) ** 2).sum(1))
    s = (q * c).sum(1)
    return s / (np.sqrt((q * q).sum(1)) * np.sqrt((c * c).sum(1))) if metric == "cosine" else s


class KBest:
    """The k best rows of each query; ties by the rows' order."""

    def __init__(self, k: int):
        self.k = k

    def candidates(self, s: np.ndarray, slack: np.ndarray, rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        floor = np.partition(s, s.shape[1] - self.k, axis=1)[:, s.shape[1] - self.k] if s.shape[1] > self.k else np.full(len(s), -np.inf)
        return np.nonzero((s >= (floor - slack)[:, None]) & (s > -np.inf))

    def settle(self, q, r, score, rows: pa.Table) -> np.ndarray:
        order = np.lexsort((r, -score, q))
        mine = q[order]
        return order[np.arange(len(mine)) - np.searchsorted(mine, mine) < self.k]


class BestBy:
    """The best row of each query and value of ``by`` at ``least`` or above; ties by the rows' order."""

    def __init__(self, by: str, least: float):
        self.by, self.least = by, least

    def candidates(self, s: np.ndarray, slack: np.ndarray, rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        return np.nonzero(s >= self.least - slack[:, None])

    def settle(self, q, r, score, rows: pa.Table) -> np.ndarray:
        group = np.asarray(rows[self.by].combine_chunks().dictionary_encode(null_encoding="encode").indices)[r]
        order = np.lexsort((r, -score, group, q))
        order = order[score[order] >= self.least]
        first = np.ones(len(order), bool)
        first[1:] = (np.diff(q[order]) != 0) | (np.diff(group[order]) != 0)
        return order[first]


def _hits_of(q: pa.Table, rows: pa.Table, metric: str, pick, qid: str, cid: str, key: str | None, out: pa.Schema) -> list[pa.Table]:
    """Hits of the queries ``q`` among ``rows``; with ``key`` only between equal keys; by vector length."""
    parts = []
    rows = rows.sort_by(cid)
    split = lambda t, v: pd.DataFrame({"n": pc.list_value_length(t[v]).to_numpy(zero_copy_only=False),
                                       **({"key": t[key].to_pandas()} if key else {})})
    by = ["n", "key"] if key else ["n"]
    groups = split(q, "_q").groupby(by).indices
    for g, at in split(rows, "_c").groupby(by).indices.items():
        mine = groups.get(g)
        dim = int(g[0] if isinstance(g, tuple) else g)
        if mine is None or not dim:
            continue
        qs, rs = q.take(mine), rows.take(at)
        a, b = _matrix(qs["_q"], dim), _matrix(rs["_c"], dim)
        s = _product(metric, a, b)
        # the product rounds otherwise than the scores pair by pair, which decide
        size = np.ones(len(a)) if metric == "cosine" else np.sqrt((a * a).sum(1)) * np.sqrt((b * b).sum(1)).max()
        size = size if metric != "l2" else np.sqrt((a * a).sum(1)) + np.sqrt((b * b).sum(1)).max()
        i, j = pick.candidates(s, 1e-6 * size if metric == "l2" else 1e-9 * size, rs)
        score = _one_by_one(metric, a[i], b[j])
        best = pick.settle(i, j, score, rs)
        i, j, score = i[best], j[best], score[best]
        cols = {qid: qs[qid].take(i), **{c: rs[c].take(j) for c in rs.column_names if c not in ("_c", "__lt", "__rt")},
                "score": pa.array(-score if metric == "l2" else score)}
        parts.append(pa.table([cols[f.name] for f in out], names=out.names))
    return parts


def block_hits(queries: DataFrame, corpus: DataFrame, pick, metric: str = "cosine", qid: str = "qid", cid: str = "vec_id",
               qvec: str = "qvec", cvec: str = "embedding", key: str | None = None) -> DataFrame:
    """(qid, columns of the corpus but its vector, score): what ``pick`` keeps of every block's scores.

    A block's scores are one matrix product in Arrow.  Up to QUERY_ROWS queries
    go along with the corpus scan, which then needs no shuffle; more queries
    and the corpus meet in tiles.  Vectors that are NULL, hold NULL or (cosine)
    are all zero have no score and are no hits; only equal lengths are compared."""
    q = _side(queries.select(*dict.fromkeys([qid, qvec, *([key] if key else [])])), qvec, "_q")
    c = _side(corpus, cvec, "_c")
    fields = [q.schema[qid], *[f for f in c.schema if f.name != "_c"], T.StructField("score", T.DoubleType())]
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in fields])
    out = empty_arrow(schema).schema
    few = q.limit(QUERY_ROWS + 1).toArrow()
    if few.num_rows <= QUERY_ROWS and few.nbytes <= QUERY_BYTES:

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for t in _hits_of(few, pa.Table.from_batches([b]), metric, pick, qid, cid, key, out):
                    yield from t.to_batches()

        return c.mapInArrow(scan, schema)

    def tile(left: pa.Table, right: pa.Table) -> pa.Table:
        found = _hits_of(left, right, metric, pick, qid, cid, key, out)
        return pa.concat_tables(found) if found else out.empty_table()

    return meet_tiles(q, c, [key] if key else [], TILE_ROWS, tile, schema)


def _first_k(hits: DataFrame, k: int, metric: str, qid: str, cid: str) -> DataFrame:
    w = Window.partitionBy(qid).orderBy(F.col("score").asc() if metric == "l2" else F.col("score").desc(), F.col(cid))
    return hits.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def scores(queries: DataFrame, corpus: DataFrame, metric: str = "cosine", qid: str = "qid",
           cid: str = "vec_id", qvec: str = "qvec", cvec: str = "embedding", where: Column | None = None) -> DataFrame:
    """The score of every corpus row for every query, in blocks of the corpus."""
    q = queries.select(qid, F.col(qvec).alias("_q"), *([c for c in queries.columns if c not in (qid, qvec)]))
    c = corpus if where is None else corpus.filter(where)
    if metric == "cosine":
        q = q.withColumn("_qn", norm("_q"))
        c = c.withColumn("_cn", norm(cvec))
    j = cross(c, q)
    if metric == "cosine":
        score = F.try_divide(dot("_q", cvec), F.col("_qn") * F.col("_cn"))
    elif metric == "ip":
        score = dot("_q", cvec)
    else:
        score = l2("_q", cvec)
    return j.select(qid, cid, score.alias("score"), *[x for x in c.columns if x not in (cid, cvec, "_cn")])


def topk(queries: DataFrame, corpus: DataFrame, k: int, metric: str = "cosine", qid: str = "qid",
         cid: str = "vec_id", qvec: str = "qvec", cvec: str = "embedding", where: Column | None = None) -> DataFrame:
    """VEC-01/02: exact top-k per query: cosine (high = close), ip (inner
    product, high = close) or l2 (low = close).  Ties by corpus id.  Each block
    keeps its k best of every query; they meet in a rank filter."""
    c = corpus if where is None else corpus.filter(where)
    return _first_k(block_hits(queries, c, KBest(k), metric, qid, cid, qvec, cvec), k, metric, qid, cid)


def topk_filtered(queries, corpus, k, key: str, metric: str = "cosine", **kw):
    """VEC-04: metadata filter before ranking: each query only sees corpus
    rows with its own ``key`` value.  A hot key is many blocks or tiles."""
    qid, cid = kw.get("qid", "qid"), kw.get("cid", "vec_id")
    hits = block_hits(queries, corpus, KBest(k), metric, qid, cid, kw.get("qvec", "qvec"), kw.get("cvec", "embedding"), key)
    return _first_k(hits.select(qid, cid, key, "score"), k, metric, qid, cid)


def best_hits(queries: DataFrame, corpus: DataFrame, min_score: float, by: str, metric: str = "cosine", qid: str = "qid",
              cid: str = "vec_id", qvec: str = "qvec", cvec: str = "embedding") -> DataFrame:
    """VEC-06: the best hit of every (query, ``by``) with at least
    ``min_score``: a block keeps one row for each, no pair below the score or
    beside the best is formed as a row."""
    return cut_hits(block_hits(queries, corpus, BestBy(by, min_score), metric, qid, cid, qvec, cvec), min_score, by, qid, cid)


def cut_hits(hits: DataFrame, min_score: float, by: str, qid: str = "qid", cid: str = "vec_id") -> DataFrame:
    """VEC-06: drop hits under the score, keep the best hit per (query, by):
    one map-side combined aggregate, no rank over a query's hits."""
    rest = [c for c in hits.columns if c not in (qid, by, "score", cid)]
    best = hits.filter(F.col("score") >= min_score).groupBy(qid, by).agg(
        F.min(F.struct((-F.col("score")).alias("_neg"), cid, "score", *rest)).alias("_b"))
    return best.select(*[F.col(c) if c in (qid, by) else F.col(f"_b.{c}").alias(c) for c in hits.columns])


def _unit_rows(df: DataFrame, vec: str, out: str, keep: str) -> DataFrame:
    """(keep, out): unit vectors of the rows that have a direction; lengths may differ."""
    d = _side(df.select(keep, vec), vec, out).select(keep, out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes = pc.list_value_length(b.column(1)).to_numpy(zero_copy_only=False)
            for n in np.unique(sizes[sizes > 0]):
                at = np.flatnonzero(sizes == n)
                x = _matrix(pa.chunked_array([b.column(1).take(pa.array(at))]), int(n))
                length = np.sqrt((x * x).sum(1))
                some = length > 0
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at[some])),
                                                  pa.array(list(x[some] / length[some][:, None]), pa.list_(pa.float64()))],
                                                 names=[keep, out])

    return d.mapInArrow(run, d.schema)


@dataclass
class IvfIndex:
    """Unit vectors by nearest centroid: ``rows`` (cid, _u, list_id) written in the checkpoint folder, every row of the corpus
    with a direction; ``centroids``, ``radius`` and ``size`` by list."""

    rows: DataFrame
    centroids: np.ndarray
    radius: np.ndarray
    size: np.ndarray
    cid: str


def build_ivf(corpus: DataFrame, lists: int, cid: str = "vec_id", cvec: str = "embedding", seed: int = 7,
              fit_rows: int = 100_000) -> IvfIndex:
    """VEC-05: k-means centroids (MLlib) fitted on about ``fit_rows`` unit
    vectors, drawn by a hash of the row; every row is assigned and indexed.  All
    vectors have one length.  A list's radius is the distance of its farthest row, so that no row lies
    outside its list's ball."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    unit = written(_unit_rows(corpus, cvec, "_u", cid), "unit-vectors")
    n = unit.count()
    if not n:
        return IvfIndex(unit.withColumn("list_id", F.lit(0)), np.zeros((0, 0)), np.zeros(0), np.zeros(0, np.int64), cid)
    drawn = unit.filter(F.pmod(F.xxhash64(cid, "_u"), F.lit(1_000_000)) < min(1.0, fit_rows / n) * 1_000_000)
    model = KMeans(k=lists, seed=seed, featuresCol="_f", maxIter=20).fit(drawn.withColumn("_f", array_to_vector("_u")))
    cents = np.array(model.clusterCenters())  # ``lists`` rows
    schema = T.StructType([*unit.schema, T.StructField("list_id", T.IntegerType()), T.StructField("_far", T.DoubleType())])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            u = _matrix(pa.chunked_array([b.column(1)]), cents.shape[1])
            near = (u @ cents.T - 0.5 * (cents * cents).sum(1)).argmax(1).astype(np.int32)
            far = np.sqrt(((u - cents[near]) ** 2).sum(1))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(near), pa.array(far)], names=schema.names)

    rows = written(unit.mapInArrow(assign, schema), "ivf-lists")
    radius, size = np.zeros(len(cents)), np.zeros(len(cents), np.int64)
    for r in rows.groupBy("list_id").agg(F.max("_far").alias("r"), F.count(F.lit(1)).alias("n")).collect():
        radius[r.list_id], size[r.list_id] = r.r, r.n
    return IvfIndex(rows.drop("_far"), cents, radius, size, cid)


def search_ivf(queries: DataFrame, index: IvfIndex, k: int, probes: int = 1, qid: str = "qid",
               qvec: str = "qvec") -> tuple[DataFrame, DataFrame]:
    """VEC-05: cosine top-k over the lists, and what it cost: (qid, probes, rows_read).

    Lists are taken by the distance of their centroids, first ``probes`` of
    them, then twice as many in every round.  By the triangle inequality no row
    of a list is nearer than the centroid's distance less the list's radius: a
    list whose bound lies beyond the k-th hit so far is not read.  So no hit is
    missed, and the number of rounds is logarithmic in the lists."""
    lists, cents, radius = len(index.centroids), index.centroids, index.radius
    unit = _unit_rows(queries, qvec, "_qu", qid)
    plan = "array<struct<list_id:int,bound:double>>"
    schema = T.StructType([*unit.schema, T.StructField("_plan", T.ArrayType(T.StructType.fromDDL("list_id int, bound double")))])

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            u = _matrix(pa.chunked_array([b.column(1)]), cents.shape[1])
            gap = np.sqrt(((u[:, None, :] - cents[None]) ** 2).sum(2))
            bound = np.maximum(gap - radius - 1e-9, 0)  # less than any rounding of the distances
            plans = [[{"list_id": int(i), "bound": float(x[i])} for i in np.argsort(g, kind="stable")] for g, x in zip(gap, bound)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(plans, pa.list_(pa.struct([("list_id", pa.int32()), ("bound", pa.float64())])))],
                                             names=schema.names)

    q = unit.mapInArrow(rank, schema) if lists else unit.withColumn("_plan", F.array().cast(plan))
    q = written(q, "ivf-queries")
    sizes = F.array(*[F.lit(int(n)) for n in index.size]) if lists else F.array().cast("array<int>")
    hits, cost, done, step = None, None, 0, max(1, probes)
    while done < max(lists, 1):
        todo = q.select(qid, "_qu", F.explode(F.slice("_plan", done + 1, step)).alias("_l")).select(qid, "_qu", "_l.*")
        if hits is not None:
            kth = hits.groupBy(qid).agg(F.count(F.lit(1)).alias("_n"), F.min("score").alias("_s"))
            far = F.sqrt(F.greatest(2 - 2 * F.col("_s"), F.lit(0.0)))
            todo = join_on(todo, kth, [qid], "left").filter((F.coalesce("_n", F.lit(0)) < k) | (F.col("bound") <= far)).drop("_n", "_s")
        todo = written(todo, "ivf-probes")
        done, step = done + step, step * 2
        if hits is not None and todo.isEmpty():
            continue
        new = block_hits(todo.drop("bound"), index.rows, KBest(k), "ip", qid, index.cid, "_qu", "_u", "list_id").select(qid, index.cid, "score")
        hits = _first_k(new if hits is None else hits.unionByName(new), k, "ip", qid, index.cid).drop("rank")
        hits = written(hits, "ivf-hits")
        spent = todo.select(qid, F.get(sizes, F.col("list_id")).cast("long").alias("_r"))
        cost = spent if cost is None else cost.unionByName(spent)
    cost = cost.groupBy(qid).agg(F.count(F.lit(1)).alias("probes"), F.sum("_r").alias("rows_read"))
    return _first_k(hits, k, "ip", qid, index.cid), cost


def topk_ivf(queries: DataFrame, corpus: DataFrame, k: int, lists: int, probes: int = 1, seed: int = 7,
             qid: str = "qid", cid: str = "vec_id", qvec: str = "qvec", cvec: str = "embedding") -> DataFrame:
    """VEC-05: ``search_ivf`` over an index built for this search."""
    return search_ivf(queries, build_ivf(corpus, lists, cid, cvec, seed), k, probes, qid, qvec)[0]


def recall(approx: DataFrame, exact: DataFrame, qid: str = "qid", cid: str = "vec_id") -> DataFrame:
    """VEC-05: per-query recall of an approximate result against exact."""
    hit = exact.join(approx.select(qid, cid), [qid, cid], "left_semi").groupBy(qid).agg(F.count(F.lit(1)).alias("_h"))
    tot = exact.groupBy(qid).agg(F.count(F.lit(1)).alias("_n"))
    return tot.join(hit, qid, "left").select(qid, (F.coalesce("_h", F.lit(0)) / F.col("_n")).alias("recall"))


def refresh_vectors(base: DataFrame, delta: DataFrame, id_col: str, delete_flag: str | None = None) -> DataFrame:
    """VEC-07: add, replace and delete vectors by id (upsert)."""
    from tessera.sources.loads import upsert
    return upsert(base, delta, [id_col], delete_flag)


def reduce_dim(df: DataFrame, col: str, d: int, out: str = "reduced") -> DataFrame:
    """VEC-08: PCA to ``d`` dimensions (MLlib, distributed fit)."""
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector, vector_to_array
    v = df.withColumn("_f", array_to_vector(_dbl(col)))
    model = PCA(k=d, inputCol="_f", outputCol="_p").fit(v)
    return model.transform(v).withColumn(out, vector_to_array("_p")).drop("_f", "_p")
