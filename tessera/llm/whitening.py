"""Whitening of embeddings by the leading eigenpairs of their covariance.

Components become integers, floor(scale * c) + offset.  The fit list is every
distinct vector once, so that copies do not pull the axes.  Its sums and the
products of its centred vectors are exact integers: every task adds up its
batches, and tasks' sums are added where rows of the matrix are dealt to.  The
covariance is their exact quotient, rounded once.  Its leading eigenpairs come
from ``spectrum`` on the driver, which holds dim * dim numbers and no row.  A
last pass projects all rows.

Defined cases: vectors that are null or hold a null, a NaN, an infinity or a
component of 2^40 or more take no part; an empty vector has no component and
gives no row; vectors of different lengths are whitened apart, each length by
its own fit; rows that repeat an id or a vector each get their rows; a null id
stays null.  Components whose eigenvalue is below 1e-12 of the trace are
rounding and are not returned, so a fit list of one vector gives no rows, nor
does an empty table.  Equal eigenvalues have any orthonormal basis of their
space as components.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import fresh_name, map_arrow, through_table
from tessera.llm.spectrum import leading_eigenpairs
from tessera.llm.vectors import matrices, scaled, usable

EXACT = pa.decimal128(38, 0)
#: Eigenvalues below this share of the trace are not told from rounding.
LEAST_SHARE = 1e-12
_PARTS = "dim int, i int, part array<decimal(38,0)>"


class Sums:
    """Exact integer sums by (dim, i); int64 while they fit."""

    def __init__(self):
        self.small: dict[tuple[int, int], tuple[int, np.ndarray]] = {}
        self.large: dict[tuple[int, int], np.ndarray] = {}

    def add(self, key: tuple[int, int], values: np.ndarray, bound: int) -> None:
        """Add an array whose entries are at most ``bound`` in size."""
        if bound >= 1 << 62:
            self.large[key] = self.large.get(key, 0) + values.astype(object)
            return
        most, held = self.small.get(key, (0, None))
        if most + bound >= 1 << 62:
            self.large[key] = self.large.get(key, 0) + held.astype(object)
            most, held = 0, None
        self.small[key] = (most + bound, values.astype(np.int64) if held is None else held + values.astype(np.int64))

    def batches(self) -> Iterator[pa.RecordBatch]:
        for key in sorted({*self.small, *self.large}):
            total = self.large.get(key, 0) + self.small.get(key, (0, np.int64(0)))[1].astype(object)
            rows = total if total.ndim == 2 else total[None]
            for i, row in enumerate(rows):
                at = i if total.ndim == 2 else key[1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key[0]], pa.int32()), pa.array([at], pa.int32()), pa.array([list(row)], pa.list_(EXACT))],
                    names=["dim", "i", "part"])


def _largest(x: np.ndarray) -> int:
    return int(np.abs(x).max()) if x.size else 0


def _gram(y: np.ndarray) -> tuple[np.ndarray, int]:
    """y' y exactly, and a bound of its entries."""
    bound = _largest(y) ** 2 * len(y)
    if bound < 1 << 53:
        f = y.astype(np.float64)
        return (f.T @ f).astype(np.int64), bound
    y = y if bound < 1 << 62 else y.astype(object)
    return y.T @ y, bound


def _totals(rows: DataFrame, add) -> dict[tuple[int, int], list[int]]:
    """{(dim, i): exact sums} over all rows: by task, then by (dim, i); a part is one row of a matrix."""

    def by_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = Sums()
        for b in batches:
            for _, x in matrices(b.column(0)):
                add(sums, x)
        yield from sums.batches()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = Sums()
        for b in batches:
            for dim, i, part in zip(*(b.column(c).to_pylist() for c in range(3))):
                sums.add((dim, i), np.array([int(v) for v in part], object), 1 << 62)
        yield from sums.batches()

    parts = map_arrow(rows, by_task, _PARTS).repartition("dim", "i")
    return {(r.dim, r.i): [int(v) for v in r.part] for r in map_arrow(parts, merge, _PARTS).collect()}


@dataclass
class Axes:
    """The fit of one vector length."""

    n: int
    sums: list[int]
    trace: float
    values: np.ndarray
    vectors: np.ndarray
    identity_error: float = 0.0

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n * x - sums; int64 if it fits."""
        if (_largest(x) + 1) * self.n + max(map(abs, self.sums)) < 1 << 62:
            return x * np.int64(self.n) - np.array(self.sums, np.int64)
        return x.astype(object) * self.n - np.array(self.sums, object)

    def white(self, deviations: np.ndarray) -> np.ndarray:
        centred = (deviations / self.n).astype(np.float64)
        return (centred @ self.vectors) / np.sqrt(self.values)


def covariances(rows: DataFrame) -> dict[int, tuple[int, list[int], np.ndarray]]:
    """Length -> (n, sums, covariance) of rows (x array<long>); exact but for one rounding an entry."""

    def add_sums(sums: Sums, x: np.ndarray) -> None:
        total = np.concatenate([[len(x)], x.sum(axis=0)])  # components are below 2^47, batches of few rows
        sums.add((x.shape[1], -1), total, _largest(x) * len(x) + len(x))

    totals = {dim: (v[0], v[1:]) for (dim, _), v in _totals(rows, add_sums).items() if dim > 0}
    # the integers next to the means: what is left of the centring is below one and exact on the driver
    near = {dim: [(2 * s + n) // (2 * n) for s in sums] for dim, (n, sums) in totals.items()}
    centres = {dim: np.array(c, np.int64) for dim, c in near.items()}

    def add_products(sums: Sums, x: np.ndarray) -> None:
        if x.shape[1] in centres:
            products, bound = _gram(x - centres[x.shape[1]])
            sums.add((x.shape[1], 0), products, bound)

    products = _totals(rows, add_products)
    out = {}
    for dim, (n, sums) in totals.items():
        rest = [s - n * c for s, c in zip(sums, near[dim])]
        out[dim] = (n, sums, np.array([[(n * products[dim, i][j] - rest[i] * rest[j]) / (n * n) for j in range(dim)]
                                       for i in range(dim)]))
    return out


def fit(rows: DataFrame, components: int) -> dict[int, Axes]:
    """The axes of every vector length of ``rows`` (x array<long>, distinct)."""
    axes = {}
    for dim, (n, sums, covariance) in covariances(rows).items():
        trace = float(np.trace(covariance))
        values, vectors = leading_eigenpairs(covariance, components, LEAST_SHARE * trace)
        axes[dim] = Axes(n, sums, trace, values, vectors)
    return axes


def identity_errors(rows: DataFrame, axes: dict[int, Axes]) -> dict[int, float]:
    """Largest entry of the whitened fit list's covariance minus the identity, by length.

    Every batch centres its vectors before it multiplies them; counts, means
    and centred products merge, by task and then by length.
    """
    moments = "dim int, n long, mean array<double>, products array<double>"

    def merged(a, b):
        if a is None:
            return b
        n, gap = a[0] + b[0], b[1] - a[1]
        return n, a[1] + gap * (b[0] / n), a[2] + b[2] + np.outer(gap, gap) * (a[0] * b[0] / n)

    def emit(held: dict) -> Iterator[pa.RecordBatch]:
        for dim, (n, mean, products) in sorted(held.items()):
            yield pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), pa.array([n], pa.int64()), pa.array([list(mean)]),
                                              pa.array([list(products.ravel())])], names=["dim", "n", "mean", "products"])

    def by_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for b in batches:
            for _, x in matrices(b.column(0)):
                if (a := axes.get(x.shape[1])) and len(a.values):
                    w = a.white(a.deviations(x))
                    centred = w - w.mean(axis=0)
                    held[x.shape[1]] = merged(held.get(x.shape[1]), (len(w), w.mean(axis=0), centred.T @ centred))
        yield from emit(held)

    def by_length(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for b in batches:
            for dim, n, mean, products in zip(*(c.to_pylist() for c in b.columns)):
                held[dim] = merged(held.get(dim), (n, np.array(mean), np.array(products).reshape(len(mean), -1)))
        yield from emit(held)

    parts = map_arrow(rows, by_task, moments).repartition("dim")  # one small row for each task
    return {r.dim: float(np.abs(np.array(r.products).reshape(len(r.mean), -1) / r.n - np.eye(len(r.mean))).max())
            for r in map_arrow(parts, by_length, moments).collect()}


def whiten(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = 16, scale: int = 64,
           offset: int = 1_000_000) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) of every usable row and leading component.

    ``deviation`` is exact, as decimal(38,0).
    """
    x = fresh_name(df, "x")
    rows = df.where(usable(F.col(vec_col))).select(id_col, scaled(F.col(vec_col), scale, offset).alias(x))
    fit_list = through_table(rows.select(x).distinct(), "fit-list")
    axes = fit(fit_list, components)
    for dim, worst in identity_errors(fit_list, axes).items():
        axes[dim].identity_error = worst
    kind = rows.schema[0].dataType.simpleString()
    names = [id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, v in matrices(b.column(1)):
                a = axes.get(v.shape[1])
                if a is None or not len(a.values):
                    continue
                y, k = a.deviations(v), len(a.values)
                squares = (y if _largest(y) ** 2 * v.shape[1] < 1 << 62 else y.astype(object)) ** 2
                deviation = pa.array([int(s) for s in squares.sum(axis=1)], EXACT)
                owner = pa.array(np.repeat(np.arange(len(v)), k))
                each = [np.tile(c, len(v)) for c in (np.arange(1, k + 1, dtype=np.int32), np.full(k, a.n, np.int64),
                                                     a.values / a.trace, np.full(k, a.identity_error))]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(at)).take(owner), pa.array(each[0]), pa.array(each[1]),
                     deviation.take(owner), pa.array(a.white(y).ravel()), pa.array(each[2]), pa.array(each[3])], names=names)

    return map_arrow(rows, project, f"`{id_col}` {kind}, component int, n long, deviation decimal(38,0), whitened double, "
                                    "explained double, identity_error double")
