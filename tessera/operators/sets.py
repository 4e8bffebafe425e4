"""Set operations and row identity (SET-*)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.common import _cols


def union(a: DataFrame, b: DataFrame, distinct: bool = False) -> DataFrame:
    """SET-01: UNION ALL by column name, or UNION (distinct)."""
    u = a.unionByName(b)
    return u.distinct() if distinct else u


def intersect(a: DataFrame, b: DataFrame, all_: bool = False) -> DataFrame:
    """SET-02: INTERSECT [ALL]."""
    return a.intersectAll(b) if all_ else a.intersect(b)


def except_all(a: DataFrame, b: DataFrame, distinct: bool = False) -> DataFrame:
    """SET-03: rows of ``a`` not in ``b`` (multiset EXCEPT ALL, or EXCEPT)."""
    return a.subtract(b) if distinct else a.exceptAll(b)


def distinct(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """SET-04: distinct rows (of a projection)."""
    return (df.select(*cols) if cols else df).distinct()


def first_per(df: DataFrame, by, order: Sequence) -> DataFrame:
    """SET-04: DISTINCT ON (by) ... ORDER BY order -> first row per group."""
    w = Window.partitionBy(*_cols(by)).orderBy(*_cols(order))
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def dedup_latest(df: DataFrame, key, ts: str, tie: str | None = None) -> DataFrame:
    """SET-05: keep the latest row per key (explicit tie column); never
    ``dropDuplicates`` when the kept row matters."""
    order = [F.col(ts).desc()] + ([F.col(tie).desc()] if tie else [])
    return first_per(df, key, order)


def dedup_symmetric(df: DataFrame, a: str, b: str, extra: Sequence[str], order: Sequence) -> DataFrame:
    """SET-06: (a, b, extra) equals (b, a, extra): keep the first by ``order``."""
    lo, hi = F.least(a, b), F.greatest(a, b)
    w = Window.partitionBy(lo, hi, *[F.col(c) for c in extra]).orderBy(*_cols(order))
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def ordered_distinct(col: str | Column) -> Column:
    """SET-07: distinct elements of a list, first-seen order kept."""
    return F.array_distinct(F.col(col) if isinstance(col, str) else col)


def duplicate_rows(df: DataFrame, out: str = "n") -> DataFrame:
    """SET-08: full-row duplicates with their multiplicity."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(out)).filter(F.col(out) > 1)
