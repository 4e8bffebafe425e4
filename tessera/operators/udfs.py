"""UDF, UDAF and UDTF surface (UDF-*).

Built-in functions come first; when a computation is not expressible, the
Arrow-batched forms are used: a scalar ``pandas_udf`` for row mappers, a
grouped-aggregate ``pandas_udf`` for reducers, a Python UDTF for flat maps.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.common import small_batches, text_steps


def map_rows(df: DataFrame, fn: Callable[[pd.Series], pd.Series], col: str, return_type: str,
             out: str | None = None) -> DataFrame:
    """UDF-01: vectorised per-row mapper (pandas Series in, Series out)."""
    udf = F.pandas_udf(fn, return_type)
    return df.withColumn(out or col, udf(F.col(col)))


def flat_map(df: DataFrame, col: str, fn: Callable[[str], list], element_type: str = "string",
             out: str = "item") -> DataFrame:
    """UDF-02: one value to many rows: a vectorised list mapper, then explode.
    A few texts' lists at a time go back, never those of a whole batch."""
    def lists(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            held = s.tolist()
            for a, z in text_steps([v if isinstance(v, str) else "" for v in held]):
                yield pd.Series([list(fn(v)) if v is not None else [] for v in held[a:z]], dtype=object)

    udf = F.pandas_udf(lists, f"array<{element_type}>")
    return small_batches(df).withColumn(out, F.explode(udf(F.col(col))))


def reduce_by(df: DataFrame, key, col: str, fn: Callable[[pd.Series], float], return_type: str = "double",
              out: str = "value") -> DataFrame:
    """UDF-03: user reducer per key over all of a group's values at once
    (grouped-aggregate pandas UDF), for groups that are small by nature;
    ``reduce_mergeable`` takes groups of any size."""
    udf = F.pandas_udf(fn, return_type)
    return df.groupBy(key).agg(udf(F.col(col)).alias(out))


@dataclass(frozen=True)
class Reducer:
    """A user reducer that combines.  ``add(values)`` reduces a pandas Series of
    one key's values to a state (a tuple of ``state``, a DDL of its fields),
    ``merge(a, b)`` joins two states and ``finish(state)`` gives the result.
    ``merge`` must be associative and commutative, so that the result does not
    depend on how the rows are split."""

    state: str
    add: Callable[[pd.Series], tuple]
    merge: Callable[[tuple, tuple], tuple]
    finish: Callable[[tuple], object]


#: States that a task holds before it sends them on.
STATES = 100_000


def reduce_mergeable(df: DataFrame, key: str, col: str, reducer: Reducer, return_type: str = "double",
                     out: str = "value") -> DataFrame:
    """UDF-03: user reducer combined on the map side.  Every task adds its own
    values to states (at most STATES, then they are sent on), so a hot key is
    reduced where its rows are, and its states, a few for each task, are merged
    as a stream in key order.  A group's values never meet in one call."""
    own = df.select(F.col(key).alias("k"), F.col(col).alias("v"))
    fields = T.StructType.fromDDL(reducer.state)
    states = T.StructType([own.schema["k"], *fields])
    names = [f.name for f in fields]
    missing = object()  # a NULL key is a key

    def rows(held: dict) -> pd.DataFrame:
        return pd.DataFrame([(None if k is missing else k, *s) for k, s in held.items()], columns=["k", *names]).astype(object)

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict = {}
        for b in batches:
            for k, v in b.groupby("k", dropna=False)["v"]:
                k = missing if pd.isna(k) else k
                s = reducer.add(v)
                held[k] = reducer.merge(held[k], s) if k in held else s
            if len(held) > STATES:
                yield rows(held)
                held = {}
        yield rows(held)

    def final(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, state = None, None
        done: list = []
        for b in batches:
            for k, *s in b[["k", *names]].itertuples(index=False, name=None):
                k = missing if pd.isna(k) else k
                if state is not None and k == at:
                    state = reducer.merge(state, tuple(s))
                    continue
                if state is not None:
                    done.append((None if at is missing else at, reducer.finish(state)))
                at, state = k, tuple(s)
            yield pd.DataFrame(done, columns=[key, out]).astype(object)
            done = []
        if state is not None:
            yield pd.DataFrame([(None if at is missing else at, reducer.finish(state))], columns=[key, out]).astype(object)

    parts = own.mapInPandas(partial, states).repartition("k").sortWithinPartitions("k")
    result = T.StructType([T.StructField(key, own.schema["k"].dataType),
                           T.StructField(out, T.StructType.fromDDL(f"x {return_type}")["x"].dataType)])
    return parts.mapInPandas(final, result)


def pipeline(df: DataFrame, *steps: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """UDF-05: chain of DataFrame -> DataFrame steps (``DataFrame.transform``)."""
    for step in steps:
        df = df.transform(step)
    return df
