"""Single list of checked queries.

Every registered query is a function ``(spark, sf_dir) -> DataFrame`` that
reads the driver tables and calls library operators; ``oracle`` is the same
question in DuckDB SQL over the same tables (or ``None`` when the result is
random, file-shaped or procedural and is covered by property tests).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    key: str
    op_id: str
    build: Callable[[SparkSession, str], DataFrame]
    oracle: str | None


def hash_sql(*exprs: str) -> str:
    """DuckDB form of ``functions.scalars.hash_key`` over ``exprs``."""
    texts = [f"CAST({e} AS VARCHAR)" for e in exprs]
    return "md5(concat_ws('|', " + ", ".join(f"coalesce(length({t}) || ':' || {t}, '-')" for t in texts) + "))"


REGISTRY: dict[str, Query] = {}


def register(op_id: str, key: str, oracle: str | None = None):
    """Decorator: add a query under ``key`` for inventory id ``op_id``."""

    def deco(fn: Callable[[SparkSession, str], DataFrame]):
        if key in REGISTRY:
            raise ValueError(f"duplicate query key {key}")
        REGISTRY[key] = Query(key, op_id, fn, oracle.strip() if oracle else None)
        return fn

    return deco


def all_queries() -> dict[str, Query]:
    from tessera import plans  # noqa: F401  (imports every plan module)

    plans.load_all()
    return dict(REGISTRY)
