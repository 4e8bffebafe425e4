"""Data quality and feature preparation (DQ-*).  Statistics are one-row
aggregates attached by broadcast; every check is a Column expression."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.aggs import median_by, mode_of
from tessera.operators.common import attach_scalars, dense_ids


def null_report(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """DQ-01: null count per column (one pass), only columns with nulls."""
    cols = list(cols or df.columns)
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return one.unpivot([], cols, "column", "nulls").filter("nulls > 0")


def type_report(df: DataFrame, expected: Mapping[str, str]) -> DataFrame:
    """DQ-02: per column: expected type, actual type, values failing the cast."""
    actual = dict(df.dtypes)
    one = df.agg(*[F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull()).alias(c)
                   for c, t in expected.items()])
    rows = one.unpivot([], list(expected), "column", "failures")
    spark = df.sparkSession
    meta = spark.createDataFrame([(c, t, actual.get(c)) for c, t in expected.items()],
                                 "column string, expected string, actual string")
    return rows.join(F.broadcast(meta), "column")


def quality_report(df: DataFrame, expected: Mapping[str, str]) -> DataFrame:
    """DQ-03: missing + type failures + duplicate rows as finding rows."""
    nulls = null_report(df).select(F.lit("missing").alias("check"), "column", F.col("nulls").alias("n"))
    types = type_report(df, expected).filter("failures > 0").select(
        F.lit("type").alias("check"), "column", F.col("failures").alias("n"))
    dups = (df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_c")).filter("_c > 1")
              .agg(F.coalesce(F.sum(F.col("_c") - 1), F.lit(0)).alias("n"))
              .select(F.lit("duplicate_rows").alias("check"), F.lit("*").alias("column"), "n"))
    return nulls.unionByName(types).unionByName(dups)


def impute(df: DataFrame, cols: Sequence[str], strategy: str = "mean") -> DataFrame:
    """DQ-04: fill NULLs per column by mean, median or mode (one statistics
    row per column; median and mode from counts per value), or drop rows with
    NULLs."""
    if strategy == "drop":
        return df.dropna(subset=list(cols))
    one = {"mean": lambda c: df.agg(F.avg(c).alias(f"_fill_{c}")), "median": lambda c: median_by(df, None, c, f"_fill_{c}"),
           "mode": lambda c: mode_of(df, c, f"_fill_{c}")}[strategy]
    d = df
    for c in cols:
        d = attach_scalars(d, one(c))
        d = d.withColumn(c, F.coalesce(F.col(c), F.col(f"_fill_{c}")))
    return d.drop(*[f"_fill_{c}" for c in cols])


def minmax(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """DQ-05: scale to [0, 1] per column (constant column -> 0)."""
    stats = df.agg(*[x for c in cols for x in (F.min(c).alias(f"_lo_{c}"), F.max(c).alias(f"_hi_{c}"))])
    d = attach_scalars(df, stats)
    for c in cols:
        rng = F.col(f"_hi_{c}") - F.col(f"_lo_{c}")
        d = d.withColumn(c, F.when(rng == 0, F.lit(0.0)).otherwise((F.col(c) - F.col(f"_lo_{c}")) / rng))
    return d.drop(*[f"_{p}_{c}" for c in cols for p in ("lo", "hi")])


def standardise(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """DQ-06: (x - mean) / population std."""
    stats = df.agg(*[x for c in cols for x in (F.avg(c).alias(f"_mu_{c}"), F.stddev_pop(c).alias(f"_sd_{c}"))])
    d = attach_scalars(df, stats)
    for c in cols:
        d = d.withColumn(c, F.try_divide(F.col(c) - F.col(f"_mu_{c}"), F.col(f"_sd_{c}")))
    return d.drop(*[f"_{p}_{c}" for c in cols for p in ("mu", "sd")])


def label_encode(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """DQ-07: sorted distinct values to 0..n-1 (NULL stays NULL).  The code
    table (one row per distinct value) is numbered by range partitions and
    joined back."""
    codes = dense_ids(df.select(col).distinct().filter(F.col(col).isNotNull()), out or f"{col}_code")
    return df.join(codes, col, "left")


def validate(df: DataFrame, rules: Mapping[str, Column], out: str = "failures") -> DataFrame:
    """DQ-08: names of the rules a row fails (empty list = valid)."""
    fails = F.filter(F.array(*[F.when(~F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in rules.items()]),
                     lambda x: x.isNotNull())
    return df.withColumn(out, fails).withColumn("is_valid", F.size(out) == 0)


def contract_rules(contract: Mapping[str, Mapping]) -> dict[str, Column]:
    """DQ-09: compile a record contract (per field: type, required,
    min_len, max_len, pattern, min, max, allowed) to named Column rules."""
    rules: dict[str, Column] = {}
    for field, spec in contract.items():
        c = F.col(field)
        if spec.get("required"):
            rules[f"{field}:required"] = c.isNotNull()
        if "type" in spec:
            rules[f"{field}:type"] = c.isNull() | c.try_cast(spec["type"]).isNotNull()
        if "min_len" in spec:
            rules[f"{field}:min_len"] = c.isNull() | (F.length(c) >= spec["min_len"])
        if "max_len" in spec:
            rules[f"{field}:max_len"] = c.isNull() | (F.length(c) <= spec["max_len"])
        if "pattern" in spec:
            rules[f"{field}:pattern"] = c.isNull() | c.rlike(spec["pattern"])
        if "min" in spec:
            rules[f"{field}:min"] = c.isNull() | (c >= spec["min"])
        if "max" in spec:
            rules[f"{field}:max"] = c.isNull() | (c <= spec["max"])
        if "allowed" in spec:
            rules[f"{field}:allowed"] = c.isNull() | c.isin(list(spec["allowed"]))
    return rules


def check_contract(df: DataFrame, contract: Mapping[str, Mapping]) -> DataFrame:
    """DQ-09: rule table compiled to Column expressions; no per-row Python."""
    return validate(df, contract_rules(contract))


def sample_drift(a: DataFrame, b: DataFrame, col: str) -> DataFrame:
    """DQ-10: group shares in two samples and their absolute difference."""
    def shares(d, name):
        g = d.groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
        t = d.agg(F.count(F.lit(1)).alias("_t"))
        return attach_scalars(g, t).select(col, (F.col("_n") / F.col("_t")).alias(name))
    j = shares(a, "share_a").join(shares(b, "share_b"), col, "full").fillna(0.0, ["share_a", "share_b"])
    return j.withColumn("abs_diff", F.abs(F.col("share_a") - F.col("share_b")))
