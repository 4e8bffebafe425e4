"""Load jobs and load audit (LOAD-*).

Plain Parquet folders have no MERGE; updates are expressed as a full outer
join on the key producing the next snapshot (written to a new folder by the
caller), deletes as anti joins, rolling windows as partition overwrite.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.common import attach_scalars, join_on


def upsert(base: DataFrame, delta: DataFrame, keys: Sequence[str], delete_flag: str | None = None) -> DataFrame:
    """LOAD-09: update on key match, insert otherwise, optional delete.

    One full outer join on the keys; the delta side wins where present.  A
    delta row with ``delete_flag`` true removes the key."""
    keys = list(keys)
    cols = [c for c in base.columns if c not in keys]
    b = base.select(*keys, *[F.col(c).alias(f"_b_{c}") for c in cols], F.lit(True).alias("_in_b"))
    dcols = [c for c in cols if c in delta.columns]
    d = delta.select(*keys, *[F.col(c).alias(f"_d_{c}") for c in dcols],
                     (F.col(delete_flag) if delete_flag else F.lit(False)).alias("_del"),
                     F.lit(True).alias("_in_d"))
    j = b.join(d, keys, "full")
    out = j.filter(~F.coalesce(F.col("_del"), F.lit(False)))
    sel = [F.col(k) for k in keys]
    for c in cols:
        if c in dcols:
            sel.append(F.when(F.col("_in_d"), F.col(f"_d_{c}")).otherwise(F.col(f"_b_{c}")).alias(c))
        else:
            sel.append(F.col(f"_b_{c}").alias(c))
    return out.select(*sel)


def validate_load(df_str: DataFrame, schema: T.StructType, row_id: str, file_col: str | None = None) -> DataFrame:
    """LOAD-01: dry run: one row per (row, column) whose text fails the cast
    to the declared type: file, row, column, value, error; nothing is loaded."""
    fails = []
    for f in schema.fields:
        v = F.col(f.name)
        bad = v.isNotNull() & v.try_cast(f.dataType).isNull()
        fails.append(F.when(bad, F.struct(F.lit(f.name).alias("column"), v.cast("string").alias("value"),
                                          F.lit(f"not a valid {f.dataType.simpleString()}").alias("error"))))
    arr = F.filter(F.array(*fails), lambda x: x.isNotNull())
    base = [F.col(row_id)] + ([F.col(file_col)] if file_col else [])
    return df_str.select(*base, F.explode(arr).alias("f")).select(*base, "f.column", "f.value", "f.error")


def split_good_bad(df_str: DataFrame, schema: T.StructType, required: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """LOAD-03: typed cast of an all-string landing table; returns (good,
    bad) that partition the input.  Bad rows keep the raw text plus a reason."""
    casts = {f.name: F.col(f.name).try_cast(f.dataType) for f in schema.fields}
    reasons = []
    for f in schema.fields:
        raw = F.col(f.name)
        reasons.append(F.when(raw.isNotNull() & casts[f.name].isNull(), F.lit(f"bad {f.name}")))
        if f.name in required:
            reasons.append(F.when(raw.isNull(), F.lit(f"missing {f.name}")))
    verdict = F.array_join(F.filter(F.array(*reasons), lambda x: x.isNotNull()), "; ")
    d = df_str.withColumn("_reason", verdict)
    good = d.filter(F.col("_reason") == "").select(*[casts[f.name].alias(f.name) for f in schema.fields])
    bad = d.filter(F.col("_reason") != "").withColumnRenamed("_reason", "reason")
    return good, bad


def apply_length(df: DataFrame, limits: Mapping[str, int], truncate: bool, enforce: bool
                 ) -> tuple[DataFrame, DataFrame]:
    """LOAD-04: over-length policy.  ``enforce`` wins over ``truncate``:
    enforce -> over-length rows are rejected; truncate only -> values are
    cut to the limit; neither -> values pass unchanged (the documented
    permissive rule).  Returns (good, rejected)."""
    over = F.lit(False)
    for c, n in limits.items():
        over = over | (F.length(F.col(c)) > n)
    if enforce:
        return df.filter(~over), df.filter(over)
    if truncate:
        out = df
        for c, n in limits.items():
            out = out.withColumn(c, F.substring(F.col(c), 1, n))
        return out, df.limit(0)
    return df, df.limit(0)


def load_new_files(inventory: DataFrame, ledger: DataFrame, identity: Sequence[str] = ("file",),
                   force: bool = False) -> DataFrame:
    """LOAD-05: files of the inventory not yet in the ledger (by the chosen
    identity: path only, or path + size + mtime); ``force`` loads all."""
    return inventory if force else inventory.join(ledger.select(*identity).distinct(), list(identity), "left_anti")


def load_history(rows: DataFrame, file_col: str, row_no: str, error: str) -> DataFrame:
    """LOAD-06: one row per file: rows, errors, status, first error (by row)."""
    g = rows.groupBy(file_col).agg(
        F.count(F.lit(1)).alias("rows_seen"), F.count(error).alias("errors"),
        F.min_by(error, F.when(F.col(error).isNotNull(), F.col(row_no))).alias("first_error"))
    status = (F.when(F.col("errors") == 0, "LOADED")
               .when(F.col("errors") < F.col("rows_seen"), "PARTIALLY_LOADED").otherwise("LOAD_FAILED"))
    return g.withColumn("status", status)


def load_alerts(history: DataFrame, expected: DataFrame, key: str, rows_col: str, min_rows: int,
                load_time: str, max_idle_hours: float) -> DataFrame:
    """LOAD-07: alerts: expected file missing, low row count, failures, and
    inactivity (latest load older than the limit versus the latest expected
    time).  Returns (key, alert)."""
    missing = expected.join(history, key, "left_anti").select(key, F.lit("missing").alias("alert"))
    low = history.filter(F.col(rows_col) < min_rows).select(key, F.lit("low_rows").alias("alert"))
    failed = history.filter(F.col("status") == "LOAD_FAILED").select(key, F.lit("failed").alias("alert")) \
        if "status" in history.columns else history.limit(0).select(key, F.lit("failed").alias("alert"))
    last = history.agg(F.max(load_time).alias("_last"))
    exp_last = expected.agg(F.max(key).alias("_exp"))
    idle = attach_scalars(last, exp_last).filter(
        (F.unix_timestamp(F.col("_exp").cast("timestamp")) - F.unix_timestamp(F.col("_last").cast("timestamp")))
        > max_idle_hours * 3600).select(F.col("_last").cast("string").alias(key), F.lit("inactive").alias("alert"))
    return missing.unionByName(low).unionByName(failed).unionByName(
        idle.select(F.col(key).cast(expected.schema[key].dataType).alias(key), "alert"))


def append_day(stage: DataFrame, date_col: str, day) -> DataFrame:
    """LOAD-08: the rows of one day (to be appended to the target)."""
    return stage.filter(F.to_date(F.col(date_col)) == F.lit(day).cast("date"))


def append_latest_day(stage: DataFrame, date_col: str) -> DataFrame:
    """LOAD-08: the rows of the stage's latest day (the day is a one-row
    aggregate attached by broadcast, nothing goes through the driver)."""
    last = stage.agg(F.to_date(F.max(date_col)).alias("_last"))
    return attach_scalars(stage, last).filter(F.to_date(date_col) == F.col("_last")).drop("_last")


def rolling_reload(base: DataFrame, stage: DataFrame, date_col: str, days: int, as_of=None) -> DataFrame:
    """LOAD-11: drop the last ``days`` days (relative to ``as_of`` or the
    stage's latest date) from the base and insert the stage rows of the same
    window; older base rows are untouched."""
    if as_of is None:
        edge = stage.agg(F.date_sub(F.to_date(F.max(date_col)), days - 1).alias("_edge"))
    else:
        edge = stage.sparkSession.range(1).select(F.date_sub(F.lit(as_of).cast("date"), days - 1).alias("_edge"))
    keep = attach_scalars(base, edge).filter(F.to_date(date_col) < F.col("_edge")).drop("_edge")
    new = attach_scalars(stage, edge).filter(F.to_date(date_col) >= F.col("_edge")).drop("_edge")
    return keep.unionByName(new)


def reload_partitions(stage: DataFrame, path: str, part: str, keep_from) -> None:
    """LOAD-11: replace the partitions ``part >= keep_from`` of the table at
    ``path`` (Parquet, partitioned by ``part``) by the stage's rows of that
    window; older partitions are not touched.

    A dynamic partition overwrite replaces the partitions that the stage has;
    partitions of the window that the stage lacks are deleted after it.  Both
    steps give the same table when they are repeated, so a failed load is
    simply run again."""
    spark = stage.sparkSession
    new = stage.filter(F.col(part) >= F.lit(keep_from))
    new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(part).parquet(path)
    there = spark.read.parquet(path).select(part).filter(F.col(part) >= F.lit(keep_from)).distinct()
    stale = there.join(new.select(part), part, "left_anti").collect()  # partition values, at most one for each folder
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    for row in stale:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(folder, f"{part}={row[0]}"), True)


def apply_error_policy(rows: DataFrame, file_col: str, bad: Column, policy: str, n: float | None = None
                       ) -> DataFrame:
    """LOAD-02: ``abort`` (raise if any bad row), ``continue`` (drop bad
    rows), ``skip_file`` (drop files with any bad row), ``skip_file_n``
    (drop files with >= n bad rows), ``skip_file_pct`` (>= n percent bad)."""
    d = rows.withColumn("_bad", bad)
    if policy == "abort":
        first = d.filter("_bad").select(file_col).limit(1).collect()
        if first:
            raise ValueError(f"load aborted: bad row in {first[0][0]}")
        return d.drop("_bad")
    if policy == "continue":
        return d.filter(~F.col("_bad")).drop("_bad")
    # per-file counts by a (map-side combined) aggregate joined back: one
    # large file is not pulled into one window task
    per_file = d.groupBy(file_col).agg(F.count_if("_bad").alias("_nbad"), F.count(F.lit(1)).alias("_n"))
    d = join_on(d, per_file, [file_col])
    if policy == "skip_file":
        keep = F.col("_nbad") == 0
    elif policy == "skip_file_n":
        keep = F.col("_nbad") < n
    elif policy in ("skip_file_pct", "skip_file_n%"):
        keep = F.col("_nbad") * 100.0 / F.col("_n") < n
    else:
        raise ValueError(policy)
    return d.filter(keep & ~F.col("_bad")).drop("_bad", "_nbad", "_n")


def replace_all(stage: DataFrame, root: str, ts) -> int:
    """LOAD-10: truncate and reload: the stage becomes a new complete
    version folder; the version row (pointer) is written last, so readers
    see the old table or the new one, never a mix."""
    from tessera.operators.versions import write_version
    return write_version(stage, root, ts)
