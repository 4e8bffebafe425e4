"""Change capture and table versions (VER-*).

Change rows carry ``_action`` (INSERT or DELETE), ``_is_update`` and
``_row_id`` (the key); an update is a DELETE of the old row plus an INSERT
of the new one, both flagged.  Versions are immutable snapshot folders
``<root>/_v=<n>`` plus a version table; a pointer row is written last.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.scalars import hash_key
from tessera.session import read_or_none
from tessera.sources.loads import upsert


def diff(old: DataFrame, new: DataFrame, key: str, cols: Sequence[str] | None = None) -> DataFrame:
    """VER-01: snapshot diff to change rows (one full outer join, null-safe
    row compare by hash, explode of one or two legs per changed key)."""
    cols = list(cols or [c for c in new.columns if c != key])
    o = old.select(key, F.struct(*cols).alias("_o"), hash_key(cols).alias("_ho"))
    n = new.select(key, F.struct(*cols).alias("_n"), hash_key(cols).alias("_hn"))
    j = o.join(n, key, "full")
    upd = F.col("_o").isNotNull() & F.col("_n").isNotNull() & (F.col("_ho") != F.col("_hn"))
    legs = F.when(F.col("_n").isNull(), F.array(F.struct(F.lit("DELETE").alias("a"), F.col("_o").alias("r"))))
    legs = (legs.when(F.col("_o").isNull(), F.array(F.struct(F.lit("INSERT").alias("a"), F.col("_n").alias("r"))))
                .when(upd, F.array(F.struct(F.lit("DELETE").alias("a"), F.col("_o").alias("r")),
                                   F.struct(F.lit("INSERT").alias("a"), F.col("_n").alias("r")))))
    x = j.withColumn("_upd", upd).withColumn("_leg", F.explode(legs))
    return x.select(key, *[F.col(f"_leg.r.{c}").alias(c) for c in cols],
                    F.col("_leg.a").alias("_action"), F.col("_upd").alias("_is_update"),
                    F.col(key).alias("_row_id"))


def new_rows(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """VER-02: append-only feed: inserted keys only."""
    return new.join(old.select(key), key, "left_anti").withColumn("_action", F.lit("INSERT"))


def before_after(changes: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """VER-03: pair the DELETE and INSERT legs of each update."""
    u = changes.filter("_is_update")
    b = u.filter(F.col("_action") == "DELETE").select(key, *[F.col(c).alias(f"before_{c}") for c in cols])
    a = u.filter(F.col("_action") == "INSERT").select(key, *[F.col(c).alias(f"after_{c}") for c in cols])
    return b.join(a, key)


def apply_changes(base: DataFrame, changes: DataFrame, key: str, seq: str | None = None) -> DataFrame:
    """VER-10: collapse change rows to a net change per key (last wins by
    ``seq``; within one update the INSERT leg follows the DELETE), then
    upsert with delete."""
    order = [F.col(seq)] if seq else []
    c = changes.withColumn("_o", F.struct(*order, (F.col("_action") == "INSERT").cast("int").alias("_ins")))
    cols = [x for x in base.columns if x != key]
    net = c.groupBy(key).agg(F.max_by(F.struct(*cols, "_action"), "_o").alias("_last"))
    net = net.select(key, *[F.col(f"_last.{x}").alias(x) for x in cols],
                     (F.col("_last._action") == "DELETE").alias("_del"))
    return upsert(base, net, [key], delete_flag="_del")


def bootstrap(base: DataFrame, feed: DataFrame) -> DataFrame:
    """VER-11: initial snapshot tagged INSERT, then the change feed."""
    b = base.withColumn("_action", F.lit("INSERT")).withColumn("_is_update", F.lit(False)) \
            .withColumn("_phase", F.lit("snapshot"))
    return b.unionByName(feed.withColumn("_phase", F.lit("feed")), allowMissingColumns=True)


def audit_rows(old: DataFrame, new: DataFrame, key: str, at) -> DataFrame:
    """VER-12: one audit row per changed key: old and new row as JSON, action."""
    cols = [c for c in new.columns if c != key]
    o = old.select(key, F.to_json(F.struct(*cols)).alias("old_row"))
    n = new.select(key, F.to_json(F.struct(*cols)).alias("new_row"))
    j = o.join(n, key, "full")
    action = (F.when(F.col("old_row").isNull(), "INSERT").when(F.col("new_row").isNull(), "DELETE")
               .when(F.col("old_row") != F.col("new_row"), "UPDATE"))
    return j.withColumn("action", action).filter(F.col("action").isNotNull()) \
            .withColumn("changed_at", F.lit(at).cast("timestamp_ntz"))


def net_change(changes: DataFrame, key: str, ts: str, qty: str) -> DataFrame:
    """VER-13: inserts count plus, deletes minus, per key and hour."""
    sign = F.when(F.col("_action") == "INSERT", F.col(qty)).otherwise(-F.col(qty))
    return changes.groupBy(key, F.date_trunc("hour", F.col(ts)).alias("hour")).agg(F.sum(sign).alias("net_qty"))


def sync_soft(history: DataFrame | None, changes: DataFrame, key: str, at) -> DataFrame:
    """VER-14: append change rows to a history with ``valid_from`` and
    ``is_deleted``; a DELETE leg of an update is not a deletion."""
    rows = changes.filter((F.col("_action") == "INSERT") | ~F.col("_is_update")) \
                  .withColumn("valid_from", F.lit(at).cast("timestamp_ntz")) \
                  .withColumn("is_deleted", F.col("_action") == "DELETE") \
                  .drop("_action", "_is_update", "_row_id")
    return rows if history is None else history.unionByName(rows)


def current_view(history: DataFrame, key: str) -> DataFrame:
    """VER-14: latest non-deleted version per key."""
    cols = [c for c in history.columns if c != key]
    last = history.groupBy(key).agg(F.max_by(F.struct(*cols), "valid_from").alias("_l"))
    return last.select(key, "_l.*").filter(~F.col("is_deleted")).drop("is_deleted", "valid_from")


# ---- versioned folders (VER-04/05/06/09) -------------------------------------

def _versions_path(root: str) -> str:
    return f"{root.rstrip('/')}/_versions"


def list_versions(spark: SparkSession, root: str) -> DataFrame:
    """Version table: (version, ts, path); empty when none written yet."""
    found = read_or_none(spark, _versions_path(root))
    return found if found is not None else spark.createDataFrame([], "version long, ts timestamp_ntz, path string")


def write_version(df: DataFrame, root: str, ts) -> int:
    """VER-04: write ``df`` as the next immutable version; the version row is
    appended only after the data is complete (readers never see a partial
    version)."""
    spark = df.sparkSession
    prev = list_versions(spark, root).agg(F.max("version")).first()[0]
    v = 1 if prev is None else prev + 1
    path = f"{root.rstrip('/')}/_v={v}"
    df.write.mode("errorifexists").parquet(path)
    spark.createDataFrame([(v, path)], "version long, path string") \
         .withColumn("ts", F.lit(ts).cast("timestamp_ntz")).select("version", "ts", "path") \
         .write.mode("append").parquet(_versions_path(root))
    return v


def read_at(spark: SparkSession, root: str, ts=None, before: bool = False, version: int | None = None) -> DataFrame:
    """VER-04: read the version current at ``ts`` (inclusive), or just
    before it, or an explicit version."""
    vt = list_versions(spark, root)
    if version is not None:
        row = vt.filter(F.col("version") == version).first()
    else:
        t = F.lit(ts).cast("timestamp_ntz")
        cond = (F.col("ts") < t) if before else (F.col("ts") <= t)
        row = vt.filter(cond).orderBy(F.col("version").desc()).first()
    if row is None:
        raise ValueError("no version at the requested time")
    return spark.read.parquet(row["path"])


def restore(spark: SparkSession, root: str, version: int, ts) -> int:
    """VER-05: copy an old version as the new current version."""
    return write_version(read_at(spark, root, version=version), root, ts)


def publish(staged: DataFrame, root: str, ts, current: DataFrame | None = None) -> DataFrame:
    """VER-06: compare schema and row totals of the refreshed table with the
    current one; on equal schemas write it as the new version.  Returns the
    comparison row (schema_match, current_rows, staged_rows, version)."""
    spark = staged.sparkSession
    cur = current
    if cur is None:
        try:
            cur = read_at(spark, root, ts="9999-12-31 00:00:00")
        except ValueError:
            cur = None
    same = cur is None or [(f.name, f.dataType) for f in cur.schema] == [(f.name, f.dataType) for f in staged.schema]
    if not same:
        raise ValueError("publish refused: schema differs from the current version")
    n_cur = cur.count() if cur is not None else 0
    n_new = staged.count()
    v = write_version(staged, root, ts)
    return spark.createDataFrame([(True, n_cur, n_new, v)],
                                 "schema_match boolean, current_rows long, staged_rows long, version long")


def replay(spark: SparkSession, root_changes: str, lo: int, hi: int, target: DataFrame, key: str) -> DataFrame:
    """VER-09: re-apply change versions lo..hi to a target by one keyed upsert
    of all their change rows, the last version winning per key (idempotent:
    replaying twice gives the same table)."""
    vt = list_versions(spark, root_changes).filter(F.col("version").between(lo, hi)).orderBy("version")
    changes = None
    for row in vt.collect():  # the version table is small: one row per version
        one = spark.read.parquet(row["path"]).withColumn("_seq", F.lit(row["version"]).cast("long"))
        changes = one if changes is None else changes.unionByName(one)
    return target if changes is None else apply_changes(target, changes, key, "_seq")
