"""Warehouse modelling jobs (DWH-*): date dimension, surrogate keys, slowly
changing dimensions 0/1/2/3/4/6, fact shapes, audits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.scalars import hash_key
from tessera.operators.common import _cols, attach_scalars, dense_ids, join_on, spread, task_count
from tessera.operators.joins import cross
from tessera.sources.loads import upsert

_SEASONS = {12: "winter", 1: "winter", 2: "winter", 3: "spring", 4: "spring", 5: "spring",
            6: "summer", 7: "summer", 8: "summer", 9: "autumn", 10: "autumn", 11: "autumn"}


def date_dim(df: DataFrame, date_col: str, fiscal_start_month: int = 1,
             holidays: DataFrame | None = None, holiday_col: str = "holiday") -> DataFrame:
    """DWH-01: one row per date between the min and max of ``date_col``:
    key yyyymmdd, names, weekend flag, quarter, fiscal year, month start and
    end, holiday flag (left join to a holiday table)."""
    rng = df.agg(F.to_date(F.min(date_col)).alias("_a"), F.to_date(F.max(date_col)).alias("_b"))
    d = rng.select(F.explode(F.sequence("_a", "_b", F.expr("INTERVAL 1 DAY"))).alias("date"))
    fy = F.year("date") + F.when(F.month("date") >= fiscal_start_month, 1 if fiscal_start_month > 1 else 0).otherwise(0)
    d = (d.withColumn("date_key", F.date_format("date", "yyyyMMdd").cast("int"))
          .withColumn("year", F.year("date")).withColumn("quarter", F.quarter("date"))
          .withColumn("month", F.month("date")).withColumn("month_name", F.date_format("date", "MMMM"))
          .withColumn("day", F.dayofmonth("date")).withColumn("day_name", F.date_format("date", "EEEE"))
          .withColumn("is_weekend", F.dayofweek("date").isin(1, 7))
          .withColumn("fiscal_year", fy)
          .withColumn("month_start", F.trunc("date", "month")).withColumn("month_end", F.last_day("date")))
    if holidays is not None:
        h = holidays.select(F.to_date(holiday_col).alias("date")).distinct().withColumn("is_holiday", F.lit(True))
        d = d.join(h, "date", "left").withColumn("is_holiday", F.coalesce("is_holiday", F.lit(False)))
    return d


def time_attrs(df: DataFrame, ts: str) -> DataFrame:
    """DWH-02: hour, minute, part of day, season."""
    h = F.hour(ts)
    part = (F.when(h.between(5, 11), "morning").when(h.between(12, 16), "afternoon")
             .when(h.between(17, 20), "evening").otherwise("night"))
    m = F.month(ts)
    season = None
    for k, v in _SEASONS.items():
        season = F.when(m == k, v) if season is None else season.when(m == k, v)
    return (df.withColumn("hour", h).withColumn("minute", F.minute(ts))
              .withColumn("part_of_day", part).withColumn("season", season))


def surrogate_key(df: DataFrame, nk: Sequence[str], mode: str = "hash", out: str = "sk",
                  start: int = 1) -> DataFrame:
    """DWH-03: stable hash key (md5 of the business key), or dense integers
    ``start..`` in business-key order.  The dense form numbers the distinct
    keys with ``dense_ids`` (a range sort, positions inside its partitions
    and their offsets) and joins them back."""
    if mode == "hash":
        return df.withColumn(out, hash_key(nk))
    numbered = dense_ids(df.select(*nk).distinct(), out, start)
    return join_on(df, numbered, list(nk), "left")


def scd0(dim: DataFrame, delta: DataFrame, key: str) -> DataFrame:
    """DWH-04: attributes never change after insert: only new keys added."""
    return dim.unionByName(delta.select(*dim.columns).join(dim.select(key), key, "left_anti"))


def scd1(dim: DataFrame, delta: DataFrame, key: str) -> DataFrame:
    """DWH-05: overwrite in place (upsert)."""
    return upsert(dim, delta.select(*dim.columns), [key])


def scd2(dim: DataFrame, delta: DataFrame, key: str, cols: Sequence[str], day,
         sk: str = "sk") -> DataFrame:
    """DWH-06: close the current version of changed keys (valid_to = day - 1,
    is_current false) and open a new one from ``day``; new keys open a
    version; unchanged and historical rows stay.  ``dim`` has columns
    key, cols, valid_from, valid_to, is_current, sk.

    One full outer join of the current rows with the delta (change detected
    by a null-safe hash of ``cols``) emits 1-2 rows per key through an array
    explode; historical rows pass through untouched."""
    day_c = F.lit(day).cast("date")
    names = dim.columns
    cur = dim.filter("is_current")
    hist = dim.filter(~F.col("is_current"))
    o = cur.select(key, F.struct(*[F.col(c) for c in names]).alias("_o"), hash_key(cols).alias("_ho"))
    n = delta.select(key, F.struct(*[F.col(c) for c in cols]).alias("_n"), hash_key(cols).alias("_hn"))
    j = o.join(n, key, "full")

    def row(src: str, **over):
        fields = []
        for c in names:
            if c in over:
                fields.append(over[c].alias(c))
            elif c == key:
                fields.append(F.col(key).alias(c))
            else:
                fields.append(F.col(f"{src}.{c}").alias(c))
        return F.struct(*fields)

    kept = row("_o")
    closed = row("_o", valid_to=F.date_sub(day_c, 1), is_current=F.lit(False))
    opened = row("_n", valid_from=day_c, valid_to=F.lit(None).cast("date"), is_current=F.lit(True),
                 **{sk: hash_key([F.col(key), day_c])})
    changed = F.col("_o").isNotNull() & F.col("_n").isNotNull() & (F.col("_ho") != F.col("_hn"))
    out = (F.when(F.col("_o").isNull(), F.array(opened))
            .when(changed, F.array(closed, opened))
            .otherwise(F.array(kept)))
    new_rows = j.select(F.explode(out).alias("_r")).select("_r.*")
    return hist.unionByName(new_rows)


def scd2_init(df: DataFrame, key: str, cols: Sequence[str], day, sk: str = "sk") -> DataFrame:
    """Initial SCD2 table: every row current from ``day``."""
    return (df.select(key, *cols).withColumn("valid_from", F.lit(day).cast("date"))
              .withColumn("valid_to", F.lit(None).cast("date")).withColumn("is_current", F.lit(True))
              .withColumn(sk, hash_key([key, "valid_from"])))


def scd3(dim: DataFrame, delta: DataFrame, key: str, col: str, prev: str | None = None) -> DataFrame:
    """DWH-07: previous and current value in two columns."""
    prev = prev or f"prev_{col}"
    base = dim if prev in dim.columns else dim.withColumn(prev, F.lit(None).cast(dim.schema[col].dataType))
    d = delta.select(key, F.col(col).alias("_new"))
    j = base.join(d, key, "full")
    changed = F.col("_new").isNotNull() & ~F.col(col).eqNullSafe(F.col("_new"))
    return j.select(
        key, F.when(F.col(col).isNull() & F.col("_new").isNotNull(), F.col("_new"))
               .when(changed, F.col("_new")).otherwise(F.col(col)).alias(col),
        F.when(F.col(col).isNotNull() & changed, F.col(col)).otherwise(F.col(prev)).alias(prev),
        *[c for c in base.columns if c not in (key, col, prev)])


def scd4(dim: DataFrame, hist: DataFrame | None, delta: DataFrame, key: str, cols: Sequence[str], day
         ) -> tuple[DataFrame, DataFrame]:
    """DWH-08: current table (overwritten) plus history table receiving the
    replaced versions with the change date."""
    d = delta.select(key, *cols)
    old = dim.select(key, *cols).withColumn("_h", hash_key(cols))
    changed = old.join(d.withColumn("_hn", hash_key(cols)).select(key, "_hn"), key) \
                 .filter(F.col("_h") != F.col("_hn")).drop("_h", "_hn").withColumn("changed_on", F.lit(day).cast("date"))
    new_hist = changed if hist is None else hist.unionByName(changed)
    return scd1(dim, d, key), new_hist


def scd6(dim: DataFrame, delta: DataFrame, key: str, cols: Sequence[str], day, sk: str = "sk") -> DataFrame:
    """DWH-09: SCD2 history plus current values on every version (type 1
    columns ``current_<col>``)."""
    base = dim.drop(*[f"current_{c}" for c in cols if f"current_{c}" in dim.columns])
    v = scd2(base, delta, key, cols, day, sk)
    cur = v.filter("is_current").select(key, *[F.col(c).alias(f"current_{c}") for c in cols])
    return v.join(cur, key, "left")


def dim_at(dim: DataFrame, day) -> DataFrame:
    """DWH-10: the version of each key valid at ``day``."""
    d = F.lit(day).cast("date")
    return dim.filter((F.col("valid_from") <= d) & (F.col("valid_to").isNull() | (F.col("valid_to") >= d)))


def star_query(fact: DataFrame, dims: Sequence[tuple[DataFrame, str]], by: Sequence[str],
               aggs: Sequence[Column]) -> DataFrame:
    """DWH-11: fact joined to several dimensions, grouped.  Dimension sizes
    are left to AQE (broadcast at run time when small)."""
    d = fact
    for dim, key in dims:
        d = d.join(dim, key)
    return d.groupBy(*by).agg(*aggs)


def denormalise(levels: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """DWH-12: join hierarchy levels (child first) into one flat table."""
    d, _ = levels[0]
    for lvl, key in levels[1:]:
        d = d.join(lvl, key, "left")
    return d


def normalise(df: DataFrame, levels: Sequence[Sequence[str]]) -> list[DataFrame]:
    """DWH-12 (reverse): distinct projection per level."""
    return [df.select(*cols).distinct() for cols in levels]


def role_join(fact: DataFrame, dim: DataFrame, dim_key: str, roles: Mapping[str, str],
              attrs: Sequence[str]) -> DataFrame:
    """DWH-13: the same dimension joined once per role (order date, ship date)."""
    d = fact
    for role, fk in roles.items():
        r = dim.select(F.col(dim_key).alias(f"_{role}_k"), *[F.col(a).alias(f"{role}_{a}") for a in attrs])
        d = d.join(r, F.col(fk) == F.col(f"_{role}_k"), "left").drop(f"_{role}_k")
    return d


def junk_dim(df: DataFrame, flags: Sequence[str], key: str = "junk_key") -> tuple[DataFrame, DataFrame]:
    """DWH-14: all observed flag combinations with a hash key; fact gets the key."""
    k = hash_key(flags)
    return df.withColumn(key, k).drop(*flags), df.select(*flags).distinct().withColumn(key, k)


def degenerate(fact: DataFrame, col: str, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """DWH-15: transaction number kept on the fact, no dimension."""
    return fact.select(F.col(col).alias("txn_no"), *keys, *measures)


def mini_dim(dim: DataFrame, key: str, band_exprs: Mapping[str, Column], mini_key: str = "mini_key"
             ) -> tuple[DataFrame, DataFrame]:
    """DWH-16: fast-changing attributes as bands split into a mini dimension."""
    d = dim.select(key, *[e.alias(n) for n, e in band_exprs.items()])
    k = hash_key(list(band_exprs))
    mini = d.select(*band_exprs).distinct().withColumn(mini_key, k)
    return d.withColumn(mini_key, k).select(key, mini_key), mini


def conformed_check(a: DataFrame, b: DataFrame, cols: Sequence[str]) -> DataFrame:
    """DWH-17: rows only in a, only in b (same keys and attributes expected)."""
    x, y = a.select(*cols), b.select(*cols)
    only_a = x.exceptAll(y).agg(F.count(F.lit(1)).alias("only_in_a"))
    only_b = y.exceptAll(x).agg(F.count(F.lit(1)).alias("only_in_b"))
    return attach_scalars(only_a, only_b)


def snapshot_fact(rows: DataFrame, key: str, date: str, val: str, out: str = "balance") -> DataFrame:
    """DWH-19: state per key and calendar day, including days without
    events: daily sums over the key x calendar grid, running sum per key."""
    daily = rows.groupBy(key, F.to_date(date).alias("day")).agg(F.sum(val).alias("_v"))
    rng = daily.agg(F.min("day").alias("_a"), F.max("day").alias("_b"))
    cal = rng.select(F.explode(F.sequence("_a", "_b", F.expr("INTERVAL 1 DAY"))).alias("day"))
    grid = cross(daily.select(key).distinct(), cal)
    g = grid.join(daily, [key, "day"], "left").withColumn("_v", F.coalesce("_v", F.lit(0.0)))
    # running balance per key over the calendar, chunked by month
    from tessera.operators.common import prefix_sum
    return prefix_sum(g, [key], [F.col("day")], "_v", out, F.trunc("day", "month")).drop("_v")


def accumulating_fact(rows: DataFrame, key: str, ts: str, kind: str, milestones: Sequence[str]) -> DataFrame:
    """DWH-20: one row per process: first time of each milestone and the
    exact seconds (microsecond precision) between consecutive milestones."""
    g = rows.groupBy(key).agg(*[F.min(F.when(F.col(kind) == m, F.col(ts))).alias(f"{m}_at") for m in milestones])
    for a, b in zip(milestones, milestones[1:]):
        g = g.withColumn(f"{a}_to_{b}_s", (F.unix_micros(F.col(f"{b}_at").cast("timestamp"))
                                           - F.unix_micros(F.col(f"{a}_at").cast("timestamp"))) / 1e6)
    return g


def factless(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """DWH-21: keys only (who, what, when happened)."""
    return rows.select(*keys).distinct()


def not_happened(grid: DataFrame, fact: DataFrame, keys: Sequence[str]) -> DataFrame:
    """DWH-21: combinations of the coverage grid with no fact row."""
    return grid.join(fact.select(*keys), list(keys), "left_anti")


def ratios(df: DataFrame, by, defs: Mapping[str, tuple[Column, Column]]) -> DataFrame:
    """DWH-22: null-safe ratios of sums."""
    return df.groupBy(*_cols(by)).agg(*[F.try_divide(F.sum(n), F.sum(d)).alias(name) for name, (n, d) in defs.items()])


def refresh_summary(summary: DataFrame, source: DataFrame, changed: DataFrame, by: Sequence[str],
                    aggs: Sequence[Column]) -> DataFrame:
    """DWH-23: recompute only the groups touched by ``changed`` rows from the
    source; untouched groups are kept from the stored summary."""
    touched = changed.select(*by).distinct()
    fresh = source.join(touched, list(by), "left_semi").groupBy(*by).agg(*aggs)
    return summary.join(touched, list(by), "left_anti").unionByName(fresh)


def harmonise(df: DataFrame, col: str, formats: Sequence[str], out: str | None = None) -> Column | DataFrame:
    """DWH-24: first format that parses wins (dates from many systems)."""
    parsed = F.coalesce(*[F.try_to_date(F.col(col), f) for f in formats])
    return df.withColumn(out or col, parsed)


def drop_with_log(df: DataFrame, key: str, drop_cols: Sequence[str], rules: Mapping[str, Column]
                  ) -> tuple[DataFrame, DataFrame]:
    """DWH-25: PII columns out, rows failing a rule out with the reasons logged."""
    reasons = F.filter(F.array(*[F.when(~c, F.lit(n)) for n, c in rules.items()]), lambda x: x.isNotNull())
    d = df.withColumn("_r", reasons)
    kept = d.filter(F.size("_r") == 0).drop("_r", *drop_cols)
    log = d.filter(F.size("_r") > 0).select(key, F.array_join("_r", ",").alias("reasons"))
    return kept, log


def run_layers(raw: DataFrame, steps: Sequence, persist_path: str | None = None) -> DataFrame:
    """DWH-26: staging -> clean -> mart as DataFrame -> DataFrame steps.  With
    ``persist_path`` each layer is written (restart point, lineage cut)."""
    d = raw
    for i, step in enumerate(steps):
        d = step(d)
        if persist_path:
            p = f"{persist_path.rstrip('/')}/layer_{i}"
            d.write.mode("overwrite").parquet(p)
            d = d.sparkSession.read.parquet(p)
    return d


def mart_slice(df: DataFrame, cols: Sequence[str], where: Column, masked: Sequence[str] = ()) -> DataFrame:
    """DWH-27: department subset with secured (hashed) columns."""
    d = df.filter(where).select(*cols)
    for c in masked:
        d = d.withColumn(c, F.sha2(F.col(c).cast("string"), 256))
    return d


def fd_audit(df: DataFrame, det: Sequence[str], dep: str) -> DataFrame:
    """DWH-28: determinant values mapping to more than one dependent value."""
    return (df.groupBy(*det).agg(F.count_distinct(dep).alias("n_values"))
              .filter("n_values > 1"))


def mvd_audit(df: DataFrame, key: str, a: str, b: str) -> DataFrame:
    """DWH-28 (4NF): per key, is the (a, b) set the product of the a-set and
    b-set?  (multi-valued independence).

    A pair counts once for its a and once for its b; the values of a key are
    counted where they are dealt, so neither a hot key nor a task whose share
    grows with the table gathers them."""
    rows = df.select(F.col(key).alias("k"), F.col(a).alias("a"), F.col(b).alias("b"))
    tasks = task_count(rows)
    none = lambda c: F.lit(None).cast(rows.schema[c].dataType)
    pairs = spread(rows, "k", "a", "b", tasks=tasks).distinct()
    sides = pairs.select("k", F.inline(F.array(F.struct(F.lit(True).alias("of_a"), F.col("a"), none("b").alias("b")),
                                               F.struct(F.lit(False).alias("of_a"), none("a").alias("a"), F.col("b")))))
    values = spread(sides, "k", "of_a", "a", "b", tasks=tasks).groupBy("k", "of_a", "a", "b").agg(F.count(F.lit(1)).alias("n"))
    g = values.groupBy(F.col("k").alias(key)).agg(
        F.sum(F.when(F.col("of_a"), F.col("n"))).alias("pairs"),
        F.count_if(F.col("of_a") & F.col("a").isNotNull()).alias("n_a"),
        F.count_if(~F.col("of_a") & F.col("b").isNotNull()).alias("n_b"))
    return g.withColumn("independent", F.col("pairs") == F.col("n_a") * F.col("n_b"))


def key_audit(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """DWH-29: unique and not-null check for a simple or composite key."""
    any_null = F.lit(False)
    for c in cols:
        any_null = any_null | F.col(c).isNull()
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  F.count_distinct(F.struct(*cols)).alias("distinct_keys"),
                  F.count_if(any_null).alias("null_keys")).withColumn(
        "is_key", (F.col("rows") == F.col("distinct_keys")) & (F.col("null_keys") == 0))
