"""Aggregation jobs (AGG-*)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.common import _cols, _names, attach_scalars, empty_arrow, join_on, meet_tiles, prefix_sum, quantile_chunk
from tessera.operators.joins import cross


def aggregate(df: DataFrame, by, aggs: Sequence[Column], having: Column | None = None) -> DataFrame:
    """AGG-01/02: grouped aggregate (partial+final hash aggregate) with HAVING."""
    out = df.groupBy(*_cols(by)).agg(*aggs)
    return out.filter(having) if having is not None else out


def mean_by(df, key, val, out="avg_value"):
    """AGG-03: sum and count reduced by key, then divided (map-side combine)."""
    return df.groupBy(*_cols(key)).agg(F.avg(val).alias(out))


def min_by_key(df, key, val_expr: Column, where: Column | None = None, out="min_value"):
    """AGG-04: keyed minimum of an expression over filtered rows."""
    d = df.filter(where) if where is not None else df
    return d.groupBy(*_cols(key)).agg(F.min(val_expr).alias(out))


def histogram(df, col, out="n"):
    """AGG-05: count per distinct value, ordered by value."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias(out)).orderBy(col)


def distinct_count(df, by, col, when: Column | None = None, out="n_distinct"):
    """AGG-06: count(distinct col), optionally of CASE WHEN when THEN col."""
    c = F.when(when, F.col(col)) if when is not None else F.col(col)
    return df.groupBy(*_cols(by)).agg(F.count_distinct(c).alias(out))


def approx_distinct(df, cols: Sequence[str], rsd: float = 0.05):
    """AGG-07: approximate distinct count per column (HLL++), one pass."""
    return df.agg(*[F.approx_count_distinct(c, rsd).alias(f"approx_{c}") for c in cols])


def distinct_sketches(df, by, col, lg_k: int = 12, out: str = "sketch"):
    """AGG-07: one mergeable distinct-count sketch (HLL) of ``col`` per group,
    to be stored; later rows only need a sketch of their own."""
    return df.groupBy(*_cols(by)).agg(F.hll_sketch_agg(F.col(col), F.lit(lg_k)).alias(out))


def merged_distinct(sketches: DataFrame, by=None, sketch: str = "sketch", out: str = "approx_distinct"):
    """AGG-07: distinct count over the union of stored sketches."""
    return sketches.groupBy(*_cols(by)).agg(F.hll_sketch_estimate(F.hll_union_agg(sketch)).alias(out))


def sum_if(df, by, conds: Mapping[str, Column], val: str | Column | None = None):
    """AGG-08: SUM/COUNT of CASE per named condition."""
    aggs = []
    for name, cond in conds.items():
        if val is None:
            aggs.append(F.count_if(cond).alias(name))
        else:
            v = F.col(val) if isinstance(val, str) else val
            aggs.append(F.sum(F.when(cond, v).otherwise(F.lit(0))).alias(name))
    return df.groupBy(*_cols(by)).agg(*aggs)


def agg_filter(df, by, agg_col: Column, predicate: Column, fn: str = "sum", out="filtered"):
    """AGG-09: aggregate with its own predicate, i.e. agg(x) FILTER (WHERE p)."""
    return df.groupBy(*_cols(by)).agg(getattr(F, fn)(F.when(predicate, agg_col)).alias(out))


def pivot(df, by, col: str, val: str, values: Sequence | None = None, fn: str = "sum"):
    """AGG-10: long to wide.  With ``values`` given the pivot is one pass;
    without, Spark runs a distinct pass first (data-driven columns)."""
    g = df.groupBy(*_cols(by))
    g = g.pivot(col, list(values)) if values is not None else g.pivot(col)
    return g.agg(getattr(F, fn)(val))


def unpivot(df, ids: Sequence[str], cols: Sequence[str], name="name", value="value"):
    """AGG-11: wide to long (static list; pass all non-id columns for 'all')."""
    return df.unpivot(list(ids), list(cols), name, value)


def list_agg(df, by, col, sep=",", distinct=False, out="items"):
    """AGG-12: ordered (distinct) string aggregate."""
    c = F.col(col).cast("string")
    arr = F.array_sort(F.collect_set(c) if distinct else F.collect_list(c))
    return df.groupBy(*_cols(by)).agg(F.array_join(arr, sep).alias(out))


def standings(df, side_a: str, side_b: str, winner: str):
    """AGG-13: played/won/lost per team from a two-column melt; draws dropped."""
    melted = df.select(F.explode(F.array(
        F.struct(F.col(side_a).alias("team"), (F.col(winner) == F.col(side_a)).alias("won"),
                 F.col(winner).isNull().alias("draw")),
        F.struct(F.col(side_b).alias("team"), (F.col(winner) == F.col(side_b)).alias("won"),
                 F.col(winner).isNull().alias("draw")))).alias("s")).select("s.*")
    return melted.groupBy("team").agg(
        F.count(F.lit(1)).alias("played"),
        F.count_if(F.coalesce(F.col("won"), F.lit(False))).alias("won"),
        F.count_if(~F.col("draw") & ~F.coalesce(F.col("won"), F.lit(False))).alias("lost"))


def share_of_total(df, by, val, out="share_pct", digits=2):
    """AGG-15: group share of the grand total; the total is a one-row
    aggregate attached by broadcast (no single-partition window)."""
    g = df.groupBy(*_cols(by)).agg(F.sum(val).alias("_part"))
    tot = df.agg(F.sum(val).alias("_all"))
    return (attach_scalars(g, tot)
            .withColumn(out, F.round(F.col("_part") * 100.0 / F.col("_all"), digits))
            .drop("_all"))


def rate(df, by, flag: Column, where: Column | None = None, out="rate_pct", digits=2):
    """AGG-16: flagged / total * 100 rounded."""
    d = df.filter(where) if where is not None else df
    return d.groupBy(*_cols(by)).agg(
        F.round(F.try_divide(F.count_if(flag) * 100.0, F.count(F.lit(1))), digits).alias(out))


def has_all(df, who, what, required: Sequence):
    """AGG-18: subjects that have every item in ``required``."""
    k = len(set(required))
    return (df.filter(F.col(what).isin(list(required)))
              .groupBy(*_cols(who)).agg(F.count_distinct(what).alias("_k"))
              .filter(F.col("_k") == k).drop("_k"))


def only_ever(df, who, category, value):
    """AGG-19: subjects whose every row has ``category == value``."""
    return (df.groupBy(*_cols(who))
              .agg(F.bool_and(F.col(category) == F.lit(value)).alias("_all"))
              .filter("_all").drop("_all"))


def never_repeat(df, who, item, day):
    """AGG-20: items a subject never bought on two different days, for
    subjects active on more than one day."""
    per = df.groupBy(who, item).agg(F.count_distinct(day).alias("_days"))
    active = df.groupBy(who).agg(F.count_distinct(day).alias("_active")).filter("_active > 1")
    return per.filter("_days = 1").join(active, who, "left_semi").drop("_days")


def arg_extremes(df, by, name, val):
    """AGG-21: name of the highest and lowest value per group; ties go to the
    smallest name.  One aggregate (map-side combined): min_by over the sort
    key (-value, name) for the top, (value, name) for the bottom."""
    return df.groupBy(*_cols(by)).agg(
        F.min_by(name, F.struct((-F.col(val)).alias("v"), F.col(name).alias("n"))).alias(f"top_{name}"),
        F.min_by(name, F.struct(F.col(val).alias("v"), F.col(name).alias("n"))).alias(f"bottom_{name}"))


def leave_one_out_mean(df, by, val, out="others_avg"):
    """AGG-22: per group, the average of all rows outside it:
    (sum_all - sum_g) / (cnt_all - cnt_g), one aggregate plus one scalar row."""
    g = df.groupBy(*_cols(by)).agg(F.sum(val).alias("_s"), F.count(val).alias("_c"),
                                   F.avg(val).alias("group_avg"))
    tot = df.agg(F.sum(val).alias("_sa"), F.count(val).alias("_ca"))
    return (attach_scalars(g, tot)
            .withColumn(out, F.try_divide(F.col("_sa") - F.col("_s"), F.col("_ca") - F.col("_c")))
            .drop("_s", "_c", "_sa", "_ca"))


def mode_by(df, by, cat, tie_aggs: Mapping[str, Column] | None = None,
            tie_order: Sequence[Column] = (), out_n="n"):
    """AGG-23: most frequent category per group.  ``tie_aggs`` are extra
    per-category aggregates (e.g. latest date) used by ``tie_order``."""
    extra = [c.alias(n) for n, c in (tie_aggs or {}).items()]
    counts = df.groupBy(*_cols(by), cat).agg(F.count(F.lit(1)).alias(out_n), *extra)
    w = Window.partitionBy(*_cols(by)).orderBy(F.col(out_n).desc(), *tie_order)
    return counts.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def median_by(df, by, val, out="median"):
    """AGG-24: exact median (odd and even counts; NULLs do not count).

    Counts per (group, value), their chunked running sum, and the values at
    the two middle positions: no task holds a group's values, and without
    ``by`` the whole table's median is spread over its value ranges."""
    keys = _names(by)
    d = df.select(*keys, F.col(val).alias("_v"))
    per = d.filter(F.col("_v").isNotNull()).groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_c"))
    per = quantile_chunk(per, "_v", out="_ch").withColumn("_all", F.lit(0))
    per = prefix_sum(per, [*keys, "_all"], ["_v"], "_c", "_upto", "_ch")
    n = d.groupBy(*keys).agg(F.count("_v").alias("_n"))
    per = join_on(per, n, keys) if keys else attach_scalars(per, n)
    at = lambda p: F.min(F.when(F.col("_upto") >= p, F.col("_v").cast("double")))
    mid = per.groupBy(*keys).agg(at(F.floor((F.col("_n") + 1) / 2)).alias("_lo"), at(F.floor(F.col("_n") / 2) + 1).alias("_hi"))
    groups = d.select(*keys).distinct() if keys else mid
    mid = mid.select(*keys, ((F.col("_lo") + F.col("_hi")) / 2).alias(out))
    return join_on(groups, mid, keys, "left") if keys else mid


def mode_of(df, val, out="mode"):
    """Most frequent value (ties: the smallest), from counts per value."""
    per = df.filter(F.col(val).isNotNull()).groupBy(F.col(val).alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    return per.agg(F.min_by("_v", F.struct((-F.col("_c")).alias("c"), F.col("_v"))).alias(out))


def rollup(df, cols, aggs):
    """AGG-30: roll-up with a grouping id."""
    return df.rollup(*cols).agg(*aggs, F.grouping_id().alias("gid"))


def cube(df, cols, aggs):
    """AGG-30: cube with a grouping id."""
    return df.cube(*cols).agg(*aggs, F.grouping_id().alias("gid"))


def top_k(df, col, k, out="n"):
    """AGG-31: k most frequent values (ties by value)."""
    return (df.groupBy(col).agg(F.count(F.lit(1)).alias(out))
              .orderBy(F.col(out).desc(), F.col(col)).limit(k))


def group_by_signature(df, word, out="signature"):
    """AGG-32: anagram groups: words keyed by their sorted letters."""
    sig = F.array_join(F.array_sort(F.split(F.lower(F.col(word)), "")), "")
    return df.withColumn(out, sig)


def has_duplicates(df, col, by=None):
    """AGG-33: does any value occur twice (per group)?"""
    g = df.groupBy(*_cols(by)) if by else df.groupBy()
    return g.agg((F.count(col) > F.count_distinct(col)).alias("has_duplicates"))


def busiest_route(df, src: str, dst: str, round_trip: Column, n: int = 1, out="trips"):
    """AGG-14: rows flagged round-trip count in both directions; top routes."""
    legs = df.select(F.explode(F.when(round_trip, F.array(
        F.struct(F.col(src).alias("src"), F.col(dst).alias("dst")),
        F.struct(F.col(dst).alias("src"), F.col(src).alias("dst")))).otherwise(F.array(
        F.struct(F.col(src).alias("src"), F.col(dst).alias("dst"))))).alias("l")).select(
        F.col("l.src").cast("bigint").alias("src"), F.col("l.dst").cast("bigint").alias("dst"))
    return (legs.groupBy("src", "dst").agg(F.count(F.lit(1)).alias(out))
                .orderBy(F.col(out).desc(), "src", "dst").limit(n))


def exclusive_usage(df, user, day, category, amount, classes):
    """AGG-17: per day and class (each single class, or 'both'), spend and
    users; every day lists every class, with zeros where absent."""
    u = df.groupBy(user, day).agg(
        F.when(F.count_distinct(category) == len(classes), F.lit("both"))
         .otherwise(F.min(category)).alias("platform"),
        F.sum(amount).alias("_amt"))
    spark = df.sparkSession
    kinds = spark.createDataFrame([(c,) for c in [*classes, "both"]], "platform string")
    grid = cross(u.select(day).distinct(), kinds)
    agg = u.groupBy(day, "platform").agg(F.sum("_amt").alias("_amt"), F.count(user).alias("total_users"))
    return (grid.join(agg, [day, "platform"], "left")
                .select(day, "platform", F.round(F.coalesce("_amt", F.lit(0.0)), 2).alias("total_amount"),
                        F.coalesce("total_users", F.lit(0)).cast("bigint").alias("total_users")))


def half_year_gain(df, key, date, val):
    """AGG-25: average in months 1-6 versus 7-12; keep improvers."""
    m = F.month(date)
    g = df.groupBy(*_cols(key)).agg(F.avg(F.when(m <= 6, F.col(val))).alias("_h1"),
                                    F.avg(F.when(m > 6, F.col(val))).alias("_h2"))
    return g.filter(F.col("_h2") > F.col("_h1")).select(
        *_cols(key), F.round("_h1", 4).alias("h1_avg"), F.round("_h2", 4).alias("h2_avg"))


def two_fact_month(a, b, key):
    """AGG-26: two monthly aggregates full-joined on month; all-zero rows dropped."""
    j = a.join(b, key, "full")
    vals = [c for c in j.columns if c != key]
    for c in vals:
        j = j.withColumn(c, F.coalesce(F.col(c), F.lit(0)))
    counts = [c for c in vals if dict(j.dtypes)[c] in ("bigint", "int")]
    return j.filter(sum((F.col(c) for c in counts), F.lit(0)) > 0)


def missing_members(df, key, member, domain=None):
    """AGG-27: (key, member) combinations absent from the data: distinct keys
    times the member domain (in blocks), anti-joined to the facts."""
    dom = domain if domain is not None else df.select(member).distinct()
    grid = cross(df.select(key).distinct(), dom)
    return grid.join(df.select(key, member), [key, member], "left_anti")


def payout(df, pool: str, won: str, stake: str, out="payout"):
    """AGG-28: losers' pot shared among winners in proportion to stake
    (pool sums from one aggregate joined back, not a window per pool)."""
    sums = df.groupBy(pool).agg(F.sum(F.when(F.col(won), F.col(stake))).alias("_win"),
                                F.sum(F.when(~F.col(won), F.col(stake))).alias("_lose"))
    d = join_on(df.filter(F.col(won)), sums, [pool])
    return d.withColumn(out, F.col(stake) + F.coalesce("_lose", F.lit(0.0)) * F.col(stake) / F.col("_win")) \
            .drop("_win", "_lose")


def loyalty(df, customer, amount, out="loyalty"):
    """AGG-34: count*10 + amount/100, half-up to 2 decimals."""
    return df.groupBy(customer).agg(
        F.round((F.count(F.lit(1)) * 10 + F.sum(amount) / 100).cast("decimal(38,9)"), 2).cast("double").alias(out))


def category_diff(df, by, cat, plus, minus, val, out="diff"):
    """AGG-35: sum of ``plus`` rows minus sum of ``minus`` rows per group."""
    d = df.filter(F.col(cat).isin(plus, minus))
    return d.groupBy(*_cols(by)).agg(F.sum(F.when(F.col(cat) == plus, F.col(val)).otherwise(-F.col(val))).alias(out))


def above_all_means(df, order, qty):
    """AGG-36: groups whose maximum exceeds every group's average."""
    g = df.groupBy(order).agg(F.max(qty).alias("_mx"), F.avg(qty).alias("_av"))
    top = g.agg(F.max("_av").alias("_top"))
    return attach_scalars(g, top).filter(F.col("_mx") > F.col("_top")).select(order)


def heavy_weeks(df, who, ts, amount, limit, min_weeks, out="heavy_weeks"):
    """AGG-37: Monday-based weeks over ``limit``; keep subjects with
    ``min_weeks`` or more such weeks."""
    w = df.groupBy(who, F.date_trunc("week", F.col(ts)).alias("_wk")).agg(F.sum(amount).alias("_t"))
    return (w.filter(F.col("_t") > limit).groupBy(who).agg(F.count(F.lit(1)).alias(out))
             .filter(F.col(out) >= min_weeks))


def best_score(have: DataFrame, need: DataFrame, cand: str, project: str, skill: str, level: str,
               importance: str, base: int = 100, plus: int = 10, minus: int = 5) -> DataFrame:
    """AGG-29: candidates holding every skill a project needs (relational
    division by counts), scored base + plus per skill above the need and
    - minus per skill below; best candidate per project (ties: lower id).

    Projects with the same multiset of (skill, importance) are one signature
    and candidates with the same skill levels one class, named by its least
    id.  A signature meets the classes that hold its rarest skill, in tiles of
    bounded size (a hot skill is many tiles); in a tile the classes are a matrix
    of levels, taken in blocks by id.  No score exceeds the sum over the needs
    of the best any class of the tile gets on them, so a signature leaves the
    tile with the block in which its best score reaches that bound."""
    own = need.groupBy(project).agg(F.array_sort(F.collect_list(F.struct(
        F.col(skill).alias("k"), F.col(importance).alias("v")))).alias("_need"))
    have = have.groupBy(cand, skill).agg(F.max(level).alias(level))
    classes = (have.groupBy(cand).agg(F.array_sort(F.collect_list(F.struct(
        F.col(skill).alias("k"), F.col(level).alias("v")))).alias("_has"))
        .groupBy("_has").agg(F.min(cand).alias(cand)))
    own = own.withColumn("_sig", F.xxhash64("_need"))
    sigs = own.select("_sig", "_need").distinct()
    by_skill = classes.select(F.explode("_has.k").alias("_k"), cand, "_has")
    holders = by_skill.groupBy("_k").agg(F.count(F.lit(1)).alias("_n"))
    rarest = (sigs.select("_sig", F.explode(F.array_distinct("_need.k")).alias("_k"))
              .join(holders, "_k", "left").groupBy("_sig")
              .agg(F.min_by("_k", F.struct(F.coalesce("_n", F.lit(0)), "_k")).alias("_k")))
    sigs = sigs.join(rarest, "_sig")
    schema = T.StructType([sigs.schema["_sig"], T.StructField(cand, have.schema[cand].dataType), T.StructField("score", T.LongType())])
    empty = empty_arrow(schema)
    names = (cand, base, plus, minus)
    best = meet_tiles(sigs, by_skill, ["_k"], SCORE_TILE, lambda n, h: _best_of_tile(n, h, names, empty), schema)
    best = best.groupBy("_sig").agg(F.min(F.struct((-F.col("score")).alias("_neg"), F.col(cand), "score")).alias("_b"))
    return (own.join(best, "_sig")
            .select(project, F.col(f"_b.{cand}").alias(cand), F.col("_b.score").alias("score")))


#: Signatures and classes of a tile of ``best_score``, and the classes that are scored at once.
SCORE_TILE, SCORE_BLOCK = 2048, 256


def _best_of_tile(needs: pa.Table, classes: pa.Table, names: tuple, empty: pa.Table) -> pa.Table:
    """The best class of each signature that some class of the tile covers: highest score, then least id."""
    cand, base, plus, minus = names
    classes = classes.sort_by(cand)
    flat = lambda t, c: pd.DataFrame({"row": np.repeat(np.arange(len(t)), pc.list_value_length(t[c]).to_numpy()),
                                      "k": pc.struct_field(pc.list_flatten(t[c]), "k").to_pandas(),
                                      "v": pc.struct_field(pc.list_flatten(t[c]), "v").to_pandas().astype(float)})
    has, want = flat(classes, "_has"), flat(needs, "_need")
    skills = {k: i for i, k in enumerate(pd.unique(want["k"]))}
    has = has[has["k"].isin(skills)]
    levels = np.full((len(classes), len(skills)), np.nan)
    levels[has["row"], has["k"].map(skills)] = has["v"]
    held = ~np.isnan(levels)
    highest = np.where(held.any(0), np.nanmax(np.where(held, levels, -np.inf), axis=0), np.nan)
    points = lambda x, v: plus * (x > v) - minus * (x < v)
    column, value = want["k"].map(skills).to_numpy(), want["v"].to_numpy()
    starts = np.searchsorted(want["row"].to_numpy(), np.arange(len(needs) + 1))
    sig, who, score = [], [], []
    for i in range(len(needs)):
        cols, v = column[starts[i]: starts[i + 1]], value[starts[i]: starts[i + 1]]
        bound, best, at = points(highest[cols], v).sum(), None, 0
        for first in range(0, len(classes), SCORE_BLOCK):
            block = slice(first, first + SCORE_BLOCK)
            full = np.flatnonzero(held[block][:, cols].all(axis=1))
            if not len(full):
                continue
            s = points(levels[block][full][:, cols], v).sum(axis=1)
            j = int(s.argmax())  # the first of equal scores has the least id
            if best is None or s[j] > best:
                best, at = s[j], first + full[j]
            if best >= bound:
                break
        if best is not None:
            sig.append(i)
            who.append(at)
            score.append(base + int(best))
    if not sig:
        return empty
    return pa.table([needs["_sig"].take(sig), classes[cand].take(who), pa.array(score, pa.int64())], names=empty.schema.names)
