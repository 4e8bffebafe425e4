"""Window functions, sort, limit and top-k (WIN-*)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.common import (_cols, _names, attach_scalars, chunk_count, global_prefix_sum, join_on, lag_chunked,
                                      prefix_sum,
                                      prefix_sums, quantile_chunk, running_extreme, shift_many_chunked)

_RANKERS = {"row_number": F.row_number, "rank": F.rank, "dense_rank": F.dense_rank}


def rank_rows(df: DataFrame, by, order: Sequence, kind: str = "row_number",
              out: str = "rn", chunk=None) -> DataFrame:
    """WIN-01: row_number / rank / dense_rank per group with a multi-key order.
    With ``chunk`` (ascending column names; the first is the ranking value,
    the rest break row_number ties) the chunked form is used."""
    if chunk is not None:
        names = _names(order)
        return rank_rows_chunked(df, by, names[0], kind, out, chunk, tie=names[1:])
    w = Window.partitionBy(*_cols(by)).orderBy(*_cols(order))
    return df.withColumn(out, _RANKERS[kind]().over(w))


def rank_rows_chunked(df: DataFrame, by, order_col: str, kind: str, out: str, chunk, tie: Sequence = ()
                      ) -> DataFrame:
    """WIN-01 chunked (single order column, ascending): row_number is a
    chunked prefix count over (order_col, *tie); rank = 1 + rows with a
    smaller order value and dense_rank = number of distinct values up to
    the row's, both from chunked prefix sums over the distinct values,
    joined back.  ``chunk`` must be an expression of ``order_col`` that is
    monotone in it."""
    keys = _names(by)
    if kind == "row_number":
        d = df.withColumn("__rk_one", F.lit(1)).withColumn("__rk_c", chunk)
        return prefix_sum(d, keys, [F.col(order_col), *_cols(tie)], "__rk_one", out, "__rk_c") \
            .drop("__rk_one", "__rk_c").withColumn(out, F.col(out).cast("int"))
    vals = df.groupBy(*keys, order_col).agg(F.count(F.lit(1)).alias("__rk_n")) \
             .withColumn("__rk_one", F.lit(1)).withColumn("__rk_c", chunk)
    if kind == "dense_rank":
        v = prefix_sum(vals, keys, [F.col(order_col)], "__rk_one", out, "__rk_c")
    elif kind == "rank":
        v = prefix_sum(vals, keys, [F.col(order_col)], "__rk_n", "__rk_upto", "__rk_c") \
            .withColumn(out, F.col("__rk_upto") - F.col("__rk_n") + 1).drop("__rk_upto")
    else:
        raise ValueError(kind)
    v = v.select(*keys, order_col, F.col(out).cast("int").alias(out))
    return join_on(df, v, [*keys, order_col])


def top_n_per(df: DataFrame, by, order: Sequence, n: int, kind: str = "row_number",
              out: str = "rn") -> DataFrame:
    """WIN-02: top-n rows per group.  A rank filter lets Spark insert a
    WindowGroupLimit, so each map task keeps only n rows per group before
    the shuffle."""
    return rank_rows(df, by, order, kind, out).filter(F.col(out) <= n)


def nth_or_last(df: DataFrame, by, order: Sequence, n: int) -> DataFrame:
    """WIN-03: the n-th row per group, or the last one when the group is
    shorter.  Only the first n rows per group are ranked (a rank filter, so
    Spark keeps n rows per group and task before the shuffle); group sizes
    come from an aggregate joined back."""
    keys = _names(by)
    top = top_n_per(df, by, order, n, "row_number", "_rn")
    cnt = df.groupBy(*_cols(by)).agg(F.count(F.lit(1)).alias("_cnt"))
    return join_on(top, cnt, keys).filter(F.col("_rn") == F.least(F.lit(n), F.col("_cnt"))).drop("_rn", "_cnt")


def shift(df: DataFrame, by, order: Sequence, col: str, n: int = 1, default=None,
          lead: bool = False, out: str | None = None, chunk=None) -> DataFrame:
    """WIN-04: lag/lead with offset; ``default`` may be a Column (own value).
    With ``chunk`` (monotone in ``order``) no group is one task: an offset of
    one is a chunked lag, a larger one is sent from row to row by position."""
    out = out or f"{'next' if lead else 'prev'}_{col}"
    if chunk is not None and n == 1:
        oc = F.struct(*_cols(order)) if len(list(order)) > 1 else _cols(order)[0]
        d = df.withColumn("__sh_o", oc).withColumn("__sh_v", F.col(col))
        d = lag_chunked(d, _names(by), "__sh_o", ["__sh_v"], chunk, "__sh_p", descending=lead)
        e = F.col("__sh_p__sh_v")
        if default is not None:
            e = F.coalesce(e, default if isinstance(default, Column) else F.lit(default))
        return d.withColumn(out, e).drop("__sh_o", "__sh_v", "__sh_p__sh_v")
    if chunk is not None:
        d = prefix_sums(df.withColumn("__fc", chunk), _names(by), order, {"__n": F.lit(1)}, "__fc").drop("__fc")
        d = _send(d, _names(by), "__n", {"__got": (F.struct(F.col(col).alias("v")), F.col("__n") + (-n if lead else n))})
        e = F.col("__got.v")
        if default is not None:
            e = F.coalesce(e, default if isinstance(default, Column) else F.lit(default))
        return d.select(*df.columns, e.alias(out))
    w = Window.partitionBy(*_cols(by)).orderBy(*_cols(order))
    fn = F.lead if lead else F.lag
    expr = fn(col, n).over(w)
    if default is not None:
        expr = F.coalesce(expr, default if isinstance(default, Column) else F.lit(default))
    return df.withColumn(out, expr)


def framed(df: DataFrame, by, order: Sequence, val: str, lo, hi, agg: str = "sum",
           out: str | None = None, range_frame: bool = False) -> DataFrame:
    """WIN-05..12: aggregate over a ROWS (or RANGE) frame ``lo..hi``."""
    w = Window.partitionBy(*_cols(by)).orderBy(*_cols(order))
    w = w.rangeBetween(lo, hi) if range_frame else w.rowsBetween(lo, hi)
    return df.withColumn(out or f"{agg}_{val}", getattr(F, agg)(val).over(w))


def running_sum(df, by, order, val, out="running", chunk=None):
    """WIN-05: rows frame unbounded preceding .. current.  With ``chunk`` the
    two-level prefix sum is used so one hot key is not one task."""
    if chunk is not None:
        return prefix_sum(df, _names(by), order, val, out, chunk)
    return framed(df, by, order, val, Window.unboundedPreceding, Window.currentRow, "sum", out)


def trailing(df, by, order, val, n, agg="avg", out=None):
    """WIN-06: n preceding .. current."""
    return framed(df, by, order, val, -n, Window.currentRow, agg, out)


def centred(df, by, order, val, before=1, after=1, agg="avg", out=None):
    """WIN-07: before preceding .. after following."""
    return framed(df, by, order, val, -before, after, agg, out)


def group_total(df, by, val, agg="sum", out=None):
    """WIN-08: whole-partition aggregate: a grouped aggregate (map-side
    combined) joined back on the key; AQE can split a hot key in that join,
    which it cannot do for a window."""
    out = out or f"{agg}_{val}"
    g = df.groupBy(*_cols(by)).agg(getattr(F, agg)(val).alias(out))
    return join_on(df, g, _names(by))


def range_running(df, by, order_col: str, val, out="running"):
    """WIN-09: RANGE frame, equal order keys (peers) share the total."""
    return framed(df, by, [order_col], val, Window.unboundedPreceding, Window.currentRow,
                  "sum", out, range_frame=True)


def reverse_running(df, by, order, val, out="remaining"):
    """WIN-10: current .. unbounded following."""
    return framed(df, by, order, val, Window.currentRow, Window.unboundedFollowing, "sum", out)


def look_ahead(df, by, order, val, k, agg="max", out=None):
    """WIN-11: current .. k following."""
    return framed(df, by, order, val, Window.currentRow, k, agg, out)


def max_before(df, by, order, val, out=None):
    """WIN-12: running max excluding the current row."""
    return framed(df, by, order, val, Window.unboundedPreceding, -1, "max", out or f"max_before_{val}")


def first_last(df: DataFrame, by, order_col: str, val: str) -> DataFrame:
    """WIN-13: first and latest value per key (full frame, as min_by/max_by)."""
    return df.groupBy(*_cols(by)).agg(F.min_by(val, order_col).alias(f"first_{val}"),
                                      F.max_by(val, order_col).alias(f"last_{val}"))


def pareto(df: DataFrame, item: str, val: str, share: float = 0.8, out_running="running",
           buckets: int | None = None) -> DataFrame:
    """WIN-14: items that make the first ``share`` of the total, largest first.

    The global running sum is a partitioned prefix sum: items are aggregated,
    cut into quantile ranges (``chunk_count`` of them) of the item total (monotone in the
    descending order, so balanced chunks), each chunk is summed locally and
    chunk offsets come from a table with a row per chunk.  No single-partition
    window is used.
    """
    per_item = df.groupBy(item).agg(F.sum(val).alias("total"))
    buckets = buckets or chunk_count(df)
    probs = [i / buckets for i in range(1, buckets)]
    stats = per_item.agg(F.percentile_approx("total", probs, max(10_000, 4 * buckets)).alias("_qs"),
                         F.sum("total").alias("_grand"))
    d = attach_scalars(per_item, stats)
    d = d.withColumn("_chunk", F.size(F.filter("_qs", lambda q: q > F.col("total"))))
    d = d.withColumn("_k", F.lit(0))
    d = prefix_sum(d, ["_k"], [F.col("total").desc(), F.col(item)], "total", out_running, "_chunk")
    # keep items whose running total before them is still under the share
    return (d.filter(F.col(out_running) - F.col("total") < F.lit(share) * F.col("_grand"))
             .drop("_k", "_qs", "_grand"))


def every_nth(df, by, order, n, chunk=None):
    """WIN-16: each n-th row per group (chunked position when ``chunk``)."""
    if chunk is None:
        w = Window.partitionBy(*_cols(by)).orderBy(*_cols(order))
        return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") % n == 0).drop("_rn")
    d = prefix_sum(df.withColumn("_one", F.lit(1)).withColumn("_ch", chunk), _names(by), order, "_one", "_rn", "_ch")
    return d.filter(F.col("_rn") % n == 0).drop("_rn", "_one", "_ch")


def form_teams(df: DataFrame, by: str, order: Sequence, size: int) -> DataFrame:
    """WIN-17: consecutive teams of ``size`` per group, global team numbers.

    Team number within a group is ``(rn-1) div size``; global numbers are a
    prefix over the per-group team counts (a table with one row per group).
    """
    d = positions(df, by, order, "_rn").withColumn("team_in_group", F.expr(f"(_rn - 1) div {size}"))
    groups = d.groupBy(by).agg(F.max("team_in_group").alias("_teams"))
    groups = groups.withColumn("_n", F.col("_teams") + 1)
    # one row per group; a quantile-chunked global prefix keeps it parallel
    groups = global_prefix_sum(groups, by, [], "_n", "_upto")
    groups = groups.withColumn("_base", F.col("_upto") - F.col("_n")).select(by, "_base")
    return (join_on(d, groups, [by]).withColumn("team_no", F.col("_base") + F.col("team_in_group") + 1)
             .drop("_rn", "_base"))


def nth_else_only(df, by, order, n=2):
    """WIN-18: the n-th row, or the only row of one-row groups (rank filter
    on the first n rows plus group counts from an aggregate)."""
    keys = _names(by)
    top = top_n_per(df, by, order, n, "row_number", "_rn")
    cnt = df.groupBy(*_cols(by)).agg(F.count(F.lit(1)).alias("_cnt"))
    return join_on(top, cnt, keys).filter((F.col("_rn") == n) | (F.col("_cnt") == 1)).drop("_rn", "_cnt")


def best_spread(df, by, order, val, out="best_spread"):
    """WIN-20: max over time of value minus the running minimum so far."""
    w = (Window.partitionBy(*_cols(by)).orderBy(*_cols(order))
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    d = df.withColumn("_gain", F.col(val) - F.min(val).over(w))
    return d.groupBy(*_cols(by)).agg(F.max("_gain").alias(out))


def repeat_within(df, key_cols, order_col: str, val: str, k: int, chunk=None):
    """WIN-21: rows whose value appeared at most ``k`` positions earlier
    (positions = ``order_col``).  Partitioned by the value; with ``chunk``
    the previous occurrence is a chunked lag, so a frequent value is not one
    task."""
    if chunk is None:
        w = Window.partitionBy(val).orderBy(order_col)
        d = df.withColumn("_prev", F.lag(order_col).over(w))
    else:
        d = lag_chunked(df, [val], order_col, [order_col], chunk, "_p").withColumnRenamed(f"_p{order_col}", "_prev")
    return d.filter(F.col(order_col) - F.col("_prev") <= k).drop("_prev")


def product_except_self(df, by, val, out="product_except_self"):
    """WIN-22: product of the other rows of the group; zeros handled by count."""
    w = Window.partitionBy(*_cols(by))
    nz = F.when(F.col(val) != 0, F.col(val).cast("double"))
    d = (df.withColumn("_zeros", F.sum(F.when(F.col(val) == 0, 1).otherwise(0)).over(w))
           .withColumn("_prod", F.product(F.coalesce(nz, F.lit(1.0))).over(w)))
    expr = (F.when(F.col("_zeros") > 1, F.lit(0.0))
             .when(F.col("_zeros") == 1, F.when(F.col(val) == 0, F.col("_prod")).otherwise(F.lit(0.0)))
             .otherwise(F.col("_prod") / F.col(val)))
    return d.withColumn(out, expr).drop("_zeros", "_prod")


def sort_limit(df, order: Sequence, n: int, offset: int = 0):
    """WIN-23: global order then limit (TakeOrderedAndProject: per-task top-n)."""
    d = df.orderBy(*_cols(order))
    if offset:
        d = d.offset(offset)
    return d.limit(n)


def page(df, order: Sequence, page_no: int, size: int, where=None):
    """WIN-24: filtered, sorted page ``page_no`` (1-based) of ``size`` rows."""
    d = df.filter(where) if where is not None else df
    return sort_limit(d, order, size, (page_no - 1) * size)


def page_after(df, order_col: str, after, size: int, where=None):
    """WIN-24 keyset form for deep pages: rows after the last seen key."""
    d = df.filter(where) if where is not None else df
    return d.filter(F.col(order_col) > F.lit(after)).orderBy(order_col).limit(size)


def positions(df: DataFrame, by, order: Sequence, out: str = "position") -> DataFrame:
    """Row number (from 1) of each row in its group, ``order`` ascending: a
    chunked prefix count over quantiles of the first order column, so a hot
    group is many tasks."""
    d = quantile_chunk(df.withColumn("__po", _cols(order)[0]), "__po", out="__pc")
    return prefix_sums(d, _names(by), order, {out: F.lit(1)}, "__pc").drop("__po", "__pc")


def slide(df, by, order, val, n, out="window_vals", full: bool = True):
    """WIN-25: overlapping lists of the next n values, NULLs left out; with
    ``full`` only lists of n values.  A chunked pass of n - 1 leads."""
    d = df.withColumn("__fo", _order_col(order)).withColumn("__po", _cols(order)[0])
    d = shift_many_chunked(quantile_chunk(d, "__po", out="__fc"), _names(by), "__fo", val, n - 1, "__fc", "__fa", descending=True)
    ahead = [f"__fa{i}" for i in range(1, n)]
    d = d.withColumn(out, F.filter(F.array(val, *ahead), lambda x: x.isNotNull())).drop("__fo", "__po", "__fc", *ahead)
    return d.filter(F.size(out) == n) if full else d


def chunk(df, by, order, n, out="chunk_no"):
    """WIN-25: consecutive chunks of n rows per group."""
    return positions(df, by, order, "__n").withColumn(out, F.floor((F.col("__n") - 1) / n).cast("long")).drop("__n")


def sorted_under(df, word: str, order_col: str, alphabet: str, by=None):
    """WIN-26: are words in ``order_col`` order sorted under a custom alphabet?

    Each letter is translated to a sortable code; returns per row whether the
    word is >= the previous word under that order, within ``by`` or, without
    it, in the whole table (a chunked lag: neither is one task)."""
    target = "".join(chr(0x4E00 + i) for i in range(len(alphabet)))
    d = quantile_chunk(df.withColumn("_key", F.translate(F.col(word), alphabet, target)), order_col, out="_qc")
    d = lag_chunked(d, _names(by), order_col, ["_key"], "_qc", prefix="_prev")
    return d.withColumn("in_order", F.col("_prev_key").isNull() | (F.col("_prev_key") <= F.col("_key"))) \
            .drop("_key", "_prev_key", "_qc")


def pack_budget(df: DataFrame, cls: str, cost: str, tie: str, budget: float,
                order_classes: Sequence[str]) -> DataFrame:
    """WIN-15: cheapest first per class until the budget is used; each next
    class gets what the previous classes left.  Running sums per class are
    chunked prefix sums (quantile chunks of cost), so one class is not one
    task."""
    d = quantile_chunk(df, cost, out="_qc")
    d = prefix_sum(d, [cls], [F.col(cost), F.col(tie)], cost, "_run", "_qc").drop("_qc")
    left = F.lit(float(budget))
    picked = None
    for c in order_classes:
        sel = d.filter((F.col(cls) == c) & (F.col("_run") <= left)) if picked is None else None
        if picked is None:
            picked = sel
            spent = sel.agg(F.coalesce(F.sum(cost), F.lit(0.0)).alias("_spent"))
        else:
            cand = attach_scalars(d.filter(F.col(cls) == c), spent)
            sel = cand.filter(F.col("_run") <= F.lit(float(budget)) - F.col("_spent")).drop("_spent")
            spent2 = sel.agg(F.coalesce(F.sum(cost), F.lit(0.0)).alias("_s2"))
            spent = attach_scalars(spent, spent2).select((F.col("_spent") + F.col("_s2")).alias("_spent"))
            picked = picked.unionByName(sel)
    return picked.drop("_run")


def nth_matches(ref: DataFrame, df: DataFrame, key: str, order: Sequence, n: int, test: Column,
                out: str = "matches") -> DataFrame:
    """WIN-19: 'Yes' when the n-th row of the key passes ``test``; a key
    without an n-th row gets 'No' (left join from the reference table)."""
    w = Window.partitionBy(key).orderBy(*_cols(order))
    nth = df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == n) \
            .select(key, test.alias("_ok"))
    return ref.join(nth, key, "left").withColumn(
        out, F.when(F.coalesce("_ok", F.lit(False)), "Yes").otherwise("No")).drop("_ok")


# ---------------------------------------------------------------- chunked frames

def _order_col(order: Sequence) -> Column:
    cols = _cols(order)
    return F.struct(*cols) if len(cols) > 1 else cols[0]


def _send(d: DataFrame, keys: Sequence[str], position: str, parcels: dict[str, tuple[Column, Column]]) -> DataFrame:
    """Rows of ``d`` with what other rows of their key have sent them: name ->
    (value, position it is sent to).  Rows and parcels meet by (key, position)
    in one shuffle, so a hot key is as many groups as it has rows."""
    none = lambda c: F.when(F.lit(False), c)  # noqa: E731  a typed NULL
    row = F.struct(*[F.col(c) for c in d.columns])
    empty = {name: none(v) for name, (v, _) in parcels.items()}

    def record(at: Column, body: Column, **held: Column) -> Column:
        return F.struct(at.alias("at"), body.alias("row"), *[held.get(n, e).alias(n) for n, e in empty.items()])

    records = [record(F.col(position), row), *[record(to, none(row), **{name: v}) for name, (v, to) in parcels.items()]]
    met = (d.select(F.struct(*[F.col(k) for k in keys]).alias("__k"), F.explode(F.array(*records)).alias("__r"))
            .groupBy("__k", "__r.at").agg(F.first("__r.row", ignorenulls=True).alias("__row"),
                                          *[F.first(f"__r.{n}", ignorenulls=True).alias(n) for n in parcels]))
    return met.filter(F.col("__row").isNotNull()).select("__row.*", *parcels)


def framed_chunked(df: DataFrame, by, order: Sequence, val: str, lo: int, hi: int, agg: str, out: str, chunk) -> DataFrame:
    """ROWS frame ``lo .. hi`` (lo <= 0 <= hi) of any width without a per-key
    window.  Every row gets its position in its key by a chunked prefix sum.
    Sums, counts and means are differences of running totals (as double, so a
    NaN or an infinity reaches all later frames of its key); extremes are those
    of the frame's two parts: blocks as wide as the frame hold at most two of
    them, the end of one (a suffix extreme) and the start of the next (a prefix
    extreme).  What a row needs from the rows at the ends of its frame is sent
    to it by position."""
    if agg not in ("sum", "avg", "count", "min", "max"):
        raise ValueError(agg)
    keys, own = _names(by), list(df.columns)
    there, x = F.col(val).isNotNull().cast("long"), F.col(val)
    number = lambda c: F.coalesce(c.cast("double"), F.lit(0.0))
    d = df.withColumn("__fc", chunk)
    if agg in ("sum", "avg", "count"):
        sums = {"__n": F.lit(1), "__c": there} | ({} if agg == "count" else {"__s": number(x)})
        d = prefix_sums(d, keys, order, sums, "__fc").drop("__fc")
        state = F.struct(*[F.col(c) for c in sums if c != "__n"])
        whole = d.groupBy(*keys).agg(F.max_by(state, "__n").alias("__whole"))
        d = _send(d, keys, "__n", {"__end": (state, F.col("__n") - hi), "__start": (state, F.col("__n") + 1 - lo)})
        d = join_on(d, whole, keys)
        part = lambda f: F.coalesce(F.col(f"__end.{f}"), F.col(f"__whole.{f}")) - F.coalesce(F.col(f"__start.{f}"), F.lit(0))
        count = part("__c")
        e = count if agg == "count" else F.when(count > 0, part("__s") if agg == "sum" else part("__s") / count)
        return d.select(*own, e.alias(out))
    wide, best, pick = hi - lo + 1, getattr(F, agg), F.least if agg == "min" else F.greatest
    d = prefix_sums(d, keys, order, {"__n": F.lit(1)}, "__fc").drop("__fc").withColumn("__n", F.col("__n") - 1)
    d = d.withColumn("__b", F.struct(*[F.col(k) for k in keys], F.floor(F.col("__n") / wide).alias("__block")))
    block = Window.partitionBy("__b").orderBy("__n")  # at most as many rows as the frame
    d = (d.withColumn("__pre", best(x).over(block.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
          .withColumn("__suf", best(x).over(block.rowsBetween(Window.currentRow, Window.unboundedFollowing))).drop("__b"))
    last = d.groupBy(*keys).agg(F.max("__n").alias("__last"), F.max_by(F.struct("__pre"), "__n").alias("__tail"))
    d = _send(d, keys, "__n", {"__end": (F.struct("__pre"), F.col("__n") - hi), "__start": (F.struct("__suf"), F.col("__n") - lo)})
    d = join_on(d, last, keys)
    first, end = F.col("__n") + lo, F.least(F.col("__n") + hi, F.col("__last"))
    head, tail = F.col("__start.__suf"), F.coalesce("__end", "__tail")["__pre"]
    e = (F.when(first < 0, tail).when(F.floor(first / wide) == F.floor(end / wide), head)
          .otherwise(F.coalesce(pick(head, tail), head, tail)))
    return d.select(*own, e.alias(out))


def max_before_chunked(df: DataFrame, by, order: Sequence, val: str, out: str, chunk) -> DataFrame:
    """WIN-12 chunked: running max excluding the current row = the previous
    row's inclusive running max (chunked running max, then chunked lag)."""
    keys = _names(by)
    d = df.withColumn("__fo", _order_col(order)).withColumn("__fc", chunk)
    d = running_extreme(d, keys, "__fo", val, out, "__fc", "max", exclusive=True)
    return d.drop("__fo", "__fc")


def best_spread_chunked(df: DataFrame, by, order: Sequence, val: str, chunk, out: str = "best_spread") -> DataFrame:
    """WIN-20 chunked: value minus the chunked running minimum, max per key."""
    keys = _names(by)
    d = df.withColumn("__fo", _order_col(order)).withColumn("__fc", chunk)
    d = running_extreme(d, keys, "__fo", val, "__rmin", "__fc", "min")
    return d.groupBy(*keys).agg(F.max(F.col(val) - F.col("__rmin")).alias(out))


def reverse_running_chunked(df: DataFrame, by, order: Sequence, val: str, out: str, chunk) -> DataFrame:
    """WIN-10 chunked: current .. unbounded following = group total - running
    total before the row (a chunked prefix sum and a grouped total)."""
    keys = _names(by)
    d = prefix_sum(df.withColumn("__fc", chunk), keys, order, val, "__run", "__fc")
    tot = df.groupBy(*keys).agg(F.sum(val).alias("__tot"))
    return join_on(d, tot, keys).withColumn(out, F.col("__tot") - F.col("__run") + F.col(val)) \
            .drop("__fc", "__run", "__tot")


def range_running_chunked(df: DataFrame, by, order_col: str, val: str, out: str, chunk) -> DataFrame:
    """WIN-09 chunked: RANGE unbounded .. current (peers share the total) =
    chunked prefix sum over the per-(key, order value) sums, joined back."""
    keys = _names(by)
    per = df.groupBy(*keys, order_col).agg(F.sum(val).alias("__s"))
    per = prefix_sum(per.withColumn("__fc", chunk), keys, [F.col(order_col)], "__s", out, "__fc").drop("__fc", "__s")
    return join_on(df, per, [*keys, order_col])
