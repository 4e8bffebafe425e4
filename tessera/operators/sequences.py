"""Sequence analytics (SEQ-*): islands, sessions, runs, retention, calendars.

Three shared building blocks: ``flag_change`` (a row starts a new group),
``running_group`` (group id = running count of starts, as a chunked prefix
sum when a chunk column is given, so a key holding a third of the rows is
spread over many tasks) and ``month_index`` (year-aware month number).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.common import (_cols, _names, attach_scalars, chunk_key, chunk_keys, join_on, lag_chunked, month_index,
                                      prefix_sum, running_extreme, spread)

__all__ = ["month_index"]


def running_group(df: DataFrame, by, order: Sequence, start_flag: Column, out: str = "grp",
                  chunk=None) -> DataFrame:
    """Group id per key = running count of rows flagged as group starts."""
    d = df.withColumn("_start", start_flag.cast("int"))
    if chunk is not None:
        return prefix_sum(d, _names(by), order, "_start", out, chunk).drop("_start")
    w = (Window.partitionBy(*_cols(by)).orderBy(*_cols(order))
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return d.withColumn(out, F.sum("_start").over(w)).drop("_start")


def islands(df: DataFrame, by, value: str, chunk=None) -> DataFrame:
    """SEQ-01: runs of consecutive integers: key = value - rank among the
    distinct values.  With ``chunk`` (monotone in the value) the rank is a
    chunked prefix count, so a hot key is not one task."""
    d = df.select(*_cols(by), value).distinct()
    if chunk is None:
        w = Window.partitionBy(*_cols(by)).orderBy(value)
        d = d.withColumn("_rk", F.row_number().over(w))
    else:
        d = prefix_sum(d.withColumn("_one", F.lit(1)), _names(by), [F.col(value)], "_one", "_rk", chunk).drop("_one")
    d = d.withColumn("_isl", F.col(value) - F.col("_rk"))
    return d.groupBy(*_cols(by), "_isl").agg(F.min(value).alias("start"), F.max(value).alias("end"),
                                             F.count(F.lit(1)).alias("n")).drop("_isl")


def date_islands(df: DataFrame, by, date: str, max_gap_days: int = 1, min_rows: int = 2,
                 chunk_days: int | None = None) -> DataFrame:
    """SEQ-02: runs of dates with gaps <= ``max_gap_days``, >= ``min_rows`` dates.
    With ``chunk_days`` the previous-date lookup and the run numbering are
    chunked by blocks of that many days."""
    d = df.select(*_cols(by), F.to_date(date).alias("_d")).distinct()
    if chunk_days is None:
        w = Window.partitionBy(*_cols(by)).orderBy("_d")
        d = d.withColumn("_prev", F.lag("_d").over(w))
        ch = None
    else:
        ch = F.floor(F.unix_date("_d") / chunk_days)
        d = lag_chunked(d, _names(by), "_d", ["_d"], ch, "_p").withColumnRenamed("_p_d", "_prev")
    d = d.withColumn("_gap", F.datediff("_d", "_prev"))
    d = running_group(d, by, ["_d"], F.col("_gap").isNull() | (F.col("_gap") > max_gap_days), chunk=ch)
    return (d.groupBy(*_cols(by), "grp").agg(F.min("_d").alias("start"), F.max("_d").alias("end"),
                                             F.count(F.lit(1)).alias("n_days"))
              .filter(F.col("n_days") >= min_rows).drop("grp"))


def runs_of(df: DataFrame, by, order: Sequence, flag: Column, k: int, chunk=None) -> DataFrame:
    """SEQ-03: rows inside runs of >= k consecutive flagged rows.  Run id =
    position in the key minus position among rows with the same flag; with
    ``chunk`` both positions are chunked prefix counts and run lengths come
    from an aggregate joined back (no window spans a key)."""
    d = df.withColumn("_f", flag)
    if chunk is None:
        w = Window.partitionBy(*_cols(by)).orderBy(*_cols(order))
        d = d.withColumn("_rn", F.row_number().over(w))
        d = d.withColumn("_rnf", F.row_number().over(Window.partitionBy(*_cols(by), "_f").orderBy(*_cols(order))))
        d = d.withColumn("_isl", F.col("_rn") - F.col("_rnf"))
        d = d.withColumn("_len", F.count(F.lit(1)).over(Window.partitionBy(*_cols(by), "_f", "_isl")))
        return d.filter(F.col("_f") & (F.col("_len") >= k)).drop("_f", "_rn", "_rnf", "_isl", "_len")
    keys = _names(by)
    d = d.withColumn("_one", F.lit(1)).withColumn("_ch", chunk)
    d = prefix_sum(d, keys, order, "_one", "_rn", "_ch")
    d = prefix_sum(d, [*keys, "_f"], order, "_one", "_rnf", "_ch")
    d = d.withColumn("_isl", F.col("_rn") - F.col("_rnf"))
    runs = (d.filter("_f").groupBy(*keys, "_isl").agg(F.count(F.lit(1)).alias("_len"))
              .filter(F.col("_len") >= k).select(*keys, "_isl"))
    return join_on(d.filter("_f"), runs, [*keys, "_isl"], "left_semi").drop("_f", "_rn", "_rnf", "_isl", "_one", "_ch")


def free_blocks(df: DataFrame, row: str, seat: str, free: Column, k: int) -> DataFrame:
    """SEQ-04: seats inside blocks of >= k adjacent free seats in a row."""
    d = df.filter(free).select(row, seat).distinct()
    w = Window.partitionBy(row).orderBy(seat)
    d = d.withColumn("_isl", F.col(seat) - F.row_number().over(w))
    d = d.withColumn("_len", F.count(F.lit(1)).over(Window.partitionBy(row, "_isl")))
    return d.filter(F.col("_len") >= k).drop("_isl", "_len")


def on_off_runs(df: DataFrame, by, ts: str, is_on: Column, chunk: Column | None = None) -> DataFrame:
    """SEQ-05: each run of 'on' rows -> login (first on), logout (first row
    of the following 'off' run, NULL when none), count of on rows.  With
    ``chunk`` (monotone in ``ts``, e.g. the day) every step is chunked."""
    d = df.withColumn("_on", is_on)
    if chunk is None:
        w = Window.partitionBy(*_cols(by)).orderBy(ts)
        d = d.withColumn("_prevon", F.lag("_on").over(w))
    else:
        d = lag_chunked(d.withColumn("_ch", chunk), _names(by), ts, ["_on"], "_ch", "_p") \
            .withColumnRenamed("_p_on", "_prevon")
    d = d.withColumn("_chg", F.coalesce(F.col("_prevon") != F.col("_on"), F.lit(True)))
    d = running_group(d, by, [ts], F.col("_chg"), chunk=None if chunk is None else "_ch")
    g = d.groupBy(*_cols(by), "grp").agg(F.first("_on").alias("_on"), F.min(ts).alias("_start"),
                                         F.count(F.lit(1)).alias("on_count"))
    if chunk is None:
        g = g.withColumn("logout", F.lead("_start").over(Window.partitionBy(*_cols(by)).orderBy("grp")))
    else:
        g = lag_chunked(g.withColumn("_gch", F.to_date("_start")), _names(by), "grp", ["_start"], "_gch", "_n",
                        descending=True).withColumnRenamed("_n_start", "logout").drop("_gch")
    return g.filter("_on").select(*_cols(by), F.col("_start").alias("login"), "logout", "on_count")


def sessionize(df: DataFrame, key: str, ts: str, gap_s: int = 1800, chunk: Column | None = None,
               id_col: str | None = None) -> DataFrame:
    """SEQ-06: per key, a gap strictly greater than ``gap_s`` seconds starts a
    new session (an event exactly ``gap_s`` later stays in the session).

    Returns one row per session: key, session_no, start, end, n_events,
    duration_s.  One chunked pass (default chunk: calendar day of ``ts``):
    inside each (key, chunk) the gaps and a local session count are computed
    with the first row's flag left open; a one-row-per-chunk summary (first
    and last time, local count) decides each chunk's first flag from the
    previous chunk's last time and gives the session offsets.  A key holding
    a third of the rows is spread over its chunks."""
    chunk = chunk if chunk is not None else F.to_date(F.col(ts))
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    d = df.select(key, ts, *([id_col] if id_col else [])).withColumn("_us", us).withColumn("_ch", chunk_key([key], chunk))
    order = [F.col("_us")] + ([F.col(id_col)] if id_col else [])
    w = Window.partitionBy("_ch").orderBy(*order)
    d = d.withColumn("_prev", F.lag("_us").over(w))
    d = d.withColumn("_f", ((F.col("_prev").isNotNull()) & (F.col("_us") - F.col("_prev") > gap_s * 1_000_000)).cast("int"))
    d = d.withColumn("_loc", F.sum("_f").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    # from here on one row per local session; only a chunk's first one can go on from the chunk before
    d = d.groupBy("_ch", "_loc").agg(F.min(ts).alias("_s"), F.max(ts).alias("_e"), F.count(F.lit(1)).alias("_n"),
                                          F.min("_us").alias("_first"), F.max("_us").alias("_last"))
    summ = d.groupBy("_ch").agg(F.min("_first").alias("_first"), F.max("_last").alias("_last"),
                                     F.max("_loc").alias("_nloc"))
    wc = Window.partitionBy("_ch.k0").orderBy("_ch.c")
    summ = summ.withColumn("_prev_last", F.lag("_last").over(wc))
    summ = summ.withColumn("_ff", (F.col("_prev_last").isNull()
                                   | (F.col("_first") - F.col("_prev_last") > gap_s * 1_000_000)).cast("int"))
    summ = summ.withColumn("_off", F.coalesce(F.sum(F.col("_ff") + F.col("_nloc")).over(
        wc.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    d = d.join(summ.select("_ch", "_ff", "_off"), "_ch").withColumn(key, F.col("_ch.k0"))
    d = d.withColumn("session_no", (F.col("_off") + F.col("_ff") + F.col("_loc")).cast("bigint"))
    return d.groupBy(key, "session_no").agg(
        F.min("_s").alias("start"), F.max("_e").alias("end"), F.sum("_n").alias("n_events")
    ).withColumn("duration_s", (F.unix_micros(F.col("end").cast("timestamp"))
                                - F.unix_micros(F.col("start").cast("timestamp"))) / 1e6)


def overlap_count(df: DataFrame, key: str, start: str, end: str, tie: str, chunk=None) -> DataFrame:
    """SEQ-07: intervals that start before some earlier interval ended
    (running max of earlier ends > own start), counted per key.  With
    ``chunk`` the running max and the one-row shift are chunked."""
    if chunk is None:
        w = Window.partitionBy(key).orderBy(start, tie).rowsBetween(Window.unboundedPreceding, -1)
        d = df.withColumn("_maxend", F.max(end).over(w))
    else:
        d = _earlier_max(df, key, start, end, tie, chunk)
    return d.groupBy(key).agg(F.count_if(F.col("_maxend") > F.col(start)).alias("overlaps"))


def _earlier_max(df: DataFrame, key: str, start: str, end: str, tie: str, chunk) -> DataFrame:
    """Max of ``end`` over the rows before each row (by start, tie): chunked
    running max, then the previous row's value by a chunked lag."""
    d = df.withColumn("_o", F.struct(start, tie)).withColumn("_ch", chunk)
    d = running_extreme(d, [key], "_o", end, "_maxend", "_ch", "max", exclusive=True)
    return d.drop("_o", "_ch")


def merge_intervals(df: DataFrame, key: str, start: str, end: str, chunk=None) -> DataFrame:
    """SEQ-08: merge overlapping (touching counts as overlapping) intervals.

    Works on distinct starts per key (each with its latest end), so the
    order is total and every step is deterministic: running max of the ends
    of earlier starts, a new group when the start is beyond it, running
    count of new groups; no recursion.  With ``chunk`` (an expression of the
    start that is monotone in it, e.g. its year) every step is chunked."""
    st = df.groupBy(key, start).agg(F.max(end).alias("_e"))
    if chunk is None:
        w = Window.partitionBy(key).orderBy(start).rowsBetween(Window.unboundedPreceding, -1)
        d = st.withColumn("_maxend", F.max("_e").over(w))
        d = running_group(d, [key], [start], F.col("_maxend").isNull() | (F.col(start) > F.col("_maxend")))
    else:
        d = st.withColumn("_ch", chunk)
        d = running_extreme(d, [key], start, "_e", "_maxend", "_ch", "max", exclusive=True)
        d = running_group(d, [key], [start], F.col("_maxend").isNull() | (F.col(start) > F.col("_maxend")),
                          chunk="_ch")
    return d.groupBy(key, "grp").agg(F.min(start).alias("start"), F.max("_e").alias("end")).drop("grp")


def always_rising(df: DataFrame, key, order: Sequence, val: str, chunk=None) -> DataFrame:
    """SEQ-09: keys whose value strictly rises at every step (last row
    neutral); the next value is a chunked lead when ``chunk`` is given."""
    if chunk is None:
        w = Window.partitionBy(*_cols(key)).orderBy(*_cols(order))
        d = df.withColumn("_next", F.lead(val).over(w))
    else:
        d = df.withColumn("_o", F.struct(*_cols(order)))
        d = lag_chunked(d, _names(key), "_o", [val], chunk, "_nx_", descending=True) \
            .withColumnRenamed(f"_nx_{val}", "_next").drop("_o")
    return (d.groupBy(*_cols(key))
             .agg(F.bool_and(F.col("_next").isNull() | (F.col("_next") > F.col(val))).alias("_ok"))
             .filter("_ok").drop("_ok"))


def next_latency(df: DataFrame, key: str, order: Sequence, ts: str, limit_s: float, chunk=None) -> DataFrame:
    """SEQ-10: seconds to the key's next event, flag when above ``limit_s``
    (chunked lead when ``chunk`` is given)."""
    if chunk is None:
        w = Window.partitionBy(key).orderBy(*_cols(order))
        d = df.withColumn("_next", F.lead(ts).over(w))
    else:
        d = df.withColumn("_o", F.struct(*_cols(order)))
        d = lag_chunked(d, [key], "_o", [ts], chunk, "_nx_", descending=True) \
            .withColumnRenamed(f"_nx_{ts}", "_next").drop("_o")
    lat = (F.unix_micros(F.col("_next").cast("timestamp")) - F.unix_micros(F.col(ts).cast("timestamp"))) / 1e6
    return d.withColumn("latency_s", lat).withColumn("long_gap", F.col("latency_s") > limit_s).drop("_next")


def chained(df: DataFrame, key: str, order: Sequence, start: str, end: str) -> DataFrame:
    """SEQ-11: per row, does the next row start where this one ended?"""
    w = Window.partitionBy(key).orderBy(*_cols(order))
    return df.withColumn("chained", F.col(end) == F.lead(start).over(w))


def first_last_same(df: DataFrame, key, order_col: str, other: str) -> DataFrame:
    """SEQ-12: groups whose first and last rows share ``other``."""
    g = df.groupBy(*_cols(key)).agg(F.min_by(other, order_col).alias("_f"), F.max_by(other, order_col).alias("_l"))
    return g.filter(F.col("_f") == F.col("_l")).select(*_cols(key), F.col("_f").alias(other))


def endpoints(df: DataFrame, start: str, end: str) -> DataFrame:
    """SEQ-13: starts never seen as an end, ends never seen as a start."""
    s = df.select(F.col(start).alias("node")).distinct()
    e = df.select(F.col(end).alias("node")).distinct()
    return (s.join(e, "node", "left_anti").withColumn("kind", F.lit("origin"))
             .unionByName(e.join(s, "node", "left_anti").withColumn("kind", F.lit("terminus"))))


def new_vs_repeat(df: DataFrame, who: str, date: str) -> DataFrame:
    """SEQ-14: per date, subjects seen for the first time versus returning."""
    first = df.groupBy(who).agg(F.min(date).alias("_first"))
    d = df.select(who, date).distinct().join(first, who)
    return d.groupBy(date).agg(F.count_if(F.col(date) == F.col("_first")).alias("new_users"),
                               F.count_if(F.col(date) > F.col("_first")).alias("repeat_users"))


def first_seen_by_year(df: DataFrame, what: str, date: str) -> DataFrame:
    """SEQ-15: number of entities first seen in each year."""
    f = df.groupBy(what).agg(F.year(F.min(date)).alias("year"))
    return f.groupBy("year").agg(F.count(F.lit(1)).alias("new_entities"))


def retention(df: DataFrame, who: str, date: str) -> DataFrame:
    """SEQ-16: per month, subjects active that month and also the next one
    (retained) and those absent next month (churned); year-aware index."""
    a = df.select(who, month_index(date).alias("m")).distinct()
    nxt = a.select(who, (F.col("m") - 1).alias("m"), F.lit(True).alias("_back"))
    j = a.join(nxt, [who, "m"], "left")
    return j.groupBy("m").agg(F.count_if(F.col("_back").isNotNull()).alias("retained"),
                              F.count_if(F.col("_back").isNull()).alias("churned"))


def next_day_rate(df: DataFrame, who: str, date: str, digits: int = 2) -> DataFrame:
    """SEQ-17: share of subjects active on the day after their first day."""
    d = df.select(who, F.to_date(date).alias("_d")).distinct()
    first = d.groupBy(who).agg(F.min("_d").alias("_d"))
    back = d.join(first.select(who, F.date_add("_d", 1).alias("_d")), [who, "_d"], "left_semi")
    n_all = first.agg(F.count(F.lit(1)).alias("_n"))
    n_back = back.agg(F.count(F.lit(1)).alias("_b"))
    return attach_scalars(n_all, n_back).select(F.round(F.col("_b") / F.col("_n"), digits).alias("fraction"))


def same_day_conversion(df: DataFrame, who: str, date: str, kind: str, a: str, b: str) -> DataFrame:
    """SEQ-18: per seen date, subjects doing both ``a`` and ``b`` that day (0 listed)."""
    d = df.withColumn("_d", F.to_date(date))
    both = (d.filter(F.col(kind).isin(a, b)).groupBy(who, "_d").agg(F.count_distinct(kind).alias("_k"))
             .filter("_k = 2").groupBy("_d").agg(F.count(F.lit(1)).alias("converted")))
    days = d.select("_d").distinct()
    return days.join(both, "_d", "left").select(F.col("_d").alias("day"),
                                                F.coalesce("converted", F.lit(0)).cast("bigint").alias("converted"))


def conversion_within(df: DataFrame, who: str, ts: str, kind: str, start_kind: str, goal: str,
                      days: int, digits: int = 2) -> DataFrame:
    """SEQ-19: share of subjects whose ``goal`` happened within ``days`` days
    after their first ``start_kind`` event."""
    first = df.filter(F.col(kind) == start_kind).groupBy(who).agg(F.min(ts).alias("_t0"))
    hit = (df.filter(F.col(kind) == goal).join(first, who)
             .filter((F.col(ts) >= F.col("_t0")) & (F.col(ts) <= F.col("_t0") + F.expr(f"INTERVAL {days} DAYS")))
             .select(who).distinct())
    n = first.agg(F.count(F.lit(1)).alias("_n"))
    h = hit.agg(F.count(F.lit(1)).alias("_h"))
    return attach_scalars(n, h).select(F.round(F.col("_h") * 100.0 / F.col("_n"), digits).alias("pct"))


def campaign_success(df: DataFrame, who: str, date: str, item: str) -> DataFrame:
    """SEQ-20: subjects that bought, on a later day, an item not bought on
    their first day (and are active on more than one day).

    An item not bought on the first day is one whose own first day is later,
    so two groupings answer it; a NULL item equals none of the first day's,
    so its last day counts."""
    rows = spread(df.filter(F.col(who).isNotNull()).select(who, item, date), who, item)
    items = rows.groupBy(who, item).agg(F.min(date).alias("_min"), F.max(date).alias("_max"))
    new = F.when(F.col(item).isNull(), F.col("_max")).otherwise(F.col("_min"))
    return items.groupBy(who).agg(F.min("_min").alias("_first"), F.max(new).alias("_new")) \
                .filter(F.col("_new") > F.col("_first")).select(who)


def lapsed(df: DataFrame, who: str, date: str, idle_days: int, age_days: int) -> DataFrame:
    """SEQ-21: no activity in the last ``idle_days`` and first activity more
    than ``age_days`` ago, measured from the data's latest date."""
    g = df.groupBy(who).agg(F.min(date).alias("_first"), F.max(date).alias("_last"))
    now = df.agg(F.max(date).alias("_now"))
    d = attach_scalars(g, now)
    return d.filter((F.datediff("_now", "_last") > idle_days) & (F.datediff("_now", "_first") > age_days)) \
            .select(who)


def one_order_cohort(df: DataFrame, who: str, date: str) -> DataFrame:
    """SEQ-22: per acquisition month, subjects with exactly one order ever."""
    g = df.groupBy(who).agg(F.date_format(F.min(date), "yyyy-MM").alias("cohort"),
                            F.count(F.lit(1)).alias("_n"))
    return g.filter("_n = 1").groupBy("cohort").agg(F.count(F.lit(1)).alias("one_order_customers"))


def organic_share(df: DataFrame, who: str, order: Sequence, date: str, promo: Column,
                  digits: int = 2) -> DataFrame:
    """SEQ-23: per acquisition month, share of subjects whose first order
    had no promotion."""
    d = df.withColumn("_o", F.struct(*_cols(order))).withColumn("_promo", promo)
    g = d.groupBy(who).agg(F.min_by("_promo", "_o").alias("_p"), F.min(date).alias("_first"))
    return g.groupBy(F.date_format("_first", "yyyy-MM").alias("cohort")).agg(
        F.round(F.count_if(~F.col("_p")) * 100.0 / F.count(F.lit(1)), digits).alias("organic_pct"))


def survivors_and_leader(df: DataFrame, who: str, day: str, tie: str) -> DataFrame:
    """SEQ-24: per day, subjects active on every day so far, and the day's
    top subject by rows (ties to the lowest ``tie``)."""
    first_day = df.agg(F.min(day).alias("_d0"))
    act = df.select(who, day).distinct()
    w = Window.partitionBy(who).orderBy(day)
    act = attach_scalars(act, first_day).withColumn("_k", F.row_number().over(w))
    act = act.withColumn("_streak", F.col("_k") == F.datediff(day, "_d0") + 1)
    surv = act.filter("_streak").groupBy(day).agg(F.count(F.lit(1)).alias("survivors"))
    per = df.groupBy(day, who).agg(F.count(F.lit(1)).alias("_n"))
    lw = Window.partitionBy(day).orderBy(F.col("_n").desc(), F.col(tie))
    lead = per.withColumn("_r", F.row_number().over(lw)).filter("_r = 1").select(day, F.col(who).alias("leader"))
    return lead.join(surv, day, "left").withColumn("survivors", F.coalesce("survivors", F.lit(0)).cast("bigint"))


def inside_now(df: DataFrame, who: str, ts: str, action: str, in_v: str, out_v: str) -> DataFrame:
    """SEQ-25: subjects whose last 'in' is later than their last 'out'."""
    g = df.groupBy(who).agg(F.max(F.when(F.col(action) == in_v, F.col(ts))).alias("_in"),
                            F.max(F.when(F.col(action) == out_v, F.col(ts))).alias("_out"))
    return g.filter(F.col("_in").isNotNull() & (F.col("_out").isNull() | (F.col("_in") > F.col("_out")))).select(who)


def active_at(df: DataFrame, who: str, ts: str, event: str, start_v: str, cancel_v: str,
              months: int, at) -> DataFrame:
    """SEQ-26: subjects whose last start before ``at`` plus ``months`` is
    after ``at`` and with no cancel between that start and ``at``."""
    at_c = F.lit(at).cast("timestamp_ntz")
    d = df.filter(F.col(ts) <= at_c)
    last = d.filter(F.col(event) == start_v).groupBy(who).agg(F.max(ts).alias("_s"))
    cancels = d.filter(F.col(event) == cancel_v).select(who, F.col(ts).alias("_c"))
    live = last.filter(F.add_months(F.col("_s"), months) > at_c)
    cancelled = live.join(cancels, who).filter(F.col("_c") > F.col("_s")).select(who).distinct()
    return live.join(cancelled, who, "left_anti").select(who)


def recovery_days(df: DataFrame, who: str, ts: str, result: str, pos: str, neg: str) -> DataFrame:
    """SEQ-27: days from the first ``pos`` to the first later ``neg``."""
    p = df.filter(F.col(result) == pos).groupBy(who).agg(F.min(ts).alias("_p"))
    n = df.filter(F.col(result) == neg).select(who, F.col(ts).alias("_n")).join(p, who) \
          .filter(F.col("_n") > F.col("_p")).groupBy(who, "_p").agg(F.min("_n").alias("_n"))
    return n.select(who, F.datediff(F.to_date("_n"), F.to_date("_p")).alias("recovery_days"))


def fill_down(df: DataFrame, order: str, col: str, by=None, chunk: Column | str | None = None,
              out: str | None = None) -> DataFrame:
    """SEQ-28: NULL takes the last non-null value above in ``order``.

    With ``chunk`` (monotone in ``order``) the fill runs per (by, chunk);
    rows still NULL at a chunk start take the last non-null value of the
    earlier chunks from a one-row-per-chunk summary: no single task sees the
    whole table even when ``by`` is empty."""
    out = out or col
    keys = _names(by)
    if chunk is None:
        w = (Window.partitionBy(*_cols(by)).orderBy(order)
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        return df.withColumn(out, F.last(col, ignorenulls=True).over(w))
    d = df.withColumn("_chunk", chunk_key(keys, chunk))
    w = (Window.partitionBy("_chunk").orderBy(order)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    d = d.withColumn("_in", F.last(col, ignorenulls=True).over(w))
    # one row per chunk (also chunks without any non-null value): the last
    # non-null value of the chunk, carried forward across chunks
    last = d.groupBy("_chunk").agg(
        F.max_by(col, F.when(F.col(col).isNotNull(), F.struct(order))).alias("_lastv"))
    wc = (Window.partitionBy(*chunk_keys(keys, "_chunk")).orderBy("_chunk.c")
          .rowsBetween(Window.unboundedPreceding, -1))
    carry = last.withColumn("_carry", F.last("_lastv", ignorenulls=True).over(wc)).select("_chunk", "_carry")
    return (d.join(carry, "_chunk", "left")
             .withColumn(out, F.coalesce("_in", "_carry")).drop("_chunk", "_in", "_carry"))


def expand_numbers(df: DataFrame, n: str, out: str = "k") -> DataFrame:
    """SEQ-29: each row to rows 1..n (no recursion)."""
    return df.withColumn(out, F.explode(F.sequence(F.lit(1), F.col(n))))


def expand_dates(df: DataFrame, a: str, b: str, out: str = "day") -> DataFrame:
    """SEQ-29: each row to the dates from a to b inclusive."""
    return df.withColumn(out, F.explode(F.sequence(F.to_date(a), F.to_date(b), F.expr("INTERVAL 1 DAY"))))


def prorate_by_year(df: DataFrame, start: str, end: str, amount: str) -> DataFrame:
    """SEQ-30: spread ``amount`` evenly over the days of [start, end] and
    total it per year; closed form per year (at most a few rows per input)."""
    s, e = F.to_date(start), F.to_date(end)
    days = F.datediff(e, s) + 1
    d = df.withColumn("_s", s).withColumn("_e", e).withColumn("_days", days) \
          .withColumn("year", F.explode(F.sequence(F.year(s), F.year(e))))
    ys = F.make_date(F.col("year"), F.lit(1), F.lit(1))
    ye = F.make_date(F.col("year"), F.lit(12), F.lit(31))
    overlap = F.datediff(F.least("_e", ye), F.greatest("_s", ys)) + 1
    return d.withColumn("prorated", F.col(amount) * overlap / F.col("_days")).drop("_s", "_e", "_days")


def business_days(a: Column, b: Column) -> Column:
    """SEQ-31 (weekday part): Monday-Friday days in [a, b], closed form.

    w full weeks give 5w weekdays; the r = n mod 7 leftover days start on
    weekday d0 (Monday = 0) and cover indexes d0 .. d0+r-1 (at most 11), of
    which 5, 6 and 12, 13 are weekend days."""
    n = F.datediff(b, a) + 1
    w = F.floor(n / 7)
    r = n - w * 7
    d0 = (F.dayofweek(a) + 5) % 7
    last = d0 + r - 1
    wk1 = F.greatest(F.lit(0), F.least(last, F.lit(6)) - F.greatest(d0, F.lit(5)) + 1)
    wk2 = F.greatest(F.lit(0), F.least(last, F.lit(13)) - 11)
    return (w * 5 + r - wk1 - wk2).cast("bigint")


def business_days_between(df: DataFrame, a: str, b: str, holidays: DataFrame, day: str = "holiday",
                          out: str = "business_days") -> DataFrame:
    """SEQ-31: weekdays in [a, b] minus weekday holidays inside the range.

    The distinct holidays are dates, so a calendar has 262 of them a year at
    most; they are one sorted array in a one-row aggregate attached by
    broadcast, and each row counts the holidays in its range: no join back,
    no row ids."""
    h = holidays.select(F.to_date(day).alias("_h")).filter(F.dayofweek("_h").between(2, 6)).distinct()
    cal = h.agg(F.array_sort(F.collect_list("_h")).alias("_hs"))
    d = attach_scalars(df.withColumn("_a", F.to_date(a)).withColumn("_b", F.to_date(b)), cal)
    n_h = F.size(F.filter("_hs", lambda x: (x >= F.col("_a")) & (x <= F.col("_b"))))
    return d.withColumn(out, business_days(F.col("_a"), F.col("_b")) - n_h).drop("_a", "_b", "_hs")


def first_missing(df: DataFrame, by, n: str) -> DataFrame:
    """SEQ-32: smallest positive integer absent from ``n`` per group.
    Candidates are 1..(count+1) per group (the answer is always among them)."""
    vals = df.select(*_cols(by), F.col(n).alias("_v")).filter("_v > 0").distinct()
    cnt = vals.groupBy(*_cols(by)).agg(F.count(F.lit(1)).alias("_c"))
    cand = cnt.select(*_cols(by), F.explode(F.sequence(F.lit(1), F.col("_c") + 1)).alias("_v"))
    miss = cand.join(vals, [*_names(by), "_v"], "left_anti")
    return miss.groupBy(*_cols(by)).agg(F.min("_v").alias("first_missing"))


def pair_adjacent(df: DataFrame, id_col: str, who: str) -> DataFrame:
    """SEQ-33: odd id = seller, id+1 = buyer; subjects in both roles removed."""
    a = df.filter(F.col(id_col) % 2 == 1).select(F.col(id_col).alias("_i"), F.col(who).alias("seller"))
    b = df.select((F.col(id_col) - 1).alias("_i"), F.col(who).alias("buyer"))
    p = a.join(b, "_i").select("seller", "buyer")
    sellers = p.select(F.col("seller").alias("_u"))
    buyers = p.select(F.col("buyer").alias("_u"))
    both = sellers.intersect(buyers)
    return (p.join(both.withColumnRenamed("_u", "seller"), "seller", "left_anti")
             .join(both.withColumnRenamed("_u", "buyer"), "buyer", "left_anti"))


def team_eligibility(df: DataFrame, team: str, member: str, c1: Column, c2: Column, min_members: int):
    """SEQ-34: members meeting both criteria; the team qualifies with at
    least ``min_members`` of them (NULL team keys kept as their own group).
    Team counts come from one aggregate joined back null-safely."""
    ok = c1 & c2
    d = df.withColumn("member_ok", ok)
    cnt = d.groupBy(team).agg(F.count_if("member_ok").alias("qualified_members"))
    j = d.join(cnt.withColumnRenamed(team, "_t"), d[team].eqNullSafe(F.col("_t"))).drop("_t")
    return j.withColumn("team_qualifies", F.col("qualified_members") >= min_members) \
            .select(team, member, "member_ok", "qualified_members", "team_qualifies")
