"""Join jobs (JOIN-*).

Join strategy is left to Catalyst and AQE (broadcast when the runtime size
is under the threshold, sort-merge with skew splitting otherwise).  Explicit
broadcast hints are only given for sides with a checked row bound.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.common import attach_scalars, borders_below, chunk_count, quantile_borders, running_extreme, spread, task_count


def join_inner(a: DataFrame, b: DataFrame, on) -> DataFrame:
    """JOIN-01: inner equi join."""
    return a.join(b, on, "inner")


def join_left(a, b, on):
    """JOIN-02: left outer join (missing right rows kept as NULL)."""
    return a.join(b, on, "left")


def join_right(a, b, on):
    """JOIN-03: right outer join."""
    return a.join(b, on, "right")


def reconcile(src: DataFrame, tgt: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """JOIN-04: full outer reconcile -> (key, comment) for rows that differ.

    Comments: new_in_source, new_in_target, mismatch (null-safe compare)."""
    s = src.select(F.col(key).alias("_k"), *[F.col(c).alias(f"s_{c}") for c in cols], F.lit(1).alias("_s"))
    t = tgt.select(F.col(key).alias("_k"), *[F.col(c).alias(f"t_{c}") for c in cols], F.lit(1).alias("_t"))
    j = s.join(t, "_k", "full")
    same = F.lit(True)
    for c in cols:
        same = same & F.col(f"s_{c}").eqNullSafe(F.col(f"t_{c}"))
    comment = (F.when(F.col("_t").isNull(), "new_in_source")
                .when(F.col("_s").isNull(), "new_in_target")
                .when(~same, "mismatch"))
    return j.select(F.col("_k").alias(key), comment.alias("comment")).filter(F.col("comment").isNotNull())


def cross(a: DataFrame, b: DataFrame, blocks: int | None = None) -> DataFrame:
    """JOIN-05: all pairs, in blocks: the rows of ``a`` are dealt to
    ``blocks`` by a hash of the whole row and ``b`` is sent once to each
    block, so the pairs are an equi join of any size on either side.  There
    are as many blocks as the session has shuffle partitions (64 at least)."""
    k, blocks = "__tessera_block", blocks or chunk_count(a)
    left = a.withColumn(k, F.pmod(F.xxhash64(*[F.col(c) for c in a.columns]), F.lit(blocks)))
    right = b.withColumn(k, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    return left.join(right, k).drop(k)


def hierarchy(df: DataFrame, id_col: str, parent: str, name: str, levels: int = 3) -> DataFrame:
    """JOIN-06: walk ``levels`` parent links by aliased self-joins."""
    out = df.select(F.col(id_col), F.col(name).alias("name_1"), F.col(parent).alias("_p1"))
    for i in range(2, levels + 1):
        up = df.select(F.col(id_col).alias(f"_p{i-1}"), F.col(name).alias(f"name_{i}"),
                       F.col(parent).alias(f"_p{i}"))
        out = out.join(up, f"_p{i-1}", "left")
    return out.drop(*[f"_p{i}" for i in range(1, levels + 1)])


def semi(a, b, on):
    """JOIN-07: IN / EXISTS."""
    return a.join(b, on, "left_semi")


def anti(a: DataFrame, b: DataFrame, a_col: str, b_col: str, null_aware: bool = False) -> DataFrame:
    """JOIN-08: NOT EXISTS (null_aware=False) or NOT IN (null_aware=True).

    NOT IN: over an empty list every row qualifies; otherwise a NULL in b's
    column makes the result empty and a NULL on the left never qualifies.
    The list's row and NULL counts are one attached aggregate row."""
    if not null_aware:
        return a.join(b, a[a_col] == b[b_col], "left_anti")
    one = b.agg(F.count(F.lit(1)).alias("_n"), F.count_if(F.col(b_col).isNull()).alias("_nulls"))
    kept = a.join(b.select(F.col(b_col).alias("_b")), a[a_col] == F.col("_b"), "left_anti")
    return attach_scalars(kept, one).filter(
        (F.col("_n") == 0) | ((F.col("_nulls") == 0) & F.col(a_col).isNotNull())).drop("_n", "_nulls")


def anti_left_null(a: DataFrame, b: DataFrame, a_col: str, b_col: str) -> DataFrame:
    """JOIN-08, third spelling: LEFT JOIN ... WHERE b.key IS NULL (same as
    NOT EXISTS; Catalyst plans it as an outer join plus filter)."""
    bb = b.select(F.col(b_col).alias("_bk")).distinct()
    return a.join(bb, a[a_col] == F.col("_bk"), "left").filter(F.col("_bk").isNull()).drop("_bk")


def tuple_semi(a, b, keys):
    """JOIN-09: (k1, k2) IN (subquery)."""
    return a.join(b.select(*keys), list(keys), "left_semi")


def tuple_anti(a, b, keys):
    """JOIN-09: (k1, k2) NOT IN (subquery) on non-null keys, as NOT EXISTS
    (avoids the broadcast nested-loop plan of tuple NOT IN)."""
    return a.join(b.select(*keys), list(keys), "left_anti")


def theta(a: DataFrame, b: DataFrame, condition: Column, how: str = "inner") -> DataFrame:
    """JOIN-10: non-equi join.  Callers should add an equi key or a bin key
    whenever both sides are large; with none, Spark plans a nested loop."""
    return a.join(b, condition, how)


def count_below(a: DataFrame, b: DataFrame, key: str, a_val: str, b_val: str, out: str = "n_below",
                chunk_buckets: int | None = None) -> DataFrame:
    """JOIN-10 at scale: for every row of ``a``, the number of ``b`` rows with
    the same key and ``b_val < a_val`` -- the count a theta join would give,
    without forming pairs.  Both sides are unioned and sorted by value per
    key (b rows before a rows only when strictly smaller); a chunked running
    count of b rows is read at each a row."""
    from tessera.operators.common import prefix_sum, quantile_chunk
    ua = a.withColumn("_v", F.col(a_val).cast("double")).withColumn("_isb", F.lit(0)).withColumn("_one", F.lit(0))
    ub = (b.select(F.col(key), F.col(b_val).cast("double").alias("_v"))
           .withColumn("_isb", F.lit(1)).withColumn("_one", F.lit(1)))
    u = ua.unionByName(ub, allowMissingColumns=True)
    u = quantile_chunk(u, "_v", chunk_buckets, "_qc")
    # at equal values a rows sort before b rows, so only strictly smaller b count
    u = prefix_sum(u, [key], [F.col("_v"), F.col("_isb")], "_one", out, "_qc")
    return u.filter(F.col("_isb") == 0).drop("_v", "_isb", "_one", "_qc").select(*a.columns, out)


def band_join(df: DataFrame, bands: DataFrame, col: str, lo: str, hi: str, leaves: int | None = None) -> DataFrame:
    """JOIN-11: value into [lo, hi] bands, as an equi join on dyadic nodes.

    Quantiles of the values are the leaves of a binary tree, so that however
    skewed they are a leaf holds about equally many (equal values share one).
    A band is covered by its two outer leaves and O(log leaves) nodes between
    them; a value has one node on each level, its path.  The nodes of a cover
    are disjoint, so a pair meets once.  The top of the tree is cut off at
    ``chunk_count`` nodes: a band over all values is sent to so many nodes, and
    no node holds more than that share of the values."""
    tasks = 1 << max(1, (chunk_count(df) - 1).bit_length())
    leaves = max(2 * tasks, 1 << max(1, ((leaves or 8 * tasks) - 1).bit_length()))
    top, bottom = tasks.bit_length() - 1, leaves.bit_length() - 1
    tree = quantile_borders(df, col, leaves)
    leaf = lambda c: borders_below("_qs", leaves - 1, c)
    node = lambda level, at: F.lit(1 << level) + at
    b = attach_scalars(bands.filter(F.col(lo) <= F.col(hi)), tree)
    b = b.withColumn("_l", leaf(lo)).withColumn("_r", leaf(hi)).drop("_qs")
    # the outer leaves hold values on both sides of the band's ends; all nodes between lie inside it
    b = (b.withColumn("_cover", F.array_distinct(F.array(node(bottom, F.col("_l")), node(bottom, F.col("_r")))))
          .withColumn("_l", F.col("_l") + 1).withColumn("_r", F.col("_r") - 1))
    for level in range(bottom, top, -1):
        left = F.when((F.col("_l") <= F.col("_r")) & (F.col("_l") % 2 == 1), F.array(node(level, F.col("_l"))))
        right = F.when((F.col("_l") <= F.col("_r")) & (F.col("_r") % 2 == 0), F.array(node(level, F.col("_r"))))
        none = F.array().cast("array<int>")
        b = (b.withColumn("_cover", F.array_union("_cover", F.concat(F.coalesce(left, none), F.coalesce(right, none))))
              .withColumn("_l", F.shiftright(F.col("_l") + 1, 1)).withColumn("_r", F.shiftright(F.col("_r") - 1, 1)))
    rest = F.when(F.col("_l") <= F.col("_r"), F.transform(F.sequence("_l", "_r"), lambda i: node(top, i)))
    b = b.withColumn("_node", F.explode(F.concat("_cover", F.coalesce(rest, F.array().cast("array<int>"))))).drop("_cover", "_l", "_r")
    d = attach_scalars(df.filter(F.col(col).isNotNull()), tree).withColumn("_leaf", leaf(col)).drop("_qs")
    path = F.array(*[node(level, F.shiftright("_leaf", bottom - level)) for level in range(bottom, top - 1, -1)])
    d = d.withColumn("_node", F.explode(path)).drop("_leaf")
    return d.join(b, "_node").filter((F.col(col) >= F.col(lo)) & (F.col(col) <= F.col(hi))).drop("_node")


def overlap_pairs(df: DataFrame, key: str, id_col: str, start: str, end: str,
                  bucket_days: int = 7) -> DataFrame:
    """JOIN-12: pairs (a, b), a.id < b.id, of overlapping [start, end) intervals
    within a key.

    Equi key plus a time-bucket key: each interval is exploded to the buckets
    it covers on one side and joined on the bucket of the other side's start,
    so candidates are only intervals that are near in time; the residual
    condition keeps exact overlaps, and counting on the later start's bucket
    makes every pair appear once."""
    sec = bucket_days * 86400
    a = (df.select(F.col(key), F.col(id_col).alias("a_id"), F.col(start).alias("a_start"),
                   F.col(end).alias("a_end"))
           .withColumn("_b", F.explode(F.sequence(F.floor(F.unix_seconds(F.col("a_start").cast("timestamp")) / sec),
                                                  F.floor(F.unix_seconds(F.col("a_end").cast("timestamp")) / sec)))))
    b = (df.select(F.col(key), F.col(id_col).alias("b_id"), F.col(start).alias("b_start"),
                   F.col(end).alias("b_end"))
           .withColumn("_b", F.floor(F.unix_seconds(F.col("b_start").cast("timestamp")) / sec)))
    j = a.join(b, [key, "_b"])
    # b starts inside a (or both start together, counted once by id order)
    cond = ((F.col("b_start") > F.col("a_start")) |
            ((F.col("b_start") == F.col("a_start")) & (F.col("a_id") < F.col("b_id")))) & \
           (F.col("b_start") < F.col("a_end"))
    return j.filter(cond).select(key, F.least("a_id", "b_id").alias("id_1"),
                                 F.greatest("a_id", "b_id").alias("id_2"))


def near_join(a: DataFrame, b: DataFrame, key: str, ts_a: str, ts_b: str,
              before_s: int, after_s: int) -> DataFrame:
    """JOIN-13: pairs with ``ts_a - before <= ts_b <= ts_a + after`` per key.

    Bucket the time axis in windows of width ``before+after``; the right side
    is exploded to the (at most two) buckets its admissible range touches, the
    left side sits in exactly one bucket, so each pair is produced once and
    only near rows are compared."""
    width = max(before_s + after_s, 1)
    ea = F.unix_micros(F.col(ts_a).cast("timestamp"))
    eb = F.unix_micros(F.col(ts_b).cast("timestamp"))
    la = a.withColumn("_bucket", F.floor(ea / (width * 1_000_000)))
    # a row of b matches a rows with ts_a in [ts_b - after, ts_b + before]
    lo = F.floor((eb - after_s * 1_000_000) / (width * 1_000_000))
    hi = F.floor((eb + before_s * 1_000_000) / (width * 1_000_000))
    rb = b.withColumn("_bucket", F.explode(F.sequence(lo, hi)))
    j = la.join(rb, [key, "_bucket"])
    diff = F.col("_eb") - F.col("_ea")
    return (j.withColumn("_ea", ea).withColumn("_eb", eb)
             .filter((diff >= -before_s * 1_000_000) & (diff <= after_s * 1_000_000))
             .drop("_bucket", "_ea", "_eb"))


def as_of(facts: DataFrame, states: DataFrame, key: str, ts: str, eff_ts: str,
          cols: Sequence[str], tie: str | None = None, chunk_days: int | None = None) -> DataFrame:
    """JOIN-14: each fact gets the state row with the latest ``eff_ts <= ts``.

    Union both sides with a side flag, sort per key by time (states before
    facts at equal times, equal-time states by ``tie``), carry the last state
    row forward as one struct (all columns of one state, its NULLs included);
    no range join, no pairs.  With
    ``chunk_days`` the carry is the chunked fill-down, so one key with a third
    of the rows is spread over many tasks."""
    from tessera.operators.sequences import fill_down
    f = facts.withColumn("_side", F.lit(1)).withColumn("_t", F.col(ts))
    s = states.select(F.col(key), F.col(eff_ts).alias("_t"),
                      (F.col(tie) if tie else F.lit(0)).alias("_tie"),
                      F.struct(*cols).alias("_state")).withColumn("_side", F.lit(0))
    u = f.withColumn("_tie", F.lit(None).cast(s.schema["_tie"].dataType)).unionByName(s, allowMissingColumns=True)
    if chunk_days is None:
        w = (Window.partitionBy(key).orderBy("_t", "_side", "_tie")
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        u = u.withColumn("_state", F.last("_state", ignorenulls=True).over(w))
    else:
        u = u.withColumn("_ord", F.struct("_t", "_side", "_tie")) \
             .withColumn("_ch", F.floor(F.unix_date(F.to_date("_t")) / chunk_days))
        u = fill_down(u, "_ord", "_state", by=[key], chunk="_ch").drop("_ord", "_ch")
    u = u.filter(F.col("_side") == 1)
    return u.select(*facts.columns, *[F.col(f"_state.{c}").alias(c) for c in cols])


def pair_by_rank(a: DataFrame, b: DataFrame, key: str, order_a: str, order_b: str,
                 chunk_a=None, chunk_b=None) -> DataFrame:
    """JOIN-15: the k-th row of ``a`` with the k-th row of ``b`` per key.
    With chunk expressions the positions are chunked prefix counts."""
    def pos(d, order, chunk):
        if chunk is None:
            return d.withColumn("_k", F.row_number().over(Window.partitionBy(key).orderBy(order)))
        from tessera.operators.common import prefix_sum
        return prefix_sum(d.withColumn("_one", F.lit(1)).withColumn("_ch", chunk), [key], [F.col(order)],
                          "_one", "_k", "_ch").drop("_one", "_ch")
    return pos(a, order_a, chunk_a).join(pos(b, order_b, chunk_b), [key, "_k"])


def join_on_expr(a: DataFrame, b: DataFrame, key_expr: Column, b_key: str, how="inner"):
    """JOIN-16: join on a computed key (CASE or id +- 1), as an equi join."""
    return a.withColumn("_jk", key_expr).join(b, F.col("_jk") == b[b_key], how).drop("_jk")


def join_json(df: DataFrame, jdf: DataFrame, key: str, json_col: str, path: str, typ: str):
    """JOIN-17: structured key = typed key extracted from a JSON column."""
    k = F.get_json_object(F.col(json_col), path).cast(typ)
    return df.join(jdf.withColumn("_jk", k), F.col(key) == F.col("_jk")).drop("_jk")


def lookup_dim(fact: DataFrame, dim: DataFrame, nk: str, sk: str):
    """JOIN-18: staged fact gets the surrogate key from the dimension (the
    planner broadcasts the dimension when its measured size allows)."""
    return fact.join(dim.select(nk, sk), nk, "left")


def orphans(fact: DataFrame, dim: DataFrame, fk: str, pk: str):
    """JOIN-19: fact rows whose key has no dimension row."""
    return fact.join(dim, fact[fk] == dim[pk], "left_anti")


def salted_join(big: DataFrame, small: DataFrame, key: str, buckets: int = 16,
                how: str = "inner") -> DataFrame:
    """JOIN-20: big side gets a salt 0..buckets-1 from a hash of the whole
    row (deterministic, so a task retried after an executor loss salts the
    same way); the small side is replicated once per salt value, so one hot
    key spreads over ``buckets`` tasks.  (AQE skew join does the same at run
    time for sort-merge joins.)  Both sides are shuffled: the planner does not
    count the replicas, so it would send all of them to every task."""
    b = big.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(c) for c in big.columns]), F.lit(buckets)).cast("int"))
    s = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
    return b.join(s.hint("merge"), [key, "_salt"], how).drop("_salt")


def preagg_join(fact: DataFrame, key: str, aggs: Sequence[Column], dim: DataFrame, how="inner"):
    """JOIN-21: aggregate the big side on the join key before joining."""
    return fact.groupBy(key).agg(*aggs).join(dim, key, how)


def broadcast_join(a: DataFrame, small: DataFrame, on, how="inner"):
    """JOIN-22: join with a small side.  Broadcasting is the planner's choice:
    adaptive execution measures the side's bytes and broadcasts it below
    ``spark.sql.autoBroadcastJoinThreshold``; beyond it both sides shuffle."""
    return a.join(small, on, how)


def pair_counts_with_sum(df: DataFrame, val: str, target) -> DataFrame:
    """JOIN-25 at scale: number of unordered row pairs per value pair
    (v_a <= v_b, v_a + v_b = target) from per-value counts, so a hot value
    never expands into its pairs: n_a * n_b, or n(n-1)/2 when v_a = v_b."""
    c = df.groupBy(F.col(val).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    a = c.select(F.col("v").alias("v_a"), F.col("n").alias("n_a"))
    b = c.select(F.col("v").alias("v_b"), F.col("n").alias("n_b"))
    j = a.join(b, (F.lit(target) - F.col("v_a") == F.col("v_b")) & (F.col("v_a") <= F.col("v_b")))
    n = F.when(F.col("v_a") == F.col("v_b"), F.expr("n_a * (n_a - 1) div 2")).otherwise(F.col("n_a") * F.col("n_b"))
    return j.select("v_a", "v_b", n.alias("n_pairs")).filter("n_pairs > 0")


def best_route(legs: DataFrame, src, dst, start_port: str, end_port: str, dep: str, arr: str,
               chunk: Column | None = None) -> DataFrame:
    """JOIN-24: fastest trip from ``src`` to ``dst``: a direct leg, or two
    legs changing at a port where the second departs at or after the first
    arrives; elapsed = final arrival - first departure.

    No leg pairs are formed: per hub, second legs (hub -> dst) get the
    suffix minimum of their arrival over departure time (chunked by day), and
    each first leg (src -> hub) takes, as-of its arrival, the earliest
    reachable final arrival by the union-sort as-of join.  Returns one row:
    path, elapsed_s (ties: lexicographic path)."""
    t = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    direct = (legs.filter((F.col(start_port) == F.lit(src)) & (F.col(end_port) == F.lit(dst)))
                  .select(F.concat_ws("-", F.lit(str(src)), F.lit(str(dst))).alias("path"),
                          ((t(arr) - t(dep)) / 1e6).alias("elapsed_s")))
    second = (legs.filter((F.col(end_port) == F.lit(dst)) & (F.col(start_port) != F.lit(src)))
                  .select(F.col(start_port).alias("hub"), t(dep).alias("_t"), t(arr).alias("_arr2")))
    ch = chunk if chunk is not None else F.floor(F.col("_t") / 86_400_000_000)
    second = running_extreme(second, ["hub"], "_t", "_arr2", "_best_arr", ch, "min", descending=True)
    first = (legs.filter((F.col(start_port) == F.lit(src)) & (F.col(end_port) != F.lit(dst)))
                 .select(F.col(end_port).alias("hub"), t(arr).alias("_t"), t(dep).alias("_dep1")))
    # as-of forward: for each first leg, the second-leg row with the smallest
    # departure >= its arrival carries the suffix-min arrival
    f = first.withColumn("_side", F.lit(1))
    s2 = second.select("hub", "_t", "_best_arr").withColumn("_side", F.lit(0))
    u = f.unionByName(s2, allowMissingColumns=True)
    from tessera.operators.sequences import fill_down
    u = u.withColumn("_ord", F.struct((-F.col("_t")).alias("t"), "_side")) \
         .withColumn("_day", F.floor(-F.col("_t") / 86_400_000_000))
    u = fill_down(u, "_ord", "_best_arr", by=["hub"], chunk="_day", out="_reach")
    via = (u.filter((F.col("_side") == 1) & F.col("_reach").isNotNull())
             .select(F.concat_ws("-", F.lit(str(src)), F.col("hub").cast("string"), F.lit(str(dst))).alias("path"),
                     ((F.col("_reach") - F.col("_dep1")) / 1e6).alias("elapsed_s")))
    return direct.unionByName(via).orderBy("elapsed_s", "path").limit(1)


def anchored_pairs(df: DataFrame, basket: str, item: str, anchors: DataFrame) -> DataFrame:
    """JOIN-23 re-aimed: for each anchor item, the other items bought in the
    same baskets and in how many baskets.

    Every basket row meets only the anchors present in that basket (equi
    joins on the item and the basket), so the work is linear in the rows times
    anchors per basket; all pairs of a basket are never formed."""
    a = anchors.select(F.col(item).alias("anchor")).distinct()
    lines = df.select(basket, item).distinct()
    hits = lines.join(a, F.col(item) == F.col("anchor")).select(basket, "anchor")
    j = lines.join(hits, basket).filter(F.col(item) != F.col("anchor"))
    return j.groupBy("anchor", F.col(item).alias("other")).agg(F.count(F.lit(1)).alias("baskets"))


def recommend(friends: DataFrame, likes: DataFrame, user: str, friend: str, page: str):
    """JOIN-27: pages liked by a friend and not by the user."""
    f = friends.select(F.col(user).alias("_u"), F.col(friend).alias("_f"))
    cand = f.join(likes.select(F.col(user).alias("_f"), F.col(page)), "_f") \
            .select(F.col("_u").alias(user), page).distinct()
    return cand.join(likes.select(user, page), [user, page], "left_anti")


def match_all(have: DataFrame, need: DataFrame, who: str, what: str, group: str | None = None):
    """JOIN-28: relational division: subjects having every required item.
    With ``group`` the required set is per group (e.g. per major)."""
    keys = [group] if group else []
    req = need.groupBy(*keys).agg(F.count_distinct(what).alias("_req"))
    got = have.join(need, [*keys, what]).groupBy(who, *keys).agg(F.count_distinct(what).alias("_got"))
    got = got.join(req, keys) if keys else attach_scalars(got, req)
    return got.filter("_got = _req").select(who, *keys)


def rejoin_check(df: DataFrame, projections: Sequence[Sequence[str]]) -> DataFrame:
    """JOIN-29: split into distinct projections, natural-join back, count
    rows lost and spurious versus the distinct original.

    The rows are joined back once and compared in one grouping: both sides are
    sets, so a row is of the original, of the joined rows, or of both."""
    tasks = task_count(df)
    names = df.columns
    parts = [spread(df.select(*p), *p, tasks=tasks).distinct() for p in projections]
    back = parts[0]
    for p in parts[1:]:
        common = [c for c in back.columns if c in p.columns]
        back = back.join(p, common)
    rows = df.distinct().select(*names, F.lit(1).alias("_base"), F.lit(0).alias("_back")) \
             .unionByName(back.select(*names, F.lit(0).alias("_base"), F.lit(1).alias("_back")))
    per = spread(rows, *names, tasks=tasks).groupBy(*names).agg(F.max("_base").alias("_base"), F.max("_back").alias("_back"))
    return per.agg(F.count_if((F.col("_base") == 1) & (F.col("_back") == 0)).alias("lost"),
                   F.count_if((F.col("_base") == 0) & (F.col("_back") == 1)).alias("spurious"))
