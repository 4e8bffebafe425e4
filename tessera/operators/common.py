"""Scale helpers shared by operators.

* ``join_on``: summaries joined back to their rows, NULL keys included.
* ``quantile_chunk`` and ``borders_below``: equal parts of an ordered column,
  a row's part by binary search.
* ``meet_tiles``: every block of one side meets every block of the other, per
  key, in tiles of bounded size.
* ``dense_ids``: consecutive numbers for sorted distinct rows, by range
  partitions and per-partition offsets.
* ``prefix_sum``: a running total that never pulls a hot key (or a whole
  table when there is no key) into one task.  Rows are split into chunks by
  an order-preserving chunk column; each chunk is summed in parallel, chunk
  offsets are a small table (one row per chunk), joined back.
* ``lag_chunked``: previous-row values for sequences keyed by a hot key, with
  the same chunk split; the first row of a chunk takes the last row of the
  nearest earlier non-empty chunk.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColLike = str | Column


def _cols(cols) -> list[Column]:
    if cols is None:
        return []
    if isinstance(cols, (str, Column)):
        cols = [cols]
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def _names(cols) -> list[str]:
    if cols is None:
        return []
    if isinstance(cols, str):
        return [cols]
    return list(cols)


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi join in which NULL keys match NULL keys.

    Summaries per group or chunk are joined back to their rows with it: a group
    with a NULL key is a group like any other, as in a window."""
    own = {k: f"__jk_{k}" for k in keys}
    renamed = right.select(*[F.col(c).alias(own.get(c, c)) for c in right.columns])
    cond = None
    for k in keys:
        c = F.col(k).eqNullSafe(F.col(own[k]))
        cond = c if cond is None else cond & c
    return left.join(renamed, cond, how).drop(*own.values())


def chunk_key(keys: Sequence[str], chunk: ColLike) -> Column:
    """(keys, chunk) as one struct: windows, chunk summaries and the join of
    the two partition by it, so they share one exchange; a struct is never
    NULL and its NULL fields are equal, so NULL keys and chunks match."""
    c = F.col(chunk) if isinstance(chunk, str) else chunk
    return F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], c.alias("c"))


def chunk_keys(keys: Sequence[str], q: str) -> list[Column]:
    """The keys inside a ``chunk_key`` column."""
    return [F.col(f"{q}.k{i}") for i in range(len(keys))]


def attach_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row aggregate to every row.

    The one-row side is an aggregate without grouping keys, so its size is
    bounded by construction; it is broadcast on a constant key (no shuffle of
    ``df``)."""
    k = "__tessera_scalar_key"
    return (df.withColumn(k, F.lit(1))
              .join(F.broadcast(one_row.withColumn(k, F.lit(1))), k)
              .drop(k))


def prefix_sum(df: DataFrame, keys: Sequence[str], order: Sequence[ColLike],
               value: ColLike, out: str, chunk: ColLike) -> DataFrame:
    """Running sum of ``value`` per ``keys`` in ``order`` (rows frame).

    ``chunk`` must be monotone in ``order`` within a key (e.g. the day of a
    timestamp, or a range bucket of an ordinal).  Work is partitioned by
    (keys, chunk), so a key holding a third of all rows is still spread over
    many tasks; the chunk-offset window runs over one row per chunk.
    """
    keys = list(keys)
    value_col = F.col(value) if isinstance(value, str) else value
    d = df.withColumn("__ps_q", chunk_key(keys, chunk)).withColumn("__ps_v", value_col)
    w_local = (Window.partitionBy("__ps_q").orderBy(*_cols(order))
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    d = d.withColumn("__ps_local", F.sum("__ps_v").over(w_local))
    totals = d.groupBy("__ps_q").agg(F.sum("__ps_v").alias("__ps_total"))
    w_off = (Window.partitionBy(*chunk_keys(keys, "__ps_q")).orderBy("__ps_q.c")
             .rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.withColumn(
        "__ps_offset", F.sum("__ps_total").over(w_off)
    ).drop("__ps_total")
    # NULL values add nothing; the sum is NULL only before the first value
    total = F.coalesce(F.col("__ps_local") + F.col("__ps_offset"), F.col("__ps_local"), F.col("__ps_offset"))
    return (d.join(offsets, "__ps_q").withColumn(out, total)
             .drop("__ps_q", "__ps_v", "__ps_local", "__ps_offset"))


def prefix_sums(df: DataFrame, keys: Sequence[str], order: Sequence[ColLike], values: dict[str, Column],
                chunk: ColLike) -> DataFrame:
    """``prefix_sum`` of several values (none of them NULL) in one pass: out -> value."""
    keys = list(keys)
    d = df.withColumn("__ps_q", chunk_key(keys, chunk))
    w = Window.partitionBy("__ps_q").orderBy(*_cols(order)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = d.groupBy("__ps_q").agg(*[F.sum(v).alias(f"__o_{o}") for o, v in values.items()])
    before = (Window.partitionBy(*chunk_keys(keys, "__ps_q")).orderBy("__ps_q.c").rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select("__ps_q", *[F.coalesce(F.sum(f"__o_{o}").over(before), F.lit(0)).alias(f"__o_{o}") for o in values])
    d = d.select("*", *[F.sum(v).over(w).alias(f"__l_{o}") for o, v in values.items()]).join(offsets, "__ps_q")
    for o in values:
        d = d.withColumn(o, F.col(f"__l_{o}") + F.col(f"__o_{o}")).drop(f"__l_{o}", f"__o_{o}")
    return d.drop("__ps_q")


def running_extreme(df: DataFrame, keys: Sequence[str], order: str, value: str, out: str, chunk: ColLike,
                    fn: str = "min", descending: bool = False, exclusive: bool = False) -> DataFrame:
    """Running min/max of ``value`` per ``keys`` along ``order`` (a single
    column), chunked like ``prefix_sum``: local running extreme per
    (keys, chunk), carried across chunks from a one-row-per-chunk table.
    ``descending`` runs from the latest row backwards (suffix extreme);
    ``exclusive`` leaves the current row out (extreme of the rows before)."""
    keys = list(keys)
    agg = F.min if fn == "min" else F.max
    pick = F.least if fn == "min" else F.greatest
    o = F.col(order).desc() if descending else F.col(order).asc()
    d = df.withColumn("__rx_q", chunk_key(keys, chunk))
    w = Window.partitionBy("__rx_q").orderBy(o).rowsBetween(
        Window.unboundedPreceding, -1 if exclusive else Window.currentRow)
    d = d.withColumn("__rx_loc", agg(value).over(w))
    per = d.groupBy("__rx_q").agg(agg(value).alias("__rx_cx"))
    co = F.col("__rx_q.c").desc() if descending else F.col("__rx_q.c").asc()
    wc = Window.partitionBy(*chunk_keys(keys, "__rx_q")).orderBy(co).rowsBetween(Window.unboundedPreceding, -1)
    carry = per.withColumn("__rx_carry", agg("__rx_cx").over(wc)).select("__rx_q", "__rx_carry")
    return (d.join(carry, "__rx_q")
             .withColumn(out, F.coalesce(pick("__rx_loc", "__rx_carry"), F.col("__rx_loc"), F.col("__rx_carry")))
             .drop("__rx_q", "__rx_loc", "__rx_carry"))


def lag_chunked(df: DataFrame, keys: Sequence[str], order: str, cols: Sequence[str],
                chunk: ColLike, prefix: str = "prev_", descending: bool = False) -> DataFrame:
    """Previous row's ``cols`` per ``keys`` ordered by ``order`` (single column).

    Same chunk split as ``prefix_sum``: lag inside (keys, chunk); the first
    row of each chunk reads the last row of the previous non-empty chunk from
    a one-row-per-chunk summary.  ``descending`` gives the next row (lead).
    """
    keys = list(keys)
    d = df.withColumn("__lg_q", chunk_key(keys, chunk))
    o = F.col(order).desc() if descending else F.col(order).asc()
    w = Window.partitionBy("__lg_q").orderBy(o)
    for c in cols:
        d = d.withColumn(f"__lg_in_{c}", F.lag(c).over(w))
    d = d.withColumn("__lg_first", F.row_number().over(w) == 1)
    last = d.groupBy("__lg_q").agg(
        # a struct is never NULL, so a row with a NULL order value counts (it sorts first)
        *[(F.min_by if descending else F.max_by)(F.col(c), F.struct(order)).alias(f"__lg_last_{c}") for c in cols])
    w_prev = Window.partitionBy(*chunk_keys(keys, "__lg_q")).orderBy(
        F.col("__lg_q.c").desc() if descending else F.col("__lg_q.c"))
    prev = last.select("__lg_q",
                       *[F.lag(f"__lg_last_{c}").over(w_prev).alias(f"__lg_pc_{c}") for c in cols])
    d = d.join(prev, "__lg_q")
    for c in cols:
        d = d.withColumn(f"{prefix}{c}",
                         F.when(F.col("__lg_first"), F.col(f"__lg_pc_{c}")).otherwise(F.col(f"__lg_in_{c}")))
    return d.drop("__lg_q", "__lg_first", *[f"__lg_in_{c}" for c in cols], *[f"__lg_pc_{c}" for c in cols])


def chunk_count(df: DataFrame) -> int:
    """Chunks of a table's value range: as many as the session has shuffle
    partitions (which a cluster sizes to its data), 64 at least."""
    return max(64, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))


def borders_below(borders: ColLike, n: int, value: ColLike) -> Column:
    """How many of at most ``n`` sorted borders lie below ``value``: a binary
    search, so the cost per row is logarithmic in the borders."""
    b, v = _cols([borders, value])
    steps, size = [], 1
    while size <= n:
        steps.insert(0, size)
        size *= 2
    if not steps:
        return F.lit(0)
    return F.aggregate(F.array(*[F.lit(x) for x in steps]), F.lit(0),
                       lambda at, step: F.when(F.get(b, at + step - 1) < v, at + step).otherwise(at))


#: Rows drawn for each border of a column without numeric quantiles.
SAMPLE_PER_CHUNK = 32


def quantile_borders(df: DataFrame, col: str, buckets: int) -> DataFrame:
    """One row: ``_qs``, at most ``buckets - 1`` sorted borders that cut ``col``
    into about equal parts.  Numbers, dates and timestamps: approximate
    quantiles; columns of other types (text, structs): quantiles of a random
    sample of SAMPLE_PER_CHUNK rows a border, since only the sizes of the parts
    depend on the borders."""
    kind = df.schema[col].dataType
    if isinstance(kind, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        probs = [i / buckets for i in range(1, buckets)]
        return df.agg(F.percentile_approx(col, probs, max(10_000, 4 * buckets)).alias("_qs"))
    drawn = (df.filter(F.col(col).isNotNull()).select(F.col(col).alias("v")).orderBy(F.rand(7))
             .limit(SAMPLE_PER_CHUNK * buckets))
    # the sample's size is set by the number of chunks; its order is the column's own
    return (drawn.agg(F.array_sort(F.collect_list("v")).alias("_all"))
            .select(F.transform(F.sequence(F.lit(1), F.lit(buckets - 1)),
                                lambda i: F.get("_all", (i * F.size("_all") / buckets).cast("int"))).alias("_qs"))
            .select(F.filter("_qs", lambda x: x.isNotNull()).alias("_qs")))


def quantile_chunk(df: DataFrame, col: str, buckets: int | None = None, out: str = "_chunk") -> DataFrame:
    """Add a chunk number monotone in ``col`` (of any ordered type) with about
    equal rows per chunk; NULLs are in chunk 0."""
    buckets = buckets or chunk_count(df)
    d = attach_scalars(df, quantile_borders(df, col, buckets))
    return d.withColumn(out, borders_below("_qs", buckets - 1, col)).drop("_qs")


def deal_tiles(left: DataFrame, right: DataFrame, keys: Sequence[str], block: int) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides with tile numbers: per key, the rows of a side are dealt by
    hash into groups of about ``block`` rows, and every group of one side meets
    every group of the other in one tile.  Keys without rows on both sides, and
    NULL keys, have no tile.  The number of tiles follows the rows of a key, so
    a hot key is many tiles and no tile grows with the data."""
    keys = list(keys)
    groups = lambda df, name: df.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias(name))
    left_n, right_n = groups(left, "__lg"), groups(right, "__rg")
    sizes = left_n.join(right_n, keys) if keys else attach_scalars(left_n, right_n)

    def deal(df: DataFrame, own: str, own_n: str, other: str, other_n: str) -> DataFrame:
        d = df.join(sizes, keys) if keys else attach_scalars(df, sizes)
        mine = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.col(own_n)).cast("int")
        return (d.withColumn(own, mine).withColumn(other, F.explode(F.sequence(F.lit(0), F.col(other_n) - 1)))
                 .drop("__lg", "__rg"))

    return deal(left, "__lt", "__lg", "__rt", "__rg"), deal(right, "__rt", "__rg", "__lt", "__lg"), [*keys, "__lt", "__rt"]


def meet_tiles(left: DataFrame, right: DataFrame, keys: Sequence[str], block: int, fn: Callable, schema) -> DataFrame:
    """``fn(left rows, right rows)`` (Arrow tables in, one Arrow table out) for every tile of ``deal_tiles``."""
    a, b, tile = deal_tiles(left, right, keys, block)
    a, b = a.toDF(*a.columns), b.toDF(*b.columns)  # both may come from one table
    nothing = empty_arrow(schema)

    def one(x, y):
        return fn(x, y) if x.num_rows and y.num_rows else nothing

    return a.groupBy(*tile).cogroup(b.groupBy(*tile)).applyInArrow(one, schema)


#: Bytes of the tables' files (compressed) whose rows one task sorts or holds.
TASK_BYTES = 8 << 20


def input_bytes(df: DataFrame) -> int | None:
    """Bytes of the files that ``df`` reads, by the planner's figures; None where it knows no size."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    size = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.length()))
    return size if size < 1 << 60 else None


def task_count(df: DataFrame) -> int:
    """Tasks for a step over all rows of ``df``: one for every TASK_BYTES of the
    files it reads, as many as there are cores at least.  A task's share then
    stays the same while the tables grow.  Where no size is known, the
    session's shuffle partitions."""
    spark, size = df.sparkSession, input_bytes(df)
    if size is None:
        return int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(spark.sparkContext.defaultParallelism, -(-size // TASK_BYTES))


def spread(df: DataFrame, *cols: ColLike, tasks: int | None = None) -> DataFrame:
    """``df`` dealt by the hash of ``cols`` to as many tasks as its size asks
    for; a grouping or join by these columns needs no further shuffle."""
    return df.repartition(tasks or task_count(df), *cols)


#: Rows of an Arrow batch where a row may be a very long text: a batch is in memory on both sides.
ARROW_ROWS = 256


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, with the session's Arrow batches lowered to ARROW_ROWS rows if
    they are larger: what a Python worker holds then depends on the length of
    a few hundred texts, not on how many rows a task reads."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(key)) <= ARROW_ROWS:
        conf.set(key, str(ARROW_ROWS))
    return df


#: Characters of the texts that a Python worker cuts up at a time, and of the pieces that it sends back at a time.
TEXT_STEP = 1 << 20


def text_steps(texts: Sequence[str | None]) -> Iterator[tuple[int, int]]:
    """(first, end) of runs of texts with about TEXT_STEP characters; a longer text is a run of its own."""
    first, held = 0, 0
    for i, t in enumerate(texts):
        if i > first and held + len(t or "") > TEXT_STEP:
            yield first, i
            first, held = i, 0
        held += len(t or "")
    if first < len(texts):
        yield first, len(texts)


def cut_texts(df: DataFrame, id_col: str, text: str, cut: Callable, schema: str) -> DataFrame:
    """One row per piece of a text: ``cut(text)`` yields the columns after the
    id.  Pieces leave the worker every TEXT_STEP characters, so neither a full
    batch of texts nor all their pieces are held as Python objects.  All text
    columns count: a heading is repeated on each section below it."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema

    types = T.StructType.fromDDL(schema)

    def run(batches):
        arrow = to_arrow_schema(types)

        def block(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)

        for b in batches:
            rows, held = [], 0
            for key, value in zip(b.column(0), b.column(1)):
                key = key.as_py()
                for piece in cut(value.as_py() or ""):
                    rows.append((key, *piece))
                    held += 100 + sum(len(v) for v in piece if isinstance(v, str))
                    if held > TEXT_STEP:
                        yield block(rows)
                        rows, held = [], 0
            if rows:
                yield block(rows)
        pa.default_memory_pool().release_unused()

    return small_batches(df.select(id_col, text)).mapInArrow(run, types)


def empty_arrow(schema: T.StructType):
    """An empty Arrow table of a Spark schema."""
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema).empty_table()


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as Parquet in the checkpoint folder, read back: computed once
    (``checkpoint`` computes twice) and kept by files that outlive executors."""
    from tessera.session import scratch_path

    path, schema = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}"), df.schema
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def global_prefix_sum(df: DataFrame, order_col: str, tie: Sequence[ColLike], value: ColLike,
                      out: str, buckets: int | None = None) -> DataFrame:
    """Running sum over the whole table in (order_col, *tie) order without a
    single-partition window: quantile chunks and a table of their offsets."""
    d = quantile_chunk(df, order_col, buckets).withColumn("_k", F.lit(0))
    d = prefix_sum(d, ["_k"], [F.col(order_col), *_cols(tie)], value, out, "_chunk")
    return d.drop("_k", "_chunk")


def shift_many_chunked(df: DataFrame, keys: Sequence[str], order: str, value: str, k: int, chunk: ColLike,
                       prefix: str, descending: bool = False) -> DataFrame:
    """Values 1..k rows before each row (``descending``: after), per key, in
    one chunked pass: native ``lag(i)`` inside (keys, chunk); a row near its
    chunk start reads the missing values from a halo holding the last k
    values of the previous chunks.  The halo is bounded: each chunk
    contributes at most k values and only the k previous non-empty chunks
    can matter.  Adds columns ``{prefix}1 .. {prefix}k``."""
    keys = list(keys)
    o = F.col(order).desc() if descending else F.col(order).asc()
    d = df.withColumn("__sm_q", chunk_key(keys, chunk))
    w = Window.partitionBy("__sm_q").orderBy(o)
    wr = Window.partitionBy("__sm_q").orderBy(F.col(order).asc() if descending else F.col(order).desc())
    d = d.withColumn("__sm_pos", F.row_number().over(w)).withColumn("__sm_back", F.row_number().over(wr))
    for i in range(1, k + 1):
        d = d.withColumn(f"__sm_in{i}", F.lag(value, i).over(w))
    # last k values of every chunk (in order), at most k rows per chunk
    tail = (d.filter(F.col("__sm_back") <= k).groupBy("__sm_q")
              .agg(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("__sm_back")).alias("p"),
                                                                     F.col(value).alias("v")))),
                               lambda x: x["v"]).alias("__sm_tail")))
    co = F.col("__sm_q.c").desc() if descending else F.col("__sm_q.c").asc()
    wc = Window.partitionBy(*chunk_keys(keys, "__sm_q")).orderBy(co).rowsBetween(-k, -1)
    tail = tail.withColumn("__sm_halo", F.flatten(F.collect_list("__sm_tail").over(wc))) \
               .select("__sm_q", "__sm_halo")
    d = d.join(tail, "__sm_q")
    for i in range(1, k + 1):
        need = F.lit(i) - F.col("__sm_pos") + 1  # how far back into the halo
        from_halo = F.when(F.size("__sm_halo") >= need, F.element_at("__sm_halo", -need))
        d = d.withColumn(f"{prefix}{i}", F.when(F.col("__sm_pos") > i, F.col(f"__sm_in{i}")).otherwise(from_halo))
    return d.drop("__sm_q", "__sm_pos", "__sm_back", "__sm_halo", *[f"__sm_in{i}" for i in range(1, k + 1)])


def dense_ids(keys: DataFrame, out: str, start: int = 0) -> DataFrame:
    """Number the rows of ``keys`` (distinct) from ``start`` in their order.

    A range sort, a position inside each partition and the partitions'
    offsets (one row per partition); the sorted rows are checkpointed, so both
    uses see the same partitions."""
    if not keys.sparkSession.sparkContext.getCheckpointDir():
        from tessera.session import checkpoint_dir
        checkpoint_dir(keys.sparkSession)
    d = (keys.orderBy(*keys.columns).withColumn("__di_p", F.spark_partition_id())
         .withColumn("__di_i", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1))).checkpoint()
    per = d.groupBy("__di_p").agg(F.count(F.lit(1)).alias("__di_n"))
    before = F.sum("__di_n").over(Window.orderBy("__di_p").rowsBetween(Window.unboundedPreceding, -1))
    offsets = per.select("__di_p", F.coalesce(before, F.lit(0)).alias("__di_o"))
    return d.join(offsets, "__di_p").withColumn(out, F.col("__di_i") + F.col("__di_o") + start) \
            .drop("__di_p", "__di_i", "__di_n", "__di_o")


def month_index(date_col: ColLike) -> Column:
    """Year-aware month number: consecutive months differ by exactly one."""
    c = F.col(date_col) if isinstance(date_col, str) else date_col
    return F.year(c) * 12 + F.month(c) - 1


def day_chunk(ts: ColLike) -> Column:
    """Order-preserving chunk for timestamps: the calendar day."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.to_date(c)
