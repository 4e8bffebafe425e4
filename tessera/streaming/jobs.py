"""Structured Streaming jobs (STR-*, VER-08).

Transform functions take a streaming (or batch) DataFrame and return one,
so the same logic is checked in batch against SQL; ``start_*`` functions
wire sources, sinks, checkpoints and triggers.  Every query has its own
checkpoint (its offset and commit logs), so each consumer sees each file or
change exactly once and resumes where it stopped after a crash.  File sinks
written from ``foreachBatch`` use one folder per batch id written with
overwrite, so a repeated batch after a failure replaces its own output.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tessera.session import read_or_none


def event_time(df: DataFrame, ts: str) -> DataFrame:
    """Watermarks need TIMESTAMP; a TIMESTAMP_NTZ column is read as session
    time (UTC in this library's sessions)."""
    if isinstance(df.schema[ts].dataType, T.TimestampNTZType):
        return df.withColumn(ts, F.col(ts).cast("timestamp"))
    return df


def _run(writer, available_now: bool = True) -> StreamingQuery:
    w = writer.trigger(availableNow=True) if available_now else writer
    return w.start()


# --------------------------------------------------------------- STR-01 ingest

def read_files(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "csv",
               options: Mapping[str, str] | None = None, max_files: int | None = None) -> DataFrame:
    """File-arrival source: every new file under ``path`` is read once per
    query (identity = path, tracked in the query checkpoint)."""
    s = T.StructType(list(schema.fields) + [T.StructField("_corrupt", T.StringType())])
    r = spark.readStream.format(fmt).schema(s).option("mode", "PERMISSIVE") \
             .option("columnNameOfCorruptRecord", "_corrupt")
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return r.load(path).withColumn("_file", F.col("_metadata.file_path"))


def start_ingest(spark: SparkSession, path: str, schema: T.StructType, out: str, checkpoint: str,
                 fmt: str = "csv", options: Mapping[str, str] | None = None,
                 available_now: bool = True) -> StreamingQuery:
    """STR-01: new files loaded once; bad rows written to ``out/_bad`` with
    their file; per-batch counts appended to ``out/_audit``.  A run with no
    new file writes nothing."""
    names = [f.name for f in schema.fields]

    def batch(df: DataFrame, batch_id: int) -> None:
        df = df.persist()
        try:
            good = df.filter(F.col("_corrupt").isNull()).select(*names, "_file")
            bad = df.filter(F.col("_corrupt").isNotNull()).select("_corrupt", "_file")
            good.write.mode("overwrite").parquet(f"{out}/data/batch_id={batch_id}")
            bad.write.mode("overwrite").parquet(f"{out}/_bad/batch_id={batch_id}")
            audit = df.groupBy("_file").agg(F.count(F.lit(1)).alias("rows"),
                                            F.count("_corrupt").alias("bad_rows")) \
                      .withColumn("batch_id", F.lit(batch_id))
            audit.write.mode("overwrite").parquet(f"{out}/_audit/batch_id={batch_id}")
        finally:
            df.unpersist()

    src = read_files(spark, path, schema, fmt, options)
    return _run(src.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint), available_now)


# --------------------------------------------------------- STR-02/03/07/08

def daily_summary(stream: DataFrame, ts: str, val: str, delay: str = "1 day") -> DataFrame:
    """STR-02: per-day revenue and count (event-time windows, watermark)."""
    return (event_time(stream, ts).withWatermark(ts, delay).groupBy(F.window(ts, "1 day").alias("w"))
                  .agg(F.sum(val).alias("revenue"), F.count(F.lit(1)).alias("events"))
                  .select(F.col("w.start").alias("day"), "revenue", "events"))


def start_daily_summary(stream: DataFrame, ts: str, val: str, out: str, checkpoint: str, delay: str = "1 day",
                        available_now: bool = True) -> StreamingQuery:
    """STR-02: the daily summary kept up to date: each micro-batch writes the
    days it changed (update mode) to its own folder; ``latest_days`` reads the
    newest row of every day."""
    w = daily_summary(stream, ts, val, delay).writeStream.outputMode("update").foreachBatch(folder_sink(out))
    return _run(w.option("checkpointLocation", checkpoint), available_now)


def latest_days(spark: SparkSession, out: str) -> DataFrame:
    """The summary that ``start_daily_summary`` has written so far."""
    d = spark.read.parquet(out)
    last = d.groupBy("day").agg(F.max_by(F.struct("revenue", "events"), "batch_id").alias("_l"))
    return last.select("day", "_l.revenue", "_l.events")


def start_alerts(stream: DataFrame, col: str, bands: Sequence[tuple[float, str]], out: str, checkpoint: str,
                 available_now: bool = True) -> StreamingQuery:
    """STR-03: alerts appended as their rows arrive, one folder per batch."""
    w = alerts(stream, col, bands).writeStream.outputMode("append").foreachBatch(folder_sink(out))
    return _run(w.option("checkpointLocation", checkpoint), available_now)


def alerts(stream: DataFrame, col: str, bands: Sequence[tuple[float, str]]) -> DataFrame:
    """STR-03: stateless banding; rows whose value reaches a band become
    alerts with the highest band reached."""
    level = None
    for lo, name in sorted(bands, key=lambda b: -b[0]):
        level = F.when(F.col(col) >= lo, name) if level is None else level.when(F.col(col) >= lo, name)
    return stream.withColumn("alert", level).filter(F.col("alert").isNotNull())


def windowed(stream: DataFrame, ts: str, size: str, slide: str | None = None, by: Sequence[str] = (),
             delay: str | None = None) -> DataFrame:
    """STR-07: tumbling (slide None) or sliding window counts."""
    s = event_time(stream, ts).withWatermark(ts, delay) if delay else stream
    w = F.window(ts, size, slide) if slide else F.window(ts, size)
    return s.groupBy(w.alias("w"), *by).agg(F.count(F.lit(1)).alias("n")) \
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by, "n")


def sessions(stream: DataFrame, key: str, ts: str, gap: str = "30 minutes", delay: str | None = None) -> DataFrame:
    """STR-08: gap-based session windows per key."""
    s = event_time(stream, ts).withWatermark(ts, delay) if delay else stream
    return s.groupBy(key, F.session_window(ts, gap).alias("s")).agg(F.count(F.lit(1)).alias("n_events")) \
            .select(key, F.col("s.start").alias("start"), F.col("s.end").alias("end"), "n_events")


# ------------------------------------------------------------- STR-04 fan-out

def start_fanout(stream: DataFrame, sinks: Mapping[str, Callable[[DataFrame, int], None]],
                 checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """STR-04: one read of the feed, several sinks per micro-batch (the batch
    is persisted once and released after the last sink)."""
    def batch(df: DataFrame, batch_id: int) -> None:
        df = df.persist()
        try:
            for fn in sinks.values():
                fn(df, batch_id)
        finally:
            df.unpersist()

    return _run(stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint), available_now)


def folder_sink(path: str, transform: Callable[[DataFrame], DataFrame] = lambda d: d):
    """Idempotent file sink for ``foreachBatch``: one folder per batch id."""
    def sink(df: DataFrame, batch_id: int) -> None:
        transform(df).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    return sink


# ---------------------------------------------------------- STR-05 inventory

def inventory(stream: DataFrame, item: str, qty: str, limit: float, opening: float = 0.0) -> DataFrame:
    """STR-05: stock per item = opening + receipts - sales (``qty`` signed): a
    streaming sum; written in update mode, every change emits the level and a
    low-stock flag (output rows double as the audit log)."""
    level = stream.groupBy(F.col(item).cast("long").alias("item")).agg(
        (F.lit(float(opening)) + F.coalesce(F.sum(F.col(qty).cast("double")), F.lit(0.0))).alias("stock"),
        F.count(F.lit(1)).alias("updates"))
    return level.select("item", "stock", (F.col("stock") < limit).alias("low_stock"), "updates")


# ------------------------------------------------------- STR-09 late + dedup

def dedup_within(stream: DataFrame, id_col: str, ts: str, delay: str) -> DataFrame:
    """STR-09: repeats of an id inside the watermark delay are dropped (on a
    batch DataFrame: plain de-duplication by id)."""
    if not stream.isStreaming:
        return stream.dropDuplicates([id_col])
    return event_time(stream, ts).withWatermark(ts, delay).dropDuplicatesWithinWatermark([id_col])


def start_dedup_late(stream: DataFrame, id_col: str, ts: str, delay_s: int, out: str, late_out: str,
                     high_water: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """STR-09: rows older than (max event time seen so far - delay) go to the
    late sink instead of being silently dropped; the rest is de-duplicated
    by id against the earlier rows inside the delay.  The high-water mark is
    one row saved per batch id; ids seen are read from the output folder, with
    the time bound pushed into the scan."""
    spark = stream.sparkSession

    def batch(df: DataFrame, batch_id: int) -> None:
        marks = read_or_none(spark, high_water)
        hw = marks.filter(F.col("batch_id") < batch_id).agg(F.max("hw")).first()[0] if marks is not None else None
        df = df.persist()
        try:
            cut = F.lit(hw).cast("timestamp_ntz") - F.expr(f"INTERVAL {delay_s} SECONDS") if hw is not None else None
            late = df.filter(F.col(ts) < cut) if cut is not None else df.limit(0)
            ok = df.filter(F.col(ts) >= cut) if cut is not None else df
            ok = ok.dropDuplicates([id_col])
            written = read_or_none(spark, out)
            if written is not None:  # an id older than the delay would be late anyway
                seen = written.filter(F.col("_batch") < batch_id)
                seen = seen.filter(F.col(ts) >= cut) if cut is not None else seen
                ok = ok.join(seen.select(id_col), id_col, "left_anti")
            ok.withColumn("_batch", F.lit(batch_id)).write.mode("overwrite").parquet(f"{out}/_batch={batch_id}")
            late.write.mode("overwrite").parquet(f"{late_out}/batch_id={batch_id}")
            new_hw = df.agg(F.max(ts).alias("hw")).withColumn("batch_id", F.lit(batch_id))
            if hw is not None:
                new_hw = new_hw.select(F.greatest("hw", F.lit(hw).cast("timestamp_ntz")).alias("hw"), "batch_id")
            new_hw.write.mode("overwrite").parquet(f"{high_water}/b={batch_id}")
        finally:
            df.unpersist()

    return _run(stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint), available_now)


# ------------------------------------------------------------ STR-10 / STR-11

def enrich(stream: DataFrame, dim: DataFrame, on: str | Sequence[str], how: str = "left") -> DataFrame:
    """STR-10: stream-static join with a dimension."""
    return stream.join(dim, on, how)


def near_join_stream(a: DataFrame, b: DataFrame, key: str, ts_a: str, ts_b: str, within_s: int,
                     delay: str = "1 hour") -> DataFrame:
    """STR-11: A then B within ``within_s`` seconds, stream-stream inner join
    bounded by watermarks on both sides (state is purged past the bound).

    The join key holds a time bucket of that width as well: an A row sits in
    its own bucket and a B row in its own and the one before, so one busy key
    is spread over its buckets and only near rows meet."""
    la = event_time(a, ts_a).withWatermark(ts_a, delay)
    rb = event_time(b, ts_b).withWatermark(ts_b, delay).withColumnRenamed(key, f"_{key}_b")
    width = max(int(within_s), 1)
    bucket_a = F.floor(F.unix_micros(F.col(ts_a).cast("timestamp")) / (width * 1_000_000))
    bucket_b = F.floor(F.unix_micros(F.col(ts_b).cast("timestamp")) / (width * 1_000_000))
    la = la.withColumn("_bucket_a", bucket_a)
    rb = rb.withColumn("_bucket_b", F.explode(F.array(bucket_b - 1, bucket_b)))
    cond = ((F.col(key) == F.col(f"_{key}_b")) & (F.col("_bucket_a") == F.col("_bucket_b")) & (F.col(ts_b) >= F.col(ts_a))
            & (F.col(ts_b) <= F.col(ts_a) + F.expr(f"INTERVAL {within_s} SECONDS")))
    return la.join(rb, cond, "inner").drop(f"_{key}_b", "_bucket_a", "_bucket_b")


# ------------------------------------------------------------------ STR-12

def start_log_tail(spark: SparkSession, path: str, out: str, checkpoint: str,
                   available_now: bool = True) -> StreamingQuery:
    """STR-12: new log lines parsed as they arrive; malformed lines kept apart."""
    from tessera.sources.scans import LOG_RE

    lines = spark.readStream.text(path)
    ok = F.col("value").rlike(LOG_RE)
    parsed = lines.select(
        ok.alias("_ok"), "value",
        F.try_to_timestamp(F.regexp_replace(F.regexp_extract("value", LOG_RE, 1), ",", ".")).alias("ts"),
        F.regexp_extract("value", LOG_RE, 2).alias("level"), F.regexp_extract("value", LOG_RE, 3).alias("thread"),
        F.regexp_extract("value", LOG_RE, 4).alias("message"))
    return _run(parsed.writeStream.format("parquet").option("path", out)
                      .option("checkpointLocation", checkpoint), available_now)


# ------------------------------------------------------------------ STR-13

def recover(feed: DataFrame, done: DataFrame, key: str, ts: str, since) -> DataFrame:
    """STR-13: after a crash, re-run from the last success time: feed rows at
    or after ``since`` whose key was not processed yet."""
    return feed.filter(F.col(ts) >= F.lit(since).cast(feed.schema[ts].dataType)) \
               .join(done.select(key), key, "left_anti")


# ------------------------------------------------------------------ STR-14

def lag_report(feed: DataFrame, progress: DataFrame, consumer: str, version: str, ts: str,
               max_lag: int) -> DataFrame:
    """STR-14: per consumer: versions behind the feed head, age of its last
    committed batch versus the feed's latest time, flag over ``max_lag``."""
    head = feed.agg(F.max(version).alias("_head"), F.max(ts).alias("_now"))
    last = progress.groupBy(consumer).agg(F.max(version).alias("committed"), F.max(ts).alias("last_success"))
    from tessera.operators.common import attach_scalars
    r = attach_scalars(last, head)
    return r.select(consumer, "committed", (F.col("_head") - F.col("committed")).alias("behind"),
                    ((F.unix_micros(F.col("_now").cast("timestamp")) - F.unix_micros(F.col("last_success").cast("timestamp")))
                     / 1e6).alias("age_s"),
                    ((F.col("_head") - F.col("committed")) > max_lag).alias("lagging"))


# -------------------------------------------------------------------- VER-08

def consume(spark: SparkSession, feed_path: str, schema: T.StructType, checkpoint: str, sink: str,
            progress: str | None = None, available_now: bool = True) -> StreamingQuery:
    """VER-08: a change-feed consumer with its own offsets.  Each consumer is
    one streaming query with its own checkpoint over the same change folder;
    a batch's output folder is keyed by batch id (a retried batch overwrites
    itself), and the committed position moves only when the batch succeeds.
    Optional progress rows (batch id, rows, time) feed STR-14."""
    def batch(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")
        if progress:
            df.agg(F.count(F.lit(1)).alias("rows")).withColumn("batch_id", F.lit(batch_id)) \
              .withColumn("at", F.current_timestamp()) \
              .write.mode("overwrite").parquet(f"{progress}/batch_id={batch_id}")

    stream = spark.readStream.schema(schema).parquet(feed_path)
    return _run(stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint), available_now)
