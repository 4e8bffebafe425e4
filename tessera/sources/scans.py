"""Scans, sources and sinks (SRC-*).

Every reader takes a declared schema (inference is opt-in and costs a pass);
filters and projections on the result are pushed into the scan by Catalyst.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: named delimited-file profiles (separator, quote, header, NULL tokens)
PROFILES = {
    "csv": {"sep": ",", "quote": '"', "header": True, "null_tokens": ["", "NULL", "null"]},
    "pipe": {"sep": "|", "quote": '"', "header": False, "null_tokens": ["", "NULL", "\\N"]},
    "tsv": {"sep": "\t", "quote": '"', "header": False, "null_tokens": ["", "NULL"]},
}


def scan_delimited(spark: SparkSession, path: str, schema: T.StructType, profile: str | Mapping = "csv"
                   ) -> DataFrame:
    """SRC-01: delimited scan with a named profile; empty fields and the
    profile's NULL tokens become NULL (string columns are re-checked so any
    number of tokens is honoured)."""
    p = PROFILES[profile] if isinstance(profile, str) else dict(profile)
    tokens = list(p.get("null_tokens", [""]))
    df = (spark.read.schema(schema).option("sep", p.get("sep", ",")).option("quote", p.get("quote", '"'))
          .option("header", str(p.get("header", False)).lower()).option("nullValue", tokens[0] if tokens else "")
          .option("mode", p.get("mode", "PERMISSIVE")).csv(path))
    for f in schema.fields:
        if isinstance(f.dataType, T.StringType) and tokens:
            df = df.withColumn(f.name, F.when(F.col(f.name).isin(tokens), F.lit(None)).otherwise(F.col(f.name)))
    return df


def scan_headerless(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",") -> DataFrame:
    """SRC-02: comma/tab/pipe file without header; names and types given."""
    return spark.read.schema(schema).option("sep", sep).option("header", "false").csv(path)


def scan_inferred(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """SRC-03: header names and inferred types (an extra pass over the data)."""
    return spark.read.option("header", str(header).lower()).option("inferSchema", "true").csv(path)


def scan_lines(spark: SparkSession, path: str) -> DataFrame:
    """SRC-04: one row per line in column ``value``."""
    return spark.read.text(path)


def scan_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """SRC-05: JSON lines; lines that do not parse are kept apart (raw text
    in ``_bad``), never fatal.  Lines are read as text and parsed with
    ``from_json``, so both outputs stream from one scan with no caching."""
    raw = spark.read.text(path).filter(F.trim("value") != "")
    parsed = raw.withColumn("_rec", F.from_json("value", schema, {"mode": "PERMISSIVE"}))
    ok = F.col("_rec").isNotNull() & F.coalesce(F.json_object_keys("value").isNotNull(), F.lit(False))
    good = parsed.filter(ok).select("_rec.*")
    bad = parsed.filter(~ok).select(F.col("value").alias("_bad"))
    return good, bad


def scan_json_array(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """SRC-06: a file holding one JSON array: one row per element."""
    return spark.read.schema(schema).option("multiLine", "true").json(path)


def scan_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """SRC-07: typed columnar scan with filter and column pushdown."""
    r = spark.read
    return (r.schema(schema) if schema is not None else r).parquet(path)


def scan_xml(spark: SparkSession, path: str, row_tag: str, schema: T.StructType | None = None) -> DataFrame:
    """SRC-08: one row per repeating tag; attributes get the ``_`` prefix."""
    r = spark.read.format("xml").option("rowTag", row_tag)
    return (r.schema(schema) if schema is not None else r).load(path)


def write_partitioned(df: DataFrame, path: str, cols: Sequence[str], mode: str = "overwrite") -> None:
    """SRC-09: ``col=value`` folders; readers prune folders by filters on them."""
    df.write.mode(mode).partitionBy(*cols).parquet(path)


def pick_files(spark: SparkSession, path: str, files: Sequence[str] | None = None, regex: str | None = None,
               fmt: str = "parquet", schema: T.StructType | None = None) -> DataFrame:
    """SRC-10: read an exact list of files, or the files whose path matches
    ``regex`` (Java regex, negative lookahead allowed) by filtering on the
    hidden file-path column (files not matching are never opened)."""
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    if files:
        return r.load([f"{path.rstrip('/')}/{f}" for f in files])
    df = r.load(path)
    return df.filter(F.col("_metadata.file_path").rlike(regex)) if regex else df


def with_provenance(df: DataFrame) -> DataFrame:
    """SRC-11: source file name and modification time beside each record;
    for Parquet sources also the row index inside the file."""
    d = df.withColumn("_file", F.col("_metadata.file_name")) \
          .withColumn("_file_mtime", F.col("_metadata.file_modification_time"))
    if "row_index" in df.select("_metadata.*").columns:
        d = d.withColumn("_row_no", F.col("_metadata.row_index") + 1)
    return d


def lines_with_numbers(spark: SparkSession, path: str) -> DataFrame:
    """SRC-11 for text files: (file, row_no, line).  Each file is read whole
    (``wholetext``), so use it for small landing files; large text files
    should be converted to Parquet, which carries a row index."""
    w = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), "value")
    return w.select("file", F.posexplode(F.split(F.regexp_replace("value", "\n$", ""), "\n")).alias("row_no", "line")) \
            .withColumn("row_no", F.col("row_no") + 1)


def scan_evolved(spark: SparkSession, path: str, superset: T.StructType | None = None) -> DataFrame:
    """SRC-13: files written before a column existed read it as NULL."""
    if superset is not None:
        return spark.read.schema(superset).parquet(path)
    return spark.read.option("mergeSchema", "true").parquet(path)


def project_positional(df: DataFrame, ordinals: Sequence[int], names: Sequence[str],
                       types: Sequence[str]) -> DataFrame:
    """SRC-14: keep columns by 1-based position, rename, cast (ANSI-safe)."""
    cols = df.columns
    return df.select(*[F.col(cols[o - 1]).try_cast(t).alias(n) for o, n, t in zip(ordinals, names, types)])


def unload_parquet(df: DataFrame, path: str, by: Sequence[str], run_id: str) -> str:
    """SRC-15: result written per partition folder under a run-id folder."""
    out = f"{path.rstrip('/')}/run_id={run_id}"
    df.write.mode("overwrite").partitionBy(*by).parquet(out)
    return out


def unload_csv(df: DataFrame, path: str, header: bool = True, compression: str | None = "gzip",
               max_rows: int | None = None) -> None:
    """SRC-16: CSV with header, compression and a row cap per file."""
    w = df.write.mode("overwrite").option("header", str(header).lower())
    if compression:
        w = w.option("compression", compression)
    if max_rows:
        w = w.option("maxRecordsPerFile", max_rows)
    w.csv(path)


def reconcile_unload(df: DataFrame, path: str, fmt: str = "parquet") -> DataFrame:
    """SRC-17: expected rows (counted on the source), written rows (from the
    written files' metadata: Parquet footers), and rows read back by scanning
    a column of every written file; ``ok`` when all three agree."""
    spark = df.sparkSession
    expected = df.count()
    df.write.mode("overwrite").format(fmt).save(path)
    back = spark.read.format(fmt).load(path)
    written = back.count()  # Parquet: answered from footers
    first = back.columns[0]
    reread = back.agg(F.count(F.coalesce(F.col(first).cast("string"), F.lit("")))).first()[0]
    return spark.createDataFrame([(expected, written, reread, expected == written == reread)],
                                 "expected long, written long, reread long, ok boolean")


def split_parts(df: DataFrame, path: str, rows_per_part: int, order: Sequence[str]) -> None:
    """SRC-18: fixed-size parts; the order is kept as a column so a merge can
    restore it."""
    df.withColumn("_order", F.struct(*order)).write.mode("overwrite") \
      .option("maxRecordsPerFile", rows_per_part).parquet(path)


def merge_parts(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """SRC-18: union of parts in the saved order."""
    out = None
    for p in paths:
        d = spark.read.parquet(p)
        out = d if out is None else out.unionByName(d)
    return out.orderBy("_order").drop("_order")


def publish_view(df: DataFrame, name: str, cached: bool = False, table: bool = False) -> DataFrame:
    """SRC-19: temp view (optionally cached) or a saved table."""
    if table:
        df.write.mode("overwrite").saveAsTable(name)
        return df.sparkSession.table(name)
    df.createOrReplaceTempView(name)
    if cached:
        df.sparkSession.catalog.cacheTable(name)
    return df.sparkSession.table(name)


LOG_RE = r"^(\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2}(?:[.,]\d+)?)\s+([A-Z]+)\s+\[([^\]]+)\]\s+(.*)$"


def parse_log(lines: DataFrame, col: str = "value") -> tuple[DataFrame, DataFrame]:
    """SRC-20: ``timestamp LEVEL [thread] message`` lines to columns;
    malformed lines go to a quarantine output."""
    ok = F.col(col).rlike(LOG_RE)
    parsed = lines.filter(ok).select(
        F.try_to_timestamp(F.regexp_replace(F.regexp_extract(col, LOG_RE, 1), ",", ".")).alias("ts"),
        F.regexp_extract(col, LOG_RE, 2).alias("level"), F.regexp_extract(col, LOG_RE, 3).alias("thread"),
        F.regexp_extract(col, LOG_RE, 4).alias("message"))
    return parsed, lines.filter(~ok | F.col(col).isNull())


def scan_orc(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """SRC-21: ORC scan (Avro needs the external spark-avro package, absent here)."""
    r = spark.read
    return (r.schema(schema) if schema is not None else r).orc(path)


def file_view(spark: SparkSession, path: str, schema: T.StructType, profile: str = "csv",
              where=None, name: str | None = None) -> DataFrame:
    """SRC-22: query files in place: typed scan, filter, optional view."""
    d = scan_delimited(spark, path, schema, profile)
    if where is not None:
        d = d.filter(where)
    if name:
        d.createOrReplaceTempView(name)
    return d


def ddl_schema(ddl: str) -> T.StructType:
    """Parse a DDL string ``name type, ...`` to a StructType."""
    return T.StructType.fromDDL(ddl)
