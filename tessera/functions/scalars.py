"""Scalar, date and list expressions (SCL-*).  Every helper returns a Column
(or a DataFrame for multi-column helpers) built from built-in functions, so
it stays inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_case(df: DataFrame, cols: Sequence[str], trim=True, lower=False, upper=False) -> DataFrame:
    """SCL-01: trim blanks and fold case."""
    for c in cols:
        e = F.col(c)
        if trim:
            e = F.trim(e)
        if lower:
            e = F.lower(e)
        if upper:
            e = F.upper(e)
        df = df.withColumn(c, e)
    return df


def cut(col, start: int, length: int) -> Column:
    """SCL-02: fixed substring (1-based)."""
    return F.substring(_c(col), start, length)


def part(col, sep: str, n: int) -> Column:
    """SCL-02: n-th delimited part (1-based); past the end gives ''."""
    return F.split_part(_c(col), F.lit(sep), F.lit(n))


def digits_only(col) -> Column:
    """SCL-03: keep digits only."""
    return F.regexp_replace(_c(col), r"[^0-9]", "")


def trailing_int(col) -> Column:
    """SCL-03: trailing number (for natural ordering); NULL when absent."""
    return F.nullif(F.regexp_extract(_c(col), r"([0-9]+)$", 1), F.lit("")).try_cast("bigint")


def join_cols(cols: Sequence, sep: str = " ") -> Column:
    """SCL-04: concatenate with a separator (NULL parts skipped)."""
    return F.concat_ws(sep, *[_c(c) for c in cols])


def round_to(col, n: int = 2) -> Column:
    """SCL-05: half-up rounding."""
    return F.round(_c(col), n)


def round_half_up(col, n: int = 2) -> Column:
    """Decimal half-up rounding of a double: the value goes through
    DECIMAL(38,9) first, so ties like 0.125 round up in every engine
    (floating rounding of ``x * 10^n`` does not)."""
    return F.round(_c(col).cast("decimal(38,9)"), n).cast("double")


def ts_str(col) -> Column:
    """``yyyy-MM-dd HH:mm:ss.SSSSSS`` text of a timestamp (for exchange/compare)."""
    return F.date_format(_c(col), "yyyy-MM-dd HH:mm:ss.SSSSSS")


def date_str(col) -> Column:
    """ISO ``yyyy-MM-dd`` text of a date or timestamp (for exchange/compare)."""
    return F.date_format(_c(col), "yyyy-MM-dd")


def cap(col, hi) -> Column:
    """SCL-05: upper cap."""
    return F.least(_c(col), F.lit(hi))


def band(col, edges: Sequence, names: Sequence[str]) -> Column:
    """SCL-05: CASE bands; value < edges[i] gets names[i], else the last name."""
    e = None
    for edge, name in zip(edges, names):
        e = F.when(_c(col) < edge, name) if e is None else e.when(_c(col) < edge, name)
    return e.otherwise(names[len(edges)])


def safe_cast(col, typ: str, fmt: str | None = None) -> Column:
    """SCL-06: string to number/date, NULL on failure (ANSI-safe)."""
    if typ == "date" and fmt:
        return F.try_to_date(_c(col), fmt)
    if typ == "timestamp" and fmt:
        return F.try_to_timestamp(_c(col), F.lit(fmt))
    return F.expr(f"try_cast(`{col}` as {typ})") if isinstance(col, str) else _c(col).try_cast(typ)


def null_tokens(col, tokens: Sequence[str]) -> Column:
    """SCL-07: unify NULL spellings ('', 'NULL', 'N/A', ...) to NULL."""
    c = _c(col)
    return F.when(F.trim(c).isin(list(tokens)) | (F.trim(c) == ""), F.lit(None)).otherwise(c)


def default(col, value) -> Column:
    """SCL-07: coalesce to a default."""
    return F.coalesce(_c(col), F.lit(value))


def decode(col, mapping: Mapping, other=None) -> Column:
    """SCL-08: DECODE / CASE value mapping."""
    e = None
    for k, v in mapping.items():
        e = F.when(_c(col) == F.lit(k), F.lit(v)) if e is None else e.when(_c(col) == F.lit(k), F.lit(v))
    return e.otherwise(F.lit(other) if other is not None else F.lit(None))


def map_codes(df: DataFrame, col: str, mapping_df: DataFrame, code: str, label: str,
              out: str | None = None) -> DataFrame:
    """SCL-08: lookup-table mapping; unknown codes keep NULL.  A small mapping
    table is broadcast by its measured size, a large one is shuffled."""
    m = mapping_df.select(F.col(code).alias("_code"), F.col(label).alias(out or f"{col}_std"))
    return df.join(m, F.col(col) == F.col("_code"), "left").drop("_code")


def contains_word(col, word: str, case_sensitive: bool = False) -> Column:
    """SCL-09: whole-word search."""
    flags = "" if case_sensitive else "(?i)"
    return _c(col).rlike(rf"{flags}\b{word}\b")


def date_parts(df: DataFrame, col: str, prefix: str = "") -> DataFrame:
    """SCL-10: year, month, day, day name, ISO weekday, ISO week, ISO year-week."""
    d = F.to_date(F.col(col))
    return (df.withColumn(f"{prefix}year", F.year(d))
              .withColumn(f"{prefix}month", F.month(d))
              .withColumn(f"{prefix}day", F.dayofmonth(d))
              .withColumn(f"{prefix}day_name", F.date_format(d, "EEEE"))
              .withColumn(f"{prefix}iso_dow", F.expr(f"extract(DAYOFWEEK_ISO FROM to_date(`{col}`))"))
              .withColumn(f"{prefix}iso_week", F.weekofyear(d))
              .withColumn(f"{prefix}iso_year", F.expr(f"extract(YEAROFWEEK FROM to_date(`{col}`))")))


def day_diff(end, start) -> Column:
    """SCL-11: whole days end - start."""
    return F.datediff(F.to_date(_c(end)), F.to_date(_c(start)))


def add_days(col, n) -> Column:
    return F.date_add(F.to_date(_c(col)), n)


def add_months(col, n) -> Column:
    """SCL-11: add months; month end clamps (Jan 31 + 1 = Feb 28/29)."""
    return F.add_months(F.to_date(_c(col)), n)


def month_start(col) -> Column:
    """SCL-12: first day of the month (date)."""
    return F.trunc(F.to_date(_c(col)), "month")


def week_start(col) -> Column:
    """SCL-12: Monday of the ISO week (date)."""
    return F.to_date(F.date_trunc("week", _c(col)))


def seconds_between(a, b) -> Column:
    """SCL-13: exact seconds b - a (double, microsecond precision)."""
    return (F.unix_micros(_c(b).cast("timestamp")) - F.unix_micros(_c(a).cast("timestamp"))) / 1e6


def minutes_between(a, b) -> Column:
    """SCL-13: whole minutes b - a, truncated toward zero (explicit rule)."""
    micros = F.unix_micros(_c(b).cast("timestamp")) - F.unix_micros(_c(a).cast("timestamp"))
    return (micros / 60_000_000).cast("bigint")


def hash_key(cols: Sequence, algo: str = "md5", sep: str = "|") -> Column:
    """SCL-14: hash of business columns: each value as its length, a colon and
    its text, NULL as '-'.  So NULL differs from '', and a separator inside a
    value cannot make two different rows equal."""
    texts = [_c(c).cast("string") for c in cols]
    s = F.concat_ws(sep, *[F.coalesce(F.concat(F.char_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])
    if algo == "md5":
        return F.md5(s)
    if algo == "sha256":
        return F.sha2(s, 256)
    return F.xxhash64(s)


def nth_weekday_after(col, weekday: str, n: int) -> Column:
    """SCL-15: n-th given weekday strictly after a date."""
    return F.date_add(F.next_day(F.to_date(_c(col)), weekday), 7 * (n - 1))


def first_code(col) -> Column:
    """SCL-16: code of the first character."""
    return F.ascii(_c(col))


def is_lower(col) -> Column:
    """SCL-16: true when the text has no upper-case letter."""
    return F.lower(_c(col)) == _c(col)


def split_name(df: DataFrame, col: str) -> DataFrame:
    """SCL-17: spaces, first, middle, last name from 1-3 space-separated parts."""
    parts = F.split(F.trim(F.col(col)), " ")
    n = F.size(parts)
    return (df.withColumn("spaces", (F.length(F.col(col)) - F.length(F.regexp_replace(F.col(col), " ", "")))
                          .cast("bigint"))
              .withColumn("first_name", F.element_at(parts, 1))
              .withColumn("middle_name", F.when(n == 3, F.element_at(parts, 2)))
              .withColumn("last_name", F.when(n >= 2, F.element_at(parts, -1))))


def pair_key(a, b) -> tuple[Column, Column]:
    """SCL-18: canonical (least, greatest) of an unordered pair."""
    return F.least(_c(a), _c(b)), F.greatest(_c(a), _c(b))


def list_map(col, fn) -> Column:
    """SCL-19: map over a list column."""
    return F.transform(_c(col), fn)


def list_filter(col, fn) -> Column:
    return F.filter(_c(col), fn)


def list_fold(col, zero, fn) -> Column:
    return F.aggregate(_c(col), zero, fn)


def eval_formula(df: DataFrame, id_col: str, formula: str, value: str, out="result") -> DataFrame:
    """SCL-20: evaluate ``a+b`` / ``a-b`` formulas over row ids by self-join."""
    op = F.regexp_extract(F.col(formula), r"^\s*\d+\s*([+\-*])\s*\d+\s*$", 1)
    left = F.regexp_extract(F.col(formula), r"^\s*(\d+)", 1).cast("bigint")
    right = F.regexp_extract(F.col(formula), r"(\d+)\s*$", 1).cast("bigint")
    d = df.withColumn("_op", op).withColumn("_l", left).withColumn("_r", right)
    lv = df.select(F.col(id_col).cast("bigint").alias("_l"), F.col(value).alias("_lv"))
    rv = df.select(F.col(id_col).cast("bigint").alias("_r"), F.col(value).alias("_rv"))
    d = d.join(lv, "_l", "left").join(rv, "_r", "left")
    res = (F.when(F.col("_op") == "+", F.col("_lv") + F.col("_rv"))
            .when(F.col("_op") == "-", F.col("_lv") - F.col("_rv"))
            .when(F.col("_op") == "*", F.col("_lv") * F.col("_rv")))
    return d.withColumn(out, res).drop("_op", "_l", "_r", "_lv", "_rv")
