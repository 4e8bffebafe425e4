"""Registered queries for scalar functions (SCL-*)."""

from pyspark.sql import functions as F

from tessera.functions import scalars as S
from tessera.plans.registry import hash_sql, register
from tessera.session import load_table as T


@register("SCL-01", "scl01_trim_case", """
SELECT c_custkey, lower(trim(c_mktsegment)) AS seg_lower, upper(trim(c_name)) AS name_upper
FROM customer""")
def scl01(spark, sf):
    c = T(spark, sf, "customer")
    d = S.clean_case(c.select("c_custkey", F.col("c_mktsegment").alias("seg_lower"),
                              F.col("c_name").alias("name_upper")), ["seg_lower"], lower=True)
    return S.clean_case(d, ["name_upper"], upper=True)


@register("SCL-02", "scl02_substring_split_part", """
SELECT c_custkey, substring(c_name, 10, 9) AS name_digits, split_part(c_name, '#', 1) AS name_prefix,
       split_part(c_name, '#', 3) AS past_end
FROM customer""")
def scl02(spark, sf):
    c = T(spark, sf, "customer")
    return c.select("c_custkey", S.cut("c_name", 10, 9).alias("name_digits"),
                    S.part("c_name", "#", 1).alias("name_prefix"), S.part("c_name", "#", 3).alias("past_end"))


@register("SCL-03", "scl03_regex_digits", """
SELECT c_custkey, regexp_replace(c_name, '[^0-9]', '', 'g') AS digits,
       CAST(nullif(regexp_extract(c_name, '([0-9]+)$', 1), '') AS BIGINT) AS trailing
FROM customer""")
def scl03(spark, sf):
    c = T(spark, sf, "customer")
    return c.select("c_custkey", S.digits_only("c_name").alias("digits"),
                    S.trailing_int("c_name").alias("trailing"))


@register("SCL-04", "scl04_concat", """
SELECT p_partkey, concat_ws(' / ', p_brand, p_type, p_name) AS label,
       p_brand || '-' || CAST(p_size AS VARCHAR) AS brand_size
FROM part""")
def scl04(spark, sf):
    p = T(spark, sf, "part")
    return p.select("p_partkey", S.join_cols(["p_brand", "p_type", "p_name"], " / ").alias("label"),
                    F.concat(F.col("p_brand"), F.lit("-"), F.col("p_size").cast("string")).alias("brand_size"))


@register("SCL-05", "scl05_round_cap_band", """
SELECT l_orderkey, l_linenumber, round(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(38,9)), 2)::DOUBLE AS net,
       least(l_quantity, 30.0) AS qty_capped,
       CASE WHEN l_quantity < 10 THEN 'small' WHEN l_quantity < 30 THEN 'medium' ELSE 'large' END AS size_band
FROM lineitem""")
def scl05(spark, sf):
    li = T(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     S.round_half_up(F.col("l_extendedprice") * (1 - F.col("l_discount")), 2).alias("net"),
                     S.cap("l_quantity", 30.0).alias("qty_capped"),
                     S.band("l_quantity", [10, 30], ["small", "medium", "large"]).alias("size_band"))


@register("SCL-06", "scl06_safe_cast", """
SELECT c_custkey, TRY_CAST(substring(c_name, 10, 9) AS BIGINT) AS num,
       CAST(TRY_CAST(c_mktsegment AS BIGINT) AS DOUBLE) AS bad_num,
       TRY_CAST(CAST(c_acctbal AS VARCHAR) AS DOUBLE) AS bal
FROM customer""")
def scl06(spark, sf):
    c = T(spark, sf, "customer")
    return c.select("c_custkey", S.safe_cast(S.cut("c_name", 10, 9), "bigint").alias("num"),
                    S.safe_cast("c_mktsegment", "bigint").cast("double").alias("bad_num"),
                    S.safe_cast(F.col("c_acctbal").cast("string"), "double").alias("bal"))


@register("SCL-07", "scl07_null_tokens", """
SELECT o_orderkey,
       coalesce(CASE WHEN o_orderstatus IN ('P', 'N/A', 'NULL') THEN NULL ELSE o_orderstatus END, 'unknown') AS status,
       nullif(o_orderpriority, '5-LOW') AS priority
FROM orders""")
def scl07(spark, sf):
    o = T(spark, sf, "orders")
    return o.select("o_orderkey",
                    S.default(S.null_tokens("o_orderstatus", ["P", "N/A", "NULL"]), "unknown").alias("status"),
                    F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("priority"))


@register("SCL-08", "scl08_code_mapping", """
SELECT o_orderkey,
       CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' WHEN 'P' THEN 'partial' END AS status_name,
       m.label AS priority_label
FROM orders LEFT JOIN (VALUES ('1-URGENT', 'high'), ('2-HIGH', 'high'), ('3-MEDIUM', 'normal'),
                               ('4-NOT SPECIFIED', 'normal'), ('5-LOW', 'low')) AS m(code, label)
  ON o_orderpriority = m.code""")
def scl08(spark, sf):
    o = T(spark, sf, "orders")
    # fixed values: the priority code set and its labels
    mapping = spark.createDataFrame(
        [("1-URGENT", "high"), ("2-HIGH", "high"), ("3-MEDIUM", "normal"),
         ("4-NOT SPECIFIED", "normal"), ("5-LOW", "low")], "code string, label string")
    d = o.select("o_orderkey", "o_orderpriority",
                 S.decode("o_orderstatus", {"F": "finished", "O": "open", "P": "partial"}).alias("status_name"))
    return S.map_codes(d, "o_orderpriority", mapping, "code", "label", "priority_label").drop("o_orderpriority")


@register("SCL-09", "scl09_pattern_filters", """
SELECT p_partkey, p_name, p_size FROM part
WHERE (p_size BETWEEN 10 AND 20 AND p_brand IN ('Brand#1', 'Brand#2', 'Brand#3'))
   OR (p_name LIKE '%ring%' AND regexp_matches(p_type, '(?i)\\bsmall\\b'))""")
def scl09(spark, sf):
    p = T(spark, sf, "part")
    pred = ((F.col("p_size").between(10, 20) & F.col("p_brand").isin("Brand#1", "Brand#2", "Brand#3"))
            | (F.col("p_name").like("%ring%") & S.contains_word("p_type", "small")))
    return p.filter(pred).select("p_partkey", "p_name", "p_size")


@register("SCL-10", "scl10_date_parts", """
SELECT o_orderkey, CAST(year(o_orderdate) AS BIGINT) AS year, CAST(month(o_orderdate) AS BIGINT) AS month,
       CAST(day(o_orderdate) AS BIGINT) AS day, dayname(o_orderdate) AS day_name,
       CAST(isodow(o_orderdate) AS BIGINT) AS iso_dow, CAST(weekofyear(o_orderdate) AS BIGINT) AS iso_week,
       CAST(isoyear(o_orderdate) AS BIGINT) AS iso_year,
       CAST(isoyear(o_orderdate) AS VARCHAR) || '-W' || lpad(CAST(weekofyear(o_orderdate) AS VARCHAR), 2, '0') AS iso_label
FROM orders""")
def scl10(spark, sf):
    o = T(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    d = S.date_parts(o, "o_orderdate").drop("o_orderdate")
    for c in ["year", "month", "day", "iso_dow", "iso_week", "iso_year"]:
        d = d.withColumn(c, F.col(c).cast("bigint"))
    return d.withColumn("iso_label", F.concat(F.col("iso_year").cast("string"), F.lit("-W"),
                                              F.lpad(F.col("iso_week").cast("string"), 2, "0")))


@register("SCL-11", "scl11_date_arithmetic", """
SELECT o_orderkey, CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '2002-01-01') AS BIGINT) AS days_to_2002,
       CAST(CAST(o_orderdate AS DATE) + 45 AS VARCHAR) AS plus_45,
       CAST(CAST(CAST(o_orderdate AS DATE) + INTERVAL 1 MONTH AS DATE) AS VARCHAR) AS plus_month,
       CAST(CAST(CAST(o_orderdate AS DATE) - INTERVAL 3 MONTH AS DATE) AS VARCHAR) AS minus_quarter
FROM orders""")
def scl11(spark, sf):
    o = T(spark, sf, "orders")
    return o.select("o_orderkey", S.day_diff(F.lit("2002-01-01").cast("date"), "o_orderdate")
                    .cast("bigint").alias("days_to_2002"),
                    S.date_str(S.add_days("o_orderdate", 45)).alias("plus_45"),
                    S.date_str(S.add_months("o_orderdate", 1)).alias("plus_month"),
                    S.date_str(S.add_months("o_orderdate", -3)).alias("minus_quarter"))


@register("SCL-12", "scl12_date_trunc", """
SELECT CAST(CAST(date_trunc('month', o_orderdate) AS DATE) AS VARCHAR) AS month_start,
       CAST(CAST(date_trunc('week', o_orderdate) AS DATE) AS VARCHAR) AS week_start, count(*) AS n
FROM orders GROUP BY ALL""")
def scl12(spark, sf):
    o = T(spark, sf, "orders")
    return o.groupBy(S.date_str(S.month_start("o_orderdate")).alias("month_start"),
                     S.date_str(S.week_start("o_orderdate")).alias("week_start")).agg(F.count(F.lit(1)).alias("n"))


@register("SCL-13", "scl13_seconds_minutes", """
SELECT event_id, round((epoch_us(lead_ts) - epoch_us(ts)) / 1e6, 3) AS secs,
       CAST(trunc((epoch_us(lead_ts) - epoch_us(ts)) / 60000000.0) AS BIGINT) AS mins
FROM (SELECT event_id, ts, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS lead_ts FROM events)
WHERE lead_ts IS NOT NULL""")
def scl13(spark, sf):
    from pyspark.sql import Window
    e = T(spark, sf, "events")
    d = e.withColumn("lead_ts", F.lead("ts").over(Window.partitionBy("user_id").orderBy("ts", "event_id")))
    return d.filter(F.col("lead_ts").isNotNull()).select(
        "event_id", F.round(S.seconds_between("ts", "lead_ts"), 3).alias("secs"),
        S.minutes_between("ts", "lead_ts").alias("mins"))


@register("SCL-14", "scl14_hash_key", f"""
SELECT c_custkey, {hash_sql('c_name', 'c_mktsegment', 'c_nationkey')} AS hk
FROM customer""")
def scl14(spark, sf):
    c = T(spark, sf, "customer")
    return c.select("c_custkey", S.hash_key(["c_name", "c_mktsegment", "c_nationkey"]).alias("hk"))


@register("SCL-15", "scl15_nth_sunday_after", """
SELECT o_orderkey,
       CAST(CAST(o_orderdate AS DATE) + CAST(((6 - isodow(o_orderdate) + 7) % 7) + 1 AS INTEGER) + 7 AS VARCHAR) AS second_sunday
FROM orders""")
def scl15(spark, sf):
    o = T(spark, sf, "orders")
    return o.select("o_orderkey", S.date_str(S.nth_weekday_after("o_orderdate", "SUN", 2)).alias("second_sunday"))


@register("SCL-16", "scl16_char_codes", """
SELECT c_custkey, CAST(ascii(c_mktsegment) AS BIGINT) AS first_code, lower(c_mktsegment) = c_mktsegment AS is_lower,
       lower(c_name) = c_name AS name_is_lower
FROM customer""")
def scl16(spark, sf):
    c = T(spark, sf, "customer")
    return c.select("c_custkey", S.first_code("c_mktsegment").cast("bigint").alias("first_code"),
                    S.is_lower("c_mktsegment").alias("is_lower"), S.is_lower("c_name").alias("name_is_lower"))


@register("SCL-17", "scl17_split_name", """
SELECT p_partkey, CAST(length(p_name) - length(replace(p_name, ' ', '')) AS BIGINT) AS spaces,
       split_part(trim(p_name), ' ', 1) AS first_name,
       CASE WHEN len(string_split(trim(p_name), ' ')) = 3 THEN split_part(trim(p_name), ' ', 2) END AS middle_name,
       CASE WHEN len(string_split(trim(p_name), ' ')) >= 2 THEN string_split(trim(p_name), ' ')[-1] END AS last_name
FROM part""")
def scl17(spark, sf):
    p = T(spark, sf, "part").select("p_partkey", "p_name")
    return S.split_name(p, "p_name").drop("p_name")


@register("SCL-18", "scl18_pair_key", """
SELECT least(l_partkey, l_suppkey) AS lo, greatest(l_partkey, l_suppkey) AS hi, count(*) AS n
FROM lineitem GROUP BY 1, 2""")
def scl18(spark, sf):
    li = T(spark, sf, "lineitem")
    lo, hi = S.pair_key("l_partkey", "l_suppkey")
    return li.groupBy(lo.alias("lo"), hi.alias("hi")).agg(F.count(F.lit(1)).alias("n"))


@register("SCL-19", "scl19_list_lambdas", """
SELECT vec_id,
       round(list_reduce(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)), lambda a, b: a + b), 3) AS sq_norm,
       CAST(len(list_filter(embedding, lambda x: x > 0)) AS BIGINT) AS n_pos,
       CAST(len(list_distinct(list_transform(embedding, lambda x: CAST(x > 0 AS INTEGER)))) AS BIGINT) AS n_signs
FROM embeddings""")
def scl19(spark, sf):
    e = T(spark, sf, "embeddings")
    sq = S.list_fold(S.list_map("embedding", lambda x: x.cast("double") * x.cast("double")),
                     F.lit(0.0), lambda acc, x: acc + x)
    return e.select("vec_id", F.round(sq, 3).alias("sq_norm"),
                    F.size(S.list_filter("embedding", lambda x: x > 0)).cast("bigint").alias("n_pos"),
                    F.size(F.array_distinct(S.list_map("embedding", lambda x: (x > 0).cast("int"))))
                    .cast("bigint").alias("n_signs"))


@register("SCL-20", "scl20_eval_formula", """
WITH f AS (SELECT n_nationkey AS id, CAST(n_nationkey AS VARCHAR) || '+' || CAST((n_nationkey * 7) % 25 AS VARCHAR) AS formula,
                  n_regionkey * 100 + n_nationkey AS value FROM nation)
SELECT f.id, f.formula, f.value, a.value + b.value AS result
FROM f JOIN f a ON a.id = CAST(split_part(f.formula, '+', 1) AS INTEGER)
       JOIN f b ON b.id = CAST(split_part(f.formula, '+', 2) AS INTEGER)""")
def scl20(spark, sf):
    n = T(spark, sf, "nation")
    f = n.select(F.col("n_nationkey").alias("id"),
                 F.concat(F.col("n_nationkey").cast("string"), F.lit("+"),
                          ((F.col("n_nationkey") * 7) % 25).cast("string")).alias("formula"),
                 (F.col("n_regionkey") * 100 + F.col("n_nationkey")).alias("value"))
    return S.eval_formula(f, "id", "formula", "value")
