"""Registered queries for the UDF surface (UDF-*) and remaining jobs."""

import re

import pandas as pd
from pyspark.sql import functions as F

from tessera.operators import udfs as U
from tessera.operators.evals import scorer
from tessera.plans.registry import register
from tessera.session import load_table as T


def _to_fahrenheit(s: pd.Series) -> pd.Series:
    return (s * 1.8 + 32).round(4)


@register("UDF-01", "udf01_vectorised_row_mapper", """SELECT event_id, round(value * 1.8 + 32, 4) AS value FROM events""")
def udf01(spark, sf):
    e = T(spark, sf, "events").select("event_id", "value")
    return U.map_rows(e, _to_fahrenheit, "value", "double")


def _words(text: str) -> list:
    return [w for w in re.split(r"\W+", text.lower()) if w]


@register("UDF-02", "udf02_flat_map_words", """
SELECT doc_id, count(*) AS n_words FROM (SELECT doc_id, unnest(list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}_]+'), lambda w: w <> '')) FROM documents) GROUP BY 1""")
def udf02(spark, sf):
    d = T(spark, sf, "documents").select("doc_id", "text")
    return U.flat_map(d, "text", _words).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_words"))


def _spread(s: pd.Series) -> float:
    return float(round(s.max() - s.min(), 4))


@register("UDF-03", "udf03_grouped_reducer", """SELECT user_id, round(max(value) - min(value), 4) AS value FROM events GROUP BY 1""")
def udf03(spark, sf):
    return U.reduce_by(T(spark, sf, "events"), "user_id", "value", _spread)


@register("UDF-03", "udf03_mergeable_reducer", """
SELECT event_type, round(stddev_pop(value), 4) AS value FROM events GROUP BY 1""")
def udf03b(spark, sf):
    e = T(spark, sf, "events")
    return U.reduce_mergeable(e, "event_type", "value", SPREAD).withColumn("value", F.round("value", 4))


def _join_moments(a, b):
    n, d = a[0] + b[0], b[1] - a[1]
    return (n, (a[0] * a[1] + b[0] * b[1]) / n, a[2] + b[2] + d * d * a[0] * b[0] / n) if a[0] and b[0] else max(a, b)


#: Population standard deviation by count, mean and squared deviations.
SPREAD = U.Reducer("n long, mean double, m2 double",
                   lambda v: (int(v.count()), float(v.mean()) if v.count() else 0.0, float(((v - v.mean()) ** 2).sum())),
                   _join_moments, lambda s: (s[2] / s[0]) ** 0.5 if s[0] else None)


@register("UDF-04", "udf04_scorer_hook", """
SELECT c.conv_id, c.turn, CAST(abs(length(c.text) - length(b.text)) <= 200 AS INTEGER) AS score
FROM conversations c JOIN benchmark b ON b.item_id = c.conv_id WHERE c.role = 'assistant'""")
def udf04(spark, sf):
    c = T(spark, sf, "conversations").filter("role = 'assistant'").select("conv_id", "turn", F.col("text").alias("got"))
    b = T(spark, sf, "benchmark").select(F.col("item_id").alias("conv_id"), F.col("text").alias("want"))
    length_close = scorer(lambda got, want: (F.abs(F.length(got) - F.length(want)) <= 200).cast("int"))
    return length_close(c.join(b, "conv_id"), "got", "want").select("conv_id", "turn", "score")


@register("UDF-05", "udf05_transform_chain", """
SELECT l_returnflag, count(*) AS n FROM lineitem WHERE l_discount > 0.05 GROUP BY 1""")
def udf05(spark, sf):
    return U.pipeline(T(spark, sf, "lineitem"),
                      lambda d: d.filter("l_discount > 0.05"),
                      lambda d: d.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n")))


@register("AGG-29", "agg29_best_candidate_score", """
WITH need AS (SELECT l_orderkey AS project, l_partkey % 20 AS skill, l_quantity AS importance FROM lineitem),
 have AS (SELECT s_suppkey AS cand, p % 20 AS skill, 10 + (s_suppkey + p) % 40 AS proficiency
          FROM supplier, range(0, 20, 3) t(p)),
 req AS (SELECT project, count(DISTINCT skill) AS k FROM need GROUP BY 1),
 m AS (SELECT n.project, h.cand, count(DISTINCT n.skill) AS matched,
              CAST(100 + sum(CASE WHEN h.proficiency > n.importance THEN 10 WHEN h.proficiency < n.importance THEN -5 ELSE 0 END) AS BIGINT) AS score
       FROM need n JOIN have h ON n.skill = h.skill GROUP BY 1, 2)
SELECT project, cand, score FROM (SELECT m.*, row_number() OVER (PARTITION BY m.project ORDER BY score DESC, cand) AS r
  FROM m JOIN req USING (project) WHERE matched = k) WHERE r = 1""")
def agg29(spark, sf):
    from tessera.operators.aggs import best_score
    li = T(spark, sf, "lineitem")
    need = li.select(F.col("l_orderkey").alias("project"), (F.col("l_partkey") % 20).alias("skill"),
                     F.col("l_quantity").alias("importance"))
    s = T(spark, sf, "supplier")
    have = s.select(F.col("s_suppkey").alias("cand"), F.explode(F.sequence(F.lit(0), F.lit(18), F.lit(3))).alias("p")) \
            .select("cand", (F.col("p") % 20).alias("skill"), (10 + (F.col("cand") + F.col("p")) % 40).alias("proficiency"))
    return best_score(have, need, "cand", "project", "skill", "proficiency", "importance")


@register("JOIN-27", "join27_friend_recommendation", """
WITH f AS (SELECT DISTINCT a.user_id AS u, b.user_id AS f FROM (SELECT DISTINCT user_id FROM events) a
           JOIN (SELECT DISTINCT user_id FROM events) b ON b.user_id = a.user_id + 1 OR b.user_id = a.user_id - 1),
 l AS (SELECT DISTINCT user_id, CAST(json_extract(props, '$.k') AS INTEGER) % 10 AS page FROM events WHERE event_type = 'click')
SELECT DISTINCT f.u AS user_id, l.page FROM f JOIN l ON l.user_id = f.f
WHERE NOT EXISTS (SELECT 1 FROM l l2 WHERE l2.user_id = f.u AND l2.page = l.page)""")
def join27(spark, sf):
    from tessera.operators.joins import recommend
    e = T(spark, sf, "events")
    friends = _adjacent_pairs(e.select("user_id").distinct())
    likes = e.filter("event_type = 'click'").select(
        "user_id", (F.get_json_object("props", "$.k").cast("int") % 10).alias("page")).distinct()
    return recommend(friends, likes, "user_id", "f", "page")


def _adjacent_pairs(users):
    """Friend edges between neighbouring ids, as two equi joins (id+1, id-1)."""
    up = users.select("user_id", (F.col("user_id") + 1).alias("f"))
    down = users.select("user_id", (F.col("user_id") - 1).alias("f"))
    cand = up.unionByName(down)
    return cand.join(users.select(F.col("user_id").alias("f")), "f").select("user_id", "f").distinct()


@register("SEMI-13", "semi13_nested_record_patch", """
SELECT c_custkey, 'patched-' || c_mktsegment AS segment, c_nationkey + 100 AS nation, c_acctbal AS balance FROM customer""")
def semi13(spark, sf):
    from tessera.operators.semi import patch_struct
    c = T(spark, sf, "customer").select("c_custkey", F.struct(
        F.struct(F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation")).alias("profile"),
        F.col("c_acctbal").alias("balance")).alias("rec"))
    p = patch_struct(c, "rec", {"profile.segment": F.concat(F.lit("patched-"), F.col("rec.profile.segment")),
                                "profile.nation": F.col("rec.profile.nation") + 100})
    return p.select("c_custkey", F.col("rec.profile.segment").alias("segment"),
                    F.col("rec.profile.nation").alias("nation"), F.col("rec.balance").alias("balance"))


@register("JOIN-24", "join24_best_one_stop_route", """
WITH legs AS (SELECT s.s_nationkey AS a, c.c_nationkey AS b, o.o_orderdate AS dep, l.l_shipdate AS arr
              FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
              JOIN supplier s ON l.l_suppkey = s.s_suppkey WHERE l.l_shipdate >= o.o_orderdate),
 r AS (SELECT '1-2' AS path, (epoch_us(arr) - epoch_us(dep)) / 1e6 AS elapsed_s FROM legs WHERE a = 1 AND b = 2
       UNION ALL
       SELECT '1-' || CAST(x.b AS VARCHAR) || '-2', (epoch_us(y.arr) - epoch_us(x.dep)) / 1e6
       FROM legs x JOIN legs y ON x.b = y.a AND y.dep >= x.arr WHERE x.a = 1 AND x.b <> 2 AND y.b = 2 AND y.a <> 1)
SELECT path, elapsed_s FROM r ORDER BY elapsed_s, path LIMIT 1""")
def join24(spark, sf):
    from tessera.operators.joins import best_route
    li = T(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_suppkey", "l_shipdate")
    o = T(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = T(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("b"))
    s = T(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("a"))
    legs = li.join(o, "o_orderkey").join(c, "o_custkey").join(s, "l_suppkey") \
             .filter(F.col("l_shipdate") >= F.col("o_orderdate"))
    return best_route(legs, 1, 2, "a", "b", "o_orderdate", "l_shipdate")


@register("JOIN-08", "join08_anti_left_join_null", """
SELECT c.c_custkey FROM customer c LEFT JOIN (SELECT DISTINCT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT') o
ON o.o_custkey = c.c_custkey WHERE o.o_custkey IS NULL""")
def join08d(spark, sf):
    from tessera.operators.joins import anti_left_null
    c = T(spark, sf, "customer").select("c_custkey")
    o = T(spark, sf, "orders").filter("o_orderpriority = '1-URGENT'").select("o_custkey")
    return anti_left_null(c, o, "c_custkey", "o_custkey")


@register("AGG-11", "agg11_unpivot_all_columns", """
SELECT o_orderkey, name, value FROM (SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders)
UNPIVOT (value FOR name IN (COLUMNS(* EXCLUDE (o_orderkey))))""")
def agg11b(spark, sf):
    from tessera.operators.aggs import unpivot
    o = T(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return unpivot(o, ["o_orderkey"], [c for c in o.columns if c != "o_orderkey"], "name", "value")


@register("SET-03", "set03_except_distinct", """
SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'O'""")
def set03b(spark, sf):
    from tessera.operators.sets import except_all
    o = T(spark, sf, "orders")
    return except_all(o.filter("o_orderstatus = 'F'").select("o_custkey"),
                      o.filter("o_orderstatus = 'O'").select("o_custkey"), distinct=True)


@register("WIN-23", "win23_last_rows_reverse_order", """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts FROM events ORDER BY events.ts DESC, event_id DESC LIMIT 7""")
def win23b(spark, sf):
    from tessera.operators.windows import sort_limit
    e = T(spark, sf, "events").select("event_id", "ts")
    return sort_limit(e, [F.col("ts").desc(), F.col("event_id").desc()], 7) \
        .withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


@register("JOIN-23", "join23_anchored_basket_pairs", """
WITH l AS (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem),
 a AS (SELECT l_partkey AS anchor FROM lineitem GROUP BY 1 ORDER BY count(*) DESC, l_partkey LIMIT 5)
SELECT a.anchor, o.l_partkey AS other, count(*) AS baskets
FROM l x JOIN a ON x.l_partkey = a.anchor JOIN l o ON o.l_orderkey = x.l_orderkey AND o.l_partkey <> a.anchor
GROUP BY 1, 2""")
def join23(spark, sf):
    from tessera.operators.aggs import top_k
    from tessera.operators.joins import anchored_pairs
    li = T(spark, sf, "lineitem")
    anchors = top_k(li, "l_partkey", 5)  # the five most frequent parts (a top-k report)
    return anchored_pairs(li, "l_orderkey", "l_partkey", anchors)
