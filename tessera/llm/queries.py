"""The operators of this folder applied to the given tables: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import license_scan, lm_scoring
from tessera.llm.common import table
from tessera.llm.decontaminate import find_benchmark_words
from tessera.llm.hard_negatives import mine
from tessera.llm.html_text import extract_pages
from tessera.llm.jaccard_join import near_duplicates
from tessera.llm.language_id import add_language, fit, held_out
from tessera.llm.line_dedup import dedup_lines
from tessera.llm.packing import pack
from tessera.llm.token_counts import count_tokens
from tessera.llm.topk_nra import top_k
from tessera.llm.url_filter import UrlFilter
from tessera.llm.whitening import whiten

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"))


@query
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


ORACLES["op8_line_dedup"] = """
WITH a AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM a),
k AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
c AS (SELECT key, max(doc_id) AS top FROM k WHERE length(key) >= 20
      GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT k.*, c.key IS NULL OR c.top = k.doc_id AS stays FROM k LEFT JOIN c ON k.key = c.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE NOT stays) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE stays), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""


@query
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_benchmark_words(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


ORACLES["op7_decontamination"] = r"""
WITH b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(
             translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL),
bw AS (SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS g
       FROM (SELECT item, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i
             FROM b WHERE len(w) > 0)),
d AS (SELECT doc_id, coalesce(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
             FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
h AS (SELECT doc_id, item, n, i FROM dw JOIN bw USING (n, g)),
x AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM h) GROUP BY doc_id),
y AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN x ON d.doc_id = x.doc_id LEFT JOIN y ON d.doc_id = y.doc_id
"""


@query
def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


@query
def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


@query
def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))


#: (host, path, verdict)
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
             ("com", "/fr/", "allow"), ("com", "/de/", "block")]


@query
def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return UrlFilter(URL_RULES).fit(pages, "url").judge(pages, "url")


@query
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.where(~held_out("doc_id")))
    rows = docs.select("doc_id", held_out("doc_id").alias("held_out"), "text")
    return add_language(rows, model).drop("text")


@query
def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


ORACLES["op4_license_scan"] = license_scan.oracle()


@query
def op1_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


ORACLES["op1_exact_topk"] = """
WITH v AS (SELECT row_number() OVER () AS key, vec_id, [CAST(floor(64 * CAST(c AS DOUBLE)) AS BIGINT) for c in embedding] AS x
    FROM embeddings WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
      AND len([c for c in embedding if c IS NULL OR NOT isfinite(c)]) = 0),
s AS (SELECT q.key, q.vec_id AS query_id, v.vec_id, CAST(list_sum([q.x[i] * v.x[i] for i in range(1, len(v.x) + 1)]) AS BIGINT) AS score
      FROM v AS q JOIN v ON q.vec_id % 20 = 0 AND q.key <> v.key AND len(q.x) = len(v.x))
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
    SELECT *, row_number() OVER (PARTITION BY key ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 20
"""


@query
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whiten(table(spark, sf_dir, "embeddings"))
    return rows.withColumn("deviation", F.col("deviation").try_cast("long"))  # beyond a long: null


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)


ORACLES["op12_hard_negatives"] = """
WITH v AS (SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
       [CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT) for c in embedding] AS x FROM embeddings
    WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND label IS NOT NULL
      AND len([c for c in embedding if c IS NULL OR NOT isfinite(c)]) = 0),
s AS (SELECT a.r, a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
             CAST(list_sum([a.x[i] * b.x[i] for i in range(1, len(a.x) + 1)]) AS BIGINT) AS score
      FROM v AS a JOIN v AS b ON a.vec_id % 100 = 0 AND a.r <> b.r AND len(a.x) = len(b.x)),
p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS place FROM s WHERE same)
      WHERE place <= 5),
n AS (SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
             row_number() OVER (PARTITION BY p.r, p.place ORDER BY s.score DESC, s.vec_id) AS rank
      FROM p JOIN s ON s.r = p.r AND NOT s.same AND 80 * p.score <= 100 * s.score AND s.score <= p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""


@query
def op13_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(table(spark, sf_dir, "documents"), F.crc32(F.col("doc_id").cast("string")) % 10 == 0)
