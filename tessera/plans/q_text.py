"""Registered queries for text and document jobs (TXT-*)."""

from pyspark.sql import functions as F

from tessera.operators import text as X
from tessera.plans.registry import register
from tessera.session import load_table as T

_WORDS = "list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}_]+'), lambda w: w <> '')"


@register("TXT-01", "txt01_word_count", f"""
SELECT word, count(*) AS n FROM (SELECT unnest({_WORDS}) AS word FROM documents) GROUP BY 1""")
def txt01(spark, sf):
    return X.word_count(T(spark, sf, "documents"), "text")


@register("TXT-02", "txt02_repeated_words_by_lang", f"""
SELECT lang, word, count(*) AS n FROM (SELECT lang, unnest({_WORDS}) AS word FROM documents) GROUP BY 1, 2 HAVING count(*) > 1""")
def txt02(spark, sf):
    return X.repeated_words(T(spark, sf, "documents"), "text", ["lang"])


@register("TXT-03", "txt03_find_replace", """
SELECT doc_id, CAST(len(regexp_extract_all(text, '(^|[^\\p{L}\\p{N}_])the([^\\p{L}\\p{N}_]|$)')) AS BIGINT) AS hits,
       md5(regexp_replace(text, '(^|[^\\p{L}\\p{N}_])the([^\\p{L}\\p{N}_]|$)', '\\1THE\\2', 'g')) AS replaced_md5
FROM documents""")
def txt03(spark, sf):
    d = X.find_replace(T(spark, sf, "documents"), "text", "the", "THE")
    return d.select("doc_id", F.col("hits").cast("bigint").alias("hits"), F.md5("replaced").alias("replaced_md5"))


@register("TXT-04", "txt04_line_hygiene", """
SELECT doc_id, md5(array_to_string(list_reverse(list_filter(string_split(
         regexp_replace(text, '[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F\\x7F]', '', 'g'), chr(10)), lambda l: trim(l) <> '')), chr(10))) AS clean_md5
FROM documents""")
def txt04(spark, sf):
    d = X.clean_lines(T(spark, sf, "documents"), "text", drop_blank=True, reverse=True)
    return d.select("doc_id", F.md5("clean").alias("clean_md5"))


@register("TXT-05", "txt05_recursive_chunks")
def txt05(spark, sf):
    return X.chunk_recursive(T(spark, sf, "documents"), "doc_id", "text", 500, 50)


@register("TXT-06", "txt06_fixed_separator_chunks")
def txt06(spark, sf):
    return X.chunk_fixed(T(spark, sf, "documents"), "doc_id", "text", "\n", 800, 0)


@register("TXT-07", "txt07_token_budget_chunks")
def txt07(spark, sf):
    return X.chunk_tokens(T(spark, sf, "documents"), "doc_id", "text", 120, 20)


@register("TXT-08", "txt08_html_header_sections")
def txt08(spark, sf):
    return X.chunk_html(T(spark, sf, "pages"), "page_id", "html")


@register("TXT-09", "txt09_main_content")
def txt09(spark, sf):
    return X.main_text(T(spark, sf, "pages"), "page_id", "html")


@register("TXT-10", "txt10_token_statistics", """
WITH d AS (SELECT source, len(regexp_extract_all(text, '[^ \\t\\n\\r\\f]+')) AS tok, length(text) AS chr FROM documents)
SELECT source, CAST(sum(tok) AS BIGINT) AS tokens, CAST(sum(chr) AS BIGINT) AS chars, round(sum(tok) / sum(chr), 6) AS tokens_per_char,
       CAST(count_if(tok > 500) AS BIGINT) AS over_limit FROM d GROUP BY 1""")
def txt10(spark, sf):
    d = X.token_stats(T(spark, sf, "documents"), ["source"], "text", 500)
    return d.withColumn("tokens_per_char", F.round("tokens_per_char", 6))


@register("TXT-11", "txt11_chunk_metadata")
def txt11(spark, sf):
    docs = T(spark, sf, "documents")
    ch = X.chunk_recursive(docs, "doc_id", "text", 500, 50)
    return X.with_meta(ch, docs, "doc_id", ["lang", "source"]).filter(F.col("metadata")["lang"] == "en")


@register("TXT-12", "txt12_chat_history_trim", """
WITH d AS (SELECT *, len(regexp_extract_all(text, '[^ \\t\\n\\r\\f]+')) AS tok FROM conversations),
 b AS (SELECT *, sum(tok) OVER (PARTITION BY conv_id ORDER BY turn DESC ROWS UNBOUNDED PRECEDING) AS run FROM d WHERE role <> 'system'),
 k AS (SELECT * FROM b WHERE run <= 150),
 fu AS (SELECT conv_id, min(turn) AS fu FROM k WHERE role = 'user' GROUP BY 1)
SELECT k.conv_id, k.turn, k.role FROM k JOIN fu USING (conv_id) WHERE k.turn >= fu.fu
UNION ALL SELECT conv_id, turn, role FROM d WHERE role = 'system'""")
def txt12(spark, sf):
    c = T(spark, sf, "conversations")
    return X.trim_history(c, "conv_id", "turn", "role", "text", 150).select("conv_id", "turn", "role")


@register("TXT-13", "txt13_thread_assembly_checks", """
SELECT conv_id, count(*) AS turns, arg_min(role, turn) AS first_role,
       bool_and(prev IS NULL OR prev <> role) AS alternates, CAST(sum(length(text)) AS BIGINT) AS chars
FROM (SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS prev FROM conversations) GROUP BY 1""")
def txt13(spark, sf):
    return X.thread_stats(T(spark, sf, "conversations"), "conv_id", "turn", "role", "text")


@register("TXT-14", "txt14_chunk_coverage_audit")
def txt14(spark, sf):
    docs = T(spark, sf, "documents")
    return X.chunk_audit(X.chunk_recursive(docs, "doc_id", "text", 500, 50), docs, "doc_id", "text")


@register("TXT-13", "txt13_thread_lines_with_offsets", """
SELECT conv_id, turn, md5(role || ': ' || text) AS line_md5,
       CAST(sum(length(role || ': ' || text) + 1) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING)
         - (length(role || ': ' || text) + 1) AS BIGINT) AS char_offset
FROM conversations""")
def txt13b(spark, sf):
    t = X.threads(T(spark, sf, "conversations"), "conv_id", "turn", "role", "text")
    return t.select("conv_id", "turn", F.md5("line").alias("line_md5"), "char_offset")
