"""Jobs whose full result SQL cannot state, reduced to what SQL can: sums that
must come out, and bounds as booleans.  The full results are registered beside
the other queries of their sections."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators import layout as Y
from tessera.operators import sampling as S
from tessera.operators import semi as M
from tessera.operators import text as X
from tessera.operators import vectors as V
from tessera.operators.common import attach_scalars
from tessera.plans.registry import register
from tessera.session import load_table as T

#: Characters that chunks may leave out at their ends, and all but them.
_SPACE = r"[ \t\n\r\f\x0B]"


def _chunks_checked(docs: DataFrame, chunks: DataFrame, too_long: Column) -> DataFrame:
    """By language: documents, characters other than white space that the chunks cover (each once), chunks that are not
    their text's span, chunks over the limit, chunks inside another."""
    order = Window.partitionBy("doc_id").orderBy("chunk_no")  # the chunks of one document
    c = chunks.join(docs.select("doc_id", "lang", "text"), "doc_id")
    c = c.withColumn("_done", F.coalesce(F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    span = lambda a, b: F.substring("text", F.col(a).cast("int") + 1, (F.col(b) - F.col(a)).cast("int"))
    c = c.withColumn("_new", F.greatest("start", "_done"))
    fresh = F.when(F.col("end") > F.col("_new"), F.length(F.regexp_replace(span("_new", "end"), _SPACE, ""))).otherwise(0)
    per = c.groupBy("lang").agg(F.sum(fresh).alias("covered"),
                                F.count_if(F.trim(span("start", "end")) != F.trim("chunk")).alias("other_text"),
                                F.count_if(too_long).alias("too_long"),
                                F.count_if(F.col("end") <= F.col("_done")).alias("inside"))
    n = docs.groupBy("lang").agg(F.count(F.lit(1)).alias("docs"))
    return n.join(per, "lang").select("lang", "docs", "covered", "other_text", "too_long", "inside")


_CHUNKS = r"""
SELECT lang, count(*) AS docs, CAST(sum(length(regexp_replace(text, '[ \t\n\r\f\x0B]', '', 'g'))) AS BIGINT) AS covered,
       CAST(0 AS BIGINT) AS other_text, CAST(0 AS BIGINT) AS too_long, CAST(0 AS BIGINT) AS inside
FROM documents WHERE lang IS NOT NULL GROUP BY 1"""


@register("TXT-05", "txt05_chunks_checked", _CHUNKS)
def txt05(spark, sf):
    d = T(spark, sf, "documents")
    return _chunks_checked(d, X.chunk_recursive(d, "doc_id", "text", 500, 50), F.length("chunk") > 500)


@register("TXT-06", "txt06_chunks_checked", _CHUNKS)
def txt06(spark, sf):
    d = T(spark, sf, "documents")  # a piece without a separator stays whole
    return _chunks_checked(d, X.chunk_fixed(d, "doc_id", "text", "\n", 800, 0),
                           (F.length("chunk") > 800) & F.regexp_replace("chunk", f"^{_SPACE}+|{_SPACE}+$", "").contains("\n"))


@register("TXT-07", "txt07_chunks_checked", _CHUNKS)
def txt07(spark, sf):
    d = T(spark, sf, "documents")
    return _chunks_checked(d, X.chunk_tokens(d, "doc_id", "text", 120, 20), F.regexp_count("chunk", F.lit(r"[^ \t\n\r\f\x0B]+")) > 120)


@register("TXT-11", "txt11_metadata_checked", """
SELECT lang, source, count(*) AS docs FROM documents WHERE trim(text) <> '' GROUP BY 1, 2""")
def txt11(spark, sf):
    d = T(spark, sf, "documents")
    c = X.with_meta(X.chunk_recursive(d, "doc_id", "text", 500, 50), d, "doc_id", ["lang", "source"])
    return c.groupBy(F.col("metadata")["lang"].alias("lang"), F.col("metadata")["source"].alias("source")) \
            .agg(F.count_distinct("doc_id").alias("docs"))


@register("SEMI-10", "semi10_leaves_checked", """
SELECT event_id, CAST((event_type IS NOT NULL)::INT + (value IS NOT NULL)::INT + (props IS NOT NULL)::INT + (user_id IS NOT NULL)::INT
       AS BIGINT) AS leaves, true AS within_limit FROM events""")
def semi10(spark, sf):
    e = T(spark, sf, "events").select("event_id", F.to_json(F.struct("event_type", "value", "props", "user_id")).alias("doc"))
    c = M.json_chunks(e, "event_id", "doc", 40)  # a leaf longer than the limit is a chunk of its own
    return c.groupBy("event_id").agg(F.sum(F.size("paths")).cast("bigint").alias("leaves"),
                                     F.bool_and((F.length("chunk") <= 40) | (F.size("paths") == 1)).alias("within_limit"))


@register("SRC-12", "src12_inventory_checked", "SELECT count(*) AS rows, true AS all_sized FROM lineitem")
def src12(spark, sf):
    return Y.inventory(spark, f"{sf}/lineitem.parquet").agg(F.sum("rows").alias("rows"), F.bool_and(F.col("bytes") > 0).alias("all_sized"))


@register("LAY-02", "lay02_ranges_checked", """
SELECT CAST(min(l_shipdate) AS VARCHAR) AS lo, CAST(max(l_shipdate) AS VARCHAR) AS hi, count(*) AS rows, true AS depth_holds FROM lineitem""")
def lay02(spark, sf):
    r = Y.layout_report(spark, f"{sf}/lineitem.parquet", "l_shipdate")
    text = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    return r.agg(text(F.min("lo")).alias("lo"), text(F.max("hi")).alias("hi"), F.sum("rows").alias("rows"),
                 F.bool_and((F.col("depth") >= 1) & (F.col("overlaps") >= 0) & (F.col("depth") <= F.col("overlaps") + 1)).alias("depth_holds"))


@register("SMP-01", "smp01_share_checked", "SELECT count(*) AS rows, true AS near_share FROM events")
def smp01(spark, sf):
    e = T(spark, sf, "events")
    n = e.agg(F.count(F.lit(1)).alias("rows"))
    kept = S.sample_rows(e, 0.1, 42).agg(F.count(F.lit(1)).alias("_k"))
    near = F.abs(F.col("_k") - 0.1 * F.col("rows")) <= 5 * F.sqrt(0.09 * F.col("rows"))  # five standard deviations
    return attach_scalars(n, kept).select("rows", near.alias("near_share"))


@register("SMP-02", "smp02_blocks_checked", "SELECT count(*) AS rows, true AS whole_blocks FROM lineitem")
def smp02(spark, sf):
    li = T(spark, sf, "lineitem")
    block = F.struct(F.col("_metadata.file_name").alias("f"), F.floor(F.col("_metadata.row_index") / 1000).alias("b")).alias("block")
    count = lambda d, name: d.select(block).groupBy("block").agg(F.count(F.lit(1)).alias(name))
    both = count(li, "n").join(count(S.sample_blocks(li, 0.5, 7), "k"), "block", "left")
    return both.agg(F.sum("n").alias("rows"), F.bool_and(F.col("k").isNull() | (F.col("k") == F.col("n"))).alias("whole_blocks"))


@register("VEC-08", "vec08_variance_checked", "SELECT count(*) AS rows, true AS keeps_most FROM embeddings")
def vec08(spark, sf):
    e = T(spark, sf, "embeddings")
    spread = lambda d, c, n: sum((F.var_pop(F.get(F.col(c), F.lit(i)).cast("double")) for i in range(n)), F.lit(0.0))
    # 8 axes of largest variance hold at least 8 of 64 equal shares, and no more than there is
    r = V.reduce_dim(e, "embedding", 8)
    got = r.agg(F.count(F.lit(1)).alias("rows"), spread(r, "reduced", 8).alias("_kept"), spread(r, "embedding", 64).alias("_all"))
    return got.select("rows", ((F.col("_kept") >= F.col("_all") * 8 / 64) & (F.col("_kept") <= F.col("_all") * 1.000001)).alias("keeps_most"))
