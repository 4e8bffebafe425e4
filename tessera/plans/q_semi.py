"""Registered queries for semi-structured data (SEMI-*)."""

from pyspark.sql import functions as F

from tessera.operators import semi as M
from tessera.plans.registry import register
from tessera.session import load_table as T


@register("SEMI-01", "semi01_json_path_cast", """
SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k, json_extract_string(props, '$.missing') AS missing
FROM events""")
def semi01(spark, sf):
    e = T(spark, sf, "events")
    return e.select("event_id", M.json_path("props", "$.k", "int").alias("k"),
                    M.json_path("props", "$.missing", "string").alias("missing"))


def _order_docs(spark, sf):
    """One JSON document per order: {"lines": [{"p": partkey, "q": qty, "m": [disc, tax]}]}.
    Bounded per document by the lines of one order."""
    li = T(spark, sf, "lineitem")
    return li.groupBy("l_orderkey").agg(F.to_json(F.struct(F.collect_list(F.struct(
        F.col("l_partkey").alias("p"), F.col("l_quantity").alias("q"),
        F.array("l_discount", "l_tax").alias("m"))).alias("lines"))).alias("doc"))


@register("SEMI-02", "semi02_flatten_array", """SELECT l_orderkey, l_partkey, l_quantity FROM lineitem""")
def semi02(spark, sf):
    docs = _order_docs(spark, sf)
    schema = "struct<lines: array<struct<p: bigint, q: double, m: array<double>>>>"
    d = docs.withColumn("_d", F.from_json("doc", schema))
    d = M.flatten_nested(d, [("_d.lines", "line")])
    return d.select("l_orderkey", F.col("line.p").alias("l_partkey"), F.col("line.q").alias("l_quantity"))


@register("SEMI-03", "semi03_nested_flatten", """
SELECT l_orderkey, l_partkey, m FROM (SELECT l_orderkey, l_partkey, l_discount AS m FROM lineitem
UNION ALL SELECT l_orderkey, l_partkey, l_tax FROM lineitem)""")
def semi03(spark, sf):
    docs = _order_docs(spark, sf)
    schema = "struct<lines: array<struct<p: bigint, q: double, m: array<double>>>>"
    d = docs.withColumn("_d", F.from_json("doc", schema))
    d = M.flatten_nested(d, [("_d.lines", "line"), ("line.m", "m")])
    return d.select("l_orderkey", F.col("line.p").alias("l_partkey"), "m")


@register("SEMI-04", "semi04_json_key_frequency", """
SELECT key, count(*) AS n FROM (SELECT unnest(json_keys(props)) AS key FROM events) GROUP BY 1""")
def semi04(spark, sf):
    return M.json_keys(T(spark, sf, "events"), "props")


@register("SEMI-05", "semi05_row_to_json", """
SELECT n_nationkey, to_json({'n_nationkey': n_nationkey, 'n_name': n_name, 'n_regionkey': n_regionkey}) AS doc FROM nation""")
def semi05(spark, sf):
    n = T(spark, sf, "nation")
    return M.row_to_json(n, ["n_nationkey", "n_name", "n_regionkey"]).select("n_nationkey", "doc")


@register("SEMI-05", "semi05_dynamic_unpivot", """
SELECT n_nationkey, key, value FROM (SELECT n_nationkey, n_name, CAST(n_regionkey AS VARCHAR) AS n_regionkey FROM nation)
UNPIVOT (value FOR key IN (n_name, n_regionkey))""")
def semi05b(spark, sf):
    return M.json_to_pairs(T(spark, sf, "nation"), ["n_nationkey"], ["n_name", "n_regionkey"])


def _order_xml(spark, sf):
    """XML per order: <order id=".." status=".."><line n=".."><part>..</part></line>...</order>."""
    li = T(spark, sf, "lineitem")
    o = T(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus")
    # text is joined from parts, a NULL as "null", after the lines have met
    text = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    lines = li.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey"))).alias("lines"))
    body = F.array_join(F.transform("lines", lambda x: text('<line n="', x.l_linenumber, '"><part>', x.l_partkey, "</part></line>")), "")
    return lines.join(o, "l_orderkey").select("l_orderkey", text(
        '<order id="', F.col("l_orderkey"), '" status="', F.col("o_orderstatus"), '">', body, "</order>").alias("xml"))


@register("SEMI-06", "semi06_xml_text", """
SELECT l_orderkey, CAST(arg_min(l_partkey, (l_linenumber, l_partkey)) AS VARCHAR) AS first_part FROM lineitem GROUP BY 1""")
def semi06(spark, sf):
    x = _order_xml(spark, sf)
    return x.select("l_orderkey", M.xml_text("xml", "/order/line[1]/part").alias("first_part"))


@register("SEMI-07", "semi07_xml_repeat_to_rows", """SELECT l_orderkey, CAST(l_partkey AS VARCHAR) AS part FROM lineitem""")
def semi07(spark, sf):
    x = _order_xml(spark, sf)
    return M.xml_rows(x, "xml", "/order/line/part/text()", "part").select("l_orderkey", "part")


@register("SEMI-08", "semi08_xml_attributes", """SELECT o_orderkey AS l_orderkey, CAST(o_orderkey AS VARCHAR) AS id, o_orderstatus AS status
FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)""")
def semi08(spark, sf):
    x = _order_xml(spark, sf)
    return x.select("l_orderkey", M.xml_attr("xml", "/order", "id").alias("id"),
                    M.xml_attr("xml", "/order", "status").alias("status"))


@register("SEMI-09", "semi09_xml_count_tags", """SELECT l_orderkey, CAST(count(*) AS INTEGER) AS n_lines FROM lineitem GROUP BY 1""")
def semi09(spark, sf):
    x = _order_xml(spark, sf)
    return x.select("l_orderkey", M.xml_count("xml", "/order/line").alias("n_lines"))


@register("SEMI-10", "semi10_json_leaf_chunks")
def semi10(spark, sf):
    e = T(spark, sf, "events").select("event_id", F.to_json(F.struct("event_type", "value", "props", "user_id")).alias("doc"))
    return M.json_chunks(e, "event_id", "doc", 40)


@register("SEMI-11", "semi11_split_to_rows", """
SELECT p_partkey, CAST(i AS INTEGER) AS pos, string_split(p_name, ' ')[i] AS part
FROM part, range(1, len(string_split(p_name, ' ')) + 1) t(i)""")
def semi11(spark, sf):
    p = T(spark, sf, "part").select("p_partkey", "p_name")
    return M.split_rows(p, "p_name", " ").select("p_partkey", "pos", "part")


@register("SEMI-12", "semi12_child_table_1nf", """
SELECT doc_id, CAST(i AS INTEGER) AS item_no, string_split(text, chr(10))[i] AS item
FROM documents, range(1, len(string_split(text, chr(10))) + 1) t(i)""")
def semi12(spark, sf):
    d = T(spark, sf, "documents")
    return M.to_child_table(d, "doc_id", "text", "\n")


@register("SEMI-14", "semi14_nested_field_filter", """
SELECT event_id, user_id FROM events WHERE CAST(json_extract(props, '$.k') AS INTEGER) IN (1, 2, 3, 5, 8, 13)""")
def semi14(spark, sf):
    e = T(spark, sf, "events").withColumn("p", F.from_json("props", "struct<k: int>"))
    return M.filter_nested(e, "p.k", [1, 2, 3, 5, 8, 13]).select("event_id", "user_id")
