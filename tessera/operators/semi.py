"""Semi-structured data (SEMI-*): JSON / variant paths, flattening, XML.

JSON text is parsed with built-in ``parse_json``/``variant_get`` or
``from_json`` with a declared schema; XML with ``from_xml`` at plain paths and
``xpath`` at any other.  Only the recursive chunker (SEMI-10) parses in
Python, per Arrow batch.
"""

from __future__ import annotations

import json
import re
from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def json_path(col, path: str, typ: str) -> Column:
    """SEMI-01: typed value at a JSON path (``$.a.b[0].c``), via the variant
    type; a missing path, a value of the
    wrong type or a malformed document gives NULL."""
    return F.try_variant_get(F.try_parse_json(_c(col)), path, typ)


def flatten(df: DataFrame, col: str, schema: T.DataType | str, alias: str = "item",
            outer: bool = False) -> DataFrame:
    """SEMI-02: one row per element of a JSON array, outer columns kept."""
    arr = F.from_json(F.col(col), schema)
    fn = F.explode_outer if outer else F.explode
    return df.withColumn(alias, fn(arr))


def flatten_nested(df: DataFrame, paths: Sequence[tuple[str, str]]) -> DataFrame:
    """SEMI-03: chained explodes: ``paths`` = [(array column, alias), ...]."""
    for col, alias in paths:
        df = df.withColumn(alias, F.explode(F.col(col)))
    return df


def json_keys(df: DataFrame, col: str) -> DataFrame:
    """SEMI-04: key frequency over a JSON object column."""
    return (df.select(F.explode(F.json_object_keys(F.col(col))).alias("key"))
              .groupBy("key").agg(F.count(F.lit(1)).alias("n")))


def row_to_json(df: DataFrame, cols: Sequence[str] | None = None, out: str = "doc") -> DataFrame:
    """SEMI-05: object construct of a row."""
    cols = list(cols or df.columns)
    return df.withColumn(out, F.to_json(F.struct(*cols)))


def json_to_pairs(df: DataFrame, ids: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """SEMI-05: dynamic unpivot: each (non-id) key as a (key, value) row."""
    return df.unpivot(list(ids), [F.col(c).cast("string").alias(c) for c in cols], "key", "value")


#: Absolute XPaths of child steps, each with or without a position.
_PLAIN_PATH = re.compile(r"/[A-Za-z_]\w*(/[A-Za-z_]\w*(\[[1-9]\d*\])?)*")


def _first_at(col, path: str, attr: str | None, general: Column) -> Column:
    """Text, or an attribute, of the first node at a plain path by ``from_xml``:
    ``xpath_string`` sets up a new parser and document model for every row and
    call, which costs many times the parsing.  ``general``, Spark's XPath, reads
    other paths, documents that do not begin with the root's tag or hold
    anything but plain tags and text, and values not found or with markup."""
    if not _PLAIN_PATH.fullmatch(path) or (attr and not re.fullmatch(r"[A-Za-z_]\w*", attr)) or not attr and path.count("/") == 1:
        return general
    doc = _c(col)
    root, *steps = path[1:].split("/")
    names = [x.partition("[")[0] for x in steps]
    kind = T.StructType().add(f"_{attr}", T.StringType()) if attr else T.StringType()
    for name in reversed(names):
        kind = T.StructType().add(name, T.ArrayType(kind))
    known = F.lit(True)
    for mark in ("&", "<!", "<?", ":"):
        known = known & ~doc.contains(mark)
    for name in {*names, attr} - {None}:  # from_xml does not tell a from A
        known = known & ~F.lower(F.replace(doc, F.lit(name), F.lit(""))).contains(name.lower())
    known = known & (doc.startswith(f"<{root} ") | doc.startswith(f"<{root}>")) & doc.endswith(f"</{root}>")
    at = F.from_xml(F.when(known, doc), kind, {"mode": "FAILFAST", "ignoreSurroundingSpaces": "false"})
    at = F.array(at)
    for name, step in zip(names, steps):
        place = int(step.partition("[")[2].rstrip("]") or 0)
        found = F.filter(F.transform(at, lambda x: x[name]), lambda x: x.isNotNull())
        at = F.transform(found, lambda x: F.get(x, F.lit(place - 1))) if place else F.flatten(found)
        at = F.filter(at, lambda x: x.isNotNull()) if attr or name != names[-1] else at
    if attr:
        at = F.filter(F.transform(at, lambda x: x[f"_{attr}"]), lambda x: x.isNotNull())
    at = F.filter(F.slice(at, 1, 1), lambda x: ~x.contains("<"))  # in one expression, so that it is evaluated once
    return F.coalesce(F.get(at, F.lit(0)), general)


def xml_text(col, path: str) -> Column:
    """SEMI-06: text of the first node at an XPath."""
    return _first_at(col, path, None, F.xpath_string(_c(col), F.lit(path)))


def xml_rows(df: DataFrame, col: str, path: str, alias: str = "node") -> DataFrame:
    """SEMI-07: repeated XML values at an XPath to rows."""
    return df.withColumn(alias, F.explode(F.xpath(F.col(col), F.lit(path))))


def xml_attr(col, path: str, name: str) -> Column:
    """SEMI-08: attribute value (``path/@name``)."""
    return _first_at(col, path, name, F.xpath_string(_c(col), F.lit(f"{path}/@{name}")))


def xml_count(col, path: str) -> Column:
    """SEMI-09: number of nodes at an XPath."""
    return F.xpath_int(_c(col), F.lit(f"count({path})"))


def _leaves(value, path: str):
    """(path, text) of every leaf of a parsed JSON value, in document order."""
    todo = [(path, value)]
    while todo:
        at, v = todo.pop()
        if isinstance(v, dict) and v:
            todo += [(f"{at}.{k}" if at else str(k), x) for k, x in reversed(v.items())]
        elif isinstance(v, list) and v:
            todo += [(f"{at}[{i}]", x) for i, x in reversed(list(enumerate(v)))]
        else:
            yield at, v if isinstance(v, str) else json.dumps(v, ensure_ascii=False)


def pack_lines(lines: Sequence[tuple[str, str]], max_chars: int):
    """Fold ordered (path, line) into chunks of at most ``max_chars``
    characters; a longer line is a chunk of its own."""
    paths, chunk, size = [], [], 0
    for path, line in lines:
        if chunk and size + 1 + len(line) > max_chars:
            yield paths, "\n".join(chunk)
            paths, chunk, size = [], [], 0
        size += len(line) + (1 if chunk else 0)
        paths.append(path)
        chunk.append(line)
    if chunk:
        yield paths, "\n".join(chunk)


def json_chunks(df: DataFrame, id_col: str, col: str, max_chars: int) -> DataFrame:
    """SEMI-10: leaves of a JSON document (nested to any depth) as
    ``path: value`` lines, packed in document order into chunks of at most
    ``max_chars`` characters, with the paths of each chunk as metadata.  One
    document is one small fold in an Arrow batch; malformed JSON has no chunk."""
    rows = df.select(id_col, col)
    schema = T.StructType([rows.schema[0], T.StructField("chunk_no", T.LongType()),
                           T.StructField("paths", T.ArrayType(T.StringType())), T.StructField("chunk", T.StringType())])

    def cut(batches):
        for b in batches:
            owner, numbers, paths, chunks = [], [], [], []
            for i, text in enumerate(b.column(1).to_pylist()):
                try:
                    doc = json.loads(text) if text is not None else None
                except ValueError:
                    continue
                if doc is None:
                    continue
                lines = [(p, f"{p}: {v}") for p, v in _leaves(doc, "")]
                for n, (own, chunk) in enumerate(pack_lines(lines, max_chars)):
                    owner.append(i)
                    numbers.append(n)
                    paths.append(own)
                    chunks.append(chunk)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(owner, pa.int64())), pa.array(numbers, pa.int64()),
                 pa.array(paths, pa.list_(pa.string())), pa.array(chunks, pa.string())], names=schema.names)

    return rows.mapInArrow(cut, schema)


def split_rows(df: DataFrame, col: str, sep: str, alias: str = "part", pos: str = "pos") -> DataFrame:
    """SEMI-11: delimited string to rows with 1-based positions (``sep`` is
    a literal, not a regex)."""
    return df.select("*", F.posexplode(F.split(F.col(col), re.escape(sep))).alias(pos, alias)) \
             .withColumn(pos, F.col(pos) + 1)


def to_child_table(df: DataFrame, key: str, col: str, sep: str, item: str = "item",
                   pos: str = "item_no") -> DataFrame:
    """SEMI-12: 1NF repair: a repeating group in one column becomes a child
    table (parent key, position, item)."""
    return split_rows(df.select(key, col), col, sep, item, pos).drop(col)


def patch_struct(df: DataFrame, col: str, updates: Mapping[str, object]) -> DataFrame:
    """SEMI-13: merge a partial update into a nested record.  ``updates``
    keys are dotted paths (``address.city``); nested structs are rebuilt with
    ``withField`` so untouched fields stay as they are."""
    c = F.col(col)
    for path, value in updates.items():
        val = value if isinstance(value, Column) else F.lit(value)
        c = c.withField(path, val)
    return df.withColumn(col, c)


def filter_nested(df: DataFrame, path: str, values: Sequence) -> DataFrame:
    """SEMI-14: keep rows whose nested attribute is in ``values``."""
    return df.filter(F.col(path).isin(list(values)))
