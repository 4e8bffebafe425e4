"""N-gram Jaccard join by vertical partitioning, and the components of its links.

A document's set is its distinct ``k``-word shingles (64-bit hashes; fewer than
k words: the whole sequence as one).  Two documents link when 100 * |A and B|
>= ``percent`` * |A or B|.  The steps:

1. Documents with equal sets become one class, found by a 128-bit signature.
2. The global order of shingles puts seldom ones first.  How often a shingle
   occurs is counted over all classes; the counts are kept as logarithms in a
   table of 2^``TABLE_BITS`` slots, so that what is broadcast does not grow.
   Any order gives the same links, a better one gives fewer candidates.
3. Two linked sets share a shingle of their prefixes, the first shingles in
   the global order.  Prefix shingles held by two classes or more are buckets.
4. Links in buckets without all pairs: in every bucket the class with the
   fewest seldom shingles is the centre, each class is compared with the one
   centre it shares most buckets with, and the links found are contracted to
   components.  Rounds go on while they pay.  Then every class that is not in
   the main component of a bucket is compared with all of the bucket that are
   in other components, behind the size, position and parity-bitmap bounds,
   which are exact.  So every link between two components is found; links
   inside a component cannot change it.
5. Candidates are compared by vertical partitioning: the global order is cut
   into ``FRAGMENTS`` fragments, each pair's overlap is counted in each
   fragment separately, and the partial counts are summed per pair.

Defined cases: a null or empty text has an empty set and links with nothing;
rows that repeat an id are reported one by one (and link by their texts); null
ids are left out of a component's least id; a text of any length is cut into
shingles whole, in one row of a batch; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import bitmap_of, components, fresh_name, in_bitmap, map_arrow, row_numbered, through_table
from tessera.llm.words import NOT_SPACE, grams, mix, steps, words_of

U64 = np.uint64
#: Ranges of the counting step, and slots of the broadcast table of counts.
RANGE_BITS, TABLE_BITS = 11, 23
#: Shingles that a task of the counting step gathers before it deals them out.
DEALT = 1 << 20
#: Shingles seen fewer times count as seldom.
SELDOM = 8
#: Fragments of the global order: seldom shingles by hash, and the others.
FRAGMENTS = 8
#: Bits of the bitmaps of classes that later steps read again.
CLASS_BITS = 1 << 24
PARITY_WORDS = 16


def shingle_sets(texts: pa.Array, k: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words, counts = words_of(texts, NOT_SPACE)
    hashes, begin = grams(words, k), np.concatenate([[0], np.cumsum(counts)])
    out = []
    for n, at in zip(counts.tolist(), begin.tolist()):
        if n >= k:
            out.append(np.unique(hashes[at: at + n - k + 1]))
        elif n:
            out.append(mix(grams(words[at: at + n], n) + U64(n)))
        else:
            out.append(np.empty(0, U64))
    return out


def _long(x) -> pa.Array:
    return pa.array(np.asarray(x, np.uint64).view(np.int64))


def _sets_of(rows: DataFrame, k: int, known: bytes | None):
    """A function that yields (uids, sets) of an iterator of batches of (uid, h, text).

    ``known``: a bitmap of h; other rows are skipped.
    """
    held = rows.sparkSession.sparkContext.broadcast(known) if known is not None else None

    def sets(batches: Iterator[pa.RecordBatch]):
        bitmap = np.frombuffer(held.value, np.uint8) if held is not None else None
        for b in batches:
            if bitmap is not None:
                b = b.filter(pa.array(in_bitmap(bitmap, b.column(1).to_numpy().view(np.uint64))))
            for at, texts in steps(b.column(2)):
                yield b.column(0).slice(at, len(texts)).to_numpy(), shingle_sets(texts, k)

    return sets


def classes_of(rows: DataFrame, k: int) -> DataFrame:
    """(uid, s, sig1, sig2) per row; an empty set is a class of its own."""
    sets = _sets_of(rows, k, None)

    def sign(batches):
        for uids, found in sets(batches):
            sizes = np.array([len(x) for x in found], np.int64)
            one = [int(mix(x).sum(dtype=U64)) if len(x) else int(u) for u, x in zip(uids, found)]
            two = [int(np.bitwise_xor.reduce(mix(x + U64(0x9E3779B97F4A7C15)))) if len(x) else 0 for x in found]
            yield pa.RecordBatch.from_arrays([pa.array(uids), pa.array(sizes), _long(one), _long(two)],
                                             names=["uid", "s", "sig1", "sig2"])

    return map_arrow(rows, sign, "uid long, s long, sig1 long, sig2 long")


def count_table(rows: DataFrame, k: int, known: bytes) -> bytes:
    """Per slot of 2^TABLE_BITS: 0, or the logarithm of how often its most frequent shingle occurs.

    The occurrences are dealt by hash range, counted exactly per 32-bit prefix
    of the hash, and only the slots' logarithms reach the driver.
    """
    sets = _sets_of(rows, k, known)
    width = 32 - RANGE_BITS

    def deal(batches):
        def dealt(held):
            top = np.sort(np.concatenate(held))
            cuts = np.searchsorted(top, (np.arange((1 << RANGE_BITS) + 1, dtype=np.uint64) << U64(width)))
            parts = [top[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])]
            return pa.RecordBatch.from_arrays([pa.array(range(1 << RANGE_BITS), pa.int32()), pa.array(parts, pa.binary())],
                                              names=["r", "part"])

        held, size = [], 0
        for _, found in sets(batches):
            held += [(x >> U64(32)).astype(np.uint32) for x in found]
            size += sum(map(len, found))
            if size > DEALT:
                yield dealt(held)
                held, size = [], 0
        if size:
            yield dealt(held)

    slots = 1 << (TABLE_BITS - RANGE_BITS)

    def count(batches):
        now, pending, size, sums = None, [], 0, None

        def flush():
            nonlocal sums, pending, size
            if pending:
                idx = np.concatenate(pending) & np.uint32((1 << width) - 1)
                more = np.bincount(idx, minlength=1 << width).astype(np.uint32)
                sums = more if sums is None else sums + more
                pending, size = [], 0

        def result():
            most = (sums if sums is not None else np.zeros(1 << width, np.int64)).reshape(slots, -1).max(axis=1)
            return pa.RecordBatch.from_arrays(
                [pa.array([now], pa.int32()),
                 pa.array([np.where(most >= SELDOM, np.log2(np.maximum(most, 1)), 0).astype(np.uint8).tobytes()], pa.binary())],
                names=["r", "part"])

        for b in batches:
            for r, part in zip(b.column(0).to_pylist(), b.column(1)):
                if r != now:
                    flush()
                    if now is not None:
                        yield result()
                    now, sums = r, None
                pending.append(np.frombuffer(part.as_buffer(), np.uint32))
                size += len(pending[-1])
                if size > DEALT:
                    flush()
        flush()
        if now is not None:
            yield result()

    schema = "r int, part binary"
    parts = map_arrow(map_arrow(rows, deal, schema).repartition("r").sortWithinPartitions("r"), count, schema).collect()
    table = np.zeros((1 << RANGE_BITS, slots), np.uint8)
    for r, part in parts:  # each range is a fixed number of slots
        table[r] = np.frombuffer(part, np.uint8)
    return table.tobytes()


def prefix_length(size: int, percent: int) -> int:
    """Shingles among which a set must share one with every linked set."""
    return size - -(-percent * size // 100) + 1


def _index_length(size, percent: int):
    """The same for the smaller set of a pair (integer arithmetic, on numbers or columns)."""
    return size - -(-2 * percent * size // (100 + percent)) + 1


def prefixes(rows: DataFrame, k: int, percent: int, known: bytes, table: bytes) -> DataFrame:
    """One row per class: uid, s, w (order of centres), its prefix shingles in order, and its parity bitmap."""
    sets = _sets_of(rows, k, known)
    held = rows.sparkSession.sparkContext.broadcast(table)
    shift = U64(64 - TABLE_BITS)

    def cut(batches):
        logs = np.frombuffer(held.value, np.uint8)
        for uids, found in sets(batches):
            size, weight, prefix, parity = [], [], [], []
            for uid, x in zip(uids, found):
                often = logs[x >> shift]
                order = np.lexsort((x, often))[: prefix_length(len(x), percent) if len(x) else 0]
                share = int(1000 * np.count_nonzero(often == 0) / max(len(x), 1))
                size.append(len(x))
                weight.append((share << 48) | int(mix(np.array([uid], np.int64).view(U64))[0] >> U64(16)))
                prefix.append(x[order].view(np.int64))
                bits = np.bincount((x & U64(64 * PARITY_WORDS - 1)).astype(np.int64), minlength=64 * PARITY_WORDS) & 1
                parity.append(np.packbits(bits.astype(np.uint8)).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(uids), pa.array(size, pa.int64()), pa.array(weight, pa.int64()), pa.array(prefix, pa.list_(pa.int64())),
                 *(pa.array([p[i] for p in parity], pa.int64()) for i in range(PARITY_WORDS))],
                names=["uid", "s", "w", "prefix", *(f"p{i}" for i in range(PARITY_WORDS))])

    return map_arrow(rows, cut, "uid long, s long, w long, prefix array<long>, "
                           + ", ".join(f"p{i} long" for i in range(PARITY_WORDS)))


def fragments(rows: DataFrame, k: int, known: bytes, table: bytes) -> DataFrame:
    """(uid, fragment, hs): each class's set cut at the same places of the global order."""
    sets = _sets_of(rows, k, known)
    held = rows.sparkSession.sparkContext.broadcast(table)
    shift = U64(64 - TABLE_BITS)

    def cut(batches):
        logs = np.frombuffer(held.value, np.uint8)
        for uids, found in sets(batches):
            owner, number, parts = [], [], []
            for uid, x in zip(uids, found):
                often = logs[x >> shift] > 0
                seldom = x[~often]
                cuts = np.searchsorted(seldom, np.arange(1, FRAGMENTS - 1, dtype=np.uint64) * U64(2**64 // (FRAGMENTS - 1)))
                for i, part in enumerate([*np.split(seldom, cuts), x[often]]):
                    if len(part):
                        owner.append(uid)
                        number.append(i)
                        parts.append(part.view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(owner, pa.int64()), pa.array(number, pa.int32()),
                                              pa.array(parts, pa.list_(pa.int64()))], names=["uid", "fragment", "hs"])

    return map_arrow(rows, cut, "uid long, fragment int, hs array<long>")


class JaccardJoin:
    def __init__(self, df: DataFrame, id_col: str, text_col: str, k: int, percent: int, row_col: str | None = None):
        self.k, self.percent = k, percent
        if row_col is None:  # every step reads the rows anew: their numbers must not depend on how files are cut
            df, row_col = row_numbered(df.select(id_col, text_col), fresh_name(df, "uid")), fresh_name(df, "uid")
        self.rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(row_col).alias("uid"))
        self.texts = self.rows.select("uid", F.xxhash64("uid").alias("h"), "text")

    def _overlap_needed(self, sx, sy):
        return F.ceil(F.lit(self.percent) * (sx + sy) / F.lit(100 + self.percent))

    def _can_link(self, x: str, y: str, positions: bool):
        """Exact bounds for rows with columns {x}s, {x}pos, {x}uid and the same of y."""
        sx, sy = F.col(f"{x}s"), F.col(f"{y}s")
        ok = (F.least(sx, sy) * 100 >= F.greatest(sx, sy) * self.percent)
        if positions:
            px, py = F.col(f"{x}pos"), F.col(f"{y}pos")
            first = (sx < sy) | ((sx == sy) & (F.col(f"{x}uid") < F.col(f"{y}uid")))

            def index(s):
                return s - F.ceil(F.lit(2 * self.percent) * s / F.lit(100 + self.percent)) + 1

            ok &= F.when(first, px < index(sx)).otherwise(py < index(sy))
            ok &= F.least(px, py) + F.least(sx - px, sy - py) >= self._overlap_needed(sx, sy)
        return ok

    def _parity_ok(self, x: str, y: str):
        """|A xor B| is at least the number of differing parity bits."""
        differ = sum((F.bit_count(F.col(f"{x}p{i}").bitwiseXOR(F.col(f"{y}p{i}"))) for i in range(1, PARITY_WORDS)),
                     F.bit_count(F.col(f"{x}p0").bitwiseXOR(F.col(f"{y}p0"))))
        sx, sy = F.col(f"{x}s"), F.col(f"{y}s")
        return differ <= sx + sy - 2 * self._overlap_needed(sx, sy)

    def verify(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, sa, b, sb) that link, by partial overlaps summed over fragments."""
        ends = pairs.select(F.xxhash64("a").alias("h")).union(pairs.select(F.xxhash64("b").alias("h")))
        parts = through_table(fragments(self.texts, self.k, bitmap_of(ends, "h", CLASS_BITS), self.table), "fragments")
        pa_, pb = parts.toDF("a", "fragment", "ha"), parts.toDF("b", "fragment", "hb")
        both = pairs.join(pa_, "a").join(pb, ["b", "fragment"])
        partial = both.select("a", "sa", "b", "sb", F.size(F.array_intersect("ha", "hb")).alias("n"))
        total = partial.groupBy("a", "sa", "b", "sb").agg(F.sum("n").alias("n"))
        return through_table(total.where(F.col("n") * 100 >= self.percent * (F.col("sa") + F.col("sb") - F.col("n")))
                             .select("a", "b"), "links")

    def labels(self, star_rounds: int = 3) -> DataFrame:
        """(uid, s, label) of every row: rows with the same label are connected by links."""
        signed = through_table(classes_of(self.texts, self.k), "signatures")
        classes = signed.groupBy("sig1", "sig2", "s").agg(F.min("uid").alias("rep"))
        known = bitmap_of(classes.where("s > 0").select(F.xxhash64("rep").alias("h")), "h", CLASS_BITS)
        self.table = count_table(self.texts, self.k, known)
        heads = through_table(prefixes(self.texts, self.k, self.percent, known, self.table), "prefixes")
        entries = heads.select("uid", F.posexplode("prefix").alias("pos", "tok"))
        shared = entries.groupBy("tok").agg(F.count("*").alias("n")).where("n > 1").select("tok")
        entries = through_table(entries.join(shared, "tok").join(heads.select("uid", "s", "w"), "uid"), "entries")
        size = entries.count()
        centres = entries.groupBy("tok").agg(F.min(F.struct("w", "uid", "s", "pos")).alias("c"))
        parity = heads.select("uid", *(f"p{i}" for i in range(PARITY_WORDS)))
        links, labels = None, None
        open_ = entries.join(centres, "tok")
        for number in range(star_rounds):
            stars = open_.select("uid", "s", "pos", F.col("c.uid").alias("cuid"), F.col("c.s").alias("cs"),
                                 F.col("c.pos").alias("cpos"), *(["label", "clabel"] if number else []))
            apart = F.col("label") != F.col("clabel") if number else F.col("uid") != F.col("cuid")
            tries = (stars.where(apart & self._can_link("", "c", True))
                     .groupBy("uid", "s", "cuid", "cs").agg(F.count("*").alias("n")))
            tries = (tries.join(parity, "uid").join(parity.toDF("cuid", *(f"cp{i}" for i in range(PARITY_WORDS))), "cuid")
                     .where(self._parity_ok("", "c")))
            best = tries.groupBy("uid", "s").agg(F.max(F.struct("n", "cuid", "cs")).alias("x"))
            best = best.select(F.col("uid").alias("a"), F.col("s").alias("sa"), F.col("x.cuid").alias("b"), F.col("x.cs").alias("sb"))
            best = through_table(best, "stars")
            new = self.verify(best)
            links = new if links is None else links.union(new)
            labels = components(links)
            open_ = through_table(self._open_entries(entries, labels), "open")
            if new.count() * 32 < size:  # few classes still join a centre; the rest is compared directly
                break
        last = self._cross_pairs(open_, parity)
        labels = components(links.union(self.verify(last)))
        mine = signed.join(classes, ["sig1", "sig2", "s"]).select("uid", "s", "rep")
        return (mine.join(labels.withColumnRenamed("node", "rep"), "rep", "left")
                .select("uid", "s", F.coalesce("label", "rep").alias("label")))

    @staticmethod
    def _open_entries(entries: DataFrame, labels: DataFrame) -> DataFrame:
        """The entries of buckets with two components or more, with labels, a new centre and the main label."""
        named = (entries.join(labels.withColumnRenamed("node", "uid"), "uid", "left")
                 .withColumn("label", F.coalesce("label", "uid")))
        per = named.groupBy("tok", "label").agg(
            F.count("*").alias("n"), F.min(F.struct(F.xxhash64("uid").alias("w"), "uid", "s", "pos")).alias("c"))
        per = per.groupBy("tok").agg(F.count("*").alias("labels"), F.max(F.struct("n", "label", "c")).alias("m"))
        per = per.where("labels > 1").select("tok", F.col("m.label").alias("clabel"), F.col("m.c").alias("c"))
        return named.join(per, "tok")

    def _cross_pairs(self, open_: DataFrame, parity: DataFrame) -> DataFrame:
        """Pairs in one bucket and two components that pass all bounds, as (a, sa, b, sb)."""
        wide = open_.select("tok", "uid", "s", "pos", "label", "clabel").join(parity, "uid")
        names = [c for c in wide.columns if c not in ("tok", "clabel")]
        x = wide.where(F.col("label") != F.col("clabel")).select("tok", *(F.col(c).alias(f"x{c}") for c in names))
        y = wide.select(F.col("tok").alias("ytok"), *(F.col(c).alias(f"y{c}") for c in names))
        near = x.join(y, (F.col("tok") == F.col("ytok")) & (F.col("xlabel") != F.col("ylabel"))
                      & self._can_link("x", "y", True) & self._parity_ok("x", "y"))
        low = F.col("xuid") < F.col("yuid")
        return through_table(near.select(
            F.when(low, F.col("xuid")).otherwise(F.col("yuid")).alias("a"), F.when(low, F.col("xs")).otherwise(F.col("ys")).alias("sa"),
            F.when(low, F.col("yuid")).otherwise(F.col("xuid")).alias("b"),
            F.when(low, F.col("ys")).otherwise(F.col("xs")).alias("sb")).distinct(), "cross")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 4,
                    percent: int = 85, row_col: str | None = None) -> DataFrame:
    """Per row: ``id_col``, n_shingles, component_id (least id reachable by links), and its row number.

    ``row_col``: a column of ``row_numbered``, if ``df`` has one; else the rows are numbered here.
    """
    join = JaccardJoin(df, id_col, text_col, k, percent, row_col)
    labelled = through_table(join.labels().join(join.rows.select("uid", "id"), "uid"), "labels")
    least = labelled.groupBy("label").agg(F.min("id").alias("component_id"))
    out = labelled.join(least, "label")
    return out.select(F.col("id").alias(id_col), F.col("s").alias("n_shingles"), "component_id",
                      F.col("uid").alias(fresh_name(df, "row")), F.col("label").alias(fresh_name(df, "label")))


def keep_one_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5,
                     percent: int = 80) -> DataFrame:
    """``df`` with one row of every group of near duplicates: the one with the least id (then the first row)."""
    rows = row_numbered(df, fresh_name(df, "row"))
    found = near_duplicates(rows, id_col, text_col, k, percent, rows.columns[-1])
    row, label = found.columns[3:]
    kept = found.groupBy(label).agg(F.min(F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"),
                                                   F.col(row).alias("row"))).alias("x"))
    gone = found.join(kept, label).where(F.col(row) != F.col("x.row")).select(F.col(row).alias(fresh_name(df, "gone_row")))
    return rows.join(gone.hint("shuffle_hash"), rows[rows.columns[-1]] == gone[gone.columns[0]], "left_anti").drop(rows.columns[-1])
