"""Best-fit packing by a grouping genetic algorithm on islands.

Documents are tokenised, closed with an end id and cut into pieces of at most
``capacity`` ids; a full piece is a sequence of its own.  The other pieces are
dealt by hash into shards of about ``shard_items`` pieces; a shard is bred on
``islands`` islands, each a task's row of its own, so no task ever holds more
than a few shards.  On an island the parents are packings: a crossover injects
whole well-filled bins of one parent into the other, removes the bins that
hold duplicates of the injected pieces, and best-fits the displaced pieces,
largest first.  After each epoch every island sends its elite to the next
island of its shard.  The shard's packing with the fewest bins wins.  A second
round (``rounds``) deals the pieces of the worst-filled bins into new shards
and breeds again, so that the remainders of different shards meet.

Defined cases: a null or empty text is the end id alone; rows that repeat an
id are packed row by row; an empty table packs into nothing; a text of any
length is encoded whole and cut into full pieces; other columns are not read.  Seeds come from the shard's number, so a lost task repeats itself.
"""

from __future__ import annotations

import math
import random
import re
import sys
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.bpe import CACHE_ENTRIES, LETTERS, NUMBERS, SPACES, Merger, library_tokenizer, needs_library
from tessera.llm.common import map_arrow, numbered, through_table

VOCABULARY = "word_bpe_49k.json"
WORDS = re.compile(f"'(?:s|t|re|ve|m|ll|d)|[{LETTERS}]+|[{NUMBERS}]|[^{SPACES}{LETTERS}{NUMBERS}]+")


def _bytes_of(ids: list[int]) -> bytes:
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


class _Ids(dict):
    """Pre-token -> its ids as little-endian unsigned 32-bit; starts with the words that are one token, merges what is missing."""

    def __init__(self, merger: Merger):
        super().__init__()
        for token in merger.vocab:
            try:
                word = merger.raw(token)[:-1].decode() if merger.suffix and token.endswith(merger.suffix) else ""
            except (KeyError, UnicodeDecodeError):
                continue
            if word and len(ids := merger.ids(word)) == 1:
                self[word] = _bytes_of(ids)
        self.merger, self.whole = merger, dict(self)

    def __missing__(self, piece: str) -> bytes:
        ids = _bytes_of(self.merger.ids(piece))
        if len(self) > CACHE_ENTRIES:
            self.clear()
            self.update(self.whole)
        if len(piece) <= 64:
            self[piece] = ids
        return ids


class TextIds:
    def __init__(self, path: str):
        self.library = library_tokenizer(path)
        self.of = _Ids(Merger(path))

    def ids(self, text: str) -> bytes:
        """The ids of a text, without special ones, as little-endian unsigned 32-bit."""
        if needs_library(text):
            return np.array(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4").tobytes()
        return b"".join(map(self.of.__getitem__, WORDS.findall(text.lower())))


@lru_cache(maxsize=2)
def text_ids(path: str) -> TextIds:
    return TextIds(path)


def cut_pieces(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY,
               end_id: int = 1, capacity: int = 4096, with_ids: bool = False) -> DataFrame:
    """One row per piece: ``id_col``, piece, start, length, ids_crc32 and, if asked for, ids."""
    rows = df.select(id_col, text_col)
    fields = [T.StructField(id_col, rows.schema[0].dataType), T.StructField("piece", T.IntegerType()),
              T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
              T.StructField("ids_crc32", T.LongType())]
    schema = T.StructType(fields + [T.StructField("ids", T.ArrayType(T.IntegerType()))] * with_ids)
    end, step = np.array([end_id], "<u4").tobytes(), 4 * capacity

    def emit(owner: list, ids: list, column) -> pa.RecordBatch:
        cols = [column.take(pa.array([o for o, _ in owner], pa.int64())), pa.array([p for _, p in owner], pa.int32()),
                pa.array([p * capacity for _, p in owner], pa.int64()), pa.array([len(x) // 4 for x in ids], pa.int64()),
                pa.array([zlib.crc32(x) for x in ids], pa.int64())]
        if with_ids:
            cols.append(pa.array([np.frombuffer(x, "<u4").astype(np.int32) for x in ids], pa.list_(pa.int32())))
        return pa.RecordBatch.from_arrays(cols, names=schema.names)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = text_ids(vocabulary)
        for b in batches:
            owner, pieces = [], []
            for i, text in enumerate(b.column(1)):
                ids = tok.ids(text.as_py() or "") + end
                for p, at in enumerate(range(0, len(ids), step)):
                    owner.append((i, p))
                    pieces.append(ids[at: at + step])
                if len(owner) >= 2000:
                    yield emit(owner, pieces, b.column(0))
                    owner, pieces = [], []
            yield emit(owner, pieces, b.column(0))

    return map_arrow(rows, cut, schema)


def best_fit(free: list[tuple[int, int]], bins: list[list[int]], items: list[int], size: list[int], capacity: int) -> None:
    """Put ``items`` one by one into the fullest bin that has room; ``free``: sorted (room, bin) of all open bins."""
    for x in items:
        at = bisect_left(free, (size[x], -1))
        if at == len(free):
            bins.append([x])
            insort(free, (capacity - size[x], len(bins) - 1))
        else:
            room, b = free.pop(at)
            bins[b].append(x)
            if room > size[x]:
                insort(free, (room - size[x], b))


def pack_order(order: list[int], size: list[int], capacity: int) -> list[list[int]]:
    bins: list[list[int]] = []
    best_fit([], bins, order, size, capacity)
    return bins


def fitness(bins: list[list[int]], size: list[int], capacity: int) -> tuple[int, float]:
    """Fewer bins first, then the bins' squared fill."""
    return -len(bins), sum((sum(size[x] for x in b) / capacity) ** 2 for b in bins)


def crossover(a: list[list[int]], b: list[list[int]], size: list[int], capacity: int, rng: random.Random) -> list[list[int]]:
    """Whole well-filled bins of ``b`` go into ``a``."""
    fill = [sum(size[x] for x in one) for one in b]
    share = rng.uniform(0.2, 0.6)
    good = sorted(range(len(b)), key=lambda i: -fill[i] - rng.random() * 0.05 * capacity)[: max(1, int(share * len(b)))]
    injected = [list(b[i]) for i in good]
    inside = {x for one in injected for x in one}
    child, loose = injected, []
    for one in a:
        kept = [x for x in one if x not in inside]
        if len(kept) == len(one):
            child.append(list(one))
        else:
            loose += kept
    if child and rng.random() < 0.5:  # mutation: the emptiest bin gives its pieces back
        least = min(range(len(child)), key=lambda i: sum(size[x] for x in child[i]))
        loose += child.pop(least)
    loose.sort(key=lambda x: -size[x])
    room = [capacity - sum(size[x] for x in one) for one in child]
    best_fit(sorted((r, i) for i, r in enumerate(room) if r > 0), child, loose, size, capacity)
    return child


def evolve(size: list[int], capacity: int, seed: int, parents: list[list[list[int]]], population: int = 4,
           generations: int = 12) -> list[list[int]]:
    """One epoch on one island; the best packing found.

    A packing of as few bins as all pieces fill ends the epoch: none has fewer.
    """
    rng = random.Random(seed)
    least = -(-sum(size) // capacity)
    herd = [(fitness(p, size, capacity), p) for p in parents]
    while len(herd) < population and all(len(p) > least for _, p in herd):
        noise = 0.0 if not herd else 0.25
        order = sorted(range(len(size)), key=lambda x: -size[x] * (1 - noise * rng.random()))
        p = pack_order(order, size, capacity)
        herd.append((fitness(p, size, capacity), p))
    for _ in range(generations):
        herd.sort(key=lambda h: h[0], reverse=True)
        if len(herd[0][1]) <= least:
            break
        i, j = rng.sample(range(min(len(herd), population)), 2)
        child = crossover(herd[i][1], herd[j][1], size, capacity, rng)
        herd = herd[: population - 1] + [(fitness(child, size, capacity), child)]
    return max(herd, key=lambda h: h[0])[1]


def _bin_of(bins: list[list[int]], n: int) -> list[int]:
    out = [0] * n
    for i, one in enumerate(bins):
        for x in one:
            out[x] = i
    return out


def _bins(bin_of: list[int]) -> list[list[int]]:
    bins: list[list[int]] = [[] for _ in range(max(bin_of, default=-1) + 1)]
    for x, b in enumerate(bin_of):
        bins[b].append(x)
    return bins


def breed(pieces: DataFrame, capacity: int, shard_items: int, islands: int, epochs: int, salt: int) -> DataFrame:
    """(uid, length) -> (uid, length, shard, bin): each shard's best packing."""
    n = pieces.count()
    shards = max(1, math.ceil(n / shard_items))
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64(F.lit(salt), F.col("uid")), F.lit(shards)))
    packed = dealt.groupBy("shard").agg(F.array_sort(F.collect_list(F.struct("uid", "length"))).alias("items"))
    state = packed.select("shard", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"), "items",
                          F.lit(None).cast("array<int>").alias("elite"), F.lit(None).cast("array<int>").alias("guest"))
    schema = state.schema
    tasks = max(1, math.ceil(shards * islands / 16))

    def epoch(number: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                best = []
                for shard, island, items, *own in zip(*(b.column(i) for i in range(5))):
                    size = [x["length"] for x in items.as_py()]
                    parents = [_bins(x.as_py()) for x in own if x.is_valid]
                    seed = (shard.as_py() * 64 + island.as_py()) * 64 + number
                    best.append(_bin_of(evolve(size, capacity, seed, parents), len(size)))
                yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(best, pa.list_(pa.int32())),
                                                  pa.nulls(len(b), pa.list_(pa.int32()))], names=schema.names)
        return run

    ring = Window.partitionBy("shard").orderBy("island")
    for e in range(epochs):
        state = map_arrow(state.repartition(tasks, "shard", "island"), epoch(e), schema)
        if e + 1 < epochs:
            state = state.withColumn("guest", F.coalesce(F.lead("elite").over(ring), F.first("elite").over(ring)))
    best = state.groupBy("shard").agg(F.min_by(F.struct("items", "elite"),
                                               F.struct(F.array_max("elite"), F.col("island"))).alias("best"))
    one = best.select("shard", F.explode(F.arrays_zip(F.col("best.items").alias("item"),
                                                      F.col("best.elite").alias("bin"))).alias("x"))
    return one.select(F.col("x.item.uid").alias("uid"), F.col("x.item.length").alias("length"), "shard",
                      F.col("x.bin").cast("long").alias("bin"))


def pack(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY, end_id: int = 1,
         capacity: int = 4096, shard_items: int = 2500, islands: int = 3, epochs: int = 2, rounds: int = 2,
         with_ids: bool = False) -> DataFrame:
    """The pieces of ``cut_pieces`` with sequence_id and offset."""
    pieces = cut_pieces(df, id_col, text_col, vocabulary, end_id, capacity, with_ids)
    pieces = through_table(numbered(pieces, "uid"), "pieces")
    todo = pieces.where(F.col("length") < capacity).select("uid", "length")
    placed = None
    for r in range(rounds):
        packed = through_table(breed(todo, capacity, shard_items, islands, epochs, r), "packed")
        full = (packed.groupBy("shard", "bin").agg(F.sum("length").alias("fill")))
        # a last round settles all bins; before it, bins with room for a median piece are opened again
        keep = full.where(F.col("fill") >= (capacity * 15) // 16) if r + 1 < rounds else full
        done = packed.join(keep.drop("fill"), ["shard", "bin"]).withColumn(
            "sequence_id", (F.col("shard") * F.lit(1 << 20) + F.col("bin")) * F.lit(rounds) + F.lit(r))
        done = done.select("uid", "length", "sequence_id")
        placed = done if placed is None else placed.unionByName(done)
        todo = packed.join(keep.select("shard", "bin"), ["shard", "bin"], "left_anti").select("uid", "length")
    in_order = Window.partitionBy("sequence_id").orderBy("uid").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("offset", F.coalesce(F.sum("length").over(in_order), F.lit(0)).cast("long"))
    out = pieces.join(placed.select(F.col("uid"), "sequence_id", "offset"), "uid", "left")
    return out.select(id_col, "piece", "start", "length", "ids_crc32",
                      F.coalesce("sequence_id", -1 - F.col("uid")).alias("sequence_id"),
                      F.coalesce("offset", F.lit(0)).cast("long").alias("offset"), *(["ids"] if with_ids else []))
