"""Language-model scores of documents by deleted interpolation.

The model mixes maximum-likelihood estimates of all orders with a uniform one:

    P(w | context) = sum over k of weight[bucket][k] * f_k + weight[bucket][0] / (V + 1)

f_k is the share of w among the training tokens that follow the last k - 1
tokens; where those never occur in training it is f_(k-1).  The bucket is the
power of two of the longest context's frequency.  The weights of a bucket are
learned by expectation-maximisation on held-out counts: the training documents
are halved by a hash of their text (copies stay together) and every token of
one half is predicted from the counts of the other half alone.

On Spark: documents are written as blocks of about ``block_bytes`` of text.  A
block asks for the counts of its distinct n-grams once, in one row for each
range of n-gram hashes, and says how often it holds them; a range adds up what
all blocks hold and answers each of them.  So a frequent n-gram costs a range
one entry a block, however often it occurs, and no range or block holds more
than its bounded share.  The answers meet their block, which keeps the counts
of its tokens and the table of its held-out estimates: how many held-out
tokens fall in each cell of bucket and estimates, in eighths of a power of two.
The added-up cells, whose number is bounded by that grid, are all that the
driver's expectation-maximisation sees.  A last pass over the blocks scores.

Tokens: words of the text, A-Z lower-cased, and one end token.  Words are told
apart by 64-bit hashes, longer n-grams by KEY_BITS bits inside their range: of
some millions of them about one takes another's counts.

Defined cases: a null or empty text is the end token alone; rows that repeat an
id are documents of their own; a null ``held_out`` counts as true; a text of
any length is one document (a block of its own if it is longer than one);
without training documents all estimates are the uniform one and the base
score is 0; an empty table has no scores; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import map_arrow, through_table
from tessera.llm.words import NOT_SPACE, U64, mix, words_of

END, START = U64(0x5D2C9E8B7A6F4E31), U64(0x1F83D9ABFB41BD6B)
_CHAIN = U64(0x9FB21C651E98DF25)
#: N-grams that one range of hashes is meant for.
RANGE_KEYS = 1 << 20
#: Context frequencies from 2^(BUCKETS - 2) on share the last bucket; bucket 0 holds unseen contexts.
BUCKETS = 26
#: Steps of a power of two in the cells of estimates.
STEPS = 8
#: Bits that tell n-grams of two tokens and more apart inside their range.
KEY_BITS = 42


def _zipped(data, level: int = 3) -> bytes:
    return zstandard.ZstdCompressor(level=level).compress(data)


def _unzipped(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def _texts(zipped: bytes, lengths: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
    return pa.Array.from_buffers(pa.large_string(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(_unzipped(zipped))])


def blocks_of(rows: DataFrame, block_bytes: int) -> DataFrame:
    """Rows (id, text, held_out, half) in blocks: arrays of all but the texts, which are one compressed value, and totals."""
    kind = rows.schema[0].dataType.simpleString()

    def block(parts: list[pa.RecordBatch], number: int) -> pa.RecordBatch:
        t = pa.Table.from_batches(parts).combine_chunks()
        ids, texts, held, half = (t.column(i).combine_chunks() for i in range(4))
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        lengths = pc.binary_length(texts).cast(pa.int32())
        _, at, data = texts.buffers()
        at = np.frombuffer(at, np.int64)[[texts.offset, texts.offset + len(texts)]]
        data = pa.array([_zipped(memoryview(data)[at[0]: at[1]] if data else b"", 9)], pa.binary())
        lists = [pa.ListArray.from_arrays(pa.array([0, len(t)], pa.int32()), c) for c in (ids, lengths, held, half)]
        train = ~held.to_numpy(zero_copy_only=False)
        docs = [int((train & (half.to_numpy() == h)).sum()) for h in (0, 1)]
        docs.append(len(t) + int(at[1] - at[0]))
        return pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()), data, *lists, *(pa.array([d], pa.int64()) for d in docs)],
            names=["block", "texts", "ids", "lengths", "held", "half", "docs0", "docs1", "bytes"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, parts, size = TaskContext.get().partitionId() << 32, [], 0
        for b in batches:
            at = 0
            for i, n in enumerate(pc.fill_null(pc.binary_length(b.column(1)), 0).to_pylist()):
                size += n + 1
                if size >= block_bytes:
                    yield block([*parts, b.slice(at, i + 1 - at)], number)
                    number, parts, size, at = number + 1, [], 0, i + 1
            if at < len(b):
                parts.append(b.slice(at))
        if parts:
            yield block(parts, number)

    return map_arrow(rows, run, f"block long, texts binary, ids array<{kind}>, lengths array<int>, held array<boolean>, "
                                "half array<int>, docs0 long, docs1 long, bytes long")


class Places:
    """Where each text's tokens begin in a block."""

    def __init__(self, sizes: np.ndarray):
        self.sizes = sizes.astype(np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def before(self, counts: np.ndarray, first: int) -> np.ndarray:
        """Each token's context count: the count at the token before, ``first`` where a text begins."""
        out = np.empty_like(counts)
        out[1:] = counts[:-1]
        out[self.starts] = first
        return out

    def per_text(self, values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values, self.starts)


class Tokens(Places):
    """The tokens of a block's texts, each text closed with the end token."""

    def __init__(self, texts: pa.Array):
        words, sizes = words_of(texts, NOT_SPACE)
        super().__init__(sizes + 1)
        ends = self.starts + sizes
        self.token = np.empty(int(self.sizes.sum()), np.uint64)
        word = np.ones(len(self.token), bool)
        word[ends] = False
        self.token[word], self.token[ends] = words, END

    def keys(self, k: int) -> np.ndarray:
        """Hash of the k-gram that ends at each token; START stands before a text."""
        chain = np.zeros(len(self.token), np.uint64)
        place = np.arange(len(self.token)) - np.repeat(self.starts, self.sizes)
        for back in range(k - 1, -1, -1):
            shifted = np.full(len(self.token), START)
            shifted[back:] = self.token[: len(self.token) - back]
            chain = chain * _CHAIN + (np.where(place >= back, shifted, START) if back else shifted)
        return mix(chain + U64(k))


def _planes(values: np.ndarray, wide: int) -> bytes:
    """The lowest ``wide`` bytes of unsigned integers, all first bytes first: high bytes are mostly equal and compress well."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :wide].T).tobytes()


def _packed(values: np.ndarray) -> bytes:
    """Unsigned integers in as few bytes each as the largest needs, compressed."""
    most = int(values.max()) if len(values) else 0
    wide = max(1, (most.bit_length() + 7) // 8)
    return bytes([wide]) + _zipped(_planes(values, wide))


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(_unzipped(data[1:]), np.uint8).reshape(data[0], -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, : data[0]] = planes.T
    return out.view("<u8").ravel()


def _short(keys: np.ndarray, k: int, bits: int) -> bytes:
    """The steps between sorted keys of one range: all bits of single tokens, KEY_BITS of longer n-grams."""
    low = keys << U64(bits)
    low = low >> U64(bits if k == 1 else 64 - KEY_BITS)
    return _packed(np.diff(low, prepend=U64(0)))


def _long(data: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(data), dtype=np.uint64)


def _ranges(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys >> U64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)


def questions(blocks: DataFrame, order: int, bits: int) -> DataFrame:
    """(k, range, block, keys, held0, held1): a block's distinct n-grams of one range and how often each half holds them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for number, texts, lengths, held, half in zip(*(b.column(c) for c in range(5))):
                tokens = Tokens(_texts(texts.as_py(), lengths.values.to_numpy()))
                train, half = ~held.values.to_numpy(zero_copy_only=False), half.values.to_numpy()
                for k in range(1, order + 1):
                    keys, place = np.unique(tokens.keys(k), return_inverse=True)
                    held_by = [np.bincount(place, np.repeat(train & (half == h), tokens.sizes), len(keys)).astype(np.int64)
                               for h in (0, 1)]
                    ranges = _ranges(keys, bits)
                    cuts = np.flatnonzero(np.diff(ranges, prepend=-1))
                    spans = list(zip(cuts, [*cuts[1:], len(keys)]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(spans), k, np.int32)), pa.array(ranges[cuts]),
                         pa.array([number.as_py()] * len(spans), pa.int64()),
                         pa.array([_short(keys[i:j], k, bits) for i, j in spans], pa.binary()),
                         *(pa.array([_packed(h[i:j]) for i, j in spans], pa.binary()) for h in held_by)],
                        names=["k", "range", "block", "keys", "held0", "held1"])

    return map_arrow(blocks.select("block", "texts", "lengths", "held", "half"), run,
                     "k int, range long, block long, keys binary, held0 binary, held1 binary")


_ANSWER = "k int, range long, block long, count0 binary, count1 binary, types long, mass0 long, mass1 long"


def answers(asked: DataFrame) -> DataFrame:
    """The counts of all blocks together for every asking block, and one row of totals a range (block below 0)."""

    def one(t: pa.Table) -> pa.Table:
        k, number = t["k"][0].as_py(), t["range"][0].as_py()
        keys = [_long(x.as_py()) for x in t["keys"]]
        ends = np.cumsum([len(x) for x in keys])
        found, place = np.unique(np.concatenate(keys), return_inverse=True)
        totals = [np.bincount(place, np.concatenate([_unpacked(x.as_py()) for x in t[c]]), len(found)).astype(np.int64)
                  for c in ("held0", "held1")]
        spans = list(zip([0, *ends[:-1]], ends))
        n = len(spans)
        out = [[_packed(c[place[i:j]]) for i, j in spans] + [None] for c in totals]
        sums = [int((totals[0] + totals[1] > 0).sum()), *(int(c.sum()) for c in totals)]
        return pa.table({"k": pa.array([k] * (n + 1), pa.int32()), "range": pa.array([number] * (n + 1), pa.int64()),
                         "block": pa.array([*t["block"].to_pylist(), -1 - number], pa.int64()),
                         "count0": pa.array(out[0], pa.binary()), "count1": pa.array(out[1], pa.binary()),
                         **{c: pa.array([None] * n + [s], pa.int64()) for c, s in zip(("types", "mass0", "mass1"), sums)}})

    return asked.groupBy("k", "range").applyInArrow(one, _ANSWER)


def bucket_of(context: np.ndarray) -> np.ndarray:
    """0 for an unseen context, else one more than the power of two of its frequency."""
    return np.where(context > 0, np.minimum(np.log2(np.maximum(context, 1)).astype(np.int64) + 1, BUCKETS - 1), 0)


#: An estimate in a cell: 0 undefined, 1 zero, else 2 - STEPS * log2 of the share (of a count: its own log2, no division).
_CODES = 1 << 10


def _code(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    share = np.rint(STEPS * (np.log2(np.maximum(whole, 1)) - np.log2(np.maximum(part, 1)))).astype(np.int64) + 2
    return np.where(whole > 0, np.where(part > 0, share, 1), 0)


def cells_of(tokens: Tokens, counts: list[np.ndarray], use: np.ndarray, docs: int, half: int) -> tuple[np.ndarray, np.ndarray]:
    """Cells of the tokens ``use`` by the counts of the other half, and how many tokens each holds."""
    contexts = [tokens.before(c, docs) for c in counts[:-1]]
    longest = contexts[-1] if contexts else np.full(len(use), docs, np.int64)
    cell = bucket_of(longest[use]) + BUCKETS * half
    for c, context in zip(counts[:0:-1], contexts[::-1]):
        cell = cell * _CODES + _code(c[use], context[use])
    one = counts[0][use]
    cell = cell * _CODES + np.where(one > 0, np.rint(STEPS * np.log2(np.maximum(one, 1))).astype(np.int64) + 2, 1)
    return np.unique(cell, return_counts=True)


def annotate(blocks: DataFrame, found: DataFrame, order: int, bits: int, docs: tuple[int, int], kind: str) -> DataFrame:
    """Blocks with the training counts of their tokens by order, and their held-out cells; totals are passed on."""

    def one(left: pa.Table, right: pa.Table) -> pa.Table:
        ids = left.schema.field("ids").type
        types = {"ids": ids, "held": pa.list_(pa.bool_()), "sizes": pa.list_(pa.int32()), "counts": pa.list_(pa.binary()),
                 "cells": pa.list_(pa.int64()), "weights": pa.list_(pa.int64()), "types": pa.int64(), "mass0": pa.int64(),
                 "mass1": pa.int64()}
        table = lambda rows: pa.table({n: pa.array([r.get(n) for r in rows], t) for n, t in types.items()})
        if not left.num_rows:  # totals of one range; those of single tokens count
            return table([r for r in right.to_pylist() if r["k"] == 1])
        tokens = Tokens(_texts(left["texts"][0].as_py(), left["lengths"].combine_chunks().flatten().to_numpy()))
        held, half = left["held"].combine_chunks().flatten(), left["half"].combine_chunks().flatten().to_numpy()
        right = right.sort_by([("k", "ascending"), ("range", "ascending")])
        of_order, by_half = right["k"].to_numpy(), ([], [])
        for k in range(1, order + 1):
            keys, place = np.unique(tokens.keys(k), return_inverse=True)
            rows = right.take(pa.array(np.flatnonzero(of_order == k)))
            for h, c in enumerate(("count0", "count1")):
                counts = np.concatenate([_unpacked(x.as_py()) for x in rows[c]])  # ranges and keys are in the same order
                by_half[h].append(counts.astype(np.int64)[place])
        train = ~held.to_numpy(zero_copy_only=False)
        found = [cells_of(tokens, by_half[1 - h], np.repeat(train & (half == h), tokens.sizes), docs[1 - h], h) for h in (0, 1)]
        return table([{"ids": left["ids"][0].values, "held": held, "sizes": tokens.sizes,
                       "counts": [_packed(a + b) for a, b in zip(*by_half)],
                       "cells": np.concatenate([c for c, _ in found]), "weights": np.concatenate([n for _, n in found])}])

    schema = (f"ids array<{kind}>, held array<boolean>, sizes array<int>, counts array<binary>, cells array<long>, "
              "weights array<long>, types long, mass0 long, mass1 long")
    return blocks.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(one, schema)


@dataclass
class Mixture:
    """The weights of each bucket (uniform first, then by order) and the training totals."""

    weights: np.ndarray
    types: int
    tokens: int
    docs: int

    @property
    def uniform(self) -> float:
        return 1 / (self.types + 1)

    def probabilities(self, places: Places, counts: list[np.ndarray]) -> np.ndarray:
        f = np.full(len(counts[0]), self.uniform)
        contexts = [np.full(len(f), self.tokens), *(places.before(c, self.docs) for c in counts[:-1])]
        mine = self.weights[bucket_of(contexts[-1] if len(counts) > 1 else np.full(len(f), self.docs))]
        p = mine[:, 0] * f
        for k, (c, context) in enumerate(zip(counts, contexts), 1):
            f = np.where(context > 0, c / np.maximum(context, 1), f)
            p += mine[:, k] * f
        return p


def learn_weights(cells: np.ndarray, n: np.ndarray, order: int, types: int, mass: tuple[int, int], rounds: int = 500,
                  close: float = 1e-9) -> np.ndarray:
    """Weights of every bucket by expectation-maximisation over held-out cells; each weight starts with one token."""
    codes = []
    for _ in range(order):
        codes.append(cells % _CODES)
        cells = cells // _CODES
    half, bucket = cells // BUCKETS, cells % BUCKETS
    f = [np.full(len(cells), 1 / (types + 1))]
    other = np.array(mass)[1 - half]
    f.append(np.where(other > 0, np.where(codes[0] > 1, 2.0 ** ((codes[0] - 2) / STEPS), 0) / np.maximum(other, 1), f[0]))
    for code in codes[1:]:
        f.append(np.where(code == 0, f[-1], np.where(code == 1, 0.0, 2.0 ** ((2 - code) / STEPS))))
    f = np.array(f).T
    out = np.full((BUCKETS, order + 1), 1 / (order + 1))
    for b in range(BUCKETS):
        mine, w = f[bucket == b], n[bucket == b].astype(float)
        if not len(w):  # no held-out token: the weights of the bucket below
            out[b] = out[b - 1] if b else out[b]
            continue
        weights, before = out[b].copy(), -math.inf
        for _ in range(rounds):
            parts = mine * weights
            total = parts.sum(axis=1)
            now = float(w @ np.log(total))
            weights = ((w / total) @ parts + 1) / (w.sum() + order + 1)
            if now - before <= close * abs(now):
                break
            before = now
        out[b] = weights
    return out


def score(df: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", order: int = 2,
          block_bytes: int = 8 << 20, add: float = 0.1) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score); ``held_out`` is a column of ``df``.

    The model learns from the other documents.  ``base_score`` is the sum of
    log10((c + add) / (N + add * (V + 1))).
    """
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.coalesce(held_out, F.lit(True)).alias("held"),
                     F.pmod(F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))), F.lit(2)).cast("int").alias("half"))
    kind = rows.schema["id"].dataType.simpleString()
    blocks = through_table(blocks_of(rows, block_bytes), "blocks")
    first = blocks.agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in ("bytes", "docs0", "docs1"))).first()
    bits = max(0, math.ceil(math.log2(first[0] / 4 / RANGE_KEYS))) if first[0] else 0
    docs = (first[1], first[2])
    found = answers(questions(blocks, order, bits))
    marked = through_table(annotate(blocks, found, order, bits, docs, kind), "marked")
    totals = marked.agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in ("types", "mass0", "mass1"))).first()
    cells = (marked.where("cells IS NOT NULL").select(F.explode(F.arrays_zip("cells", "weights")).alias("c"))
             .groupBy("c.cells").agg(F.sum("c.weights")).collect())
    cells = np.array(sorted(map(tuple, cells)), np.int64).reshape(-1, 2)
    weights = learn_weights(cells[:, 0], cells[:, 1], order, totals[0], (totals[1], totals[2]))
    model = Mixture(weights, totals[0], totals[1] + totals[2], docs[0] + docs[1])
    lowest = math.log10(model.tokens + add * (model.types + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for ids, held, sizes, counts in zip(*(b.column(i) for i in range(4))):
                places = Places(sizes.values.to_numpy())
                of = [_unpacked(c.as_py()).astype(np.int64) for c in counts]
                yield pa.RecordBatch.from_arrays(
                    [ids.values, held.values, pa.array(places.sizes),
                     pa.array(places.per_text((of[0] > 0).astype(np.int64))),
                     pa.array(np.full(len(places.sizes), model.tokens, np.int64)),
                     pa.array(places.per_text(np.log10(of[0] + add) - lowest)),
                     pa.array(places.per_text(np.log10(model.probabilities(places, of))))],
                    names=[id_col, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return map_arrow(marked.where("ids IS NOT NULL").select("ids", "held", "sizes", "counts"), run,
                     f"`{id_col}` {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
                     "score double")
