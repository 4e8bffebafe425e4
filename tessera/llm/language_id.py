"""Language identification by nearest centroids.

A text's vector counts the trigrams of its UTF-8 bytes (letters lower-cased,
every run of other characters one space), hashed to ``DIMENSIONS`` places,
dampened by a logarithm, weighted by inverse document frequency and
normalised.  Each language has several centroids, found by spherical k-means
over its training texts, and a text gets the language of the centroid with the
greatest cosine.  A text is rejected when its distance to that centroid is
beyond what training texts of a similar length reach (``LIMIT_SHARE`` of their
least cosine, by powers of two of the length), or when it has no letter.

The model is fitted on about ``per_language`` rows of each language (a
documented bound on the sample, drawn by a hash of the text over the whole
table, each text once, so that it does not depend on how the files are cut);
its size is DIMENSIONS times the centroids.  Whole texts are read, in training
and in prediction.

Defined cases: a null text or one without a letter is ``und`` with score 0 and
rejected; equal cosines go to the first centroid, in the order of the languages;
a text of any length is read whole, in steps; with no training rows everything is ``und``; rows that repeat an id
each get a row; null languages are not learned; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import map_arrow

DIMENSIONS = 1 << 13
LENGTH_CLASSES = 24
LIMIT_SHARE = 0.6
UNKNOWN = "und"
_GAP = re.compile(r"[\W\d_]+")
#: Characters of one counting step.
_STEP = 1 << 20


def trigrams(text: str | None) -> tuple[np.ndarray, np.ndarray, int] | None:
    """(places, counts, number of trigrams) of a text, or None without a letter."""
    if not text:
        return None
    sums, total = np.zeros(DIMENSIONS, np.int64), 0
    at = 0
    while at < len(text):  # cut where a gap is, so that every word is whole
        end = at + _STEP
        if end < len(text):
            gap = _GAP.search(text, end)
            end = gap.end() if gap else len(text)
        words = _GAP.sub(" ", text[at:end].lower()).strip()
        at = end
        if not any(map(str.isalpha, words)):  # numerals such as a half or a circled one are no letters
            continue
        b = np.frombuffer(f" {words} ".encode(), np.uint8).astype(np.uint32)
        place = (b[:-2] * np.uint32(0x9E3779B1) + b[1:-1] * np.uint32(0x85EBCA6B) + b[2:] * np.uint32(0xC2B2AE35))
        place ^= place >> np.uint32(15)
        place *= np.uint32(0x2C1B3C6D)
        sums += np.bincount(place >> np.uint32(32 - 13), minlength=DIMENSIONS)
        total += len(place)
    if not total:
        return None
    places = np.flatnonzero(sums)
    return places, sums[places], total


def _vectors(sparse: list[tuple[np.ndarray, np.ndarray]], idf: np.ndarray) -> np.ndarray:
    out = np.zeros((len(sparse), DIMENSIONS), np.float32)
    for row, (places, counts) in zip(out, sparse):
        row[places] = (1.0 + np.log(counts)) * idf[places]
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)


def length_class(n: int) -> int:
    return min(int(n).bit_length(), LENGTH_CLASSES - 1)


def cluster(x: np.ndarray, k: int, seed: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means: unit centroids of the rows of x."""
    rng = np.random.default_rng(seed)
    centers = [x[rng.integers(len(x))]]
    while len(centers) < min(k, len(x)):  # the farthest text becomes the next centre
        centers.append(x[int(np.argmin(np.max(x @ np.array(centers).T, axis=1)))])
    c = np.array(centers)
    for _ in range(rounds):
        nearest = np.argmax(x @ c.T, axis=1)
        sums = np.array([x[nearest == i].sum(axis=0) if (nearest == i).any() else c[i] for i in range(len(c))])
        c = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return c.astype(np.float32)


@dataclass
class LanguageModel:
    languages: list[str]      # of each centroid
    centroids: np.ndarray
    idf: np.ndarray
    limits: np.ndarray        # least cosine by length class

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        """(language, score, rejected) of each text."""
        out: list[tuple[str, float, bool]] = [(UNKNOWN, 0.0, True)] * len(texts)
        grams = [(i, g) for i, g in enumerate(map(trigrams, texts)) if g is not None]
        if not len(self.languages):
            return out
        for at in range(0, len(grams), 256):
            part = grams[at: at + 256]
            cos = _vectors([g[:2] for _, g in part], self.idf) @ self.centroids.T
            best = np.argmax(cos, axis=1)
            for (i, g), j, row in zip(part, best, cos):
                score = float(min(max(row[j], 0.0), 1.0))
                out[i] = (self.languages[j], score, score < self.limits[length_class(g[2])])
        return out


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", per_language: int = 400,
        clusters: int = 4, seed: int = 17) -> LanguageModel:
    """A model of the rows with a language and a letter; about ``per_language`` rows of each language are read."""
    rows = labelled.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), F.xxhash64(text_col).alias("hash"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    texts = rows.groupBy("lang").agg(F.approx_count_distinct("hash").alias("n"))
    sizes = {r.lang: max(r.n, 1) for r in texts.collect()}  # one row per language
    share = F.lit(0.0)
    for lang, n in sizes.items():
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, per_language / n))).otherwise(share)
    drawn = rows.where(F.pmod("hash", F.lit(1 << 30)) < share * (1 << 30)).dropDuplicates(["lang", "hash"])
    drawn = drawn.select("lang", "text", "hash")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [(lang, g, h) for lang, g, h in zip(b.column(0).to_pylist(), (trigrams(x.as_py()) for x in b.column(1)),
                                                        b.column(2).to_pylist()) if g]
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[0] for f in found], pa.string()), pa.array([f[1][0].astype(np.int32) for f in found], pa.list_(pa.int32())),
                 pa.array([f[1][1] for f in found], pa.list_(pa.int64())), pa.array([f[1][2] for f in found], pa.int64()),
                 pa.array([f[2] for f in found], pa.int64())],
                names=["lang", "places", "counts", "n", "hash"])

    sample = map_arrow(drawn, count, "lang string, places array<int>, counts array<long>, n long, hash long").toPandas()
    sample = sample.sort_values(["lang", "n", "hash"])
    vectors_of = [(np.asarray(p), np.asarray(c)) for p, c in zip(sample["places"], sample["counts"])]
    df = np.zeros(DIMENSIONS)
    for places, _ in vectors_of:
        df[places] += 1
    idf = (np.log((1 + len(sample)) / (1 + df)) + 1).astype(np.float32)
    languages, centroids = [], []
    lows = np.full(LENGTH_CLASSES, np.inf)
    langs = sample["lang"].to_numpy()
    for lang in sorted(sizes):
        own = np.flatnonzero(langs == lang)
        if not len(own):
            continue
        x = _vectors([vectors_of[i] for i in own], idf)
        c = cluster(x, clusters, seed)
        centroids.append(c)
        languages += [lang] * len(c)
        for cos, n in zip(np.max(x @ c.T, axis=1), sample["n"].to_numpy()[own]):
            lows[length_class(n)] = min(lows[length_class(n)], cos)
    # shorter texts are farther away: a class's limit is never above that of a longer one, nor above a short class's share
    limits, least = np.zeros(LENGTH_CLASSES), np.inf
    for i in range(LENGTH_CLASSES - 1, -1, -1):
        least = min(least, lows[i])
        known = np.isfinite(lows[: i + 1]).any()
        limits[i] = LIMIT_SHARE * least if known and np.isfinite(least) else 0.0
    return LanguageModel(languages, np.concatenate(centroids) if centroids else np.zeros((0, DIMENSIONS), np.float32), idf, limits)


def add_language(df: DataFrame, model: LanguageModel, text_col: str = "text",
                 names: tuple[str, str, str] = ("lang_pred", "score", "rejected")) -> DataFrame:
    """``df`` with the prediction in three new columns, which it must not have."""
    held = df.sparkSession.sparkContext.broadcast(model)
    at = df.columns.index(text_col)
    columns = [*df.columns, *names]

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found: list[tuple[str, float, bool]] = []
            for start in range(0, len(b), 256):
                found += held.value.predict([x.as_py() for x in b.column(at).slice(start, 256)])
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()),
                 pa.array([f[2] for f in found], pa.bool_())], names=columns)

    schema = df.select("*", F.lit("").alias(names[0]), F.lit(0.0).alias(names[1]), F.lit(True).alias(names[2])).schema
    return map_arrow(df, predict, schema)


def held_out(id_col: str):
    """crc32 of the id as text, modulo 3, is 1; a null id is not held out."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))
