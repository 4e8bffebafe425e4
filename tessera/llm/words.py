"""Words of many texts at once: 64-bit word hashes over the bytes of an Arrow string column.

A word is a run of *word bytes* of the UTF-8 text; classes that name only
ASCII separators are exact on bytes.  The hash of a word is a polynomial of
per-byte random values (A-Z count as a-z), taken from running sums, so that no
Python code runs per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Bytes of one piece of the running sums.
PIECE = 1 << 18
#: Bytes of text that one step works on; a single longer text is a step of its own.
STEP = 2 << 20

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)
_BYTE[65:91] = _BYTE[97:123]
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 2**64)
_GRAM = U64(0xD6E8FEB86659FD93)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP, _DOWN = _powers(_BASE, PIECE + 1), _powers(_BACK, PIECE + 1)


def word_class(is_word) -> np.ndarray:
    return np.array([bool(is_word(b)) for b in range(256)])


#: `[^\x20\x09-\x0D]+`
NOT_SPACE = word_class(lambda b: not (b == 0x20 or 0x09 <= b <= 0x0D))
#: `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` of a text whose A-Z are lower-cased
ALNUM = word_class(lambda b: b >= 0x80 or chr(b).isalnum())


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _one_piece(data: np.ndarray, first: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and starts of the words in ``data``; ``first``: where a text begins."""
    n = len(data)
    inside = is_word[data]
    before = np.empty(n, dtype=bool)
    before[0] = False
    before[1:] = inside[:-1]
    before[first] = False
    starts = np.flatnonzero(inside & ~before)
    if not len(starts):
        return np.empty(0, np.uint64), starts
    after = np.empty(n, dtype=bool)
    after[-1] = False
    after[:-1] = inside[1:]
    cut = first[first > 0]
    after[cut - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    up, down = (_UP, _DOWN) if n <= PIECE else (_powers(_BASE, n + 1), _powers(_BACK, n + 1))
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_BYTE[data] * up[:n], out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * down[starts]
    return mix(hashes + (ends - starts).astype(np.uint64) * U64(0x2545F4914F6CDD1D)), starts


def words_of(texts: pa.Array, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, in order, and the number of words of each text (null: none)."""
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_string())
    if not len(texts):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    _, offsets, values = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset: texts.offset + len(texts) + 1]
    lo, hi = int(offsets[0]), int(offsets[-1])
    if lo == hi:
        return np.empty(0, np.uint64), np.zeros(len(texts), np.int64)
    data = np.frombuffer(values, np.uint8, hi - lo, lo)
    offsets = offsets - lo
    begins = offsets[:-1][offsets[:-1] < hi - lo]
    hashes, starts, at, n = [], [], 0, hi - lo
    while at < n:
        end = min(n, at + PIECE)
        while end < n and is_word[data[end]] and is_word[data[end - 1]]:  # a piece ends where no word goes on
            block = data[end: end + PIECE]
            gaps = np.flatnonzero(~is_word[block])
            end += int(gaps[0]) if len(gaps) else len(block)
        a, b = np.searchsorted(begins, (at, end))
        h, s = _one_piece(data[at:end], np.unique(begins[a:b]) - at, is_word)
        hashes.append(h)
        starts.append(s + at)
        at = end
    starts = np.concatenate(starts)
    return np.concatenate(hashes), np.diff(np.searchsorted(starts, offsets))


def steps(column: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """Cut a string column into (first row, slice) of about STEP bytes."""
    column = column.cast(pa.large_string())
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset: column.offset + len(column) + 1]
    at = 0
    while at < len(column):
        end = int(np.searchsorted(offsets, offsets[at] + STEP, "right")) - 1
        end = min(max(end, at + 1), len(column))
        yield at, column.slice(at, end - at)
        at = end


def grams(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each word on; the last k - 1 are missing."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = words[:n].copy()
    for j in range(1, k):
        out *= _GRAM
        out += words[j: n + j]
    return mix(out)
