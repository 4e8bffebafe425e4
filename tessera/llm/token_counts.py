"""Token counts by the whole-token shortcut.

Offline (once per worker, from the vocabulary file alone) every vocabulary
string that is exactly one pre-token and that merges to exactly one token is
proved to be a *whole token*.  Counting then cuts a text into pre-tokens; a
pre-token that is a whole token counts one without merging, only the rest is
merged.  Latin texts are cut by fixed character classes, other texts by Unicode
classes; a worker proves the class of each character beyond Latin that it meets,
once, against the library's own cut.  Only texts with special strings, or with a
character whose class the library holds otherwise (code points that one of the
two Unicode versions does not know yet), go to the library as a whole.

Defined cases: a null text counts as empty (0 bytes, 0 tokens); repeated rows
each get their row; lone surrogates cannot occur in a Parquet string.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tessera.llm.bpe import CACHE_ENTRIES, LETTERS, NUMBERS, SPACES, Merger, library_tokenizer, needs_library
from tessera.llm.common import map_arrow

#: Byte-level pre-tokens of a Latin text.
PRE_TOKENS = re.compile(
    f"'(?:s|t|re|ve|m|ll|d)| ?[{LETTERS}]+| ?[{NUMBERS}]+| ?[^{SPACES}{LETTERS}{NUMBERS}]+"
    f"|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+")
#: The same for any text.
WIDE_PRE_TOKENS = regex.compile(
    r"'(?:s|t|re|ve|m|ll|d)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")

VOCABULARY = "byte_bpe_50k.json"


def cut(text: str) -> list[str]:
    """The pre-tokens of a text without special strings."""
    return (WIDE_PRE_TOKENS if needs_library(text) else PRE_TOKENS).findall(text)


def prove_whole_tokens(merger: Merger) -> set[str]:
    """The vocabulary strings that are one pre-token and encode alone as one token."""
    whole = set()
    for token in merger.vocab:
        try:
            s = merger.raw(token).decode("utf-8")
        except (KeyError, UnicodeDecodeError):
            continue
        if s and "<|" not in s and cut(s) == [s] and merger.count(s) == 1:
            whole.add(s)
    return whole


class _Counts(dict):
    """Pre-token -> token count; starts with the whole tokens, merges what is missing."""

    def __init__(self, merger: Merger):
        super().__init__(dict.fromkeys(prove_whole_tokens(merger), 1))
        self.merger, self.whole = merger, dict(self)

    def __missing__(self, piece: str) -> int:
        n = self.merger.count(piece)
        if len(self) > CACHE_ENTRIES:
            self.clear()
            self.update(self.whole)
        if len(piece) <= 64:
            self[piece] = n
        return n


class _Agreed(dict):
    """Character -> whether both cuts give it the same class; at most one entry a code point."""

    def __init__(self, library):
        super().__init__()
        self.library = library.pre_tokenizer

    def __missing__(self, char: str) -> bool:
        probe = f"a{char}1{char}!{char} {char}"
        theirs = [probe[a:z] for _, (a, z) in self.library.pre_tokenize_str(probe)]
        self[char] = theirs == WIDE_PRE_TOKENS.findall(probe)
        return self[char]


class TokenCounter:
    def __init__(self, path: str = VOCABULARY):
        self.library = library_tokenizer(path)
        self.counts = _Counts(Merger(path))
        self.agreed = _Agreed(self.library)

    def by_library(self, text: str) -> bool:
        """Whether the text goes to the library whole."""
        return needs_library(text) and ("<|" in text or not all(map(self.agreed.__getitem__, set(text))))

    def count(self, text: str) -> int:
        if self.by_library(text):
            return len(self.library.encode_batch_fast([text], add_special_tokens=False)[0])
        return sum(map(self.counts.__getitem__, cut(text)))


@lru_cache(maxsize=2)
def counter(path: str) -> TokenCounter:
    return TokenCounter(path)


def count_tokens(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 vocabulary: str = VOCABULARY, limit: int = 1024) -> DataFrame:
    """Per row: ``id_col``, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > ``limit``)."""
    rows = df.select(id_col, text_col)
    id_type = rows.schema[0].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(vocabulary)
        for b in batches:
            sizes, tokens = [], []
            for x in b.column(1):
                t = x.as_py() or ""
                sizes.append(len(t) if t.isascii() else len(t.encode()))
                tokens.append(c.count(t))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64()),
                 pa.array([n > limit for n in tokens], pa.bool_())],
                names=[id_col, "n_bytes", "n_tokens", "over_limit"])

    return map_arrow(rows, count, f"`{id_col}` {id_type}, n_bytes long, n_tokens long, over_limit boolean")
