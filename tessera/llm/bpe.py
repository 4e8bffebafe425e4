"""Merging of single pre-tokens by the ranks of a BPE vocabulary file.

The vocabulary file is the ``.json`` of the ``tokenizers`` library; nothing is
trained.  ``Merger`` reads its merge list once per worker process and merges
one pre-token at a time with ``tiktoken``, which is several times faster than
a call of ``tokenizers`` and gives the same ids (the tests compare the two on
every printable Latin character, on the corpus and on generated strings).
``needs_library`` names the texts for which the caller must use ``tokenizers``
itself: texts with the opening of a special token, or with a character beyond
Latin, where normalisation and character classes are left to the library.
"""

from __future__ import annotations

import json
import os
import re

from tessera.llm.common import tokenizer_path

#: Character classes below U+0180, as the pre-tokenizers use them.
LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ſ"
NUMBERS = "0-9²³¹¼-¾"
SPACES = "\\t\\n\\x0b\\x0c\\r \u0085 "
#: Beyond Latin, and the one Latin letter whose lower case is two characters.
_OTHER = re.compile("[^\\x00-įı-ſ]")
#: More than this many cached pre-tokens and the cache starts anew, so that a worker's memory is bounded.
CACHE_ENTRIES = 150_000


def needs_library(text: str) -> bool:
    return "<|" in text or _OTHER.search(text) is not None


def byte_of_char() -> dict[str, int]:
    """Byte-level alphabet: printable Latin-1 stands for itself, other bytes for U+0100 onward."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {chr(b): b for b in own}
    for n, b in enumerate(x for x in range(256) if x not in set(own)):
        table[chr(256 + n)] = b
    return table


class Merger:
    """ids(piece): the ids of one pre-token (bytes of its UTF-8)."""

    def __init__(self, path: str):
        import tiktoken

        with open(tokenizer_path(path), encoding="utf-8") as f:
            model = json.load(f)["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        # 0xFF is no byte of any UTF-8 text: it stands for the end of a word
        self.end = b"\xff" if self.suffix else b""
        to_byte = byte_of_char()

        def raw(token: str) -> bytes:
            end = bool(self.suffix) and token.endswith(self.suffix)
            body = token[: -len(self.suffix)] if end else token
            return bytes(to_byte[c] for c in body) + (self.end if end else b"")

        ranks = {bytes([b]): b for b in range(256)}
        if self.end:  # the last byte of a word takes its end mark before any other merge
            for b in range(255):
                ranks[bytes([b]) + self.end] = len(ranks)
        for pair in model["merges"]:
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            ranks.setdefault(raw(left) + raw(right), len(ranks))
        self.id_of = [-1] * len(ranks)
        for token, i in model["vocab"].items():
            if all(c in to_byte for c in (token[: -len(self.suffix)] if self.suffix and token.endswith(self.suffix) else token)):
                r = ranks.get(raw(token))
                if r is not None:
                    self.id_of[r] = i
        self._core = tiktoken.Encoding("merges", pat_str=r"[\s\S]+", mergeable_ranks=ranks,
                                       special_tokens={})._core_bpe
        self.vocab = model["vocab"]
        self.raw = raw

    def ids(self, piece: str) -> list[int]:
        of = self.id_of
        return [of[r] for r in self._core.encode_single_piece(piece.encode() + self.end)]

    def count(self, piece: str) -> int:
        return len(self._core.encode_single_piece(piece.encode()))


def library_tokenizer(path: str):
    """The ``tokenizers`` object itself, with one thread per worker."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path(path))
    tok.no_truncation()
    tok.no_padding()
    return tok
