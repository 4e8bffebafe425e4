import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from tessera.llm.bpe import needs_library
from tessera.llm.common import tokenizer_path
from tessera.llm.packing import (best_fit, crossover, cut_pieces, evolve, pack, pack_order, text_ids)
from tessera.llm.token_counts import count_tokens, counter, cut

ODD = ["", " ", "a", "\n\n  x", "don't  we'll 'tis ''s", "<|endoftext|>", "x<|endoftext|> y", "<|startoftext|>", "naïve café İstanbul",
       "日本語 テキスト", "한국어", "e\u0301 combining", "ﬁne ½ ²³ ª", "\x1c\x1d a\x85b\xa0c", "ÀÉÎ ǅ ß", "a" * 300, "1234567890 12,5", "🙂🙂 ok",
       "tab\tand\rcr", "Ω ω ς", "\u200bzero", "K ſ"]


@pytest.fixture(scope="module")
def library():
    return {n: Tokenizer.from_file(tokenizer_path(n)) for n in ("byte_bpe_50k.json", "word_bpe_49k.json")}


def _texts(words):
    rng = random.Random(5)
    latin = [chr(c) for c in range(0x250)] + list("  \n\n''sdmtre") * 30
    return ODD + ["".join(rng.choices(latin, k=rng.randint(0, 20))) for _ in range(4000)] + [
        " ".join(words(rng) for _ in range(200)) + ", " + words(rng).upper() + "." for _ in range(20)]


def test_counts_equal_the_library(library, words):
    c = counter("byte_bpe_50k.json")
    for t in _texts(words):
        assert c.count(t) == len(library["byte_bpe_50k.json"].encode(t, add_special_tokens=False).ids), repr(t)


def test_every_latin_character_alone_and_in_words(library):
    c, ids = counter("byte_bpe_50k.json"), text_ids("word_bpe_49k.json")
    for point in range(0x250):
        for t in (chr(point), f"a{chr(point)}b {chr(point)} {chr(point)}{chr(point)}1"):
            assert c.count(t) == len(library["byte_bpe_50k.json"].encode(t, add_special_tokens=False).ids), point
            assert list(np.frombuffer(ids.ids(t), "<u4")) == library["word_bpe_49k.json"].encode(t, add_special_tokens=False).ids, point


def test_whole_tokens_are_single_pre_tokens(library):
    c = counter("byte_bpe_50k.json")
    some = sorted(c.counts.whole)[::97]
    assert len(c.counts.whole) > 40_000
    for s in some:
        assert cut(s) == [s]
        assert len(library["byte_bpe_50k.json"].encode(s, add_special_tokens=False).ids) == 1


def test_other_scripts_take_the_shortcut(library):
    c, tok = counter("byte_bpe_50k.json"), library["byte_bpe_50k.json"]
    known = ["“Curly” – quotes… don’t", "Привет, мир! 123", "日本語 テキスト、です。", "한국어 문장", "مرحبا بالعالم ٣٤", "हिन्दी पाठ १२", "🙂🙂 ok\u2009x\u3000y",
             "Ω ω ς ǅ", "e\u0301 combining", "\u200bzero \u2028 line", "字" * 5000, "İstanbul ⅷ ①②"]
    for t in known:
        assert not c.by_library(t), t
        assert c.count(t) == len(tok.encode(t, add_special_tokens=False).ids), t
    for t in ("x <|endoftext|> 日本", "\U0003fc3f unassigned"):
        assert c.count(t) == len(tok.encode(t, add_special_tokens=False).ids), t
    assert c.by_library("x <|endoftext|> y")
    assert any("\u0400" <= ch <= "\u04ff" for s in c.counts.whole for ch in s)


def test_random_characters_of_all_planes(library):
    c, tok = counter("byte_bpe_50k.json"), library["byte_bpe_50k.json"]
    rng = random.Random(11)
    planes = [*range(0x20, 0xD800), *range(0xE000, 0x11000), *range(0x1F000, 0x20000), *range(0x3FC00, 0x3FD00)]
    texts = ["".join(rng.choice((chr(rng.choice(planes)), chr(rng.randint(0x370, 0x700)), rng.choice("a1 '\n\u3000")))
                     for _ in range(rng.randint(1, 30))) for _ in range(5000)]
    cut_here = 0
    for t, e in zip(texts, tok.encode_batch(texts, add_special_tokens=False)):
        assert c.count(t) == len(e.ids), repr(t)
        cut_here += not c.by_library(t)
    assert cut_here > 2000


def test_word_ids_equal_the_library(library, words):
    ids = text_ids("word_bpe_49k.json")
    for t in _texts(words):
        assert list(np.frombuffer(ids.ids(t), "<u4")) == library["word_bpe_49k.json"].encode(t, add_special_tokens=False).ids, repr(t)


def test_special_strings_go_to_the_library():
    assert needs_library("a <|endoftext|>") and needs_library("日本") and not needs_library("Größe, naïve")


def test_count_query_rows(spark, library):
    rows = [(1, "Hello world", 9), (2, None, 9), (3, "", 9), (1, "Hello world", 9), (None, "x " * 3000, 9), (4, "é" * 5, 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens long")
    got = sorted(map(tuple, count_tokens(df).collect()), key=str)
    tok = library["byte_bpe_50k.json"]
    want = sorted([(i, len((t or "").encode()), n := len(tok.encode(t or "", add_special_tokens=False).ids), n > 1024)
                   for i, t, _ in rows], key=str)
    assert got == want
    assert count_tokens(df.limit(0)).count() == 0


def test_evolved_packings_are_whole():
    rng = random.Random(3)
    size = [rng.randint(1, 90) for _ in range(300)]
    best = evolve(size, 100, 1, [])
    assert sorted(x for b in best for x in b) == list(range(300))
    assert all(sum(size[x] for x in b) <= 100 for b in best)
    plain = pack_order(sorted(range(300), key=lambda x: -size[x]), size, 100)
    assert -(-sum(size) // 100) <= len(best) <= len(plain)
    child = crossover(plain, pack_order(list(range(300)), size, 100), size, 100, rng)
    assert sorted(x for b in child for x in b) == list(range(300))
    assert all(sum(size[x] for x in b) <= 100 for b in child)


def test_an_epoch_ends_at_the_lower_bound(monkeypatch):
    from tessera.llm import packing

    size = [50, 50, 30, 70, 20, 80]
    at_bound = [[0, 1], [2, 3], [4, 5]]
    monkeypatch.setattr(packing, "crossover", None)  # neither breeds nor builds more parents
    monkeypatch.setattr(packing, "pack_order", lambda *a: at_bound)
    assert evolve(size, 100, 1, [at_bound]) == at_bound
    assert evolve(size, 100, 1, []) == at_bound


def test_whole_words_stay_when_the_cache_starts_anew(library, words, monkeypatch):
    from tessera.llm import packing

    rng = random.Random(9)
    ids = packing.TextIds("word_bpe_49k.json")
    whole = len(ids.of.whole)
    assert whole > 20_000 and all(len(v) == 4 for v in ids.of.whole.values())
    monkeypatch.setattr(packing, "CACHE_ENTRIES", whole + 50)
    for _ in range(40):
        t = " ".join(words(rng) + words(rng) for _ in range(20))
        assert list(np.frombuffer(ids.ids(t), "<u4")) == library["word_bpe_49k.json"].encode(t, add_special_tokens=False).ids
        assert whole <= len(ids.of) <= whole + 52


def test_best_fit_takes_the_fullest_bin_with_room():
    bins = [[0], [1]]
    best_fit([(40, 0), (60, 1)], bins, [2], [60, 40, 35], 100)
    assert bins == [[0, 2], [1]]


def _check_packing(rows, texts, tok, capacity):
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, []).append(r)
    for i, text in texts.items():
        ids = tok.encode(text or "", add_special_tokens=False).ids + [1]
        got = [(r.piece, r.start, r.length, r.ids_crc32) for r in sorted(by_id[i], key=lambda r: r.piece)]
        assert got == [(p, p * capacity, len(x := ids[p * capacity:(p + 1) * capacity]), zlib.crc32(np.array(x, "<u4").tobytes()))
                       for p in range(-(-len(ids) // capacity))]
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_packing_rounds(spark, saved, library, words):
    rng = random.Random(8)
    texts = {i: " ".join(words(rng) for _ in range(rng.randint(0, 60))) for i in range(400)}
    texts |= {400: None, 401: "", 402: "long words " * 800}
    df = saved([(i, t, "x") for i, t in texts.items()], "doc_id long, text string, uid string")
    rows = pack(df, capacity=256, shard_items=100, islands=2).collect()
    bins = _check_packing(rows, texts, library["word_bpe_49k.json"], 256)
    least = -(-sum(r.length for r in rows) // 256)
    assert bins <= least * 1.05 + 2
    twice = pack(df.select("doc_id", "text").union(df.select("doc_id", "text")), capacity=256, shard_items=100, islands=2)
    assert twice.count() == 2 * len(rows)
    assert pack(df.limit(0)).count() == 0
    assert [len(r.ids) for r in cut_pieces(df, capacity=256, with_ids=True).where("piece = 0").take(3)]
