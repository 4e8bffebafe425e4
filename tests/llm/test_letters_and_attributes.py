"""Texts without letters, samples that do not depend on the files, attributes with stray quotes, deep pages."""

from __future__ import annotations

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm.html_text import _attributes, _TOKEN, main_text
from tessera.llm.language_id import add_language, fit, trigrams


@pytest.mark.parametrize("text", [None, "", " \n", "½ ²", "Ⅷ ①", "12 + 3_4", "٣", "①" * 50])
def test_texts_without_letters(text):
    assert trigrams(text) is None


@pytest.mark.parametrize("text", ["a", "½ b", "日本", "ª", "é"])
def test_texts_with_letters(text):
    assert trigrams(text) is not None


def test_the_sample_does_not_depend_on_the_files(spark, words):
    rng = random.Random(11)
    rows = [(i, " ".join(words(rng) for _ in range(rng.randint(3, 40))), lang) for i in range(400) for lang in ("xx", "yy")]
    rows += [(1000 + i, rows[0][1], "xx") for i in range(500)]  # one text is a third of all rows
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("hash", F.lit(1)).withColumn("n", F.lit("x"))
    models = [fit(df.repartition(n), per_language=100) for n in (1, 3, 7)]
    for m in models[1:]:
        assert m.languages == models[0].languages and np.array_equal(m.centroids, models[0].centroids)
        assert np.array_equal(m.idf, models[0].idf) and np.array_equal(m.limits, models[0].limits)
    found = add_language(df.select("doc_id", "text", "hash"), models[0])
    assert found.columns == ["doc_id", "text", "hash", "lang_pred", "score", "rejected"] and found.count() == len(rows)


def test_a_quote_opens_a_string_only_after_an_equals_sign():
    page = "<article><p data-x=it's>one two three</p><p>don't stop</p><p>last para</p></article>"
    assert main_text(page) == "one two three\ndon't stop\nlast para"
    assert main_text('<article><p title="a > b" x = \'c > d\'>one</p><p 5" wide>two</p><p a=>three</p></article>') == "one\ntwo\nthree"
    assert main_text('<article><p title="never closed>one</p><p>two</p></article>') == "one\ntwo"
    m = _TOKEN.match("<div class=it's id = \"a'b\" hidden>")
    assert m.end() == len(m[0]) and _attributes("div", m[3]) == {"class": "it's", "id": "a'b", "hidden": ""}


@pytest.mark.parametrize("tag", ["div", "span", "blockquote", "div class='ad x'", "li", "article"])
def test_deep_pages_take_linear_time(tag):
    name = tag.split()[0]
    body = f"<{tag}>" * 20_000 + "<p>some words of the article</p>" + f"</{name}>" * 20_000 + "</b>" * 5_000
    began = time.process_time()
    main_text(f"<html><body>{body}</body></html>")
    assert time.process_time() - began < 8


def _attributes_by_state(text):
    """The attributes of a start tag's inside, character by character."""
    out, i, n = [], 0, len(text)
    while i < n:
        while i < n and (text[i].isspace() or text[i] in "/\"'<>="):
            i += 1
        start = i
        while i < n and not text[i].isspace() and text[i] not in "/>=":
            i += 1
        name, value = text[start:i], ""
        j = i
        while j < n and text[j].isspace():
            j += 1
        if name and j < n and text[j] == "=":
            i = j + 1
            while i < n and text[i].isspace():
                i += 1
            if i < n and text[i] in "\"'" and text[i] in text[i + 1:]:
                end = text.index(text[i], i + 1)
                value, i = text[i + 1: end], end + 1
            else:
                start = i
                while i < n and not text[i].isspace() and text[i] != ">":
                    i += 1
                value = text[start:i]
        if name:
            out.append((name, value))
    return out


def test_attributes_against_a_character_machine():
    rng = random.Random(12)
    read = {"class", "id", "role", "hidden", "aria-hidden"}
    for _ in range(3000):
        text = " " + "".join(rng.choice(["class", "id", "hidden", "role", "x", "=", "=", " ", " ", '"', "'", "ad", "b", "/"]) for _ in range(rng.randint(0, 14)))
        want: dict[str, str] = {}
        for name, value in _attributes_by_state(text):
            if name in read:
                want.setdefault(name, value)
        assert _attributes("div", text) == want, text
