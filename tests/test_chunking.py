"""Chunker properties (TXT-05/06/07/14): chunks rebuild the text, respect
the size whenever a separator allows it, and overlap as asked."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.operators.text import _token_len, split_text

TEXT = st.text(alphabet=st.sampled_from(list("ab c\n\n.")), min_size=0, max_size=400)


@given(TEXT, st.integers(5, 60), st.integers(0, 10))
@settings(max_examples=300, deadline=None)
def test_chunks_cover_text(text, size, overlap):
    chunks = split_text(text, size, overlap)
    if not text:
        assert chunks == []
        return
    assert chunks[0][0] == 0 and chunks[-1][1] == len(text)
    for (s1, e1, c1), (s2, e2, c2) in zip(chunks, chunks[1:]):
        assert s2 <= e1, "gap between chunks"
        assert s2 > s1, "no progress"
    for s, e, c in chunks:
        assert c == text[s:e]
        assert len(c) <= size


def test_no_separator_longer_than_size():
    text = "x" * 95
    chunks = split_text(text, 10, 0)
    assert [len(c) for _, _, c in chunks] == [10] * 9 + [5]


def test_overlap_carries_trailing_pieces():
    text = "one two three four five six seven"
    chunks = split_text(text, 14, 6)
    assert all(len(c) <= 14 for _, _, c in chunks)
    assert any(b[0] < a[1] for a, b in zip(chunks, chunks[1:]))


def test_token_counter():
    chunks = split_text("a b c d e f g h", 3, 1, length=_token_len)
    assert all(_token_len(c) <= 3 for _, _, c in chunks)


def test_chunk_audit_on_documents(spark, sf):
    from tessera.operators.text import chunk_audit, chunk_recursive
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    audit = chunk_audit(chunk_recursive(docs, "doc_id", "text", 300, 40), docs, "doc_id", "text")
    bad = audit.filter(~F.col("covered") & (F.col("length") > 0)).count()
    assert bad == 0


def test_html_sections_and_main_text(spark):
    from tessera.operators.text import chunk_html, main_text
    html = ("<html><head><title>t</title><script>var x=1;</script></head><body><nav>menu</nav>"
            "<h1>Top</h1><p>intro</p><h2>Sub</h2><p>body <b>bold</b></p><article>main words</article>"
            "<h1>Next</h1><p>tail</p></body></html>")
    df = spark.createDataFrame([(1, html)], "page_id long, html string")
    secs = chunk_html(df, "page_id", "html").orderBy("section_no").collect()
    assert [(r.h1, r.h2, r.text) for r in secs] == [("Top", None, "intro"), ("Top", "Sub", "body bold main words"),
                                                    ("Next", None, "tail")]
    assert main_text(df, "page_id", "html").first().main_text == "main words"


def test_thread_lines_rebuild_the_thread(spark):
    from tessera.operators.text import threads
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"msg {t}" * (t + 1)) for t in range(7)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    lines = threads(df, "conv_id", "turn", "role", "text", turns_per_chunk=3).orderBy("char_offset").collect()
    full = "\n".join(f"{r} : {x}".replace(" : ", ": ") for _, _, r, x in rows)
    assert "\n".join(l.line for l in lines) == full
    assert [l.char_offset for l in lines] == [full.index(l.line) if i == 0 else sum(len(x.line) + 1 for x in lines[:i])
                                              for i, l in enumerate(lines)]
