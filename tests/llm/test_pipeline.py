import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402
from test_text_operators import _components, _hits_by_hand, _lines_by_hand  # noqa: E402

from tessera.llm.common import table, through_table  # noqa: E402
from tessera.llm.queries import ORACLES, QUERIES  # noqa: E402


def test_stages_against_brute_force(spark, sf):
    docs = table(spark, sf, "documents")
    bench = [tuple(r) for r in table(spark, sf, "benchmark").select("item_id", "text").collect()]
    states = [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        docs = through_table(stage(spark, docs, sf), name)
        states.append(docs.collect())
        if name != "packing":
            assert docs.columns == table(spark, sf, "documents").columns
    start, spoken, lines, near, clean, packed = [[(r["doc_id"], r["text"]) if "text" in r.asDict() else r for r in s] for s in states]
    assert set(spoken) <= set(start) and len(spoken) >= 0.98 * len(start)
    by_hand = [(i, t) for i, t, _, _ in _lines_by_hand(spoken)]
    assert sorted(lines) == sorted(by_hand)
    assert all(r.n_chars == len(r.text) for r in states[2])
    _, group = _components(lines, 5, 80)
    assert sorted(i for i, _ in near) == sorted({g: min(i for (i, _), h in zip(lines, group) if h == g) for g in set(group)}.values())
    assert sorted(clean) == sorted((i, t) for i, t in near if not _hits_by_hand(t, bench)[1])
    assert {r.doc_id for r in packed} == {i for i, _ in clean}


def test_empty_documents(spark, sf):
    docs = through_table(table(spark, sf, "documents").limit(0), "none")
    for name, stage in corpus_pipeline.STAGES:
        docs = through_table(stage(spark, docs, sf), name)
        assert docs.count() == 0


def test_every_operator_has_its_query():
    assert {q.split("_")[0] for q in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(ORACLES) <= set(QUERIES)


def test_oracles(spark, sf, duck):
    for name in ("op1_exact_topk", "op4_license_scan", "op7_decontamination", "op8_line_dedup", "op12_hard_negatives"):
        got = QUERIES[name](spark, sf).toPandas()
        want = duck.sql(ORACLES[name]).df()
        cols = sorted(got.columns)
        assert cols == sorted(want.columns)
        assert (sorted(map(str, got[cols].itertuples(index=False, name=None)))
                == sorted(map(str, want[cols].itertuples(index=False, name=None)))), name


def test_odd_documents_pass_every_stage(spark, sf, tmp_path, words):
    """Nulls in any column, repeated rows, very long texts and columns named like the operators' own."""
    import random

    rng = random.Random(11)
    say = lambda n: " ".join(words(rng) for _ in range(n))
    long = say(40_000)
    line = say(8)
    rows = [(i, f"{line}\n{say(60)}", "en" if i % 2 else "fr", "s", 1) for i in range(60)]
    rows += [(None, say(50), "en", None, None), (100, None, "en", "s", 1), (101, "", None, None, 0), (102, say(40), None, "s", None),
             (103, long, "en", "s", 5), (104, long, "fr", "s", 5), rows[3], rows[3], (None, None, None, None, None), (105, "1234 !!", "en", "s", 7)]
    extra = [(*r, "u", 1.5, None, "r", 7, True) for r in rows]
    schema = ("doc_id long, text string, lang string, source string, n_chars long, uid string, score double, h string, row string, "
              "n_lines long, rejected boolean")
    spark.createDataFrame(extra, schema).repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, rows[7][1]), (None, "x"), (2, None), (1, rows[7][1])], "item_id long, text string") \
        .write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = table(spark, str(tmp_path), "documents")
    columns, counts = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        docs = through_table(stage(spark, docs, str(tmp_path)), name)
        counts.append(docs.count())
        if name != "packing":
            assert docs.columns == columns
            if name == "near_duplicates":
                ids = [r.doc_id for r in docs.select("doc_id").collect()]
                assert ids.count(3) == 1 and ids.count(103) == 1 and 104 not in ids and ids.count(None) == 1
            if name == "decontamination":
                assert 7 not in [r.doc_id for r in docs.select("doc_id").collect()]
    assert counts[0] == counts[1] > counts[2] > counts[3] > 50
    assert spark.read.parquet(f"{tmp_path}/documents.parquet").count() == len(rows)
