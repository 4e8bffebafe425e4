"""The training-corpus pipeline: documents in, packed sequences out.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before
it kept; its result is written as Parquet in the shared folder and read again
as the next stage's documents.  All stages but the last return the columns of
``documents``, whatever other columns it has.

Defined cases: null and empty texts have no letter and go in the first stage;
rows that repeat an id are documents of their own until the near-duplicate
stage, where equal texts are one group; an empty table gives no sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import fresh_name, table, through_table
from tessera.llm.decontaminate import drop_contaminated
from tessera.llm.jaccard_join import keep_one_of_each
from tessera.llm.language_id import add_language, fit, held_out
from tessera.llm.line_dedup import dedup_lines
from tessera.llm.packing import pack


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is in a language that the labelled documents have."""
    model = fit(docs.where(~held_out("doc_id")))
    names = tuple(fresh_name(docs, n) for n in ("lang_pred", "score", "rejected"))
    return add_language(docs, model, names=names).where(~F.col(names[2])).select(*docs.columns)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that three documents or more hold stay in one of them; n_chars follows the text."""
    kept = dedup_lines(docs, counts=(fresh_name(docs, "n_lines"), fresh_name(docs, "n_dropped")))
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return kept.select(*docs.columns)


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group that five-word shingles link at a Jaccard similarity of 0.8."""
    return keep_one_of_each(docs, k=5, percent=80)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no ten words in a row (or a whole shorter item) with the benchmark."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of 4096 tokens."""
    return pack(docs)


STAGES = [
    ("language_id", known_language),
    ("line_dedup", without_repeated_lines),
    ("near_duplicates", one_of_near_duplicates),
    ("decontamination", without_benchmark),
    ("packing", packed),
]

#: Language ID, the similarity join and the packing have no SQL form; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = through_table(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
