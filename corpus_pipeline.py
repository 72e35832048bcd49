"""Prepare a corpus: languages, near duplicates, benchmark passages, personal data, token ids.

Every stage reads what the stage before it kept. Stages but the last return the columns of
documents; the last one returns token ids. None of the stages drops a row for another reason
than its own decision: the first drops texts in none of the corpus's languages, the second all
but one of each group of near duplicates, the third texts with passages of the benchmark; the
fourth masks personal data in place, and the fifth keeps every row.

A document with a null id is compared with no other, and stays unless the first or third stage
takes it out; null text is in no language, so the first stage takes it out. An empty table
gives an empty result. Columns beyond those of documents are carried along up to the last
stage. Very long texts are worked on whole, one at a time. Where documents tie, the smallest id
stays of a group of near duplicates, and the language that sorts first wins.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from hitledger.llm import decontaminate, langid, neardup, pieces, pii
from hitledger.llm.tables import read_table, stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Rows that Spark hands to a Python worker at once: whole texts, so about a megabyte.
BATCH_ROWS = "250"

PIECE_MODEL = "piece_bpe_32k.model"
#: Columns of documents that the last stage carries along.
CARRIED = ("lang", "source")

#: No SQL: learned models and a tokenizer are not expressible. The tests hold run() against
#: plain Python versions of its stages.
ORACLE_SQL = None


def known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents written in one of the languages the corpus is labelled with."""
    return langid.accepted_rows(docs, F.lit(True))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five words, similarity 0.8."""
    return neardup.without_copies(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark, in its own or other parameters."""
    found = decontaminate.findings(docs, read_table(spark, sf_dir, "benchmark"))
    return decontaminate.without_findings(docs, found)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with personal data masked, and n_chars of the masked text."""
    return pii.mask_personal_data(docs).withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document's whole text, and whether they decode to it."""
    return pieces.encode_texts(docs, public_tokenizers.path(PIECE_MODEL), keep=CARRIED)


def in_small_batches(stage: Stage) -> Stage:
    """The stage with batches of BATCH_ROWS, so that a worker's memory does not follow the rows."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES: list[tuple[str, Stage]] = [
    ("language_id", in_small_batches(known_languages)),
    ("near_duplicates", in_small_batches(one_of_each)),
    ("benchmark", in_small_batches(without_benchmark)),
    ("personal_data", in_small_batches(without_personal_data)),
    ("token_ids", in_small_batches(token_ids)),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written below the shared scratch folder and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
