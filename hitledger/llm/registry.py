"""Queries of the text operators, and the SQL they must agree with where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from hitledger.llm import bond, decontaminate, langid, linerules, neardup, pieces, pii, quality, secrets, sharding, signatures, tokencounts, topk
from hitledger.llm.sql import HARD_NEGATIVES_SQL, LINE_RULES_SQL, SEARCH_SQL, SHARDING_SQL, TOP_K_SQL
from hitledger.llm.tables import fold_of, read_table

Query = Callable[[SparkSession, str], DataFrame]

SHARDS = 16
PIECE_MODEL = "piece_bpe_32k.model"
BYTE_RANKS = "byte_bpe_50k.tiktoken"


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(read_table(spark, sf_dir, "documents"))


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(read_table(spark, sf_dir, "documents"))


def op4_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = fold_of(F.col("doc_id"), 4) == 2
    documents = read_table(spark, sf_dir, "documents")
    return langid.learn_and_identify(documents, ~held_out).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected"
    )


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = fold_of(F.col("doc_id"), 5) == 0
    documents = read_table(spark, sf_dir, "documents")
    labels = read_table(spark, sf_dir, "labels")
    scored = quality.score_quality(documents, labels, ~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op6_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    return neardup.near_duplicates(documents, words=3, similarity="0.85")


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    benchmark = read_table(spark, sf_dir, "benchmark")
    return decontaminate.findings(documents, benchmark)


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    return sharding.shard_records(documents, [1.0] * SHARDS, [1.0] * (SHARDS + 1))


def op9_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    return pieces.round_trip(documents, public_tokenizers.path(PIECE_MODEL))


def op10_tokencounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencounts.count_section_tokens(
        read_table(spark, sf_dir, "documents"),
        public_tokenizers.path(BYTE_RANKS),
        public_tokenizers.PATTERN,
    )


def op11_linerules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linerules.check_lines(read_table(spark, sf_dir, "documents"))


def op12_hardneg(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, label = F.col("vec_id"), F.col("label")
    shifted = F.when(key % 7 == 0, (label + 1) % 10).otherwise(label)
    return bond.hard_negatives(read_table(spark, sf_dir, "embeddings"), key % 100 == 0, label=shifted)


def op13_lexsearch(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    return signatures.search(documents, read_table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Query]:
    return {
        "op1_secrets": op1_secrets,
        "op2_topk": op2_topk,
        "op3_pii": op3_pii,
        "op4_langid": op4_langid,
        "op5_quality": op5_quality,
        "op6_neardup": op6_neardup,
        "op7_decontaminate": op7_decontaminate,
        "op8_sharding": op8_sharding,
        "op9_pieces": op9_pieces,
        "op10_tokencounts": op10_tokencounts,
        "op11_linerules": op11_linerules,
        "op12_hardneg": op12_hardneg,
        "op13_lexsearch": op13_lexsearch,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_topk": TOP_K_SQL,
        "op8_sharding": SHARDING_SQL,
        "op11_linerules": LINE_RULES_SQL,
        "op12_hardneg": HARD_NEGATIVES_SQL,
        "op13_lexsearch": SEARCH_SQL,
    }
