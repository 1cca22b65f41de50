"""The operators as registered queries over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patronage.llm import (
    byte_bpe,
    embedding_dedup,
    exact_dedup,
    hard_negatives,
    kneser_ney,
    language_id,
    license_scan,
    mixing,
    quality,
    simhash,
    spelling,
    token_count,
    token_files,
)
from patronage.llm.columns import table
from patronage.session import ship


def op1_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, folder, "documents", "doc_id", "text"))


def op2_kneser_ney(spark: SparkSession, folder: str) -> DataFrame:
    return kneser_ney.held_out_scores(table(spark, folder, "documents", "doc_id", "text"))


def op3_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return byte_bpe.round_trip(
        table(spark, folder, "documents", "doc_id", "text"),
        public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )


def op4_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_dedup.near_vectors(
        table(spark, folder, "embeddings", "vec_id", "embedding"), probes=embedding_dedup.PROBES
    )


def op5_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language_id.held_out_predictions(
        table(spark, folder, "documents", "doc_id", "text", "lang")
    )


def op6_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.scan(table(spark, folder, "documents", "doc_id", "text"))


def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.taken_words(table(spark, folder, "documents", "doc_id", "text", "source"))


def op8_token_count(spark: SparkSession, folder: str) -> DataFrame:
    return token_count.count_tokens(
        table(spark, folder, "documents", "doc_id", "text"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.PATTERN,
    )


def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.held_out_scores(
        table(spark, folder, "documents", "doc_id", "text"),
        table(spark, folder, "labels", "doc_id", "quality"),
    )


def op10_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_groups(table(spark, folder, "documents", "doc_id", "text"))


def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, folder, "documents", "doc_id", "text"))


def op12_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.round_trip(
        table(spark, folder, "documents", "doc_id", "text"),
        public_tokenizers.path("word_bpe_49k.json"),
        end_id=2,
    )


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings", "vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(vectors.withColumn("label", moved))


def _shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable:
    """The query, after the package has been sent to the executors."""

    @wraps(query)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        ship(spark)
        return query(spark, folder)

    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: _shipped(query)
    for query in (
        op1_exact_dedup,
        op2_kneser_ney,
        op3_byte_bpe,
        op4_embedding_dedup,
        op5_language_id,
        op6_license_scan,
        op7_mixing,
        op8_token_count,
        op9_quality,
        op10_simhash,
        op11_spelling_variants,
        op12_token_files,
        op13_hard_negatives,
    )
}
