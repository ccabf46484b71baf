"""The named queries of the training-data operators and the SQL each must agree with, where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline

from . import (block_search, chat_format, curriculum_mix, embedding_whitening, exact_dedup, jaccard_join, kneser_ney,
               line_dedup, merkle_manifest, pii_boosting, retrieval_packing, token_counts, unit_dedup)
from .common import read

BYTE_RANKS = "byte_bpe_50k.tiktoken"
WORD_BPE = "word_bpe_49k.json"


def op1_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.query(read(spark, folder, "documents"))


def op2_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    return chat_format.query(read(spark, folder, "conversations"), public_tokenizers.path(BYTE_RANKS),
                             public_tokenizers.PATTERN)


def op3_unit_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return unit_dedup.query(read(spark, folder, "documents"))


def op4_curriculum_mix(spark: SparkSession, folder: str) -> DataFrame:
    return curriculum_mix.query(read(spark, folder, "documents"))


def op5_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.query(read(spark, folder, "documents"))


def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.query(read(spark, folder, "documents"), public_tokenizers.path(BYTE_RANKS),
                              public_tokenizers.PATTERN)


def op7_retrieval_packing(spark: SparkSession, folder: str) -> DataFrame:
    return retrieval_packing.query(read(spark, folder, "documents"), public_tokenizers.path(WORD_BPE))


def op8_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.query(read(spark, folder, "documents"))


def op9_block_search(spark: SparkSession, folder: str) -> DataFrame:
    return block_search.query(read(spark, folder, "embeddings"))


def op10_kneser_ney(spark: SparkSession, folder: str) -> DataFrame:
    return kneser_ney.query(read(spark, folder, "documents"), read(spark, folder, "labels"))


def op11_pii_boosting(spark: SparkSession, folder: str) -> DataFrame:
    return pii_boosting.query(read(spark, folder, "documents"))


def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle_manifest.query(read(spark, folder, "documents"))


def op13_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_whitening.query(read(spark, folder, "embeddings"))


QUERIES = {q.__name__: q for q in (
    op1_jaccard_join, op2_chat_format, op3_unit_dedup, op4_curriculum_mix, op5_exact_dedup, op6_token_counts,
    op7_retrieval_packing, op8_line_dedup, op9_block_search, op10_kneser_ney, op11_pii_boosting,
    op12_merkle_manifest, op13_embedding_whitening)}
QUERIES["pipeline"] = corpus_pipeline.run

# Mixing, packing, token counts, passages, perplexities and eigenvectors have no SQL form; tests hold them against brute force.
ORACLES = {"op1_jaccard_join": jaccard_join.ORACLE, "op2_chat_format": chat_format.ORACLE,
           "op5_exact_dedup": exact_dedup.ORACLE, "op8_line_dedup": line_dedup.ORACLE,
           "op9_block_search": block_search.ORACLE, "op12_merkle_manifest": merkle_manifest.ORACLE}
