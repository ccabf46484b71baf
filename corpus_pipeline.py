"""The training-corpus pipeline: reject bad documents, drop copies and near copies, mix the sources, pack.

Each stage takes (spark, docs, folder of tables) and returns what the next one reads; all but the last return
documents with the columns they came with. `run` writes each stage's result to the shared checkpoint folder and
reads it again, as a scheduler would between jobs.
"""

from __future__ import annotations

import tempfile
import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillsight.llm import curriculum_mix, exact_dedup, jaccard_join, kneser_ney, retrieval_packing
from tillsight.llm.common import free_name, read, settle

TOKENIZER = "word_bpe_49k.json"


def good_documents(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Without the documents whose perplexity lies outside what trusted text of their language shows."""
    return kneser_ney.keep_good(docs, read(spark, folder, "labels"))


def without_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One of each group of equal texts: the one with the largest id."""
    return exact_dedup.keep_one(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One of each component of documents that share 80 % of their five-word shingles: the smallest id."""
    return jaccard_join.keep_first(docs, words=5, percent=80)


def mixed(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Sources brought to their weights along the curriculum, in training order."""
    return curriculum_mix.mixture(docs)


def in_order(docs: DataFrame, name: str) -> DataFrame:
    """The documents with their place: by file and row where they come from files, as the mixture writes them."""
    if not docs.inputFiles():
        return docs.withColumn(name, F.monotonically_increasing_id())
    part = F.regexp_extract("file", r"part-(\d+)", 1).cast("long")
    file, row = free_name(docs.columns, "file"), free_name(docs.columns, "row")
    rows = docs.select("*", F.col("_metadata.file_path").alias(file), F.col("_metadata.row_index").alias(row))
    counts = rows.select(F.col(file).alias("file")).groupBy("file").count().orderBy(part, "file").collect()
    # One row per file.
    starts, done = [], 0
    for r in counts:
        starts.append((r["file"], done))
        done += r["count"]
    known = docs.sparkSession.createDataFrame(starts, f"`{file}` string, `{name}` long")
    placed = rows.join(F.broadcast(known), file)
    return placed.select(*[F.col(f"`{c}`") for c in docs.columns], (F.col(name) + F.col(row)).alias(name))


def packed(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pieces of documents in sequences, whose ids grow in training order."""
    place = free_name(docs.columns, "place")
    return retrieval_packing.query(in_order(docs, place), public_tokenizers.path(TOKENIZER), order=place)


STAGES = [("quality classifier", good_documents), ("exact dedup", without_copies),
          ("n-gram Jaccard join", without_near_copies), ("mixing sources", mixed), ("packing", packed)]

# The classifier's perplexities and the packing have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over the documents table."""
    settle(spark.range(0))  # sets a checkpoint folder where the session has none
    root = spark.sparkContext.getCheckpointDir() or tempfile.mkdtemp(prefix="run-")
    docs = read(spark, folder, "documents")
    for number, (_, stage) in enumerate(STAGES):
        path = f"{root}/corpus-{uuid.uuid4().hex}-{number}"
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
