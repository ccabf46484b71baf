"""Helpers shared by the training-data operators: input, written-down steps, row tags, task sizes."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Code points that separate words: space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def settle(df: DataFrame) -> DataFrame:
    """Write the rows to the shared checkpoint folder and go on from there.

    Later steps then neither recompute the rows nor depend on the executors that made them. The folder is
    the one in spark.checkpoint.dir; only where none is set (tests, one machine) a temporary one is taken.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="run-"))
    return df.checkpoint()


def tagged(docs: DataFrame, name: str) -> DataFrame:
    """Number the rows. Settle the result before using the numbers twice."""
    return docs.withColumn(name, F.monotonically_increasing_id())


def words(text: Column) -> Column:
    """Number of words; null counts none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def free_name(taken: list[str], wish: str) -> str:
    """A column name that clashes with none of those given, whatever their case."""
    names = {c.lower() for c in taken}
    while wish.lower() in names:
        wish = "_" + wish
    return wish


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """The same rows in pieces of about `limit` bytes of one column, one row at least: bounds the task's memory."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(column)).to_pylist()
        start, held = 0, 0
        for i, n in enumerate(sizes):
            if held and held + (n or 0) > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n or 0
        if batch.num_rows > start:
            yield batch.slice(start)
