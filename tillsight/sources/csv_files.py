"""Delivered CSV files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.casts import null_if
from ..schemas import Landing

CORRUPT = "corrupt_record"

# Comma, optional double quotes (doubled inside), one header line; columns map by position.
# Unless a landing asks for it, multiLine is off so that one large file is split over many tasks.
# Column pruning is off because a parser that skips fields does not notice that a line has too few
# or too many.
CSV_OPTIONS = {
    "header": "true", "sep": ",", "quote": '"', "escape": '"',
    "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT,
    "columnPruning": "false",
}

# Which delivered file, in which state, a row came from.
SOURCE_COLUMNS = ["source_file", "source_modified", "source_size"]


def _options(landing: Landing) -> dict[str, str]:
    return CSV_OPTIONS | {"multiLine": str(landing.multi_line).lower()}


def _reader_schema(landing: Landing) -> T.StructType:
    return T.StructType([*landing.schema.fields, T.StructField(CORRUPT, T.StringType())])


def _with_source(df: DataFrame) -> DataFrame:
    return df.select("*",
                     F.col("_metadata.file_path").alias("source_file"),
                     F.col("_metadata.file_modification_time").alias("source_modified"),
                     F.col("_metadata.file_size").alias("source_size"))


def read_csv(spark: SparkSession, path: str | list[str], landing: Landing) -> DataFrame:
    """All lines of the files, malformed ones marked in ``corrupt_record``."""
    reader = spark.read.schema(_reader_schema(landing)).options(**_options(landing))
    if isinstance(path, str):
        reader = reader.option("pathGlobFilter", landing.pattern)
    return _with_source(reader.csv(path))


def only_files(lines: DataFrame, names: Sequence[str]) -> DataFrame:
    """The lines of the named files. The names reach Spark as literals on the file path, so it opens only these."""
    return lines.where(F.col("source_file").isin(list(names)))


def stream_csv(spark: SparkSession, path: str, landing: Landing,
               max_files: int | None = None) -> DataFrame:
    """The same as a stream over files not seen before."""
    reader = (spark.readStream.schema(_reader_schema(landing)).options(**_options(landing))
              .option("pathGlobFilter", landing.pattern))
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return _with_source(reader.csv(path))


def list_files(spark: SparkSession, path: str, landing: Landing) -> DataFrame:
    """Files now in the folder with their state; contents are not read."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", landing.pattern).load(path))
    return files.select("path",
                        F.col("_metadata.file_path").alias("source_file"),
                        F.col("_metadata.file_modification_time").alias("source_modified"),
                        F.col("_metadata.file_size").alias("source_size"))


def clean(df: DataFrame, landing: Landing) -> DataFrame:
    """Marker texts to null, and a ``bad`` flag on malformed lines."""
    flagged = null_if(df, landing.columns)
    return flagged.withColumn("bad", F.col(CORRUPT).isNotNull())


def split_bad(df: DataFrame, landing: Landing) -> tuple[DataFrame, DataFrame]:
    """(good rows, malformed lines with what could be parsed of them).

    Spark refuses a bare count of either straight from the files; count what the landing tables
    have stored.
    """
    marked = clean(df, landing)
    good = marked.where(~F.col("bad")).select(*landing.columns)
    bad = marked.where("bad").select(*landing.columns, CORRUPT, *SOURCE_COLUMNS)
    return good, bad


def with_audit(df: DataFrame, run_ts: str | None = None) -> DataFrame:
    """insert_date and update_date, from the statement time or a given run time."""
    now = F.current_timestamp() if run_ts is None else F.lit(run_ts).cast("timestamp")
    return df.withColumns({"insert_date": now, "update_date": now})
