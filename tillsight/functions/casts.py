"""Text to typed values, and typed decimals to report doubles."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts that stand for a missing value in delivered files.
NULL_TOKENS = ("NULL", "null", "NA")


def null_if(df: DataFrame, columns: Iterable[str] | None = None,
            tokens: Iterable[str] = NULL_TOKENS) -> DataFrame:
    """Null out the marker texts in the given columns (default: all string columns)."""
    strings = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    chosen = strings if columns is None else set(columns)
    tokens = list(tokens)
    return df.select(*[
        F.when(~F.col(c).isin(tokens), F.col(c)).alias(c) if c in chosen else F.col(c)
        for c in df.columns
    ])


def to_int(c: str | Column) -> Column:
    """Strict text to INT: bad text fails the job under ANSI."""
    return _col(c).cast("int")


def parse_date(c: str | Column) -> Column:
    """Strict yyyy-MM-dd text to DATE: bad text fails the job under ANSI.

    Text of the exact shape takes the plain cast, which is as strict there and far cheaper than
    the pattern parser; anything else goes to the parser, which rejects it.
    """
    c = _col(c)
    shaped = (F.length(c) == 10) & (F.substring(c, 5, 1) == "-") & (F.substring(c, 8, 1) == "-")
    return F.when(shaped, c.cast("date")).otherwise(F.to_date(c, "yyyy-MM-dd"))


def to_bool(c: str | Column) -> Column:
    """Strict text to BOOLEAN."""
    return _col(c).cast("boolean")


def try_decimal(c: str | Column, precision: int, scale: int) -> Column:
    """Text to DECIMAL, null where it is not a number or does not fit.

    Texts for a missing value are told apart first: where they are common, failing to read them costs more than all else.
    """
    c = _col(c)
    return F.when(~c.isin(*NULL_TOKENS), c).try_cast(T.DecimalType(precision, scale))


def to_timestamp(c: str | Column) -> Column:
    """Date or text to TIMESTAMP, for a time axis."""
    return _col(c).cast("timestamp")


def decimals_to_double(df: DataFrame) -> DataFrame:
    """Cast by declared type: every DECIMAL column becomes DOUBLE, everything else is untouched."""
    return df.select(*[
        F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
        for f in df.schema.fields
    ])


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c
