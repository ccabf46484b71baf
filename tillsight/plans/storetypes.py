"""Report datasets over the store-type mart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import month_name
from ..functions.labels import money
from ..functions.measures import scaled

# The store types with a column of their own, and the month number of the total row.
STORE_TYPES = ["A", "B", "C"]
TOTAL_MONTH = 99

MOST_TYPES = 200  # columns a pivot may have


def store_types(by_type: DataFrame, most: int = MOST_TYPES) -> list[str]:
    """The types that occur, for a pivot with a column of each. Only ``most`` and one more are fetched; past that
    a pivot would be too wide, and ``month_long`` has the same figures as rows."""
    found = by_type.select("store_type").where("store_type IS NOT NULL").distinct().orderBy("store_type").limit(most + 1)
    types = [r["store_type"] for r in found.collect()]
    if len(types) > most:
        raise ValueError(f"more than {most} store types, use month_long")
    return types


def type_columns(types: Sequence[str] = STORE_TYPES) -> list[str]:
    """Column names of the types and, last, of all others; numbered where types differ only by case."""
    names: list[str] = []
    for wish in [f"type_{t.lower()}" for t in types if t is not None]:
        name, n = wish, 1
        while name in names or name == "type_other":
            n += 1
            name = f"{wish}_{n}"
        names.append(name)
    return [*names, "type_other"]


def _sums(types: Sequence[str]) -> list[Column]:
    """Total per type; ``type_other`` takes all other types and stores without one, so rows keep their sum."""
    columns = type_columns(types)
    named = F.coalesce(F.col("store_type").isin(list(types)), F.lit(False))
    return [*[F.sum(F.when(F.col("store_type") == t, F.col("total_sales"))).alias(c)
              for t, c in zip(types, columns)],
            F.sum(F.when(~named, F.col("total_sales"))).alias(columns[-1])]


def monthly_line(by_type: DataFrame) -> DataFrame:
    """Total in millions per type and calendar month over all years."""
    return by_type.groupBy("store_type", "sales_month").agg(
        scaled(F.sum("total_sales"), 1e6).alias("total_sales_m"))


def last_month(by_type: DataFrame) -> DataFrame:
    """Each type's last month on the line, with its display text."""
    last = monthly_line(by_type).groupBy("store_type").agg(
        F.max("sales_month").alias("sales_month"),
        F.max_by("total_sales_m", "sales_month").alias("total_sales_m"))
    return last.withColumn("label", money("total_sales_m", "M"))


def month_pivot(by_type: DataFrame, types: Sequence[str] = STORE_TYPES) -> DataFrame:
    """Months by store type: a column for each of ``types`` (``store_types`` finds those that occur)."""
    return (by_type.groupBy("sales_month").agg(*_sums(types))
            .select("sales_month", month_name("sales_month").alias("month_name"), *type_columns(types)))


def _labelled(is_total: Column) -> list[Column]:
    return [F.when(is_total, F.lit(TOTAL_MONTH)).otherwise(F.col("sales_month")).alias("sales_month"),
            F.when(is_total, F.lit("TOTAL")).otherwise(month_name("sales_month")).alias("month_name")]


def month_totals(by_type: DataFrame, types: Sequence[str] = STORE_TYPES) -> DataFrame:
    """The pivot with a TOTAL row of column sums (0 for a type without sales), in one pass."""
    rolled = by_type.rollup("sales_month").agg(F.grouping("sales_month").alias("is_total"), *_sums(types))
    is_total = F.col("is_total") == 1
    return rolled.select(*_labelled(is_total), *[
        F.when(is_total, F.coalesce(F.col(c), F.lit(0))).otherwise(F.col(c)).alias(c) for c in type_columns(types)])


def month_table(by_type: DataFrame, types: Sequence[str] = STORE_TYPES) -> DataFrame:
    """The pivot with totals as display texts, '-' where a type has no sales."""
    return month_totals(by_type, types).select(
        "sales_month", "month_name",
        *[money(scaled(c, 1e6), "M", missing="-").alias(c) for c in type_columns(types)])


def month_long(by_type: DataFrame) -> DataFrame:
    """The pivot with totals as rows, for any number of types: a row per month and type, and a TOTAL row per type."""
    columns = [F.col("store_type"), F.col("sales_month")]
    rolled = by_type.groupingSets([columns, columns[:1]], *columns).agg(
        F.grouping("sales_month").alias("is_total"), F.sum("total_sales").alias("total_sales"))
    return rolled.select("store_type", *_labelled(F.col("is_total") == 1), "total_sales")


def by_type_and_size(by_store: DataFrame) -> DataFrame:
    """Totals and number of stores per store type and size."""
    return by_store.groupBy("store_type", "store_size").agg(
        F.sum("total_sales").alias("total_sales"), F.count_distinct("store_id").alias("stores"))
