"""Data-quality checks. Each returns (check_name, failures, passed) rows and scans its table once."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _report(name: str, counts: DataFrame) -> DataFrame:
    """One-row frame with column ``failures`` to a check row."""
    return counts.select(F.lit(name).alias("check_name"), F.col("failures").cast("bigint").alias("failures"),
                         (F.col("failures") == 0).alias("passed"))


def unique(df: DataFrame, table: str, *columns: str) -> DataFrame:
    """Number of column values, or value combinations, that occur more than once.

    A single column skips nulls; a combination counts them.
    """
    rows = df.where(F.col(columns[0]).isNotNull()) if len(columns) == 1 else df
    repeated = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    kind = "unique" if len(columns) == 1 else "unique_combination"
    return _report(f"{kind}_{table}_{'__'.join(columns)}", repeated.agg(F.count(F.lit(1)).alias("failures")))


def not_null(df: DataFrame, table: str, *columns: str) -> DataFrame:
    """Number of nulls per column, all columns in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    names = F.array(*[F.struct(F.lit(f"not_null_{table}_{c}").alias("check_name"),
                               F.col(c).cast("bigint").alias("failures")) for c in columns])
    return (counts.select(F.inline(names))
            .withColumn("passed", F.col("failures") == 0))


def table_checks(df: DataFrame, table: str, key: list[str], filled: list[str]) -> DataFrame:
    """The key's uniqueness and the nulls of columns from one grouped pass over the table."""
    per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"),
                                   *[F.count_if(F.col(c).isNull()).alias(f"_null_{c}") for c in filled])
    repeated = F.col("_n") > 1
    if len(key) == 1:
        repeated &= F.col(key[0]).isNotNull()
    kind = "unique" if len(key) == 1 else "unique_combination"
    sums = per_key.agg(F.count_if(repeated).alias("_repeated"),
                       *[F.coalesce(F.sum(f"_null_{c}"), F.lit(0)).alias(f"_null_{c}") for c in filled])
    rows = [(f"{kind}_{table}_{'__'.join(key)}", "_repeated"), *((f"not_null_{table}_{c}", f"_null_{c}") for c in filled)]
    named = F.array(*[F.struct(F.lit(name).alias("check_name"), F.col(c).cast("bigint").alias("failures"))
                      for name, c in rows])
    return sums.select(F.inline(named)).withColumn("passed", F.col("failures") == 0)


def suite(dates: DataFrame, stores: DataFrame, snapshot: DataFrame, by_store: DataFrame) -> DataFrame:
    """All configured checks. ``snapshot`` holds current rows: a key repeats over its versions."""
    return reduce(DataFrame.unionByName, [
        table_checks(dates, "date_dim", ["date_id"], ["date_id", "store_date"]),
        table_checks(stores, "store_dim", ["store_id", "dept_id"], ["store_id", "dept_id"]),
        table_checks(snapshot, "fact_snapshot", ["snapshot_key"], ["snapshot_key", "store_id", "dept_id", "store_date"]),
        table_checks(by_store, "sales_by_store", ["store_id", "isholiday"], ["store_id"])])


def warnings(dates: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """Checks beyond the configured ones: a date with both flags doubles its sales in the marts."""
    checks = [unique(dates, "date_dim", "store_date")]
    if history is not None:
        checks.append(unique(history, "fact_snapshot", "dbt_scd_id"))
    return reduce(DataFrame.unionByName, checks)


def flag_conflicts(dates: DataFrame) -> DataFrame:
    """Dates that the calendar holds under more than one holiday flag."""
    return (dates.where(F.col("store_date").isNotNull()).groupBy("store_date").agg(F.count(F.lit(1)).alias("flags"))
            .where("flags > 1"))
