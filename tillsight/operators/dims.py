"""Calendar and store dimensions, and their keyed upsert."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.casts import parse_date, to_bool, to_int


def calendar_source(department_raw: DataFrame) -> DataFrame:
    """Distinct (date, holiday flag) pairs of the delivered sales."""
    return (department_raw.where(F.col("store_date").isNotNull())
            .select(parse_date("store_date").alias("store_date"), to_bool("isholiday").alias("isholiday"))
            .distinct())


def number_dates(dates: DataFrame, start: int = 0, per: Sequence[str] = ()) -> DataFrame:
    """Dense ids in date order, for each value of ``per`` where it is given.

    One task sorts the whole input, which is the set of distinct calendar dates and so cannot grow
    past the calendar, whatever the number of sales behind it.
    """
    order = W.partitionBy(*per).orderBy("store_date", "isholiday")
    return dates.select(*per, (F.row_number().over(order) + F.lit(start)).cast("bigint").alias("date_id"),
                        "store_date", "isholiday")


def date_dim(department_raw: DataFrame) -> DataFrame:
    """First build of the calendar dimension."""
    return number_dates(calendar_source(department_raw))


def new_dates(source: DataFrame, existing: DataFrame) -> DataFrame:
    """Source dates the dimension lacks."""
    return source.join(existing.select("store_date").where(F.col("store_date").isNotNull()).distinct(),
                       "store_date", "left_anti")


def new_dates_not_in(source: DataFrame, existing: DataFrame) -> DataFrame:
    """The same by NOT IN: a null among the existing dates empties the result."""
    return source.sparkSession.sql(
        "SELECT * FROM {source} WHERE store_date NOT IN (SELECT store_date FROM {existing})",
        source=source, existing=existing)


def date_dim_increment(department_raw: DataFrame, existing: DataFrame, mode: str = "stable") -> DataFrame:
    """Rows to merge into the calendar dimension for dates it lacks.

    ``stable`` continues after the highest id. ``as_written`` restarts at 1, so that the merge by
    id replaces old dates; kept only to compare with runs of the older job.
    """
    fresh = new_dates(calendar_source(department_raw), existing)
    if mode == "as_written":
        return number_dates(fresh)
    if mode != "stable":
        raise ValueError(f"unknown date id mode {mode!r}")
    top = existing.agg(F.coalesce(F.max("date_id"), F.lit(0)).alias("top")).scalar()
    return number_dates(fresh).withColumn("date_id", F.col("date_id") + top)


def one_row_per_store(stores_raw: DataFrame) -> DataFrame:
    """Typed store attributes, the first (type, size) where a store was delivered twice."""
    typed = stores_raw.select(to_int("store_id").alias("store_id"), "store_type",
                              to_int("store_size").alias("store_size"))
    return first_per_key(typed.where(F.col("store_id").isNotNull()), ["store_id"],
                         ["store_type", "store_size"])


def first_per_key(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """First row per key in the given order.

    Spark turns this shape into a per-task limit before the shuffle, so a hot key sends one row
    per task, not all its rows.
    """
    position = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_position", position).where("_position = 1").drop("_position")


def store_dim(department_raw: DataFrame, stores_raw: DataFrame) -> DataFrame:
    """One row per (store, department) with the store's type and size."""
    pairs = department_raw.select(to_int("store_id").alias("store_id"),
                                  to_int("dept_id").alias("dept_id")).distinct()
    return (pairs.join(one_row_per_store(stores_raw), "store_id", "left")
            .select("store_id", "dept_id", "store_type", "store_size"))


def one_type_per_store(stores: DataFrame) -> DataFrame:
    """Highest store type per store."""
    return stores.groupBy("store_id").agg(F.max("store_type").alias("store_type"))


def upsert(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """MERGE: matched rows take all source values, unmatched ones are added, the rest stay.

    Both sides are read once and meet in one aggregate by key, in which a source row beats the target's. As in a
    MERGE, a key that the source holds twice aborts the job, and so does a null key, which would never match.
    """
    columns = target.columns
    row = F.struct(*[F.col(c) for c in columns])
    sides = (target.select(*columns, F.lit(0).alias("_new"))
             .unionByName(source.select(*columns, F.lit(1).alias("_new"))))
    merged = sides.groupBy(*keys).agg(F.max_by(row, "_new").alias("_row"), F.sum("_new").alias("_n"))
    bad = F.exists(F.array(*[F.col(k).isNull() for k in keys]), lambda x: x) & (F.col("_n") > 0)
    checked = (F.when(bad, F.raise_error(F.lit(f"null merge key among {keys}")))
               .when(F.col("_n") > 1, F.raise_error(F.lit(f"duplicate merge key among {keys}")))
               .otherwise(F.lit(True)))
    return merged.where(checked.cast("boolean")).select("_row.*")
