"""The six aggregate tables.

All measures are sums, counts, minima and maxima, so each mart can be built from sales rows
(``row_measures``) or from their store-week aggregate (``store_week``): both carry the same
columns. The ordered run stores the store-week aggregate, and one per store, department and month
(``dept_month``), month by month, and feeds all marts from these; only months whose sales changed
are aggregated anew.

Two marts join the store dimension, one row per (store, department), on the store alone, which
repeats every sale once per department. The result is kept, without the repetition: sales are
aggregated per store first, and the aggregate is multiplied by the store's number of dimension
rows. ``fan_out=False`` gives the totals without that multiplication.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import date_parts
from ..functions.measures import mean_of
from ..operators.dims import one_type_per_store
from ..schemas import CHECK_COLUMNS, MARKDOWNS, TOTAL

SALES = "store_weekly_sales"
ECONOMICS = ["temperature", "fuel_price", "cpi", "unemployment"]
WEIGHT = "decimal(10,0)"


def row_measures(facts: DataFrame) -> DataFrame:
    """Sales rows as aggregates of one row each."""
    measures = [m for m in CHECK_COLUMNS if m in facts.columns]
    keys = [c for c in ("store_id", "dept_id", "store_date", "sales_month", "_bucket") if c in facts.columns]
    return facts.select(
        *keys,
        F.when(F.col("store_id").isNotNull(), 1).otherwise(0).cast("bigint").alias("rows"),
        F.col(SALES).alias("sales_max"), F.col(SALES).alias("sales_min"),
        *[F.col(m).alias(f"{m}_sum") for m in measures],
        *[F.when(F.col(m).isNotNull(), 1).otherwise(0).cast("bigint").alias(f"{m}_n") for m in measures])


def _merge(df: DataFrame, keys: list[str | Column], measures: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.sum("rows").alias("rows"), F.max("sales_max").alias("sales_max"), F.min("sales_min").alias("sales_min"),
        *[F.sum(f"{m}_sum").alias(f"{m}_sum") for m in measures],
        *[F.sum(f"{m}_n").alias(f"{m}_n") for m in measures])


def store_week(rows: DataFrame, *by: str) -> DataFrame:
    """Measures per store and date; ``by`` are columns that the date determines."""
    measures = [m for m in CHECK_COLUMNS if f"{m}_sum" in rows.columns]
    return _merge(rows, [*by, "store_id", "store_date"], measures)


def dept_month(rows: DataFrame, *by: str) -> DataFrame:
    """Measures per store and department, with the number of dates, for each value of ``by``. Where a date has one such
    value, as its month is, the numbers of dates add up over them as the measures do."""
    return rows.groupBy(*by, "store_id", "dept_id").agg(
        F.count_distinct("store_date").alias("weeks"),
        F.sum(f"{SALES}_sum").alias(f"{SALES}_sum"), F.sum(f"{SALES}_n").alias(f"{SALES}_n"),
        F.max("sales_max").alias("sales_max"), F.min("sales_min").alias("sales_min"))


def week_measures(sold: DataFrame, econ: DataFrame) -> DataFrame:
    """Measures per store and date straight from sales and economics.

    Equal to ``store_week`` over the joined rows, but sales are aggregated before the join: every
    department row of a store-week carries the same economics, so those count once per row.
    """
    weekly = store_week(row_measures(sold))
    joined = weekly.join(econ, ["store_id", "store_date"], "left")
    measures = [*ECONOMICS, *MARKDOWNS]
    return joined.select(
        *weekly.columns,
        *[(F.col(m) * F.col("rows").cast(WEIGHT)).alias(f"{m}_sum") for m in measures],
        *[F.when(F.col(m).isNotNull(), F.col("rows")).otherwise(0).alias(f"{m}_n") for m in measures])


def _total(c: Column) -> Column:
    return c.cast(TOTAL)


def _sales_figures(weight: Column | None = None) -> list[Column]:
    """Total, mean, maximum and minimum from merged measures, each row counted ``weight`` times."""
    total, n = F.col(f"{SALES}_sum"), F.col(f"{SALES}_n")
    if weight is not None:
        total, n = total * weight.cast(WEIGHT), n * weight
    return [
        _total(total).alias("total_sales"),
        mean_of(total, n).alias("avg_weekly_sales"),
        F.col("sales_max").alias("max_weekly_sales"),
        F.col("sales_min").alias("min_weekly_sales"),
    ]


def store_weights(stores: DataFrame, attributes: list[str], fan_out: bool = True) -> DataFrame:
    """Number of store-dimension rows per store and attribute values (1 without fan-out)."""
    n = F.count(F.lit(1)) if fan_out else F.lit(1).cast("bigint")
    return stores.groupBy("store_id", *attributes).agg(n.alias("weight"))


def sales_by_dept(rows: DataFrame) -> DataFrame:
    """Weeks, mean, total, maximum and minimum per store and department."""
    return dept_month(rows).select("store_id", "dept_id", F.col("weeks").alias("weeks_of_data"), *_sales_figures())


def sales_by_dept_of_months(months: DataFrame) -> DataFrame:
    """The same from the measures of months."""
    merged = months.groupBy("store_id", "dept_id").agg(
        F.sum("weeks").alias("weeks_of_data"),
        F.sum(f"{SALES}_sum").alias(f"{SALES}_sum"), F.sum(f"{SALES}_n").alias(f"{SALES}_n"),
        F.max("sales_max").alias("sales_max"), F.min("sales_min").alias("sales_min"))
    return merged.select("store_id", "dept_id", "weeks_of_data", *_sales_figures())


def sales_by_store(rows: DataFrame, stores: DataFrame, dates: DataFrame, fan_out: bool = True) -> DataFrame:
    """Figures per store, type, size and holiday flag."""
    # A calendar is bounded whatever the sales; unhinted, store-weeks are dealt by date before it is measured.
    flagged = rows.join(F.broadcast(dates.select("store_date", "isholiday")), "store_date")
    merged = flagged.groupBy("store_id", "isholiday").agg(
        F.count_distinct("store_date").alias("weeks_of_data"),
        F.sum(f"{SALES}_sum").alias(f"{SALES}_sum"), F.sum(f"{SALES}_n").alias(f"{SALES}_n"),
        F.max("sales_max").alias("sales_max"), F.min("sales_min").alias("sales_min"))
    # A store has two or three merged rows, so this join cannot meet a hot key.
    return (merged.join(store_weights(stores, ["store_type", "store_size"], fan_out), "store_id")
            .select("store_id", "store_type", "store_size", "isholiday", "weeks_of_data",
                    *_sales_figures(F.col("weight"))))


def sales_by_date_parts(rows: DataFrame, dates: DataFrame) -> DataFrame:
    """Figures per date with its calendar parts and holiday flag; ``num_stores`` counts sales rows."""
    merged = _merge(rows, ["store_date"], [SALES])
    flags = dates.groupBy("store_date", "isholiday").agg(F.count(F.lit(1)).alias("copies"))
    copies = F.coalesce(F.col("copies"), F.lit(1))
    total, mean, *_ = _sales_figures(copies)
    return (merged.join(flags, "store_date", "left")
            .select("store_date", *date_parts(), "isholiday", total, mean,
                    (F.col("rows") * copies).alias("num_stores")))


def sales_by_storetype_month(rows: DataFrame, stores: DataFrame, fan_out: bool = True) -> DataFrame:
    """Figures per store type and month."""
    month = [F.year("store_date").alias("sales_year"), F.month("store_date").alias("sales_month")]
    per_store = _merge(rows, ["store_id", *month], [SALES])
    weighted = per_store.join(store_weights(stores, ["store_type"], fan_out), "store_id")
    total = F.sum(F.col(f"{SALES}_sum") * F.col("weight").cast(WEIGHT))
    n = F.sum(F.col(f"{SALES}_n") * F.col("weight"))
    # One row per store, type and month reaches this aggregate, so counting rows counts stores.
    merged = weighted.groupBy("store_type", "sales_year", "sales_month").agg(
        total.alias("total"), n.alias("n"), F.count("store_id").alias("num_stores"))
    return merged.select(
        "store_type", "sales_year", "sales_month",
        F.format_string("%04d-%02d", "sales_year", "sales_month").alias("year_month"),
        mean_of("total", "n").alias("avg_weekly_sales"), _total(F.col("total")).alias("total_sales"),
        "num_stores")


def _markdown_figures() -> list[Column]:
    totals = [F.coalesce(F.col(f"{m}_sum"), F.lit(0)).cast(TOTAL) for m in MARKDOWNS]
    every = totals[0]
    for t in totals[1:]:
        every = every + t
    return [
        *[mean_of(f"{m}_sum", f"{m}_n").alias(f"avg_{m}") for m in MARKDOWNS],
        *[t.alias(f"total_{m}") for m, t in zip(MARKDOWNS, totals, strict=True)],
        _total(every).alias("total_all_markdowns"),
    ]


def markdown_by_year_store(rows: DataFrame, stores: DataFrame, per_week: bool = False) -> DataFrame:
    """Sales and markdowns per store, type and year.

    Markdowns belong to a store-week but stand on each of its department rows, so the totals count
    them once per department. ``per_week=True`` counts each store-week once.
    """
    year = F.year("store_date").alias("sales_year")
    if per_week:
        weekly = rows.groupBy("store_id", "store_date").agg(
            F.sum(f"{SALES}_sum").alias(f"{SALES}_sum"),
            *[F.max(F.try_divide(F.col(f"{m}_sum"), F.col(f"{m}_n").cast(WEIGHT))).cast("decimal(18,2)")
              .alias(f"{m}_sum") for m in MARKDOWNS])
        counted = weekly.select("store_id", "store_date", f"{SALES}_sum", *[f"{m}_sum" for m in MARKDOWNS],
                                *[F.when(F.col(f"{m}_sum").isNotNull(), 1).otherwise(0).alias(f"{m}_n")
                                  for m in MARKDOWNS])
    else:
        counted = rows
    merged = counted.groupBy("store_id", year).agg(
        F.sum(f"{SALES}_sum").alias(f"{SALES}_sum"),
        *[F.sum(f"{m}_sum").alias(f"{m}_sum") for m in MARKDOWNS],
        *[F.sum(f"{m}_n").alias(f"{m}_n") for m in MARKDOWNS])
    # Joined after the aggregate: a store has one row per year and one type.
    return (merged.join(one_type_per_store(stores), "store_id", "left")
            .select("store_id", "store_type", "sales_year",
                    _total(F.col(f"{SALES}_sum")).alias("total_sales"), *_markdown_figures()))


def economic_factors(rows: DataFrame) -> DataFrame:
    """Mean sales, economics and markdowns per store and date."""
    measures = [SALES, *ECONOMICS, *MARKDOWNS]
    merged = rows.groupBy("store_id", "store_date").agg(
        *[F.sum(f"{m}_sum").alias(f"{m}_sum") for m in measures],
        *[F.sum(f"{m}_n").alias(f"{m}_n") for m in measures])
    return merged.select(
        "store_id", "store_date",
        F.year("store_date").alias("sales_year"), F.month("store_date").alias("sales_month"),
        mean_of(f"{SALES}_sum", f"{SALES}_n").alias("avg_weekly_sales"),
        *[mean_of(f"{m}_sum", f"{m}_n").alias(f"avg_{m}") for m in [*ECONOMICS, *MARKDOWNS]])
