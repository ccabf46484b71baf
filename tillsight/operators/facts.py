"""Typed sales and economics, and the joined source of the versioned sales table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.casts import parse_date, to_int, try_decimal
from ..functions.keys import surrogate_key
from ..schemas import CHECK_COLUMNS, MARKDOWNS

KEY = "snapshot_key"
KEY_PARTS = ["store_id", "dept_id", "store_date"]
# What the rows of ``enriched`` are dealt by, as its join with economics leaves them.
DEALT_BY = ["store_id", "store_date"]
# The columns of the versioned sales table, in order.
ENRICHED_COLUMNS = [KEY, "store_id", "dept_id", "date_id", "store_date", "store_type", "store_size",
                    *CHECK_COLUMNS]


def sales(department_raw: DataFrame, *amounts: str) -> DataFrame:
    """Typed weekly sales per store, department and date; ``amounts`` are further columns typed alike."""
    return department_raw.where(F.col("store_date").isNotNull()).select(
        to_int("store_id").alias("store_id"),
        to_int("dept_id").alias("dept_id"),
        parse_date("store_date").alias("store_date"),
        try_decimal("weekly_sales", 18, 2).alias("store_weekly_sales"),
        *[try_decimal(a, 18, 2).alias(a) for a in amounts])


def economics(fact_raw: DataFrame) -> DataFrame:
    """Typed economic measures and markdowns per store and date."""
    return fact_raw.where(F.col("store_date").isNotNull()).select(
        to_int("store_id").alias("store_id"),
        parse_date("store_date").alias("store_date"),
        try_decimal("temperature", 10, 4).alias("temperature"),
        try_decimal("fuel_price", 10, 4).alias("fuel_price"),
        try_decimal("cpi", 18, 4).alias("cpi"),
        try_decimal("unemployment", 10, 4).alias("unemployment"),
        *[try_decimal(m, 18, 2).alias(m) for m in MARKDOWNS])


def with_economics(sold: DataFrame, econ: DataFrame) -> DataFrame:
    return sold.join(econ, ["store_id", "store_date"], "left")


def enriched(sold: DataFrame, econ: DataFrame, dates: DataFrame, stores: DataFrame) -> DataFrame:
    """Sales with economics and dimension attributes; one row per sales row.

    Stores come first, while rows are narrow. Neither they nor the economics are hinted: the adaptive planner broadcasts
    one after measuring it, and splits a store-week that is too big for one task; a store-department has at most one row
    per date. The calendar is bounded whatever the sales, and so broadcast.
    """
    typed = sold.join(stores.select("store_id", "dept_id", "store_type", "store_size"), ["store_id", "dept_id"], "left")
    return (with_economics(typed, econ)
            .join(F.broadcast(dates.select("store_date", "date_id")), "store_date", "left")
            .withColumn(KEY, surrogate_key(*KEY_PARTS))
            .select(*ENRICHED_COLUMNS))
