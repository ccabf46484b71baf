"""Report datasets over the date mart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.labels import holiday_label
from ..functions.measures import scaled

MONTH = ["sales_month", "month_name"]


def series(by_date: DataFrame) -> DataFrame:
    """The mart with the holiday text and totals in millions."""
    return (by_date.withColumn("holiday", holiday_label("isholiday"))
            .withColumn("total_sales_m", scaled("total_sales", 1e6)))


def by_month(by_date: DataFrame) -> DataFrame:
    """Total in millions and mean of the weekly means per calendar month over all years."""
    return by_date.groupBy(*MONTH).agg(scaled(F.sum("total_sales"), 1e6).alias("total_sales_m"),
                                       F.avg("avg_weekly_sales").alias("avg_weekly"))


def year_over_year(by_date: DataFrame) -> DataFrame:
    """Weeks numbered within their year; a year has at most a few hundred date rows."""
    order = W.partitionBy("sales_year").orderBy("store_date", "isholiday")
    return series(by_date).select("sales_year", "store_date",
                                  F.row_number().over(order).cast("bigint").alias("week_num"), "total_sales_m")


def holiday_weeks(by_date: DataFrame) -> DataFrame:
    return series(by_date).where("holiday = 'TRUE'").select("store_date", "total_sales_m", "avg_weekly_sales")


def holiday_by_month(by_date: DataFrame) -> DataFrame:
    """Mean of the weekly means per month and flag."""
    return series(by_date).groupBy(*MONTH, "holiday").agg(F.avg("avg_weekly_sales").alias("avg_weekly"))


def holiday_months(by_date: DataFrame) -> DataFrame:
    """Months that have a holiday week, holiday beside other weeks (0 where there are none)."""
    flag = F.col("holiday")
    return (series(by_date).groupBy(*MONTH)
            .agg(F.count_if(flag == "TRUE").alias("n"),
                 F.coalesce(F.avg(F.when(flag == "FALSE", F.col("avg_weekly_sales"))), F.lit(0.0))
                 .alias("nonholiday_avg"),
                 F.avg(F.when(flag == "TRUE", F.col("avg_weekly_sales"))).alias("holiday_avg"))
            .where("n > 0").drop("n"))


def year_boundaries(by_date: DataFrame) -> DataFrame:
    """First of January of every year but the first."""
    years = by_date.select("sales_year").distinct()
    first = F.min("sales_year").over(W.partitionBy(F.lit(0)))  # a row per year
    return years.withColumn("first", first).where(F.col("sales_year") > F.col("first")).select(
        "sales_year", F.make_date("sales_year", F.lit(1), F.lit(1)).alias("boundary"))
