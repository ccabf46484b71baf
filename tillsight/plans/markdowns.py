"""Report datasets over the markdown mart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.labels import money, percent
from ..functions.measures import pct_change, pct_of, scaled
from ..schemas import MARKDOWNS

SUMS = ["md1", "md2", "md3", "md4", "md5", "total_all", "total_sales"]


def by_year(markdowns: DataFrame) -> DataFrame:
    """Markdowns and sales per year, also in millions, with share of sales and a display text."""
    sources = [*[f"total_{m}" for m in MARKDOWNS], "total_all_markdowns", "total_sales"]
    sums = markdowns.groupBy("sales_year").agg(
        *[F.sum(s).alias(c) for s, c in zip(sources, SUMS, strict=True)])
    share = F.when(F.col("total_sales") > 0, pct_of(F.col("total_all"), F.col("total_sales"))).otherwise(F.lit(0.0))
    text = F.concat(F.lit("Total: "), money("total_all_m", "M"), F.lit("\n("), percent("pct_sales"),
                    F.lit(" of sales)"))
    return (sums.select("*", *[scaled(c, 1e6).alias(f"{c}_m") for c in SUMS])
            .withColumn("pct_sales", share)
            .withColumn("label", F.when(F.col("total_all_m") > 0, text).otherwise(F.lit("No markdown\ndata"))))


def in_year(markdowns: DataFrame, year: int) -> DataFrame:
    """Total markdowns of one year in millions."""
    return by_year(markdowns.where(F.col("sales_year") == year)).select("sales_year", "total_all_m")


def long_form(markdowns: DataFrame) -> DataFrame:
    """One row per year and markdown type, in millions."""
    wide = by_year(markdowns)
    columns = [f"md{k}_m" for k in range(1, 6)]
    renamed = wide.select("sales_year", *[F.col(c).alias(f"Markdown {k}") for k, c in enumerate(columns, 1)])
    return renamed.unpivot("sales_year", [f"Markdown {k}" for k in range(1, 6)], "markdown", "amount_m")


def year_change(markdowns: DataFrame) -> DataFrame:
    """Change between the first two years that have markdowns; no row with fewer than two."""
    order = W.orderBy("sales_year")  # one row per year
    totals = by_year(markdowns).where(F.col("total_all") > 0).select("sales_year", "total_all")
    return (totals.withColumn("n", F.row_number().over(order))
            .withColumn("from_year", F.lag("sales_year").over(order))
            .withColumn("before", F.lag("total_all").over(order))
            .where("n = 2")
            .select("from_year", F.col("sales_year").alias("to_year"),
                    pct_change(F.col("total_all"), F.col("before")).alias("yoy_change")))


def profile(markdowns: DataFrame) -> DataFrame:
    """Row count, stores, years present and their range."""
    return markdowns.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct("store_id").alias("stores"),
        F.array_join(F.sort_array(F.collect_set("sales_year")), ",").alias("years"),
        F.min("sales_year").alias("first_year"), F.max("sales_year").alias("last_year"))
