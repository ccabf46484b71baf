"""Report datasets over the department mart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.labels import dept_label
from ..functions.measures import pct_of, range_bounds, scaled

FIGURES = ["total_sales", "avg_weekly_sales", "max_weekly_sales", "min_weekly_sales"]


def top_departments(by_dept: DataFrame, n: int = 20, ascending_result: bool = False) -> DataFrame:
    """The n best (store, department) pairs by total, with labels and distances to min and max.

    Ties break by store, then department. ``ascending_result`` lists the same rows worst first.
    """
    order = [F.desc_nulls_last("total_sales"), F.asc("store_id"), F.asc("dept_id")]
    top = by_dept.select("store_id", "dept_id", *FIGURES).orderBy(*order).limit(n)
    out = top.select("*", dept_label().alias("label"), dept_label(" ").alias("label_line"), *range_bounds())
    if ascending_result:
        return out.orderBy(F.asc_nulls_first("total_sales"), F.desc("store_id"), F.desc("dept_id"))
    return out


def in_units(by_dept: DataFrame) -> DataFrame:
    """Totals in millions and billions, means in thousands."""
    return by_dept.select("store_id", "dept_id",
                          scaled("total_sales", 1e6).alias("total_sales_m"),
                          scaled("total_sales", 1e9).alias("total_sales_b"),
                          scaled("avg_weekly_sales", 1e3).alias("avg_weekly_sales_k"))


def grand_total(by_dept: DataFrame) -> DataFrame:
    return by_dept.agg(F.sum("total_sales").alias("grand_total"))


def share_of_total(by_dept: DataFrame) -> DataFrame:
    """Each pair's percentage of the grand total, which is fetched as a scalar inside the plan."""
    whole = grand_total(by_dept).scalar()
    return by_dept.select("store_id", "dept_id", pct_of(F.col("total_sales"), whole).alias("pct"))


def share_by_store_type(by_dept: DataFrame, stores: DataFrame, fan_out: bool = True) -> DataFrame:
    """Total and percentage per store type.

    As in the marts, the join on the store alone repeats a department once per department of the
    store; totals per store times the number of dimension rows give the same.
    """
    from .marts import WEIGHT, store_weights

    per_store = by_dept.groupBy("store_id").agg(F.sum("total_sales").alias("total"))
    weighted = per_store.join(store_weights(stores, ["store_type"], fan_out), "store_id", "left")
    amount = F.col("total").cast("decimal(28,2)") * F.coalesce(F.col("weight"), F.lit(1)).cast(WEIGHT)
    by_type = weighted.groupBy("store_type").agg(F.sum(amount).alias("total_sales"))
    whole = F.sum("total_sales").over(W.partitionBy(F.lit(0)))  # a row per store type
    return by_type.select("store_type", "total_sales", pct_of(F.col("total_sales"), whole).alias("pct"))
