"""Report datasets on holiday weeks, over the store mart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.labels import fixed, holiday_label, money, percent
from ..functions.measures import pct_change, pct_of, scaled


def _labelled(by_store: DataFrame) -> DataFrame:
    return by_store.withColumn("holiday", holiday_label("isholiday"))


def _total(flag: str) -> Column:
    return F.coalesce(F.sum(F.when(F.col("holiday") == flag, F.col("total_sales"))), F.lit(0))


def _mean(flag: str) -> Column:
    return F.avg(F.when(F.col("holiday") == flag, F.col("avg_weekly_sales")))


def summary(by_store: DataFrame) -> DataFrame:
    """Totals and mean weekly sales with and without holidays, and the holiday premium in percent."""
    return _labelled(by_store).agg(
        F.sum("total_sales").alias("grand_total"),
        _total("TRUE").alias("holiday_total"), _total("FALSE").alias("nonholiday_total"),
        _mean("TRUE").alias("holiday_avg"), _mean("FALSE").alias("nonholiday_avg"),
    ).withColumn("pct_diff", pct_change(F.col("holiday_avg"), F.col("nonholiday_avg")))


def share(by_store: DataFrame) -> DataFrame:
    """Total and percentage per flag, both flags always present."""
    rows = F.array(*[F.struct(F.lit(flag).alias("holiday"), F.col(c).alias("total"))
                     for flag, c in (("FALSE", "nonholiday_total"), ("TRUE", "holiday_total"))])
    return (summary(by_store).select("grand_total", F.inline(rows))
            .select("holiday", "total", pct_of(F.col("total"), F.col("grand_total")).alias("pct")))


def share_positions(by_store: DataFrame) -> DataFrame:
    """Shares with running sum and midpoint, holidays first (two rows in one window)."""
    running = W.orderBy(F.desc("holiday")).rowsBetween(W.unboundedPreceding, W.currentRow)
    return (share(by_store).withColumn("cumsum", F.sum("pct").over(running))
            .withColumn("midpoint", F.col("cumsum") - F.col("pct") / 2)
            .withColumn("label", percent("pct")))


def average_rows(by_store: DataFrame) -> DataFrame:
    """One labelled row per flag with the mean weekly sales."""
    rows = F.array(*[
        F.struct(F.lit(kind).alias("type"), F.col(c).alias("avg"), money(c).alias("label"))
        for kind, c in (("Non-Holiday", "nonholiday_avg"), ("Holiday", "holiday_avg"))])
    return summary(by_store).select(F.inline(rows))


def store_pivot(by_store: DataFrame) -> DataFrame:
    """Holiday and other totals per store in millions, zero where a store has none."""
    return (_labelled(by_store).groupBy("store_id").pivot("holiday", ["FALSE", "TRUE"]).agg(F.sum("total_sales"))
            .fillna(0).select("store_id", (F.col("FALSE").cast("double") / 1e6).alias("nonholiday_m"),
                              (F.col("TRUE").cast("double") / 1e6).alias("holiday_m")))


def top_stores(by_store: DataFrame, n: int = 10) -> DataFrame:
    """The n stores with the highest totals; ties break by store."""
    return (by_store.groupBy("store_id").agg(F.sum("total_sales").alias("total_sales"))
            .orderBy(F.desc_nulls_last("total_sales"), F.asc("store_id")).limit(n))


def store_labels(by_store: DataFrame, n: int = 10) -> DataFrame:
    """Every store row in millions, with a text label on the rows of the n top stores."""
    marked = top_stores(by_store, n).select("store_id", F.lit(True).alias("is_top"))
    in_m = scaled("total_sales", 1e6)
    label = F.when(F.col("is_top"), F.concat(fixed(in_m, 0, commas=False), F.lit("M"))).otherwise(F.lit(""))
    return (_labelled(by_store).join(marked, "store_id", "left")
            .select("store_id", "store_type", "holiday", in_m.alias("total_sales_m"), label.alias("label")))


def store_split(by_store: DataFrame) -> DataFrame:
    """Store rows with a flag, beside the flag's total and its share of both."""
    flagged = by_store.where(F.col("isholiday").isNotNull())
    per_flag = flagged.groupBy("isholiday").agg(F.sum("total_sales").alias("flag_total"))
    # At most two rows, one per flag value: the window over both and the broadcast are bounded.
    both = F.sum("flag_total").over(W.partitionBy(F.lit(0)))
    per_flag = per_flag.withColumn("flag_pct", pct_of(F.col("flag_total"), both))
    return (flagged.join(F.broadcast(per_flag), "isholiday")
            .select("store_id", "store_type", "store_size", "isholiday", "total_sales", "avg_weekly_sales",
                    "weeks_of_data", "flag_total", "flag_pct"))
