"""Landing-shaped tables derived from a star schema of orders.

Suppliers stand for stores, part sizes for departments and shipping weeks for sales weeks. The
result has the shape and text types of delivered files, so every operator runs on it unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .schemas import FACT_COLUMNS, MARKDOWNS

# Weeks of the year that count as holidays, and the first year with markdowns.
HOLIDAY_WEEKS = [6, 36, 47, 52]
FIRST_MARKDOWN_YEAR = 1997


# Declared types of the columns read, so that opening a table starts no job.
LINEITEM = ("l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
            "l_discount double, l_tax double, l_returnflag string, l_shipdate timestamp_ntz")
PART = "p_partkey bigint, p_size int"
SUPPLIER = "s_suppkey bigint, s_nationkey int"


def _read(spark: SparkSession, folder: str, table: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{folder}/{table}.parquet")


def _friday(ts: str) -> Column:
    """Friday of the ISO week."""
    day = F.col(ts).cast("date")
    return F.date_add(day, 4 - F.weekday(day))


def _hundredths(c: str) -> Column:
    """A double with at most two decimals as a whole number of hundredths."""
    return F.rint(F.col(c) * 100).cast("bigint")


def _half_up(ten_thousandths: Column) -> Column:
    """Non-negative ten-thousandths to hundredths, halves up."""
    return F.floor((ten_thousandths + 50) / 100)


def _text(hundredths: Column) -> Column:
    """Hundredths as text with two decimals."""
    return (hundredths.cast("decimal(26,0)") / 100).cast("decimal(28,2)").cast("string")


def lines(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines with store, week and amounts in cents, so that sums are exact and cheap."""
    li = _read(spark, folder, "lineitem", LINEITEM)
    px, di = _hundredths("l_extendedprice"), _hundredths("l_discount")
    return li.select(
        F.col("l_suppkey").cast("int").alias("store_id"), "l_partkey", "l_linenumber",
        F.coalesce(F.col("l_returnflag") == "R", F.lit(False)).alias("returned"),
        _friday("l_shipdate").alias("store_date"), px.alias("px"), di.alias("di"),
        _hundredths("l_tax").alias("tx"), _hundredths("l_quantity").alias("qty"),
        _half_up(px * (100 - di)).alias("amount"))


def stores_raw(spark: SparkSession, folder: str) -> DataFrame:
    nation, key = F.col("s_nationkey"), F.col("s_suppkey")
    kind = F.get(F.array(F.lit("A"), F.lit("B"), F.lit("C")), nation % 3)
    return _read(spark, folder, "supplier", SUPPLIER).select(
        key.cast("string").alias("store_id"), kind.alias("store_type"),
        (34000 + (key * 997) % 185000).cast("string").alias("store_size"))


def department_raw(spark: SparkSession, folder: str, net: bool = True) -> DataFrame:
    """Weekly sales per store and department; returned lines count negative unless ``net`` is off."""
    return _departments(spark, folder, {"weekly_sales": net})


def department_both(spark: SparkSession, folder: str) -> DataFrame:
    """``department_raw`` with the gross amounts as ``gross_sales`` beside the net ones, from one pass over the lines."""
    return _departments(spark, folder, {"weekly_sales": True, "gross_sales": False})


def _departments(spark: SparkSession, folder: str, amounts: dict[str, bool]) -> DataFrame:
    gross = F.col("amount")
    less_returns = F.when(F.col("returned"), -gross).otherwise(gross)
    grouped = (_department_lines(spark, folder).groupBy("store_id", "dept_id", "store_date")
               .agg(*[F.sum(less_returns if net else gross).alias(name) for name, net in amounts.items()]))
    return _department_text(grouped, list(amounts))


def department_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Stores, departments, dates and flags of ``department_raw`` before its lines are grouped, so each as often as it has
    lines: for what takes them distinct."""
    return _department_text(_department_lines(spark, folder), [])


def _department_lines(spark: SparkSession, folder: str) -> DataFrame:
    part = _read(spark, folder, "part", PART).select(
        F.col("p_partkey").alias("l_partkey"), F.col("p_size").alias("dept_id"))
    return lines(spark, folder).join(part, "l_partkey")


def _department_text(rows: DataFrame, amounts: list[str]) -> DataFrame:
    missing = (F.col("store_id") * 7 + F.col("dept_id")) % 97 == 0
    holiday = F.weekofyear("store_date").isin(HOLIDAY_WEEKS)
    return rows.select(
        F.col("store_id").cast("string").alias("store_id"), F.col("dept_id").cast("string").alias("dept_id"),
        F.col("store_date").cast("string").alias("store_date"),
        *[F.when(missing, F.lit("NA")).otherwise(_text(F.col(name))).alias(name) for name in amounts],
        F.when(holiday, F.lit("TRUE")).otherwise(F.lit("FALSE")).alias("isholiday"))


def fact_raw(spark: SparkSession, folder: str) -> DataFrame:
    """Economics and markdowns per store and week."""
    def markdown(k: int) -> Column:
        counts = ((F.col("l_linenumber") == k) & (F.col("di") > 0)
                  & (F.year("store_date") >= FIRST_MARKDOWN_YEAR))
        total = F.sum(F.when(counts, _half_up(F.col("px") * F.col("di"))))
        return F.coalesce(_text(total), F.lit("NA")).alias(f"markdown{k}")

    grouped = lines(spark, folder).groupBy("store_id", "store_date").agg(
        _text(F.sum("qty")).alias("temperature"),
        _text(F.max("tx") + 200).alias("fuel_price"),
        _text(F.max("px")).alias("cpi"),
        _text(F.min("di") * 100).alias("unemployment"),
        *[markdown(k) for k in range(1, len(MARKDOWNS) + 1)])
    return (grouped.withColumns({
        "isholiday": F.when(F.weekofyear("store_date").isin(HOLIDAY_WEEKS), F.lit("TRUE")).otherwise(F.lit("FALSE")),
        "store_id": F.col("store_id").cast("string"), "store_date": F.col("store_date").cast("string")})
        .select(*FACT_COLUMNS))
