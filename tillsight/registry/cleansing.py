"""Scalar cleansing, filters, joins and plain aggregates over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import calendar, casts, keys, labels, measures
from ..operators import dims, facts
from ..schemas import FACT_COLUMNS, MARKDOWNS
from ..sources.landing import correct
from .base import Retail, avg, query, total


@query("null_tokens", f"""
SELECT {', '.join(f"CASE WHEN {c} NOT IN ('NULL', 'null', 'NA') THEN {c} END AS {c}" for c in FACT_COLUMNS)}
FROM fact_raw""")
def null_tokens(r: Retail) -> DataFrame:
    return casts.null_if(r.fact_raw)


@query("bronze_correction", """
SELECT store_id, dept_id, store_date,
       CASE WHEN store_id = '1' AND dept_id = '1' THEN '99999.99' ELSE weekly_sales END AS weekly_sales, isholiday
FROM department_raw""")
def bronze_correction(r: Retail) -> DataFrame:
    return correct(r.department_raw, (F.col("store_id") == "1") & (F.col("dept_id") == "1"),
                   {"weekly_sales": "99999.99"})


@query("decimal_to_double", f"""
SELECT store_id, store_date, cast(temperature AS double) AS temperature, cast(fuel_price AS double) AS fuel_price,
       cast(cpi AS double) AS cpi, cast(unemployment AS double) AS unemployment,
       {', '.join(f'cast({m} AS double) AS {m}' for m in MARKDOWNS)}
FROM economics""")
def decimal_to_double(r: Retail) -> DataFrame:
    return casts.decimals_to_double(r.economics)


@query("cast_int", """
SELECT cast(store_id AS int) AS store_id, cast(dept_id AS int) AS dept_id, store_date FROM department_raw""")
def cast_int(r: Retail) -> DataFrame:
    return r.department_raw.select(casts.to_int("store_id").alias("store_id"),
                                   casts.to_int("dept_id").alias("dept_id"), "store_date")


@query("parse_date", """
SELECT store_id, dept_id, strptime(store_date, '%Y-%m-%d')::date AS store_date FROM department_raw""")
def parse_date(r: Retail) -> DataFrame:
    return r.department_raw.select("store_id", "dept_id", casts.parse_date("store_date").alias("store_date"))


@query("try_cast_decimal", """
SELECT store_id, dept_id, store_date, cast(try_cast(weekly_sales AS decimal(18,2)) AS double) AS weekly_sales
FROM department_raw""")
def try_cast_decimal(r: Retail) -> DataFrame:
    return r.department_raw.select("store_id", "dept_id", "store_date",
                                   casts.try_decimal("weekly_sales", 18, 2).alias("weekly_sales"))


@query("cast_bool", """
SELECT store_id, dept_id, store_date, cast(isholiday AS boolean) AS isholiday FROM department_raw""")
def cast_bool(r: Retail) -> DataFrame:
    return r.department_raw.select("store_id", "dept_id", "store_date",
                                   casts.to_bool("isholiday").alias("isholiday"))


@query("null_default", f"""
SELECT store_id, store_date, {', '.join(f'cast(coalesce({m}, 0) AS double) AS {m}' for m in MARKDOWNS)}
FROM economics""")
def null_default(r: Retail) -> DataFrame:
    return r.economics.select("store_id", "store_date", *[measures.null_default(m).alias(m) for m in MARKDOWNS])


@query("row_sum", f"""
SELECT store_id, store_date, cast({' + '.join(f'coalesce({m}, 0)' for m in MARKDOWNS)} AS double) AS total_markdowns
FROM economics""")
def row_sum(r: Retail) -> DataFrame:
    return r.economics.select("store_id", "store_date", measures.row_sum(*MARKDOWNS).alias("total_markdowns"))


@query("date_parts", """
SELECT store_date, cast(year(store_date) AS int) AS sales_year, cast(month(store_date) AS int) AS sales_month,
       strftime(store_date, '%b') AS month_name, cast(weekofyear(store_date) AS int) AS week_of_year,
       strftime(store_date, '%Y-%m') AS year_month
FROM date_dim""")
def date_parts(r: Retail) -> DataFrame:
    return r.date_dim.select("store_date", *calendar.date_parts())


@query("month_name_map", """
SELECT DISTINCT cast(month(store_date) AS int) AS sales_month, strftime(store_date, '%b') AS month_name FROM sales""")
def month_name_map(r: Retail) -> DataFrame:
    months = r.sales.select(F.month("store_date").alias("sales_month")).distinct()
    return months.withColumn("month_name", calendar.month_name("sales_month"))


@query("surrogate_key", """
SELECT store_id, dept_id, store_date, snapshot_key FROM enriched""")
def surrogate_key(r: Retail) -> DataFrame:
    return r.sales.select("store_id", "dept_id", "store_date",
                          keys.surrogate_key(*facts.KEY_PARTS).alias("snapshot_key"))


@query("dept_label", """
SELECT store_id, dept_id, 'Dept ' || dept_id || chr(10) || '(Store ' || store_id || ')' AS label,
       'Dept ' || dept_id || ' (Store ' || store_id || ')' AS label_line
FROM store_dim""")
def dept_label(r: Retail) -> DataFrame:
    return r.store_dim.select("store_id", "dept_id", labels.dept_label().alias("label"),
                              labels.dept_label(" ").alias("label_line"))


@query("holiday_label", """
SELECT DISTINCT store_date, isholiday,
       CASE WHEN upper(isholiday) IN ('TRUE', '1', 'YES') THEN 'TRUE' ELSE 'FALSE' END AS token_label,
       CASE WHEN length(isholiday) > 0 THEN 'TRUE' ELSE 'FALSE' END AS truthy_text_label,
       CASE WHEN cast(isholiday AS boolean) THEN 'TRUE' ELSE 'FALSE' END AS truthy_flag_label,
       CASE WHEN cast(isholiday AS boolean) = true THEN 'TRUE' ELSE 'FALSE' END AS equals_label
FROM department_raw""")
def holiday_label(r: Retail) -> DataFrame:
    flag = casts.to_bool("isholiday")
    dates = r.department_raw.select("store_date", "isholiday").distinct()
    return dates.select("store_date", "isholiday",
                        labels.holiday_label("isholiday").alias("token_label"),
                        labels.holiday_label("isholiday", "truthy").alias("truthy_text_label"),
                        labels.holiday_label(flag, "truthy").alias("truthy_flag_label"),
                        labels.holiday_label(flag, "equals").alias("equals_label"))


@query("not_null_filter", """
SELECT store_id, store_date, cast(markdown1 AS double) AS markdown1 FROM economics WHERE markdown1 IS NOT NULL""")
def not_null_filter(r: Retail) -> DataFrame:
    return r.economics.where(F.col("markdown1").isNotNull()).select("store_id", "store_date", "markdown1")


@query("dedup_first", """
SELECT store_id, dept_id, store_date, cast(store_weekly_sales AS double) AS store_weekly_sales FROM (
    SELECT *, row_number() OVER (PARTITION BY store_id, dept_id ORDER BY store_date) AS rn FROM sales) WHERE rn = 1""")
def dedup_first(r: Retail) -> DataFrame:
    return dims.first_per_key(r.sales, ["store_id", "dept_id"], ["store_date"])


@query("fact_enriched", f"""
SELECT snapshot_key, store_id, dept_id, date_id, store_date, store_type, store_size,
       {', '.join(f'cast({c} AS double) AS {c}' for c in
                  ['store_weekly_sales', 'fuel_price', 'temperature', 'cpi', 'unemployment', *MARKDOWNS])}
FROM enriched""")
def fact_enriched(r: Retail) -> DataFrame:
    return r.enriched


@query("agg_basic", f"""
SELECT store_id, {total('store_weekly_sales', 'total_sales')}, {avg('store_weekly_sales', 'avg_weekly_sales')},
       cast(min(store_weekly_sales) AS double) AS min_weekly_sales,
       cast(max(store_weekly_sales) AS double) AS max_weekly_sales
FROM sales GROUP BY store_id""")
def agg_basic(r: Retail) -> DataFrame:
    amount = F.col("store_weekly_sales")
    return r.sales.groupBy("store_id").agg(
        F.sum(amount).alias("total_sales"),
        measures.mean_of(F.sum(amount), F.count(amount)).alias("avg_weekly_sales"),
        F.min(amount).alias("min_weekly_sales"), F.max(amount).alias("max_weekly_sales"))


@query("count_distinct", """
SELECT store_id, count(DISTINCT store_date) AS weeks, count(DISTINCT dept_id) AS depts FROM sales GROUP BY store_id""")
def count_distinct(r: Retail) -> DataFrame:
    def distinct(column: str, name: str) -> DataFrame:
        return r.sales.select("store_id", column).distinct().groupBy("store_id").agg(F.count(column).alias(name))

    # Two small distincts instead of one aggregate that copies every row per counted column.
    return distinct("store_date", "weeks").join(distinct("dept_id", "depts"), "store_id")


@query("to_timestamp", "SELECT store_id, dept_id, strftime(store_date, '%Y-%m-%d %H:%M:%S') AS at FROM sales")
def to_timestamp(r: Retail) -> DataFrame:
    return r.sales.select("store_id", "dept_id", F.date_format(casts.to_timestamp("store_date"), "yyyy-MM-dd HH:mm:ss").alias("at"))


@query("distinct_pairs", "SELECT DISTINCT store_id, dept_id FROM sales")
def distinct_pairs(r: Retail) -> DataFrame:
    return r.sales.select("store_id", "dept_id").distinct()


@query("date_dim", "SELECT date_id, store_date, isholiday FROM date_dim")
def date_dim(r: Retail) -> DataFrame:
    return r.date_dim


@query("store_dim", "SELECT store_id, dept_id, store_type, store_size FROM store_dim")
def store_dim(r: Retail) -> DataFrame:
    return r.store_dim


@query("store_type_dedup", "SELECT store_id, max(store_type) AS store_type FROM store_dim GROUP BY store_id")
def store_type_dedup(r: Retail) -> DataFrame:
    return dims.one_type_per_store(r.store_dim)
