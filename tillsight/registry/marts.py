"""The six aggregate tables, as written and without the repetition by department."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans import marts
from .base import Retail, query


@query("sales_by_dept", "SELECT * FROM by_dept")
def sales_by_dept(r: Retail) -> DataFrame:
    return r.by_dept


@query("sales_by_store", "SELECT * FROM by_store")
def sales_by_store(r: Retail) -> DataFrame:
    return r.by_store


@query("sales_by_store_dedup", "SELECT * FROM by_store_dedup")
def sales_by_store_dedup(r: Retail) -> DataFrame:
    return marts.sales_by_store(r.rows, r.store_dim, r.date_dim, fan_out=False)


@query("sales_by_date_parts", "SELECT * FROM by_date")
def sales_by_date_parts(r: Retail) -> DataFrame:
    return r.by_date


@query("sales_by_storetype_month", "SELECT * FROM by_type")
def sales_by_storetype_month(r: Retail) -> DataFrame:
    return r.by_type


@query("sales_by_storetype_month_dedup", "SELECT * FROM by_type_dedup")
def sales_by_storetype_month_dedup(r: Retail) -> DataFrame:
    return marts.sales_by_storetype_month(r.rows, r.store_dim, fan_out=False)


@query("markdown_by_year_store", "SELECT * FROM markdowns")
def markdown_by_year_store(r: Retail) -> DataFrame:
    return r.markdowns


@query("markdown_by_year_store_dedup", "SELECT * FROM markdowns_dedup")
def markdown_by_year_store_dedup(r: Retail) -> DataFrame:
    return marts.markdown_by_year_store(r.weeks, r.store_dim, per_week=True)


@query("economic_factors", "SELECT * FROM factors")
def economic_factors(r: Retail) -> DataFrame:
    return r.factors


@query("sorted_output", "SELECT * FROM by_type ORDER BY year_month, store_type")
def sorted_output(r: Retail) -> DataFrame:
    return r.by_type.orderBy("year_month", "store_type")


@query("filter_eq", "SELECT * FROM by_store WHERE isholiday AND store_type = 'A'")
def filter_eq(r: Retail) -> DataFrame:
    return r.by_store.where(F.col("isholiday") & (F.col("store_type") == "A"))
