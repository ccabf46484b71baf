"""Data-quality checks over the dimensions, the current sales and the store mart."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators import quality
from .base import Retail, query


def _unique_sql(table: str, name: str, *columns: str) -> str:
    cols = ", ".join(columns)
    kind = "unique" if len(columns) == 1 else "unique_combination"
    return f"""
SELECT '{kind}_{name}_{'__'.join(columns)}' AS check_name, count(*) AS failures, count(*) = 0 AS passed
FROM (SELECT {cols} FROM {table} GROUP BY {cols} HAVING count(*) > 1)"""


def _not_null_sql(table: str, name: str, *columns: str) -> str:
    return " UNION ALL ".join(f"""
SELECT 'not_null_{name}_{c}' AS check_name, count(*) FILTER ({c} IS NULL) AS failures,
       count(*) FILTER ({c} IS NULL) = 0 AS passed FROM {table}""" for c in columns)


_UNIQUE = [_unique_sql("date_dim", "date_dim", "date_id"), _unique_sql("enriched", "fact_snapshot", "snapshot_key")]
_COMBOS = [_unique_sql("store_dim", "store_dim", "store_id", "dept_id"),
           _unique_sql("by_store", "sales_by_store", "store_id", "isholiday")]
_NOT_NULL = [_not_null_sql("date_dim", "date_dim", "date_id", "store_date"),
             _not_null_sql("store_dim", "store_dim", "store_id", "dept_id"),
             _not_null_sql("enriched", "fact_snapshot", "snapshot_key", "store_id", "dept_id", "store_date"),
             _not_null_sql("by_store", "sales_by_store", "store_id")]


@query("dq_unique", " UNION ALL ".join(_UNIQUE))
def dq_unique(r: Retail) -> DataFrame:
    return (quality.unique(r.date_dim, "date_dim", "date_id")
            .unionByName(quality.unique(r.enriched, "fact_snapshot", "snapshot_key")))


@query("dq_unique_combo", " UNION ALL ".join(_COMBOS))
def dq_unique_combo(r: Retail) -> DataFrame:
    return (quality.unique(r.store_dim, "store_dim", "store_id", "dept_id")
            .unionByName(quality.unique(r.by_store, "sales_by_store", "store_id", "isholiday")))


@query("dq_not_null", " UNION ALL ".join(_NOT_NULL))
def dq_not_null(r: Retail) -> DataFrame:
    return (quality.not_null(r.date_dim, "date_dim", "date_id", "store_date")
            .unionByName(quality.not_null(r.store_dim, "store_dim", "store_id", "dept_id"))
            .unionByName(quality.not_null(r.enriched, "fact_snapshot", "snapshot_key", "store_id", "dept_id",
                                          "store_date"))
            .unionByName(quality.not_null(r.by_store, "sales_by_store", "store_id")))


REPORT_SQL = " UNION ALL ".join([*_UNIQUE, *_COMBOS, *_NOT_NULL])


@query("dq_report", REPORT_SQL)
def dq_report(r: Retail) -> DataFrame:
    return quality.suite(r.date_dim, r.store_dim, r.enriched, r.by_store)
