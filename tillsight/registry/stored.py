"""The stored path of the ordered run: two deliveries versioned into a table, marts kept by month, read back.

The landed deliveries, the dimensions and the versioned table with its closed rows are written to the session's shared
folder, once per session and folder of tables; a mart and the monthly aggregate behind it once a query reads it.
"""

from __future__ import annotations

import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixtures
from ..operators import dims, facts, quality
from ..operators import versions as v
from ..plans.pipeline import DATE_DIM, STORE_DIM, Pipeline
from ..session import shared_folder
from .base import ORACLES, Retail, query
from .versions import BETWEEN, FIRST_ENDS, RUN_1, RUN_2, SECOND_STARTS, _shown


def kept(name: str, like: str):
    """Register a query that must give the rows of another one's SQL."""
    def add(fn):
        ORACLES[name] = ORACLES[like]
        return query(name)(fn)

    return add


@lru_cache(maxsize=8)
def _stored(spark: SparkSession, folder: str) -> Pipeline:
    """The versioned table after both deliveries, with its dimensions. The deliveries are landed once, from one pass over
    the lines, and dimensions and sources are read from there."""
    r = Retail(spark, folder)
    pipe = Pipeline(spark, f"{shared_folder(spark)}/stored-{uuid.uuid4().hex}")
    pipe.write_together({"bronze/department_both": fixtures.department_both(spark, folder), "bronze/fact_raw": r.fact_raw})
    landed, facts_landed = pipe.wh.table("bronze/department_both"), pipe.wh.table("bronze/fact_raw")
    pipe.write_together({DATE_DIM: dims.date_dim(landed), STORE_DIM: dims.store_dim(landed, r.stores_raw)})
    stores = pipe.wh.table(STORE_DIM)
    first = landed.where(F.col("store_date") < FIRST_ENDS).withColumn("weekly_sales", F.col("gross_sales"))
    second = landed.where(F.col("store_date") >= SECOND_STARTS)
    for delivery, run_ts in ((first, RUN_1), (second, RUN_2)):
        pipe.snapshot.run(facts.enriched(facts.sales(delivery), facts.economics(facts_landed), dims.date_dim(delivery), stores), run_ts)
    return pipe


def _with_mart(r: Retail, name: str) -> Pipeline:
    """The same with a mart, which is built, over its monthly aggregate, when a query first reads it."""
    pipe = _stored(r.spark, r.folder)
    if not pipe.wh.exists(f"gold/{name}"):
        pipe.build_marts(RUN_2, only=[name])
    return pipe


def _mart(r: Retail, name: str) -> DataFrame:
    return _with_mart(r, name).mart(name).drop("insert_date", "update_date")


@kept("kept_sales_by_dept", "current_sales_by_dept")
def kept_sales_by_dept(r: Retail) -> DataFrame:
    return _mart(r, "sales_by_dept")


@kept("kept_sales_by_store", "current_sales_by_store")
def kept_sales_by_store(r: Retail) -> DataFrame:
    return _mart(r, "sales_by_store")


@kept("kept_sales_by_date_parts", "current_sales_by_date_parts")
def kept_sales_by_date_parts(r: Retail) -> DataFrame:
    return _mart(r, "sales_by_date_parts")


@kept("kept_sales_by_storetype_month", "current_sales_by_storetype_month")
def kept_sales_by_storetype_month(r: Retail) -> DataFrame:
    return _mart(r, "sales_by_storetype_month")


@kept("kept_markdown_by_year_store", "current_markdown_by_year_store")
def kept_markdown_by_year_store(r: Retail) -> DataFrame:
    return _mart(r, "markdown_by_year_store")


@kept("kept_economic_factors", "current_economic_factors")
def kept_economic_factors(r: Retail) -> DataFrame:
    return _mart(r, "economic_factors")


@kept("kept_dq_report", "current_dq_report")
def kept_dq_report(r: Retail) -> DataFrame:
    pipe = _with_mart(r, "sales_by_store")
    return quality.suite(pipe.wh.table(DATE_DIM), pipe.wh.table(STORE_DIM), pipe.snapshot.current(), pipe.mart("sales_by_store"))


@kept("kept_snapshot", "scd2_snapshot")
def kept_snapshot(r: Retail) -> DataFrame:
    return _shown(_stored(r.spark, r.folder).snapshot.history())


@kept("kept_as_of", "snapshot_as_of")
def kept_as_of(r: Retail) -> DataFrame:
    return _shown(_stored(r.spark, r.folder).snapshot.as_of(BETWEEN))


@kept("kept_version_counts", "snapshot_version_counts")
def kept_version_counts(r: Retail) -> DataFrame:
    return v.version_counts(_stored(r.spark, r.folder).snapshot.history())
