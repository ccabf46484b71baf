"""Named queries: the SQL agrees, and the plans keep their shape."""

import re
from pathlib import Path

import pytest

import compare
from tillsight.registry import ORACLES, QUERIES
from tillsight.registry.base import Retail

SMALL = "/root/testdata/sf0.001"
# One of each kind; compare.py runs them all.
SAMPLE = ["null_tokens", "fact_enriched", "store_dim", "sales_by_dept", "sales_by_store", "sales_by_storetype_month",
          "sales_by_date_parts", "markdown_by_year_store_dedup", "economic_factors", "share_by_store_type",
          "store_holiday_split", "markdown_by_year", "storetype_month_table", "yoy_week_num", "trend_line",
          "scd2_snapshot", "date_dim_incremental", "scd1_merge_composite", "dq_report", "dept_share", "to_timestamp",
          "markdown_in_year", "storetype_size_totals", "current_sales_by_store", "current_dq_report",
          "kept_sales_by_dept", "kept_sales_by_store", "kept_markdown_by_year_store", "kept_dq_report", "kept_snapshot", "kept_as_of"]

pytestmark = pytest.mark.skipif(not Path(SMALL).exists(), reason="needs the generated tables")


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES) and len(QUERIES) >= 107


@pytest.mark.parametrize("name", SAMPLE)
def test_sql_agrees(spark, name):
    text, n = compare.difference(spark, SMALL, name)
    assert text == "" and n > 0


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, SMALL))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "Python" not in text and "ArrowEval" not in text


def test_scan_reads_only_needed_columns(spark):
    text = plan(QUERIES["sales_by_dept"](spark, SMALL))
    read = re.search(r"FileScan parquet \[(l_[^\]]*)\]", text).group(1)
    assert {c.split("#")[0] for c in read.split(",")} == {
        "l_partkey", "l_suppkey", "l_extendedprice", "l_discount", "l_returnflag", "l_shipdate"}


def test_sales_are_aggregated_before_they_meet_economics(spark):
    text = plan(Retail(spark, SMALL).weeks)
    join = text.index("Join")
    assert "HashAggregate" in text[join:] and text.count("HashAggregate") >= 4
