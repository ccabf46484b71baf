"""The path of the ordered run: open rows of the versioned table, store-week aggregate, marts and checks."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame

from ..functions.keys import surrogate_key
from ..operators import facts, quality
from ..operators import versions as v
from ..plans import marts
from ..session import shared_folder
from ..sources.warehouse import Warehouse
from .base import TABLES, Retail, query
from .checks import REPORT_SQL
from .versions import _history

# After both deliveries a key's open row has the second's values, or the first's where it is missing there.
TABLES |= {"open_rows": """
    SELECT * FROM second_source
    UNION ALL
    SELECT * FROM first_source WHERE snapshot_key NOT IN (SELECT snapshot_key FROM second_source)""",
           "open_by_store": re.sub(r"\benriched\b", "open_rows", TABLES["by_store"])}


def _over_open(table: str) -> str:
    return re.sub(r"\benriched\b", "open_rows", TABLES[table])


def _rows(r: Retail) -> DataFrame:
    return marts.row_measures(v.current_rows(_history(r)))


def _weeks(r: Retail) -> DataFrame:
    return marts.store_week(_rows(r))


@query("current_sales_by_dept", _over_open("by_dept"))
def current_sales_by_dept(r: Retail) -> DataFrame:
    return marts.sales_by_dept(_rows(r))


@query("current_sales_by_store", _over_open("by_store"))
def current_sales_by_store(r: Retail) -> DataFrame:
    return marts.sales_by_store(_weeks(r), r.store_dim, r.date_dim)


@query("current_sales_by_date_parts", _over_open("by_date"))
def current_sales_by_date_parts(r: Retail) -> DataFrame:
    return marts.sales_by_date_parts(_weeks(r), r.date_dim)


@query("current_sales_by_storetype_month", _over_open("by_type"))
def current_sales_by_storetype_month(r: Retail) -> DataFrame:
    return marts.sales_by_storetype_month(_weeks(r), r.store_dim)


@query("current_markdown_by_year_store", _over_open("markdowns"))
def current_markdown_by_year_store(r: Retail) -> DataFrame:
    return marts.markdown_by_year_store(_weeks(r), r.store_dim)


@query("current_economic_factors", _over_open("factors"))
def current_economic_factors(r: Retail) -> DataFrame:
    return marts.economic_factors(_weeks(r))


@query("current_dq_report", re.sub(r"\bby_store\b", "open_by_store", re.sub(r"\benriched\b", "open_rows", REPORT_SQL)))
def current_dq_report(r: Retail) -> DataFrame:
    """Two checks each read the dimensions and the open rows, which are therefore made once and kept on the session's shared
    folder; of the rows, the columns that the checks read, and the key as the parts it is the hash of."""
    wh = Warehouse(r.spark, f"{shared_folder(r.spark)}/current-{uuid.uuid4().hex}")
    dates, stores = wh.write(r.date_dim, "current/date_dim"), wh.write(r.store_dim, "current/store_dim")
    read = v.current_rows(_history(r)).select(*facts.KEY_PARTS, marts.SALES)
    current = wh.write(read, "current/sales").withColumn(facts.KEY, surrogate_key(*facts.KEY_PARTS))
    by_store = marts.sales_by_store(marts.store_week(marts.row_measures(current)), stores, dates)
    return quality.suite(dates, stores, current, by_store)
