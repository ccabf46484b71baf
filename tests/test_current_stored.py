"""Checks over open rows make dimensions and rows once and read them stored."""

import datetime as dt
import re

from conftest import rows
from pyspark.sql import functions as F

from tillsight import fixtures
from tillsight.registry import current
from tillsight.registry.base import Retail


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_checks_over_open_rows_read_them_stored(spark, tmp_path):
    line = [(1, 1, 1, 2.0, 100.0, 0.1, 0.02, "N", dt.datetime(1998, 3, 6)), (1, 1, 2, 2.0, 50.0, 0.1, 0.02, None, dt.datetime(1998, 3, 6))]
    for name, (schema, items) in {"lineitem": (fixtures.LINEITEM, line), "part": (fixtures.PART, [(1, 10)]),
                                  "supplier": (fixtures.SUPPLIER, [(1, 0)])}.items():
        spark.createDataFrame(items, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    r = Retail(spark, str(tmp_path))
    report = current.current_dq_report(r)
    assert len(rows(report)) == 13 and all(c.passed for c in report.collect())
    assert "lineitem" not in "".join(report.inputFiles())
    grouped = plan(r.date_dim)
    assert "dept_id" not in re.sub(r"Location.*", "", grouped).split("hashpartitioning(store_date")[0] and "l_extendedprice" not in grouped
    assert rows(r.date_dim, "store_date") == rows(r.department_raw.select(F.col("store_date").cast("date")).distinct())
