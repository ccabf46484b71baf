"""Time the headline queries and print one JSON line.

Plain names run a registered query from the given tables to its result. ``stored_*`` names read
the versioned sales table as the ordered run stores it, ``snapshot_*`` names are runs of that table
with the given share of changed keys.

    BENCH_SF_DIR  folder of tables (default /root/testdata/sf0.1)
    BENCH_CPUS    local cores (default: all)
    BENCH_RUNS    timed runs per query after one warm-up (default 2); the median counts
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import functions as F

from tillsight.operators import dims, facts
from tillsight.operators.snapshot import SnapshotTable
from tillsight.plans import marts
from tillsight.registry import QUERIES
from tillsight.registry.base import Retail
from tillsight.session import local_session
from tillsight.sources.csv_files import with_audit
from tillsight.sources.warehouse import Warehouse

HEADLINE = [
    "sales_by_dept", "sales_by_store", "sales_by_date_parts", "sales_by_storetype_month", "markdown_by_year_store",
    "markdown_by_year_store_dedup", "economic_factors", "fact_enriched", "scd2_snapshot", "scd1_merge_composite",
    "date_dim", "store_dim", "top20_dept", "share_by_store_type", "holiday_summary", "storetype_month_totals",
    "econ_weekly", "dq_report",
]


def measure(spark, folder: str, name: str, runs: int) -> float:
    def once() -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    once()
    return statistics.median(once() for _ in range(runs))


def stored(spark, folder: str, runs: int, note) -> dict[str, float]:
    """Marts over stored tables and repeated versioning runs, in a scratch folder."""
    r = Retail(spark, folder)
    wh = Warehouse(spark, tempfile.mkdtemp(prefix="run-", dir=os.environ.get("BENCH_SCRATCH", "/tmp")))
    seconds = {}

    def clock(name: str, job, times: int = 1) -> None:
        took = []
        for _ in range(times):
            start = time.perf_counter()
            job()
            took.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(took), 3)
        note(name, seconds[name])

    # Landing tables and dimensions as files, so that the runs below start where a real one does.
    for name in ("stores_raw", "department_raw", "fact_raw"):
        wh.write(getattr(r, name), name)
    dates = wh.write(dims.date_dim(wh.table("department_raw")), "date_dim")
    stores = wh.write(dims.store_dim(wh.table("department_raw"), wh.table("stores_raw")), "store_dim")
    source = with_audit(facts.enriched(facts.sales(wh.table("department_raw")),
                                       facts.economics(wh.table("fact_raw")), dates, stores), "2024-01-01 00:00:00")
    table = SnapshotTable(wh, "fact_snapshot")
    clock("snapshot_first", lambda: table.run(source, "2024-01-01 00:00:00"))
    clock("snapshot_0pct", lambda: table.run(source, "2024-01-02 00:00:00"))
    for n, pct in enumerate((1, 10), 3):
        hit = F.pmod(F.xxhash64("snapshot_key"), F.lit(100)) < pct
        changed = source.withColumn("store_weekly_sales", F.when(hit, F.lit(n)).otherwise(
            F.col("store_weekly_sales")).cast("decimal(18,2)"))
        clock(f"snapshot_{pct}pct", lambda c=changed, n=n: table.run(c, f"2024-01-0{n} 00:00:00"))

    rows = marts.row_measures(table.current())
    weeks = wh.write(marts.store_week(rows), "store_week")
    plans = {
        "stored_store_week": lambda: marts.store_week(rows),
        "stored_sales_by_dept": lambda: marts.sales_by_dept(rows),
        "stored_sales_by_store": lambda: marts.sales_by_store(weeks, stores, dates),
        "stored_sales_by_date_parts": lambda: marts.sales_by_date_parts(weeks, dates),
        "stored_sales_by_storetype_month": lambda: marts.sales_by_storetype_month(weeks, stores),
        "stored_markdown_by_year_store": lambda: marts.markdown_by_year_store(weeks, stores),
        "stored_economic_factors": lambda: marts.economic_factors(weeks),
        # The join as literally written, for comparison with the multiplied form.
        "literal_sales_by_store": lambda: literal_sales_by_store(table.current(), stores, dates),
    }
    for name, plan in plans.items():
        def job(p=plan):
            p().write.format("noop").mode("overwrite").save()

        job()
        clock(name, job, runs)
    return seconds


def literal_sales_by_store(current, stores, dates):
    amount = F.col("store_weekly_sales")
    joined = (current.select("store_id", "store_date", "store_weekly_sales")
              .join(stores.select("store_id", "store_type", "store_size"), "store_id")
              .join(dates.select("store_date", "isholiday"), "store_date"))
    return joined.groupBy("store_id", "store_type", "store_size", "isholiday").agg(
        F.count_distinct("store_date").alias("weeks_of_data"), F.sum(amount).alias("total_sales"),
        F.avg(amount).alias("avg_weekly_sales"), F.max(amount).alias("max_weekly_sales"),
        F.min(amount).alias("min_weekly_sales"))


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS") or str(os.cpu_count() or 8)
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cores, shuffle_partitions=int(cores), memory="8g", app="bench")
    seconds = {}

    def note(name: str, took: float) -> None:
        print(f"{name}: {took}s", file=sys.stderr, flush=True)

    for name in names:
        seconds[name] = round(measure(spark, folder, name, runs), 3)
        note(name, seconds[name])
    if not sys.argv[1:]:
        seconds |= stored(spark, folder, runs, note)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": folder.rstrip("/").rsplit("sf", 1)[-1], "cpus": int(cores),
                      "runs": runs}))
    spark.stop()


if __name__ == "__main__":
    main()
