"""The ordered run: landing, dimensions, versioned sales, marts, checks."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import dims, facts, quality
from ..operators.snapshot import BUCKET, MONTH, SnapshotTable, dealt, largest_month
from ..session import shuffles_freed, tune
from ..sources.csv_files import with_audit
from ..sources.landing import LandingZone
from ..sources.warehouse import Warehouse
from . import affected, departments, economy, holiday, markdowns, marts, seasons, storetypes

log = logging.getLogger(__name__)

DATE_DIM, STORE_DIM = "silver/date_dim", "silver/store_dim"
STORE_WEEK, DEPT_MONTH = "silver/store_week", "silver/dept_month"
DEPARTMENT_KEY = ["store_id", "dept_id", "store_date"]
MARTS = ["sales_by_dept", "sales_by_store", "sales_by_date_parts", "sales_by_storetype_month",
         "markdown_by_year_store", "economic_factors", "holiday_impact"]


@dataclass
class RunReport:
    loaded: dict[str, int] = field(default_factory=dict)
    snapshot: dict[str, int] = field(default_factory=dict)
    failed_checks: list[str] = field(default_factory=list)
    doubtful_dates: list[str] = field(default_factory=list)


class Pipeline:
    """All tables live under one shared folder; every step is re-runnable after a failure."""

    def __init__(self, spark: SparkSession, root: str, date_ids: str = "stable"):
        self.spark = tune(spark)
        self.wh = Warehouse(spark, root)
        self.landing = LandingZone(self.wh)
        self.snapshot = SnapshotTable(self.wh)
        self.date_ids = date_ids

    @contextmanager
    def _step(self, name: str) -> Iterator[None]:
        """Name the step's jobs, so that they can be told apart in the Spark UI and logs."""
        log.info("start %s", name)
        self.spark.sparkContext.setJobDescription(name)
        try:
            yield
        finally:
            self.spark.sparkContext.setJobDescription(None)

    # --- steps -------------------------------------------------------------------------------

    def load(self, folder: str, mode: str = "once", run_ts: str | None = None) -> dict[str, int]:
        with self._step("load"):
            return self.landing.load_all(folder, mode, run_ts)

    def build_dims(self, run_ts: str | None = None, full_refresh: bool = False,
                   delivered: DataFrame | None = None) -> None:
        """Upsert the dimensions from all landed department rows, or from those just ``delivered``."""
        departments = self.landing.table("department_raw") if delivered is None else delivered
        self._together({
            "date_dim": partial(self._build_date_dim, departments, run_ts, full_refresh),
            "store_dim": partial(self._build_store_dim, departments, run_ts, full_refresh),
        })

    def _build_date_dim(self, departments: DataFrame, run_ts: str | None, full_refresh: bool) -> None:
        with self._step("date_dim"):
            if full_refresh or not self.wh.exists(DATE_DIM):
                out = with_audit(dims.date_dim(departments), run_ts)
            else:
                existing = self.wh.table(DATE_DIM)
                fresh = dims.date_dim_increment(departments, existing, self.date_ids)
                out = dims.upsert(existing, with_audit(fresh, run_ts), ["date_id"])
            self.wh.write(out, DATE_DIM)

    def _build_store_dim(self, departments: DataFrame, run_ts: str | None, full_refresh: bool) -> None:
        with self._step("store_dim"):
            fresh = with_audit(dims.store_dim(departments, self.landing.table("stores_raw")), run_ts)
            if full_refresh or not self.wh.exists(STORE_DIM):
                out = fresh
            else:
                out = dims.upsert(self.wh.table(STORE_DIM), fresh, ["store_id", "dept_id"])
            self.wh.write(out, STORE_DIM)

    def snapshot_source(self, run_ts: str | None = None, delivered: DataFrame | None = None,
                        touched: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
        """Source rows of the versioned table, of all landed department rows or of those ``delivered``, and of
        these all or those that ``touched`` picks."""
        departments = self.landing.settled("department_raw", DEPARTMENT_KEY) if delivered is None else delivered
        sold = facts.sales(departments)
        joined = facts.enriched(sold if touched is None else touched(sold), facts.economics(self.landing.table("fact_raw")),
                                self.wh.table(DATE_DIM), self.wh.table(STORE_DIM))
        return with_audit(joined, run_ts)

    def run_snapshot(self, run_ts: str) -> dict[str, int]:
        """Version what the deliveries since the last run can have changed."""
        with self._step("fact_snapshot"):
            return affected.version(self, run_ts)

    def _monthly(self, name: str, plan: Callable[..., DataFrame]) -> DataFrame:
        """A stored aggregate of the open rows by month, brought up to date.

        Each month's rows name the versioning run they were made from. Months that the versioned table has written
        since are read and aggregated again, and replaced by Spark's dynamic partition overwrite; the others are
        neither read nor written. A failed attempt leaves months with an older run, which the next one makes good.
        """
        months, path = self.snapshot.months(), self.wh.path(name)
        if not months:  # an empty source
            return plan(marts.row_measures(self.snapshot.current()))
        held = {}
        if self.wh.folders(path, MONTH):
            held = {r[MONTH]: r["written_by"] for r in self.spark.read.parquet(path).select(
                F.col(MONTH).cast("string").alias(MONTH), "written_by").distinct().collect()}  # calendar months
        stale = {m: run for m, run in months.items() if held.get(m) != run}
        if stale:
            runs = self.spark.createDataFrame(sorted(stale.items()), f"{MONTH} string, written_by int")
            rows = self.snapshot.open_rows(stale)
            # Sales are narrower than their aggregate, and so dealt before it, by what it is written by.
            by_month = marts.row_measures(dealt(rows, "store_id", largest_month(rows)))
            fresh = plan(by_month, MONTH, BUCKET).drop(BUCKET).join(F.broadcast(runs), MONTH)
            with shuffles_freed(self.spark):
                (fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
                 .partitionBy(MONTH).parquet(path))
        log.info("%s: %d of %d months aggregated", name, len(stale), len(months))
        return self.spark.read.parquet(path).drop(MONTH, "written_by")

    def build_marts(self, run_ts: str | None = None, only: Sequence[str] = MARTS) -> None:
        """Six marts and the holiday figures, or ``only`` some of them, from two stored aggregates that follow the
        versioned table by month."""
        dates, stores = self.wh.table(DATE_DIM), self.wh.table(STORE_DIM)
        weeks = depts = None
        if set(only) - {"sales_by_dept"}:
            with self._step("store_week"):
                weeks = self._monthly(STORE_WEEK, marts.store_week)
        if "sales_by_dept" in only:
            with self._step("dept_month"):
                depts = self._monthly(DEPT_MONTH, marts.dept_month)
        plans = {
            "sales_by_dept": lambda: marts.sales_by_dept_of_months(depts),
            "sales_by_store": lambda: marts.sales_by_store(weeks, stores, dates),
            "sales_by_date_parts": lambda: marts.sales_by_date_parts(weeks, dates),
            "sales_by_storetype_month": lambda: marts.sales_by_storetype_month(weeks, stores),
            "markdown_by_year_store": lambda: marts.markdown_by_year_store(weeks, stores),
            "economic_factors": lambda: marts.economic_factors(weeks),
        }
        self._together({name: partial(self._build_mart, name, plan, run_ts) for name, plan in plans.items() if name in only})
        if "holiday_impact" in only:
            self._build_mart("holiday_impact", lambda: holiday.summary(self.mart("sales_by_store")), run_ts)

    def _build_mart(self, name: str, plan: Callable[[], DataFrame], run_ts: str | None) -> None:
        with self._step(name):
            self.wh.write(with_audit(plan(), run_ts), f"gold/{name}")

    def _together(self, jobs: dict[str, Callable[[], None]]) -> None:
        """Submit independent jobs at once, so that one's last tasks do not leave the cluster idle."""
        with ThreadPoolExecutor(len(jobs)) as pool:
            started = [pool.submit(inheritable_thread_target(self.spark)(job)) for job in jobs.values()]
        for job in started:
            job.result()

    def write_together(self, tables: dict[str, DataFrame]) -> None:
        """Independent tables at once."""
        self._together({name: partial(self.wh.write, df, name) for name, df in tables.items()})

    def run_checks(self) -> DataFrame:
        """The check table, stored under ``checks`` and returned."""
        with self._step("checks"):
            report = quality.suite(self.wh.table(DATE_DIM), self.wh.table(STORE_DIM),
                                   self.snapshot.current(), self.mart("sales_by_store"))
            return self.wh.write(report, "checks")

    def run_warnings(self) -> DataFrame:
        return quality.warnings(self.wh.table(DATE_DIM), self.snapshot.history())

    def warn_dates(self) -> list[str]:
        """Dates that carry both holiday flags, stored under ``warnings`` and logged. Such a date would repeat
        each of its sales, and the versioned table would refuse the repeated keys without naming it."""
        with self._step("warnings"):
            stored = self.wh.write(quality.flag_conflicts(self.wh.table(DATE_DIM)), "warnings")
            found = [str(r.store_date) for r in stored.orderBy("store_date").collect()]  # calendar dates
        for date in found:
            log.warning("date %s carries both holiday flags", date)
        return found

    def build_reports(self) -> list[str]:
        """Store the dataset of every report over the stored marts, in parallel, under ``reports``."""
        mart = self.mart
        plans = {
            "top_departments": lambda: departments.top_departments(mart("sales_by_dept")),
            "share_by_store_type": lambda: departments.share_by_store_type(mart("sales_by_dept"), self.wh.table(STORE_DIM)),
            "holiday_share": lambda: holiday.share_positions(mart("sales_by_store")),
            "store_holiday_split": lambda: holiday.store_split(mart("sales_by_store")),
            "store_type_and_size": lambda: storetypes.by_type_and_size(mart("sales_by_store")),
            "weekly_series": lambda: seasons.series(mart("sales_by_date_parts")),
            "storetype_months": lambda: storetypes.month_totals(mart("sales_by_storetype_month")),
            "markdown_by_year": lambda: markdowns.by_year(mart("markdown_by_year_store")),
            "economy_by_week": lambda: economy.weekly(mart("economic_factors")),
        }
        self._together({name: partial(self._build_report, name, plan) for name, plan in plans.items()})
        return sorted(plans)

    def _build_report(self, name: str, plan: Callable[[], DataFrame]) -> None:
        with self._step(f"report {name}"):
            self.wh.write(plan(), f"reports/{name}")

    def report(self, name: str) -> DataFrame:
        return self.wh.table(f"reports/{name}")

    def prune(self, keep: int = 2) -> None:
        """Drop old versions of the tables that every run rebuilds."""
        for name in (DATE_DIM, STORE_DIM, "checks", "warnings", *(f"gold/{m}" for m in MARTS)):
            self.wh.prune(name, keep)

    def mart(self, name: str) -> DataFrame:
        return self.wh.table(f"gold/{name}")

    def run(self, folder: str, run_ts: str, mode: str = "once", full_refresh: bool = False) -> RunReport:
        """One full run over a folder of delivered files."""
        report = RunReport(loaded=self.load(folder, mode, run_ts))
        self.build_dims(run_ts, full_refresh)
        report.doubtful_dates = self.warn_dates()
        report.snapshot = self.run_snapshot(run_ts)
        self.build_marts(run_ts)
        failed = self.run_checks().where(~F.col("passed")).select("check_name")
        report.failed_checks = sorted(r.check_name for r in failed.collect())  # at most 13 rows
        self.prune()
        return report
