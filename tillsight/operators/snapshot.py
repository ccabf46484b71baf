"""The stored versioned sales table.

Layout under ``<root>/silver/fact_snapshot``
``current/run=<n>/sales_month=<yyyy-MM>``  open rows; a run rewrites only the months it changes
``closed/ended=<yyyy-MM>/run=<n>``         rows closed by that run, in the month of its time; never rewritten
``changes/run=<n>``                        the run's new and changed source rows, beside what each ended
``commits/run=<n>``                        one row per month: the run that last wrote it

A run exists once its ``commits`` folder holds the commit file; it is written last. Until then readers see
the run before, and a repeated run overwrites its own leftovers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.keys import version_id
from ..schemas import CHECK_COLUMNS, VersionColumns
from ..session import shuffles_freed
from ..sources.warehouse import Warehouse
from .facts import DEALT_BY, KEY, KEY_PARTS
from .versions import NAMES, as_of, differences, narrowed, open_version, reject_duplicates, whole_key

MONTH, ENDED, BUCKET = "sales_month", "ended", "_bucket"
# Parameter: rows of a month that one bucket holds on average; what is dealt by month and bucket goes to so many more tasks.
BUCKET_ROWS = 250_000


def dealt(rows: DataFrame, by: str, most: int) -> DataFrame:
    """Rows dealt by month and bucket, which a column decides; ``most`` is the number of rows of the largest month."""
    bucket = F.pmod(F.xxhash64(by), F.lit(1 + most // BUCKET_ROWS)).cast("int")
    return rows.withColumn(BUCKET, bucket).repartition(MONTH, BUCKET)


def largest_month(rows: DataFrame) -> int:
    """Rows of the largest month; of files, only the footers are read."""
    return rows.groupBy(MONTH).count().agg(F.max("count")).first()[0] or 0


class SnapshotTable:
    def __init__(self, warehouse: Warehouse, name: str = "silver/fact_snapshot", key: str = KEY,
                 check_cols: list[str] | None = None, month_of: str = "store_date",
                 names: VersionColumns = NAMES, parts: Sequence[str] | None = None,
                 dealt_by: Sequence[str] | None = None):
        """``parts`` are the columns behind the key: two rows have one key if they agree in these, and only then.
        ``dealt_by`` are those of them by which sources mostly come dealt; open rows are then dealt alike."""
        self.wh, self.name, self.key, self.names = warehouse, name, key, names
        self.spark = warehouse.spark
        self.parts = list(parts or (KEY_PARTS if key == KEY else [key]))
        self.dealt_by = list(dealt_by or (DEALT_BY if self.parts == KEY_PARTS else self.parts))
        self.check_cols = list(CHECK_COLUMNS if check_cols is None else check_cols)
        self.month_of = month_of

    # --- reading -----------------------------------------------------------------------------

    def _path(self, *parts: str) -> str:
        return self.wh.path(self.name, *parts)

    def last_run(self) -> int:
        base = self._path("commits")
        last = self.wh.newest(base, "run")
        if last is None and self.wh.folders(base, "run")[1:]:
            raise RuntimeError(f"{base} holds runs but no commit file; nothing is read or overwritten")
        return int(last or 0)

    def last_mark(self, kind: str) -> int | None:
        """Number of the newest ``kind-<number>`` mark of a committed run; runs without such a mark are passed over."""
        base, last = self._path("commits"), self.last_run()
        for run in reversed(self.wh.folders(base, "run")):
            if int(run) <= last:
                for name in self.wh.files(f"{base}/run={run}"):
                    if name.startswith(f"_{kind}-"):
                        return int(name.rpartition("-")[2])
        return None

    def exists(self) -> bool:
        return self.last_run() > 0

    def _months(self, run: int) -> dict[str, int]:
        """Month to the run that last wrote it. One row per calendar month."""
        if run == 0:
            return {}
        rows = self.spark.read.parquet(self._path("commits", _run(run))).collect()
        return {r[MONTH]: r["written_by"] for r in rows}

    def _read_months(self, months: dict[str, int]) -> DataFrame:
        """One scan over the folders of the given months, whichever runs wrote them."""
        base = self._path("current")
        folders = [f"{base}/{_run(run)}/{MONTH}={month}" for month, run in sorted(months.items())]
        df = self.spark.read.option("basePath", base).parquet(*folders)
        return df.withColumn(MONTH, F.col(MONTH).cast("string")).drop("run")

    def current(self) -> DataFrame:
        """Open rows only; closed ones are not read."""
        last = self.last_run()
        if not last:
            raise LookupError(f"{self.name} has not been built")
        months = self._months(last)
        if not months:  # every run so far had an empty source
            none = self.spark.read.parquet(self._path("changes", _run(last)))
            return open_version(none.drop("is_new", MONTH), self.key, F.lit(None).cast("timestamp"), self.names)
        return self._read_months(months).drop(MONTH)

    def closed(self, after: str | None = None) -> DataFrame:
        """Closed rows, or those that ended after a time: months before it are not listed, and Spark prunes the runs that
        do not count from the folders' names."""
        last, base = self.last_run(), self._path("closed")
        template = self.current()
        months = self.wh.folders(base, ENDED)
        if after is not None:
            first = self.spark.sql("SELECT date_format(CAST(:at AS TIMESTAMP), 'yyyy-MM')", args={"at": after}).first()[0]
            months = [m for m in months if first is not None and m >= first]
        if not months:
            return template.limit(0)
        schema = T.StructType([*template.schema.fields, T.StructField(ENDED, T.StringType()), T.StructField("run", T.IntegerType())])
        folders = [f"{base}/{ENDED}={m}" for m in months]
        rows = self.spark.read.schema(schema).option("basePath", base).parquet(*folders).where(F.col("run") <= last)
        if after is not None:
            at = F.lit(after).cast("timestamp")
            rows = rows.where((F.col(ENDED) >= F.date_format(at, "yyyy-MM")) & (F.col(self.names.valid_to) > at))
        return rows.drop(ENDED, "run")

    def as_of(self, ts: str) -> DataFrame:
        """Rows as they stood at a point in time; of the closed ones only those that ended later are read."""
        return as_of(self.current(), ts, self.names).unionByName(as_of(self.closed(after=ts), ts, self.names))

    def months(self) -> dict[str, int]:
        """Month to the run that last wrote its open rows."""
        return self._months(self.last_run())

    def open_rows(self, months: dict[str, int]) -> DataFrame:
        """Open rows of some months, with the month."""
        return self._read_months(months)

    def history(self) -> DataFrame:
        """All versions."""
        return self.current().unionByName(self.closed())

    # --- writing -----------------------------------------------------------------------------

    def run(self, source: DataFrame, run_ts: str, prune: bool = False, held: set[str] | None = None,
            mark: str | None = None) -> dict[str, int]:
        """Compare the source with the open rows and store the outcome. Returns what it did.

        The key must determine the row's month. ``prune`` first looks up which months the source
        holds and reads only those, which pays for a small source such as a micro-batch; ``held`` names
        months beyond which the source has no rows. ``mark`` names what the run has taken in.
        """
        last = self.last_run()
        now = last + 1
        self._drop_leftovers(now)
        months = self._months(last)
        source = source.withColumn(MONTH, F.date_format(F.col(self.month_of), "yyyy-MM"))
        if months:
            known = months
            if prune and held is None:
                held = {r[MONTH] for r in source.select(MONTH).distinct().collect()}  # calendar months
            if held is not None:
                known = {m: r for m, r in months.items() if m in held}
            stats = self._write_changes(source, known, now, run_ts)
        else:
            stats = self._write_first(source, now, run_ts)
        months.update({r[MONTH]: now for r in stats})
        self._commit(months, now, mark)
        return {"opened": sum(r.n for r in stats), "replaced": sum(r.c for r in stats),
                "months_rewritten": len(stats)}

    def unchanged(self, mark: str | None = None) -> dict[str, int]:
        """Commit a run that had nothing to compare. The table holds rows."""
        self._drop_leftovers(self.last_run() + 1)
        self._commit(self.months(), self.last_run() + 1, mark)
        return {"opened": 0, "replaced": 0, "months_rewritten": 0}

    def _drop_leftovers(self, now: int) -> None:
        """Drop what a failed attempt at this run left."""
        for part in ("changes", "current", *(f"closed/{ENDED}={m}" for m in self.wh.folders(self._path("closed"), ENDED))):
            self.wh.drop_folder(self._path(part, _run(now)))

    def _commit(self, months: dict[str, int], now: int, mark: str | None) -> None:
        schema = T.StructType([T.StructField(MONTH, T.StringType()), T.StructField("written_by", T.IntegerType())])
        (self.spark.createDataFrame(sorted(months.items()), schema).coalesce(1)
         .write.mode("overwrite").parquet(self._path("commits", _run(now))))
        if mark is not None:
            self.wh.mark(self._path("commits", _run(now), f"_{mark}"))
        self.wh.commit(self._path("commits", _run(now)))

    def _narrowed(self, rows: DataFrame) -> DataFrame:
        """Without version ids and with narrow keys: hashes, which hardly compress, are made after rows are dealt."""
        return narrowed(rows, self.key, self.parts).drop(self.names.scd_id)

    def _whole(self, rows: DataFrame) -> DataFrame:
        """With keys, and version ids where rows are versions."""
        rows = rows.withColumn(self.key, whole_key(self.key, self.parts))
        at = self.names.updated_at
        return rows.withColumn(self.names.scd_id, version_id(self.key, F.col(at))) if at in rows.columns else rows

    def _write(self, rows: DataFrame, *parts: str, by: Sequence[str] = ()) -> None:
        with shuffles_freed(self.spark):
            rows.write.mode("overwrite").option("compression", "zstd").partitionBy(*by).parquet(self._path(*parts))

    def _write_first(self, source: DataFrame, now: int, run_ts: str) -> list:
        """No open rows yet: every source row is new, so it is written once."""
        none = source.limit(0).withColumn("is_new", F.lit(True))
        none.write.mode("overwrite").parquet(self._path("changes", _run(now)))
        unique = reject_duplicates(self._narrowed(source), self.key, self.parts)
        self._store_new(unique, now, run_ts)
        base = self._path("current", _run(now))
        written = {m: now for m in self.wh.folders(base, MONTH)}
        if not written:
            return []
        return (self._read_months(written).groupBy(MONTH)
                .agg(F.count(F.lit(1)).alias("n"), F.lit(0).alias("c")).collect())

    def _write_changes(self, source: DataFrame, months: dict[str, int], now: int, run_ts: str) -> list:
        """Write down what changed, then rewrite the months it touches from that small table."""
        known = self._read_months(months) if months else self.spark.createDataFrame([], source.schema)
        known = self._narrowed(known).drop(MONTH).repartition(*self.dealt_by)
        delta = differences(known, self._narrowed(source), self.key, self.check_cols, self.parts)
        self._write(self._whole(delta), "changes", _run(now))
        delta = self.spark.read.parquet(self._path("changes", _run(now)))
        stats = delta.groupBy(MONTH).agg(F.count_if("is_new").alias("n"),
                                         F.count_if(~F.col("is_new")).alias("c")).collect()
        if not stats:
            return []
        new = delta.drop("is_new", "was")
        touched = {r[MONTH] for r in stats}
        rewritten = {m: r for m, r in months.items() if m in touched}
        if not rewritten:
            self._store_new(self._narrowed(new), now, run_ts)
            return stats
        before = self._read_months(rewritten)
        if any(r.c for r in stats):
            ended = (delta.where(~F.col("is_new")).select(*dict.fromkeys([self.key, *self.parts]), "was.*")
                     .withColumn(self.names.valid_to, F.lit(run_ts).cast("timestamp")))
            self._write(self._whole(ended).select(*before.drop(MONTH).columns), "closed", f"{ENDED}={run_ts[:7]}", _run(now))
        self._replace(before, open_version(new, self.key, run_ts, self.names), now)
        return stats

    def _store_new(self, rows: DataFrame, now: int, run_ts: str) -> None:
        """Source rows as open ones. Few files per month; a month too big for one task is split over several."""
        by_month = rows.hint("rebalance", MONTH).withColumn(self.key, whole_key(self.key, self.parts))
        self._write(open_version(by_month, self.key, run_ts, self.names), "current", _run(now), by=[MONTH])

    def _replace(self, before: DataFrame, fresh: DataFrame, now: int) -> None:
        """The open rows of months again, each replaced by the fresh one of its key. All are dealt once, as they are
        written."""
        columns = before.columns
        both = (self._narrowed(before).withColumn("_new", F.lit(False))
                .unionByName(self._narrowed(fresh.select(*columns)).withColumn("_new", F.lit(True))))
        most = largest_month(both)
        follows = F.lead("_new").over(W.partitionBy(MONTH, BUCKET, *self.parts).orderBy("_new"))
        rows = dealt(both, self.parts[0], most).withColumn("_next", follows).where(F.col("_next").isNull())
        self._write(self._whole(rows.drop("_new", "_next", BUCKET)).select(*columns), "current", _run(now), by=[MONTH])


def _run(n: int) -> str:
    return f"run={n:06d}"
