"""Versioning of the keys that deliveries since the last run can have changed, and of no others.

The landing tables are themselves read as a stream: Spark's file source, with its checkpoint, hands a run the landed
files that no committed run has taken in. Department rows in them name their own keys; economics rows name their
store-weeks, hence every key of those. Only source rows of these keys are joined, compared and written; the months they
fall in are the only ones of the versioned table that are read. Without new files nothing is read at all.

A run that fails leaves the checkpoint where it was, so its keys come again. Where the versioned table does not hold
the run of the last streamed batch (it was lost, or the table is new), the whole source is compared once.
Landed lines that do not count in the end (of a failed load, or replaced since) name keys too; that costs a comparison
and changes nothing, as source rows are always those of the landing tables as they stand.
"""

from __future__ import annotations

from typing import TYPE_CHECKING

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.casts import parse_date, to_int
from ..functions.keys import surrogate_key
from ..operators.facts import KEY, KEY_PARTS
from ..operators.snapshot import MONTH

if TYPE_CHECKING:
    from .pipeline import Pipeline

STREAM = "_streams/affected"


def landed_keys(pipe: Pipeline) -> DataFrame:
    """Stream of (store_id, dept_id, store_date, whole_week) of newly landed lines; economics have no department."""
    def keys(table: str, dept, whole_week: bool) -> DataFrame:
        lines = pipe.landing.stream_lines(table).where(F.col("store_date").isNotNull())
        return lines.select(to_int("store_id").alias("store_id"), dept.alias("dept_id"),
                            parse_date("store_date").alias("store_date"), F.lit(whole_week).alias("whole_week"))

    return keys("department_raw", to_int("dept_id"), False).unionByName(keys("fact_raw", F.lit(None).cast("int"), True))


def touched_sales(sold: DataFrame, keys: DataFrame, whole_weeks: bool) -> DataFrame:
    """The sales rows of the affected keys. No side is hinted: the adaptive planner sends the smaller one around."""
    known = keys.where("NOT whole_week").select(surrogate_key(*KEY_PARTS).alias(KEY)).distinct()
    named = sold.withColumn(KEY, surrogate_key(*KEY_PARTS))
    if not whole_weeks:
        return named.join(known, KEY, "left_semi").drop(KEY)
    weeks = keys.where("whole_week").select("store_id", "store_date").distinct().withColumn("in_week", F.lit(True))
    marked = named.join(weeks, ["store_id", "store_date"], "left").join(known.withColumn("by_key", F.lit(True)), KEY, "left")
    return marked.where("in_week OR by_key").select(*sold.columns)


def version(pipe: Pipeline, run_ts: str) -> dict[str, int]:
    """Compare and version; returns what was done."""
    table, wh = pipe.snapshot, pipe.wh
    last = table.last_run()
    done = max((int(n) for n in wh.files(wh.path(STREAM, "commits")) if n.isdigit()), default=None)
    whole = last == 0 or table.last_mark("batch") != done
    stats: list[dict[str, int]] = []
    failure: list[Exception] = []

    def batch(landed: DataFrame, batch_id: int) -> None:
        try:
            if whole:
                stats.append(table.run(pipe.snapshot_source(run_ts), run_ts, mark=f"batch-{batch_id}"))
                return
            path = wh.path(STREAM, "keys")
            landed.distinct().write.mode("overwrite").parquet(path)
            keys = pipe.spark.read.parquet(path)
            months, weeks = set(), False
            for r in keys.groupBy(F.date_format("store_date", "yyyy-MM").alias(MONTH)).agg(F.max("whole_week").alias("w")).collect():
                months.add(r[MONTH])  # calendar months
                weeks |= r["w"]
            source = pipe.snapshot_source(run_ts, touched=lambda sold: touched_sales(sold, keys, weeks))
            stats.append(table.run(source, run_ts, held=months, mark=f"batch-{batch_id}"))
        except Exception as e:
            failure.append(e)
            raise

    query = (landed_keys(pipe).writeStream.foreachBatch(batch).queryName("affected_keys").trigger(availableNow=True)
             .option("checkpointLocation", wh.path(STREAM)).start())
    try:
        query.awaitTermination()
    except PySparkException:
        raise failure[0] if failure else query.exception()
    if not stats:  # nothing new has landed
        mark = None if done is None else f"batch-{done}"
        whole = whole or not table.months()
        stats.append(table.run(pipe.snapshot_source(run_ts), run_ts, mark=mark) if whole else table.unchanged(mark))
    return {k: sum(s[k] for s in stats) for k in ("opened", "replaced", "months_rewritten")}
