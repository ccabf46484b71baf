"""Streams over the delivery folder.

Both use Spark's file source: each micro-batch is the files that appeared since the last one, and
its checkpoint remembers them. With ``available_now`` a stream drains the backlog and stops.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..plans.pipeline import DEPARTMENT_KEY, Pipeline
from ..schemas import LANDINGS
from ..sources.csv_files import SOURCE_COLUMNS, stream_csv


def start_landing(pipeline: Pipeline, table: str, folder: str, available_now: bool = False,
                  interval: str = "1 minute", max_files: int | None = None) -> StreamingQuery:
    """Keep one landing table up to date with its delivery folder."""
    writer = pipeline.landing.stream_writer(table, folder, max_files=max_files)
    return (writer.trigger(availableNow=True) if available_now
            else writer.trigger(processingTime=interval)).start()


def start_snapshot(pipeline: Pipeline, folder: str, run_ts_of, available_now: bool = False,
                   interval: str = "1 hour", max_files: int | None = None) -> StreamingQuery:
    """Take in each micro-batch of new department files as the batch run does: land its lines, good and bad,
    upsert the dimensions from its rows, then version its sales.

    ``run_ts_of(batch_id)`` gives the run time. A streamed row stands for earlier landed rows of its key, so a
    batch run that follows finds nothing changed. Of a key delivered several times in one batch, by a repeated line or
    a correction behind it, the row of the newest file is versioned, and in one file the greatest as text; all of
    them are landed. A batch that is retried lands under the same name and finds nothing changed.
    """
    table = "department_raw"
    landing = LANDINGS[table]

    def version(batch: DataFrame, batch_id: int) -> None:
        run_ts, load = run_ts_of(batch_id), f"upsert-{batch_id:06d}"
        known = pipeline.landing.loaded_files(table, without=load)
        pipeline.landing.store(batch.join(known, SOURCE_COLUMNS, "left_anti"), table, load, run_ts)
        rows = pipeline.landing.load_rows(table, load, DEPARTMENT_KEY)
        if rows.isEmpty():  # every line malformed, or every file landed before
            return
        pipeline.build_dims(run_ts, delivered=rows)
        pipeline.snapshot.run(pipeline.snapshot_source(run_ts, delivered=rows), run_ts, prune=True)

    writer = (stream_csv(pipeline.spark, folder, landing, max_files).writeStream.foreachBatch(version)
              .queryName("version_sales")
              .option("checkpointLocation", pipeline.wh.path("_streams", "fact_snapshot")))
    return (writer.trigger(availableNow=True) if available_now
            else writer.trigger(processingTime=interval)).start()
