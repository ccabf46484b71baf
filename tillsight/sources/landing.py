"""Landing tables: delivered files appended load by load, all text, with malformed lines aside.

Layout under ``<root>/bronze/<table>``
``v=<n>/load=<id>/bad=<true|false>``  lines of one load, good and bad written in one pass over the files
``files/v=<n>/load=<id>``             one row per file of the load: its state, its row counts, what it replaces
``v=<n>/_loads/<id>``                 empty file that makes the load count; written last

Questions about files and counts read the file rows, never the lines. A file row may replace what earlier
loads hold of the same file; such lines are left out of every read.

Load modes
``once``          files not seen before (streaming file source with a checkpoint); files that another
                  mode has already loaded in the same state are left out
``changed``       files whose name, time or size is not among the loaded ones; a file's earlier lines go
``force_append``  every file again, on top of what is there
``replace``       every file into a fresh table
"""

from __future__ import annotations

import logging
from itertools import batched

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import AUDIT_COLUMNS, LANDINGS, Landing
from .csv_files import CORRUPT, SOURCE_COLUMNS, clean, list_files, only_files, read_csv, stream_csv, with_audit
from .warehouse import Warehouse

log = logging.getLogger(__name__)

FILES = T.StructType([
    T.StructField("source_file", T.StringType()), T.StructField("source_modified", T.TimestampType()),
    T.StructField("source_size", T.LongType()), T.StructField("good_rows", T.LongType()),
    T.StructField("bad_rows", T.LongType()), T.StructField("replaces", T.ArrayType(T.StringType())),
    T.StructField("load", T.StringType())])

FILES_A_LOAD = 1000

MODES = ("once", "changed", "force_append", "replace")


class LandingZone:
    def __init__(self, warehouse: Warehouse):
        self.wh = warehouse
        self.spark: SparkSession = warehouse.spark

    # --- reading -----------------------------------------------------------------------------

    def _base(self, table: str) -> str:
        return self.wh.path("bronze", table)

    def _generations(self, table: str) -> list[str]:
        """Newest table version that holds a load, as a list of one or none."""
        return next(([v] for v in reversed(self.wh.folders(self._base(table), "v")) if self._loads(table, v)), [])

    def _loads(self, table: str, version: str) -> list[str]:
        return self.wh.files(f"{self._base(table)}/v={version}/_loads")

    def _files(self, table: str, loads: list[str] | None = None) -> DataFrame:
        """File rows of the current generation's loads."""
        generations = self._generations(table)
        if not generations or loads == []:
            return self.spark.createDataFrame([], FILES)
        base = f"{self._base(table)}/files/v={generations[-1]}"
        chosen = self._loads(table, generations[-1]) if loads is None else loads
        return (self.spark.read.schema(FILES).option("basePath", base).parquet(base)
                .where(F.col("load").isin(chosen) if loads is not None else ~F.col("load").isin(
                    sorted(set(self.wh.folders(base, "load")) - set(chosen)))))

    def _schema(self, landing: Landing) -> T.StructType:
        return T.StructType([
            *landing.schema.fields,
            T.StructField(CORRUPT, T.StringType()),
            T.StructField("source_file", T.StringType()),
            T.StructField("source_modified", T.TimestampType()),
            T.StructField("source_size", T.LongType()),
            *[T.StructField(c, T.TimestampType()) for c in AUDIT_COLUMNS],
            T.StructField("bad", T.BooleanType()),
            T.StructField("load", T.StringType()),
        ])

    def _lines(self, table: str, loads: list[str] | None = None) -> DataFrame:
        """Stored lines of the current generation, good and bad."""
        schema = self._schema(LANDINGS[table])
        generations = self._generations(table)
        if not generations:
            return self.spark.createDataFrame([], schema)
        base = f"{self._base(table)}/v={generations[-1]}"
        chosen = self._loads(table, generations[-1]) if loads is None else loads
        if not chosen:
            return self.spark.createDataFrame([], schema)
        lines = (self.spark.read.schema(schema).option("basePath", base)
                 .parquet(*[f"{base}/load={i}" for i in chosen]))
        gone = self._replaced(table)
        return lines if gone.isEmpty() else lines.join(gone, ["load", "source_file"], "left_anti").select(*schema.names)

    def _replaced(self, table: str) -> DataFrame:
        """(load, source_file) of lines that a later load replaces."""
        return self._files(table).select(F.explode("replaces").alias("load"), "source_file").distinct()

    def table(self, table: str) -> DataFrame:
        """Good rows with their audit columns."""
        df = self._lines(table).where(~F.col("bad")).select(*LANDINGS[table].columns, *AUDIT_COLUMNS)
        df.createOrReplaceTempView(table)
        return df

    def settled(self, table: str, key: list[str]) -> DataFrame:
        """Good rows, where rows that a stream landed stand for earlier ones of their key.

        A stream delivers single rows anew, so of a key that it touched the newest row counts. Keys that only
        whole files brought stay as they are, repeated or not.
        """
        lines = self._lines(table).where(~F.col("bad"))
        loads = self._loads(table, self._current(table))
        columns = [*LANDINGS[table].columns, *AUDIT_COLUMNS]
        if not any(i.startswith("upsert-") for i in loads):
            return lines.select(*columns)
        touched = lines.where(F.col("load").startswith("upsert-")).select(*key).distinct()
        newest = self._newest(lines.join(touched, key, "left_semi"), table, key)
        return lines.join(touched, key, "left_anti").select(*columns).unionByName(newest)

    def _newest(self, lines: DataFrame, table: str, key: list[str]) -> DataFrame:
        """One row per key: of the newest load, in it of the newest file, in that the greatest as text."""
        columns = LANDINGS[table].columns
        order = F.struct("insert_date", F.col("load").startswith("upsert-"), "load", "source_modified", "source_file",
                         *columns)
        return (lines.groupBy(*key).agg(F.max_by(F.struct(*columns, *AUDIT_COLUMNS), order).alias("row"))
                .select("row.*"))

    def stream_lines(self, table: str) -> DataFrame:
        """Stream of the table's delivered columns over all landed files, of whatever load or generation."""
        base = self._base(table)
        self.wh.make_folder(f"{base}/v={self._current(table)}")
        return (self.spark.readStream.schema(LANDINGS[table].schema).option("ignoreMissingFiles", "true")
                .option("recursiveFileLookup", "true").parquet(f"{base}/v=*"))

    def quarantine(self, table: str) -> DataFrame:
        """Malformed lines set aside, with the file they came from."""
        return self._lines(table).where("bad").select(CORRUPT, *SOURCE_COLUMNS, "insert_date")

    def load_rows(self, table: str, load: str, key: list[str]) -> DataFrame:
        """Good rows of one load, of each key the one that ``settled`` takes; rows without a whole key all stay."""
        lines = self._lines(table, [load]).where(~F.col("bad"))
        whole = ~F.exists(F.array(*key), lambda part: part.isNull())
        return (lines.where(~whole).select(*LANDINGS[table].columns, *AUDIT_COLUMNS)
                .unionByName(self._newest(lines.where(whole), table, key)))

    def loaded_files(self, table: str, streamed: bool = True, without: str | None = None) -> DataFrame:
        """File states already loaded, by other loads than the one named."""
        files = self._files(table)
        if without is not None:
            files = files.where(F.col("load") != without)
        if not streamed:
            files = files.where(~F.col("load").startswith("stream-"))
        return files.select(*SOURCE_COLUMNS).distinct()

    # --- writing -----------------------------------------------------------------------------

    def store(self, lines: DataFrame, table: str, load: str, run_ts: str | None = None, version: str | None = None,
              replaces: DataFrame | None = None) -> None:
        """Write one load and make it count. ``lines`` come as read, or with ``bad`` and audit columns already.

        ``replaces`` has (source_file, replaces): the loads whose lines of the file no longer count.
        """
        version = version or self._current(table)
        target = f"{self._base(table)}/v={version}/load={load}"
        if "bad" not in lines.columns:
            lines = with_audit(clean(lines, LANDINGS[table]), run_ts)
        lines.write.mode("overwrite").partitionBy("bad").parquet(target)
        written = self.spark.read.schema(self._schema(LANDINGS[table])).parquet(target)
        files = written.groupBy(*SOURCE_COLUMNS).agg(F.count_if(~F.col("bad")).alias("good_rows"),
                                                     F.count_if("bad").alias("bad_rows"))
        none = F.lit(None).cast("array<string>")
        files = (files.withColumn("replaces", none) if replaces is None
                 else files.join(replaces, "source_file", "left"))
        (files.select(*[f.name for f in FILES.fields if f.name != "load"]).coalesce(1)
         .write.mode("overwrite").parquet(f"{self._base(table)}/files/v={version}/load={load}"))
        self.wh.mark(f"{self._base(table)}/v={version}/_loads/{load}")

    def _current(self, table: str) -> str:
        generations = self._generations(table)
        return generations[-1] if generations else "000001"

    def _next_load(self, table: str, version: str, kind: str) -> str:
        started = self.wh.folders(f"{self._base(table)}/v={version}", "load")
        taken = [int(i.split("-")[1]) for i in started if i.startswith(kind + "-")]
        return f"{kind}-{max(taken, default=0) + 1:06d}"

    def load(self, table: str, folder: str, mode: str = "once", run_ts: str | None = None) -> int:
        """Load one table; returns the number of good rows in what it loaded."""
        if mode not in MODES:
            raise ValueError(f"unknown load mode {mode!r}, use one of {MODES}")
        landing = LANDINGS[table]
        held = (self._generations(table), set(self._loads(table, self._current(table))))
        if mode == "once":
            self._load_new(table, folder, run_ts)
        elif mode == "replace":
            started = [int(v) for v in self.wh.folders(self._base(table), "v")]
            version = f"{max(started, default=0) + 1:06d}"
            self.store(read_csv(self.spark, folder, landing), table, "replace-000001", run_ts, version)
        else:
            self._load_listed(table, folder, mode, run_ts)
        loads = set(self._loads(table, self._current(table)))
        fresh = sorted(loads - held[1] if self._generations(table) == held[0] else loads)
        added = self._files(table, fresh).agg(F.coalesce(F.sum("good_rows"), F.lit(0))).first()[0]
        log.info("loaded %s: %d rows (%s)", table, added, mode)
        return added

    def _load_listed(self, table: str, folder: str, mode: str, run_ts: str | None) -> None:
        """Read the folder's files again: all of them, or those whose state is new. The latter are named to the scan
        in literal predicates on the file path, so that it opens no other file; each predicate names at most
        ``FILES_A_LOAD`` and makes a load of its own, so the driver never holds more names than that."""
        landing = LANDINGS[table]
        files = list_files(self.spark, folder, landing)
        if mode == "force_append":
            if not files.isEmpty():
                self.store(read_csv(self.spark, folder, landing), table, self._next_load(table, self._current(table), "force"),
                           run_ts)
            return
        files = files.join(self.loaded_files(table), SOURCE_COLUMNS, "left_anti")
        if files.isEmpty():
            return
        live = self._files(table).select("source_file", "load").join(
            self._replaced(table), ["load", "source_file"], "left_anti")
        older = live.groupBy("source_file").agg(F.sort_array(F.collect_set("load")).alias("replaces"))
        names = (r["source_file"] for r in files.select("source_file").orderBy("source_file").toLocalIterator())
        for chosen in batched(names, FILES_A_LOAD):
            self.store(only_files(read_csv(self.spark, folder, landing), chosen), table,
                       self._next_load(table, self._current(table), "changed"), run_ts, replaces=older)

    def _load_new(self, table: str, folder: str, run_ts: str | None) -> None:
        query = (self.stream_writer(table, folder, run_ts)
                 .trigger(availableNow=True).start())
        query.awaitTermination()

    def stream_writer(self, table: str, folder: str, run_ts: str | None = None,
                      max_files: int | None = None):
        """Stream writer that appends each micro-batch of new files as one load.

        A micro-batch is rewritten under the same load name when it is retried, so a crash at any
        point neither loses nor doubles rows.
        """
        def append(batch: DataFrame, batch_id: int) -> None:
            known = self.loaded_files(table, streamed=False)
            if not known.isEmpty():
                batch = batch.join(known, SOURCE_COLUMNS, "left_anti")
            self.store(batch, table, f"stream-{batch_id:06d}", run_ts)

        return (stream_csv(self.spark, folder, LANDINGS[table], max_files)
                .writeStream.foreachBatch(append).queryName(f"load_{table}")
                .option("checkpointLocation", self.wh.path("_streams", table)))

    def load_all(self, folder: str, mode: str = "once", run_ts: str | None = None) -> dict[str, int]:
        return {table: self.load(table, folder, mode, run_ts) for table in LANDINGS}

    # --- corrections -------------------------------------------------------------------------

    def correct(self, table: str, condition: str | Column, changes: dict[str, str],
                run_ts: str | None = None) -> None:
        """UPDATE ... WHERE on a landing table. Files that hold matching rows are written anew as one load that
        replaces their lines; all other loads stay as they are."""
        condition = (F.expr(condition) if isinstance(condition, str) else condition) & ~F.col("bad")
        lines = self._lines(table)
        hit = lines.where(condition).groupBy("source_file").agg(F.lit(True).alias("hit"))
        held = self._files(table).select("source_file", "load").join(
            self._replaced(table), ["load", "source_file"], "left_anti").join(hit, "source_file", "left_semi")
        older = held.groupBy("source_file").agg(F.sort_array(F.collect_set("load")).alias("replaces"))
        fixed = correct(lines.join(hit.select("source_file"), "source_file", "left_semi"), condition, changes).drop("load")
        if run_ts is not None:
            fixed = fixed.withColumn("update_date", F.when(condition, F.lit(run_ts).cast("timestamp"))
                                     .otherwise(F.col("update_date")))
        if not hit.isEmpty():
            self.store(fixed, table, self._next_load(table, self._current(table), "fix"), run_ts, replaces=older)


def correct(df: DataFrame, condition: str | Column, changes: dict[str, str]) -> DataFrame:
    """Set columns to new values where the condition holds; all other rows stay."""
    condition = F.expr(condition) if isinstance(condition, str) else condition
    return df.withColumns({
        c: F.when(condition, F.lit(v)).otherwise(F.col(c)) for c, v in changes.items()
    })
