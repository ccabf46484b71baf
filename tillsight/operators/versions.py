"""Row versions by value comparison: open, close, and read them back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.keys import surrogate_key, version_id
from ..schemas import VersionColumns

NAMES = VersionColumns()


def _ts(run_ts: str | Column) -> Column:
    return F.lit(run_ts).cast("timestamp") if isinstance(run_ts, str) else run_ts


def open_version(df: DataFrame, key: str, run_ts: str | Column, names: VersionColumns = NAMES) -> DataFrame:
    """Give source rows the metadata of a version that starts now and has no end."""
    now = _ts(run_ts)
    return df.withColumns({
        names.scd_id: version_id(key, now),
        names.updated_at: now,
        names.valid_from: now,
        names.valid_to: F.lit(None).cast("timestamp"),
    })


def _null_key(key: str) -> Column:
    return F.raise_error(F.lit(f"null {key} in the source"))


def _repeated_key(key: str, parts: Sequence[str]) -> Column:
    return F.raise_error(F.concat(F.lit(f"duplicate {key} in the source: "), whole_key(key, parts)))


def narrowed(df: DataFrame, key: str, parts: Sequence[str]) -> DataFrame:
    """The key left out where it is the hash of its ``parts``, which make it anew (``whole_key``): its 32 characters are
    then neither shuffled nor sorted. The job aborts if a key is null."""
    rest = F.col(key) if key in parts else F.when(~F.col(key).eqNullSafe(surrogate_key(*parts)), F.col(key))
    return df.withColumn(key, F.when(F.col(key).isNull(), _null_key(key).cast("string")).otherwise(rest))


def whole_key(key: str, parts: Sequence[str]) -> Column:
    return F.col(key) if key in parts else F.coalesce(F.col(key), surrogate_key(*parts))


def reject_duplicates(df: DataFrame, key: str, parts: Sequence[str] = ()) -> DataFrame:
    """The same rows; the job aborts if a key is null or occurs twice.

    Numbers rows by key, which needs the shuffle and sort the version join needs anyway. Given the ``parts`` behind the key,
    rows are ``narrowed`` and numbered by these, and not dealt again where an earlier step has dealt them by some of these.
    """
    position = F.row_number().over(W.partitionBy(*(parts or [key])).orderBy(*(parts or [key])[:1]))
    verdict = F.when(F.col("_position") > 1, _repeated_key(key, parts or [key])).otherwise(F.lit(True))
    if not parts:
        verdict = F.when(F.col(key).isNull(), _null_key(key)).otherwise(verdict)
    return df.withColumn("_position", position).where(verdict.cast("boolean")).drop("_position")


def changed(before: str, after: str, check_cols: list[str]) -> Column:
    """Null-safe: any checked column differs between the two aliases."""
    old = F.struct(*[F.col(f"{before}.{c}") for c in check_cols])
    new = F.struct(*[F.col(f"{after}.{c}") for c in check_cols])
    return ~old.eqNullSafe(new)


def differences(current: DataFrame, source: DataFrame, key: str, check_cols: list[str], parts: Sequence[str]) -> DataFrame:
    """Source rows that are new or whose checked values changed, with ``is_new`` and, as ``was``, what the current row
    that they end has beside the key; both sides ``narrowed``. The job aborts if the source holds a key twice.

    Both meet in one window on the columns behind the key, so that no row has to be looked up again to be closed.
    """
    own = [c for c in current.columns if c != key and c not in parts]
    both = current.withColumn("_new", F.lit(False)).unionByName(source.withColumn("_new", F.lit(True)), allowMissingColumns=True)
    history = W.partitionBy(*parts).orderBy("_new")
    placed = both.withColumn("_was", F.lag(F.struct("_new", *own)).over(history))
    is_new = F.col("_was").isNull()
    checked, was = F.struct(*check_cols), F.struct(*[F.col(f"_was.{c}").alias(c) for c in check_cols])
    picked = (F.when(~F.col("_new"), F.lit(False))
              .when(F.col("_was._new"), _repeated_key(key, parts).cast("boolean"))
              .otherwise(is_new | ~checked.eqNullSafe(was)))
    before = F.struct(*[F.col(f"_was.{c}").alias(c) for c in own])
    return placed.where(picked).select(*source.columns, is_new.alias("is_new"), F.when(~is_new, before).alias("was"))


def apply_versions(history: DataFrame, source: DataFrame, key: str, check_cols: list[str],
                   run_ts: str | Column, names: VersionColumns = NAMES) -> DataFrame:
    """The whole versioned table after one run.

    Unchanged and missing keys keep their open row as it is; a changed key closes it and opens a
    new one at the same instant; a new key opens one. Closed rows pass through. One full-outer
    join on the key, which is unique on both sides, so no key can be hot.
    """
    columns = history.columns
    closed = history.where(F.col(names.valid_to).isNotNull())
    current = history.where(F.col(names.valid_to).isNull()).alias("cur")
    incoming = open_version(reject_duplicates(source, key), key, run_ts, names).alias("src")
    joined = current.join(incoming, F.col(f"cur.{key}") == F.col(f"src.{key}"), "full_outer")

    has_old, has_new = F.col(f"cur.{key}").isNotNull(), F.col(f"src.{key}").isNotNull()
    opens = has_new & (~has_old | changed("cur", "src", check_cols))
    end = F.when(has_new & opens, F.col(f"src.{names.valid_from}"))
    old = F.struct(*[(end if c == names.valid_to else F.col(f"cur.{c}")).alias(c) for c in columns])
    new = F.struct(*[F.col(f"src.{c}").alias(c) for c in columns])
    rows = F.array_compact(F.array(F.when(has_old, old), F.when(opens, new)))
    return closed.unionByName(joined.select(F.inline(rows)).select(*columns))


def versions_of_deliveries(rows: DataFrame, match: list[str], check_cols: list[str], delivered: str,
                           names: VersionColumns = NAMES) -> DataFrame:
    """Every version that a sequence of deliveries opens, in one pass.

    The rows are those of ``open_version`` on the first delivery and ``apply_versions`` on each later one: a key opens
    a version where it comes first or differs from its delivery before, and the next version ends it. ``match`` are the
    columns behind the key, nulls equal; ``delivered`` is the timestamp of a row's delivery. Rows that an earlier step
    has dealt by some of ``match`` are not dealt again. A key twice in one delivery aborts the job. ``scd_id`` is left
    to ``with_version_id``, so that no hash is carried through the sort.
    """
    history = W.partitionBy(*match).orderBy(delivered)
    checked = F.struct(*[F.col(c) for c in check_cols])
    placed = rows.withColumns({"_last": F.lag(delivered).over(history), "_was": F.lag(checked).over(history)})
    twice = F.concat(F.lit("duplicate key in the source: "), F.to_json(F.struct(*match)))
    opens = (F.when(F.col("_last") == F.col(delivered), F.raise_error(twice).cast("boolean"))
             .otherwise(F.col("_last").isNull() | ~checked.eqNullSafe(F.col("_was"))))
    return placed.where(opens).drop("_last", "_was").withColumns({
        names.updated_at: F.col(delivered), names.valid_from: F.col(delivered),
        names.valid_to: F.lead(delivered).over(history)})


def with_version_id(history: DataFrame, key: str, names: VersionColumns = NAMES) -> DataFrame:
    return history.withColumn(names.scd_id, version_id(key, F.col(names.valid_from)))


# --- reading ---------------------------------------------------------------------------------

def current_rows(history: DataFrame, names: VersionColumns = NAMES) -> DataFrame:
    return history.where(F.col(names.valid_to).isNull())


def as_of(history: DataFrame, ts: str, names: VersionColumns = NAMES) -> DataFrame:
    """Rows as they stood at a point in time."""
    at = _ts(ts)
    ends = F.col(names.valid_to)
    return history.where((F.col(names.valid_from) <= at) & (ends.isNull() | (ends > at)))


def version_history(history: DataFrame, *key: str, names: VersionColumns = NAMES) -> DataFrame:
    """Every version with its place in the history of its key, or of the columns behind the key; a key has at most one
    version per run."""
    order = W.partitionBy(*key).orderBy(names.valid_from)
    return history.withColumn("version_no", F.row_number().over(order).cast("bigint"))


def version_counts(history: DataFrame, names: VersionColumns = NAMES) -> DataFrame:
    """Total, open and closed versions."""
    ends = F.col(names.valid_to)
    return history.agg(F.count(F.lit(1)).alias("total_rows"),
                       F.count_if(ends.isNull()).alias("open_rows"),
                       F.count_if(ends.isNotNull()).alias("closed_rows"))
