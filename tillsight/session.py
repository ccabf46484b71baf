"""Session settings shared by the jobs, the tests and the benchmark."""

from __future__ import annotations

import tempfile
import threading
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Runtime SQL settings. All may be set on a live session, so they also apply to one we did not build.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where a later operator then needs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings; partition counts and memory stay as the cluster set them."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_freeing: Counter = Counter()
_lock = threading.Lock()


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the statements inside go when each of them ends, not when the driver's garbage is collected.

    Only for statements that are not run again from the same plan, as writes are. Threads may enter at once.
    """
    with _lock:
        _freeing[spark] += 1
        spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        with _lock:
            _freeing[spark] -= 1
            if not _freeing[spark]:
                del _freeing[spark]
                spark.conf.unset(_FREE_SHUFFLES)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g",
                  app: str = "tillsight") -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def shared_folder(spark: SparkSession) -> str:
    """A folder that driver and executors share, for tables that a query stores on its way.

    The checkpoint folder of the session. Only where none is set and all runs on one machine, a temporary one is taken.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="run-")
    return folder.rstrip("/")
