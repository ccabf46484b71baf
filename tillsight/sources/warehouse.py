"""Parquet tables on a shared folder, each write a new directory that counts once complete.

A write goes to ``<root>/<name>/v=<n>``; readers take the newest one holding a commit file, which is
written after the data by this package and so does not depend on the store's job settings. A failed
job leaves none, so readers keep the previous state, and no plan ever overwrites the files it reads.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..session import shuffles_freed

COMMIT = "_COMMIT"


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # --- folders -----------------------------------------------------------------------------

    def path(self, *parts: str) -> str:
        return "/".join([self.root, *parts])

    def _hadoop(self, path: str):
        jvm = self.spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), target

    def complete(self, path: str) -> bool:
        fs, target = self._hadoop(f"{path}/{COMMIT}")
        return fs.exists(target)

    def mark(self, path: str) -> None:
        """Create an empty file."""
        fs, target = self._hadoop(path)
        fs.create(target, True).close()

    def commit(self, path: str) -> None:
        self.mark(f"{path}/{COMMIT}")

    def files(self, path: str) -> list[str]:
        """Names of the files directly under ``path``, from one listing."""
        fs, target = self._hadoop(path)
        if not fs.exists(target):
            return []
        return sorted(s.getPath().getName() for s in fs.listStatus(target) if s.isFile())

    def newest(self, path: str, prefix: str) -> str | None:
        """Value of the last complete ``<prefix>=<value>`` folder; looks from the end, so few calls whatever
        the number of folders."""
        return next((v for v in reversed(self.folders(path, prefix)) if self.complete(f"{path}/{prefix}={v}")), None)

    def folders(self, path: str, prefix: str) -> list[str]:
        """Values of the ``<prefix>=<value>`` folders directly under ``path``, in order."""
        fs, target = self._hadoop(path)
        if not fs.exists(target):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(target) if s.isDirectory()]
        return sorted(n[len(prefix) + 1:] for n in names if n.startswith(prefix + "="))

    def make_folder(self, path: str) -> None:
        fs, target = self._hadoop(path)
        fs.mkdirs(target)

    def drop_folder(self, path: str) -> None:
        fs, target = self._hadoop(path)
        fs.delete(target, True)

    # --- whole-table versions ----------------------------------------------------------------

    def versions(self, name: str) -> list[int]:
        base = self.path(name)
        return [int(v) for v in self.folders(base, "v") if self.complete(f"{base}/v={v}")]

    def exists(self, name: str) -> bool:
        return self.newest(self.path(name), "v") is not None

    def table(self, name: str) -> DataFrame:
        """Newest complete version, also registered as a view of the same name for SQL."""
        last = self.newest(self.path(name), "v")
        if last is None:
            raise LookupError(f"table {name!r} has not been built under {self.root}")
        df = self.spark.read.parquet(self.path(name, f"v={last}"))
        df.createOrReplaceTempView(name.replace("/", "_"))
        return df

    def write(self, df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
        """Full rebuild as a new version; returns the stored table."""
        started = [int(v) for v in self.folders(self.path(name), "v")]
        target = self.path(name, _version(max(started, default=0) + 1))
        with shuffles_freed(self.spark):
            df.write.mode("errorifexists").partitionBy(*partition_by).parquet(target)
        self.commit(target)
        return self.table(name)

    def prune(self, name: str, keep: int = 2) -> None:
        """Drop all but the newest complete versions, and leftovers of failed writes before them."""
        done = self.versions(name)[-keep:]
        for v in self.folders(self.path(name), "v"):
            if done and int(v) < done[0]:
                self.drop_folder(self.path(name, f"v={v}"))


def _version(n: int) -> str:
    return f"v={n:06d}"
