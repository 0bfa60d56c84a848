"""The folder that every executor can read, for tables a run keeps between its steps."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import cache
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, SparkSession


@cache
def _local_base() -> str:
    return tempfile.mkdtemp(prefix="tierwork-")


#: The paths given out by this process, in order.
_given: list[str] = []


def work_paths() -> list[str]:
    """The work tables of this process that were not removed: once its results are written, they can go, by
    ``remove`` or by the storage's own tools."""
    return list(_given)


def work_path(spark: SparkSession, purpose: str) -> str:
    """A new path under ``spark.checkpoint.dir``.

    Where the setting is missing only a local session, whose driver and executors share one
    machine, gets a folder of its own; a cluster has to name one.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        base = _local_base()
    path = f"{base.rstrip('/')}/{purpose}-{uuid4().hex}"
    _given.append(path)
    return path


#: Lets Spark delete an execution's shuffle files when it ends, not when the driver collects garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_end_here(spark: SparkSession) -> Iterator[None]:
    """Executions inside leave no shuffle files, as their rows are in a table from then on."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


class Folder:
    """Files under a path of any store that Spark reads, by names relative to it."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = path.rstrip("/")
        self._context = spark.sparkContext
        root = self._at()
        self._store = root.getFileSystem(self._context._jsc.hadoopConfiguration())
        self._root = self._store.makeQualified(root).toUri().getPath()

    def _at(self, name: str = ""):
        return self._context._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def relative(self, path: str) -> str:
        """The name of a file that Spark calls ``path``."""
        return self._context._jvm.org.apache.hadoop.fs.Path(path).toUri().getPath()[len(self._root) + 1 :]

    def files(self, name: str) -> list[str]:
        """All files below a folder, by names relative to that."""
        found, below = [], self._store.listFiles(self._at(name), True)
        start = len(f"{self._root}/{name}") + 1
        while below.hasNext():
            found.append(below.next().getPath().toUri().getPath()[start:])
        return sorted(found)

    def names(self) -> list[str]:
        """What is in the folder itself."""
        return sorted(x.getPath().getName() for x in self._store.listStatus(self._at()))

    def read(self, name: str) -> str | None:
        """The text of a file, None if there is none."""
        if not self._store.exists(self._at(name)):
            return None
        opened = self._store.open(self._at(name))
        try:
            return bytes(opened.readAllBytes()).decode()
        finally:
            opened.close()

    def write(self, name: str, text: str) -> None:
        """Write a file under another name and rename it, so that it is there whole or not at all."""
        opened = self._store.create(self._at(f"{name}.part"), True)
        opened.write(bytearray(text.encode()))
        opened.close()
        self._store.rename(self._at(f"{name}.part"), self._at(name))

    def move(self, name: str, other: str) -> None:
        """Rename a file, unless it is gone already."""
        if self._store.exists(self._at(name)):
            self._store.mkdirs(self._at(other).getParent())
            if not self._store.rename(self._at(name), self._at(other)):
                raise OSError(f"{name} could not be moved to {other} under {self.path}")

    def remove(self, name: str = "") -> None:
        """Delete a file or a folder with all in it, if it is there."""
        self._store.delete(self._at(name), True)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a table of the work folder that no one reads any more."""
    Folder(spark, path).remove()
    if path in _given:
        _given.remove(path)


def remove_work(spark: SparkSession) -> None:
    """Delete all work tables of this process. Results that were not written elsewhere can't be read after it."""
    for path in work_paths():
        remove(spark, path)


def written(df: DataFrame, purpose: str, path: str | None = None) -> DataFrame:
    """``df`` written to the shared folder and read back: its lineage ends there, so a lost
    executor costs a re-read, never the shuffle that made the rows. A ``path`` given is overwritten."""
    path = path or work_path(df.sparkSession, purpose)
    with shuffles_end_here(df.sparkSession):
        df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written_and_counted(
    df: DataFrame, purpose: str, counts: Sequence[Column], path: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """``written``, and one row of bigint ``counts`` over the rows, which are taken while they are
    written: no second read. A task that runs again counts once, like its file."""
    seen = Observation()
    rows = written(df.observe(seen, *counts), purpose, path)
    found = seen.get
    schema = ", ".join(f"{name} bigint" for name in found)
    return rows, df.sparkSession.createDataFrame([tuple(found.values())], schema)
