"""File layout of a table folder: how many files, how large, and fewer of them."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from contextlib import AbstractContextManager, contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierwork.functions.names import quoted
from tierwork.sources.work import Folder

DEFAULT_FILE_BYTES = 512 * 1024 * 1024
#: Files of at least this share of the size asked for are left alone.
LARGE_ENOUGH = 0.75
#: The note of an exchange of files; readers pass over names that begin so.
EXCHANGE_NOTE = "_exchange.json"
JOINED = "_joined-"
#: A file is joined from up to so many scan tasks, each of ``SMALLEST_PIECE`` bytes at least.
PIECES = 4
SMALLEST_PIECE = 1024 * 1024


def table_detail(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """Number of data files and their bytes, from the folder listing; no file is opened."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .load(path)
    )
    return files.agg(
        F.count("*").alias("numFiles"), F.coalesce(F.sum("length"), F.lit(0)).alias("sizeInBytes")
    )


@contextmanager
def _settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    """The session with other settings while it lasts."""
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def _advised(spark: SparkSession, size: int) -> AbstractContextManager[None]:
    """While it lasts, rebalanced partitions are about ``size`` bytes."""
    return _settings(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": str(size)})


def _write_joined(rows: DataFrame, target: str, size: int, file_bytes: int, most_rows: int) -> None:
    """Write scanned rows of ``size`` bytes to ``target`` without a shuffle, each task about ``file_bytes`` of them.

    Scan tasks are packed by bytes alone, however many files those are, and as many of them are joined
    as together hold ``file_bytes``; so what a task reads does not grow with the table, nor with the
    number of small files beside large ones.
    """
    piece = max(file_bytes // PIECES, SMALLEST_PIECE)
    packed = {
        "spark.sql.files.maxPartitionBytes": f"{piece}b",
        "spark.sql.files.openCostInBytes": "0b",
        "spark.sql.files.minPartitionNum": "1",
    }
    with _settings(rows.sparkSession, packed):
        pieces = rows.rdd.getNumPartitions() if size > file_bytes else 1
        tasks = max(1, -(-pieces // max(1, file_bytes // piece)))
        rows.coalesce(tasks).write.option("maxRecordsPerFile", most_rows).parquet(target)


def _write_rebalanced(
    rows: DataFrame, target: str, file_bytes: int, most_rows: int, partition_by: Sequence[str]
) -> None:
    """Write rows to ``target`` in the folders of their partitions, each task about ``file_bytes``."""
    with _advised(rows.sparkSession, file_bytes):
        laid_out = rows.hint("rebalance", *map(quoted, partition_by))
        laid_out.write.option("maxRecordsPerFile", most_rows).partitionBy(*partition_by).parquet(target)


def compact(
    spark: SparkSession,
    path: str,
    target: str,
    file_bytes: int = DEFAULT_FILE_BYTES,
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """Write the parquet rows under ``path`` to the new folder ``target`` in files of about
    ``file_bytes``, and return them.

    Smaller files are joined without a shuffle: scan tasks pack them and ``coalesce`` joins tasks, as many
    as together read ``file_bytes`` (a row group is read whole by one of them). A task begins a new file
    after as many rows as ``file_bytes`` hold on average, so larger files are cut. A partitioned table is
    rebalanced on its partition columns first, which brings the rows of a small partition together and
    splits a large one at ``file_bytes``.
    """
    rows = spark.read.parquet(path)
    size = table_detail(spark, path).first()["sizeInBytes"]
    each = max(1, rows.count() * file_bytes // max(size, 1))
    if partition_by:
        _write_rebalanced(rows, target, file_bytes, each, partition_by)
    else:
        _write_joined(rows, target, size, file_bytes, each)
    return spark.read.schema(rows.schema).parquet(target)


def small_files(
    spark: SparkSession, path: str, file_bytes: int = DEFAULT_FILE_BYTES, pattern: str = "*.parquet"
) -> DataFrame:
    """The data files worth joining: ``path``, ``length`` and ``folder`` of those below ``LARGE_ENOUGH`` of
    ``file_bytes`` that are not alone in their folder. Folders are listed and no file is opened."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .load(path)
        .select("path", "length", F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("folder"))
    )
    small = files.filter(F.col("length") < int(file_bytes * LARGE_ENOUGH))
    several = small.groupBy("folder").agg(F.count("*").alias("n")).filter("n > 1").select("folder")
    return small.join(several, "folder").select("path", "length", "folder")


def compact_small(
    spark: SparkSession,
    path: str,
    file_bytes: int = DEFAULT_FILE_BYTES,
    partition_by: Sequence[str] = (),
) -> tuple[int, int]:
    """Join the small parquet files under ``path`` into files of about ``file_bytes`` and leave the others as
    they are; the number of files replaced, and of those in their place.

    Only the small files are read. Their rows are written beside the table, in a folder that readers pass over; then
    the files are exchanged: a note of what comes and goes is written, the new files are moved in, the old ones deleted, the
    note deleted. The exchange is file operations alone, one per file; a reader that lists the folder meanwhile may see rows
    twice, never miss any. One call at a time may work on a table. If the exchange does not end, ``finish_exchange``, which every call begins with, ends it. The driver
    holds the names of the small files.
    """
    finish_exchange(spark, path)
    folder = Folder(spark, path)
    for name in folder.names():
        if name.startswith(JOINED):
            folder.remove(name)
    chosen = small_files(spark, path, file_bytes).collect()
    if not chosen:
        return 0, 0
    size = sum(row["length"] for row in chosen)
    rows = spark.read.option("basePath", path).parquet(*(row["path"] for row in chosen))
    each = max(1, rows.count() * file_bytes // max(size, 1))
    beside = f"{JOINED}{uuid4().hex}"
    if partition_by:
        _write_rebalanced(rows, f"{folder.path}/{beside}", file_bytes, each, partition_by)
    else:
        _write_joined(rows, f"{folder.path}/{beside}", size, file_bytes, each)
    new = [name for name in folder.files(beside) if name.endswith(".parquet")]
    if not new:
        folder.remove(beside)
        return 0, 0
    note = {"beside": beside, "new": new, "old": [folder.relative(row["path"]) for row in chosen]}
    folder.write(EXCHANGE_NOTE, json.dumps(note))
    finish_exchange(spark, path)
    return len(chosen), len(new)


def finish_exchange(spark: SparkSession, path: str) -> None:
    """Move in and delete what the note of an exchange says, if there is one; steps that are done
    already are passed over."""
    folder = Folder(spark, path)
    text = folder.read(EXCHANGE_NOTE)
    if text is None:
        return
    note = json.loads(text)
    for name in note["new"]:
        folder.move(f"{note['beside']}/{name}", name)
    for name in note["old"]:
        folder.remove(name)
    folder.remove(note["beside"])
    folder.remove(EXCHANGE_NOTE)
