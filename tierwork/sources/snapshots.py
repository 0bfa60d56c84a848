"""Every version of a table in one folder, partitioned by version.

A version is rows with their number and commit time; who writes it says which number it has. Writing
a number again replaces that version, so a job that failed is simply run again. There is no log:
reading is reading the folder, and picking versions prunes it.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierwork.functions.dates import moment
from tierwork.operators.versions import COMMIT_TIME, VERSION


def write_version(df: DataFrame, location: str, version: int, committed_at: datetime) -> None:
    """Store ``df`` as a version. One without rows leaves nothing in the folder; that it was
    committed is known from the ``commits`` which the operators on versions take."""
    rows = df.withColumns({COMMIT_TIME: moment(committed_at), VERSION: F.lit(version)})
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(VERSION).parquet(location)


def read_versions(spark: SparkSession, location: str, merge_schema: bool = False) -> DataFrame:
    """All versions with ``_version`` and ``_commit_timestamp``. ``merge_schema`` is for tables whose
    columns have changed: a version without a column has nulls there."""
    return spark.read.option("mergeSchema", merge_schema).parquet(location)


def expired_files(spark: SparkSession, location: str, expired: DataFrame) -> DataFrame:
    """The files of ``expired`` versions (``operators.versions.expired_versions``), for the storage's
    own tools to delete: ``version, path, length``. Folders are listed and no file is opened."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .load(location)
    )
    version = F.regexp_extract("path", f"/{VERSION}=([0-9]+)/", 1).cast("int")
    return files.select(version.alias("version"), "path", "length").join(
        expired.select("version"), "version"
    )
