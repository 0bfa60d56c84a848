"""Named tables: current namespace, scan, overwrite, append, properties."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tierwork.functions.names import named, quoted


class SchemaChanged(ValueError):
    """An overwrite would change the columns of a table."""


def use_namespace(spark: SparkSession, catalog: str | None, schema: str) -> None:
    if catalog:
        spark.catalog.setCurrentCatalog(catalog)
    spark.catalog.setCurrentDatabase(schema)


def table_scan(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def _columns(df: DataFrame) -> list[tuple[str, str]]:
    return sorted((name.lower(), kind) for name, kind in df.dtypes)


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"{quoted(name)} {kind}" for name, kind in df.dtypes)


def _text(value: str) -> str:
    """A value as SQL text."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _described(spark: SparkSession, name: str) -> dict[str, str]:
    """What the catalog says of a table."""
    rows = spark.sql("DESCRIBE TABLE EXTENDED IDENTIFIER(:name)", args={"name": name}).collect()
    return {row["col_name"]: row["data_type"] for row in rows}


def _beside(name: str, suffix: str) -> str:
    """A name next to a table's, in the same schema."""
    return f"{name}__{suffix}"


@contextmanager
def _partitions_by_folder(spark: SparkSession) -> Iterator[None]:
    """Tables created inside find their partitions in their folder, so that pointing them to another folder
    is one step; else the catalog keeps a folder per partition."""
    setting = "spark.sql.hive.manageFilesourcePartitions"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def _create(
    spark: SparkSession, name: str, df: DataFrame, file_format: str, folder: str, partition_by: Sequence[str]
) -> None:
    parts = f"PARTITIONED BY ({', '.join(map(quoted, partition_by))})" if partition_by else ""
    with _partitions_by_folder(spark):
        spark.sql(
            f"CREATE TABLE IDENTIFIER(:name) ({_ddl(df)}) USING {file_format} {parts} LOCATION {_text(folder)}",
            args={"name": name},
        )


def _point(spark: SparkSession, name: str, folder: str) -> None:
    """Let a table read another folder."""
    spark.sql(f"ALTER TABLE IDENTIFIER(:name) SET LOCATION {_text(folder)}", args={"name": name})
    spark.catalog.refreshTable(name)


def _rename(spark: SparkSession, name: str, other: str) -> None:
    """The catalog's RENAME takes the new name without a catalog."""
    short = ".".join(map(quoted, other.split(".")[-2:]))
    spark.sql(f"ALTER TABLE IDENTIFIER(:name) RENAME TO {short}", args={"name": name})


def _drop(spark: SparkSession, name: str) -> None:
    spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:name)", args={"name": name})


def restore_table(spark: SparkSession, name: str) -> None:
    """Finish or undo an exchange of tables that the driver did not live to finish."""
    before, after = _beside(name, "before"), _beside(name, "next")
    if spark.catalog.tableExists(before):
        if spark.catalog.tableExists(name):
            _drop(spark, before)
        else:
            _rename(spark, before, name)
    _drop(spark, after)


def _exchange(spark: SparkSession, name: str, properties: dict[str, str]) -> None:
    """Put the table beside ``name`` in its place; at a failure the old one comes back."""
    before, after = _beside(name, "before"), _beside(name, "next")
    for key, value in properties.items():
        set_table_property(spark, after, key, value)
    _rename(spark, name, before)
    try:
        _rename(spark, after, name)
    except BaseException:
        _rename(spark, before, name)
        raise
    _drop(spark, before)


def overwrite_table(
    df: DataFrame,
    name: str,
    location: str,
    file_format: str = "parquet",
    partition_by: Sequence[str] = (),
    allow_schema_change: bool = False,
) -> DataFrame:
    """Make ``df`` the content of table ``name`` and return the table.

    A table has two folders under ``location``. The rows are written to the one it is not in, and
    the table is pointed there, in one step of the catalog, when they are complete: readers see the old rows or the
    new ones, ``df`` may read the table it replaces, and a failed job leaves the table as it was. The rows
    before the last overwrite stay in the other folder until the next one. Partitions are found by
    their folders, so that this holds for tables with partitions too.

    Columns that are only added are added to the table before it is pointed to the new rows. Other
    changes of columns, and tables whose partitions the catalog keeps, need another table: it is made complete beside the
    old one, and two renames exchange them. If the second fails, the first is undone; if the driver ends between the two,
    ``restore_table``, which every overwrite begins with, brings the old table back. Properties are kept.
    """
    spark = df.sparkSession
    restore_table(spark, name)
    if not spark.catalog.tableExists(name):
        folder = f"{location.rstrip('/')}/a"
        _write(df, file_format, partition_by, folder)
        _create(spark, name, df, file_format, folder, partition_by)
        return spark.table(name)
    old, known = dict(_columns(spark.table(name))), _described(spark, name)
    new = dict(_columns(df))
    if old != new and not allow_schema_change:
        raise SchemaChanged(f"{name} has other columns than the rows to be written")
    side = "b" if known["Location"].rstrip("/").endswith("/a") else "a"
    folder = f"{location.rstrip('/')}/{side}"
    _write(df, file_format, partition_by, folder)
    parts = [c.name.lower() for c in spark.catalog.listColumns(name) if c.isPartition]
    by_folder = parts == [c.lower() for c in partition_by] and known.get("Partition Provider") != "Catalog"
    if by_folder and old.items() <= new.items() and known.get("Provider", "").lower() == file_format:
        added = df.select(*(named(c) for c in df.columns if c.lower() not in old))
        if added.columns:
            spark.sql(f"ALTER TABLE IDENTIFIER(:name) ADD COLUMNS ({_ddl(added)})", args={"name": name})
        _point(spark, name, folder)
    else:
        properties = {
            row["key"]: row["value"] for row in spark.sql("SHOW TBLPROPERTIES IDENTIFIER(:name)", args={"name": name}).collect()
        }
        _create(spark, _beside(name, "next"), df, file_format, folder, partition_by)
        _exchange(spark, name, properties)
    return spark.table(name)


def _write(df: DataFrame, file_format: str, partition_by: Sequence[str], folder: str) -> None:
    df.write.format(file_format).mode("overwrite").partitionBy(*partition_by).save(folder)


def append_rows(df: DataFrame, name: str) -> DataFrame:
    """Add rows to a table, matched by column name, and return the table. Only the new rows are
    written."""
    spark = df.sparkSession
    df.select(*map(named, spark.table(name).columns)).write.insertInto(name)
    spark.catalog.refreshTable(name)
    return spark.table(name)


def table_property(spark: SparkSession, name: str, key: str) -> str | None:
    """A property of a table, None if there is no such table or property."""
    if not spark.catalog.tableExists(name):
        return None
    rows = spark.sql("SHOW TBLPROPERTIES IDENTIFIER(:name)", args={"name": name}).collect()
    return next((row["value"] for row in rows if row["key"] == key), None)


def set_table_property(spark: SparkSession, name: str, key: str, value: str) -> None:
    spark.sql(
        f"ALTER TABLE IDENTIFIER(:name) SET TBLPROPERTIES ({_text(key)} = {_text(value)})",
        args={"name": name},
    )
