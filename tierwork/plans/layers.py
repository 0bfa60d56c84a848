"""The layers of a dataset, each a function of the one before it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tierwork.functions.dates import loss_counts, parse_timestamps
from tierwork.functions.names import NameCollision, named, rename_columns, sanitize_columns
from tierwork.operators.metrics import metric_table
from tierwork.operators.routing import clean_rows, fill_defaults, route
from tierwork.sources.delimited import Facts, read_csv
from tierwork.spec import INGEST_TIME_COLUMN, METADATA, SOURCE_FILE_COLUMN, DatasetSpec

# Fixed value: the time column of a metric table.
CREATED_TIME_COLUMN = "created_timestamp"


def with_metadata(df: DataFrame, file_name: Column, at: Column | None = None) -> DataFrame:
    """Add load time and source file as the last columns; the rows must not have such columns."""
    at = F.current_timestamp() if at is None else at
    taken = {name.lower() for name in df.columns} & {name.lower() for name in METADATA}
    if taken:
        raise NameCollision(f"the rows have a column {min(taken)!r} already")
    return df.select("*", at.alias(INGEST_TIME_COLUMN), file_name.alias(SOURCE_FILE_COLUMN))


def bronze(
    spark: SparkSession,
    spec: DatasetSpec,
    path: str,
    at: Column | None = None,
    facts: Facts | None = None,
) -> DataFrame:
    """The raw file with usable column names and load metadata, otherwise as it came. A record that
    does not fit its header keeps its text in a column of its own. ``facts``, if known, save a pass over the text."""
    file_name = "/source file"
    raw = read_csv(
        spark,
        path,
        infer_types=spec.infer_types,
        malformed=spec.malformed_column,
        by_name=spec.by_name,
        file_name=file_name,
        multi_line=spec.multi_line,
        facts=facts,
    )
    origin = named(file_name)
    if spec.file_names == "path":
        origin = F.lit(path.rstrip("/").rsplit("/", 1)[-1])
    own = usable_names(raw.drop(file_name), spec).columns
    rows = raw.select(*(named(old).alias(new) for old, new in zip(raw.columns, own)), named(file_name))
    times = F.current_timestamp() if at is None else at
    taken = {name.lower() for name in own} & {name.lower() for name in METADATA}
    if taken:
        raise NameCollision(f"the file has a column {min(taken)!r}, which the load adds")
    return rows.select(
        *map(named, own), times.alias(INGEST_TIME_COLUMN), origin.alias(SOURCE_FILE_COLUMN)
    )


def usable_names(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    renamed = rename_columns(df, spec.renames)
    return sanitize_columns(renamed) if spec.sanitize else renamed


def routed(rows: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Distinct bronze rows marked for silver or quarantine (see ``operators.routing``)."""
    key, order = spec.duplicate_key, spec.duplicate_order
    if spec.across_loads:
        key, order = [name for name in rows.columns if name not in METADATA], METADATA
    malformed = spec.malformed_column if spec.malformed_column in rows.columns else None
    return route(rows, spec.critical, key, order, malformed)


def silver(
    routed_rows: DataFrame, spec: DatasetSpec, losses: Observation | None = None
) -> DataFrame:
    """Clean rows with defaults filled in and dates parsed. ``losses`` sees per date column how many
    values fit no format, while the rows are written."""
    rows = clean_rows(routed_rows)
    if spec.malformed_column in rows.columns:
        rows = rows.drop(named(spec.malformed_column))
    filled = fill_defaults(rows, spec.defaults)
    if losses is not None and spec.date_columns:
        filled = filled.observe(losses, *loss_counts(filled, spec.date_columns, spec.date_formats))
    return parse_timestamps(filled, spec.date_columns, spec.date_formats)


def gold(silver_rows: DataFrame, spec: DatasetSpec, at: Column | None = None) -> DataFrame:
    """The long metric table."""
    at = F.current_timestamp() if at is None else at
    return metric_table(silver_rows, spec.metrics).withColumn(CREATED_TIME_COLUMN, at)
