"""Timestamps: parsing text, month keys, durations."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierwork.functions.names import named


def moment(at: datetime) -> Column:
    """A point in time; without a zone of its own it is meant in the session's, whatever the zone
    of the machine the driver runs on."""
    return F.lit(at.isoformat(sep=" ")).cast("timestamp")


def parsed_timestamp(df: DataFrame, name: str, formats: Sequence[str]) -> Column:
    """The column as a timestamp: the first format that fits, null if none does.

    A column that is a timestamp already is passed on unchanged.
    """
    if df.select(named(name)).dtypes[0][1].startswith("timestamp"):
        return named(name)
    return F.coalesce(*(F.try_to_timestamp(named(name), F.lit(fmt)) for fmt in formats))


def parse_timestamps(df: DataFrame, names: Sequence[str], formats: Sequence[str]) -> DataFrame:
    return df.withColumns({name: parsed_timestamp(df, name, formats) for name in names})


def loss_counts(df: DataFrame, names: Sequence[str], formats: Sequence[str]) -> list[Column]:
    """Aggregates ``_0``, ``_1`` and so on: values of each date column that fit no format."""
    return [
        F.count_if(named(name).isNotNull() & parsed_timestamp(df, name, formats).isNull()).alias(f"_{i}")
        for i, name in enumerate(names)
    ]


def parse_losses(df: DataFrame, names: Sequence[str], formats: Sequence[str]) -> DataFrame:
    """Per date column, how many values are present as text but fit no format (one pass)."""
    return listed_losses(df.agg(*loss_counts(df, names, formats)), names)


def listed_losses(counts: DataFrame, names: Sequence[str]) -> DataFrame:
    """A row per date column from one row of ``loss_counts``."""
    return counts.select(
        F.inline(
            F.array(
                *(
                    F.struct(F.lit(name).alias("column_name"), F.col(f"_{i}").alias("lost_values"))
                    for i, name in enumerate(names)
                )
            )
        )
    )


def year_month(column: Column, pad: bool = False) -> Column:
    """``2024-1`` for January 2024, or ``2024-01`` with ``pad``."""
    if pad:
        return F.date_format(column, "yyyy-MM")
    return F.concat(F.year(column), F.lit("-"), F.month(column))


def hours_between(start: Column, end: Column) -> Column:
    """Hours from ``start`` to ``end``, two decimals, from whole seconds."""
    return F.round((F.unix_timestamp(end) - F.unix_timestamp(start)) / 3600, 2)
