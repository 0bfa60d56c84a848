"""Business metrics in long form: ``aggregation_type, group_column, metric, value``.

A metric says what to group by and what to measure. ``metric_table`` computes any number of them
with one grouping-sets aggregate over one column-pruned scan; the partial aggregates fold hot
groups before the shuffle. No sort is planned: order belongs to whoever shows the table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierwork.functions.dates import hours_between, year_month
from tierwork.functions.names import named


@dataclass(frozen=True)
class CountBy:
    """Rows per value of a column."""

    name: str
    column: str
    metric: str = "row_count"

    def group(self) -> Column:
        return named(self.column)

    def input(self) -> Column:
        """What is measured, per row."""
        return F.lit(1)

    def measure(self, values: Column) -> Column:
        return F.count(values)

    def reported(self, group: Column, measure: Column) -> Column:
        return F.lit(True)


@dataclass(frozen=True)
class CountByMonth(CountBy):
    """Rows per month of a date column; rows without a date are left out."""

    pad: bool = False

    def group(self) -> Column:
        return year_month(named(self.column), self.pad)

    def reported(self, group: Column, measure: Column) -> Column:
        return group.isNotNull()


def exact_mean(values: Column) -> Column:
    """The mean of decimals, rounded to two places. A decimal sum does not depend on the order in which
    partial sums arrive, so a task that runs again cannot change the last digit."""
    mean = F.try_divide(F.sum(values).cast("double"), F.count(values).cast("double"))
    return F.round(mean, 2)


@dataclass(frozen=True)
class AverageHours:
    """Mean hours between two dates per value of a column; missing dates and negative durations
    are left out, and so is a group that has nothing else."""

    name: str
    column: str
    start: str
    end: str
    metric: str = "avg_hours"

    def group(self) -> Column:
        return named(self.column)

    def input(self) -> Column:
        hours = hours_between(named(self.start), named(self.end))
        return F.when(hours >= 0, hours).cast("decimal(20,2)")

    def measure(self, values: Column) -> Column:
        return exact_mean(values)

    def reported(self, group: Column, measure: Column) -> Column:
        return measure.isNotNull()


Metric = CountBy | AverageHours


def count_by(df: DataFrame, column: str, alias: str = "count") -> DataFrame:
    return df.groupBy(named(column)).agg(F.count(F.lit(1)).alias(alias))


def average_by(df: DataFrame, column: str, value: Column, alias: str, scale: int = 6) -> DataFrame:
    """The mean of a value per value of a column, rounded to two places. The value is taken to ``scale``
    places, in decimals of 38 digits, so the sum does not depend on the order of partial sums."""
    return df.groupBy(named(column)).agg(exact_mean(value.cast(f"decimal({20 + scale},{scale})")).alias(alias))


def largest_first(df: DataFrame, measure: str, *ties: str) -> DataFrame:
    """Ordered by a measure, largest first, ties by the given columns."""
    return df.orderBy(named(measure).desc(), *map(named, ties))


def metric_table(df: DataFrame, metrics: Sequence[Metric]) -> DataFrame:
    """All metrics of ``df`` as one long table."""
    groups: dict[str, Column] = {}
    for metric in metrics:
        groups.setdefault(str(metric.group()), metric.group())
    places = {text: i for i, text in enumerate(groups)}
    dims = [f"_group{i}" for i in range(len(groups))]

    # Groups and inputs are worked out before the rows are multiplied by the grouping sets.
    wide = df.select(
        *(group.alias(dim) for dim, group in zip(dims, groups.values())),
        *(metric.input().alias(f"_input{i}") for i, metric in enumerate(metrics)),
    )
    totals = wide.groupingSets([[F.col(dim)] for dim in dims], *map(F.col, dims)).agg(
        F.grouping_id().alias("_set"),
        *(
            metric.measure(F.col(f"_input{i}")).alias(f"_measure{i}")
            for i, metric in enumerate(metrics)
        ),
    )

    def long_row(i: int, metric: Metric) -> Column:
        place = places[str(metric.group())]
        group, measure = F.col(dims[place]), F.col(f"_measure{i}")
        # grouping_id has one bit per grouping column, first column highest, set where the
        # column takes no part; only this tells an unused column from a null group.
        used = 2 ** len(dims) - 1 - 2 ** (len(dims) - 1 - place)
        return F.when(
            (F.col("_set") == used) & metric.reported(group, measure),
            F.struct(
                F.lit(metric.name).alias("aggregation_type"),
                group.cast("string").alias("group_column"),
                F.lit(metric.metric).alias("metric"),
                measure.cast("string").alias("value"),
            ),
        )

    rows = F.array_compact(F.array(*(long_row(i, metric) for i, metric in enumerate(metrics))))
    return totals.select(F.inline(rows))
