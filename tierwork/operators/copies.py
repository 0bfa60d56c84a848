"""Exact copies of rows: counting them, dropping them, writing them out again.

Copies are always counted with a grouped aggregate. Its map side folds equal rows before the
shuffle, so a row that makes up a third of a table reaches the reducers as one row per map task.
A window over the full row would carry every copy to a single task. Nulls equal nulls, NaN equals
NaN and -0.0 equals 0.0, as everywhere in Spark's grouping.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierwork.functions.names import free_name, named

# Up to this many repeats of a row are written by the task that holds the row; beyond it the row
# is cut into blocks that are spread over the cluster first. No repeat is ever left out.
REPEATS_IN_PLACE = 100
# Upper bound on the blocks one row is cut into, hence on the array that lists them.
MOST_BLOCKS = 1_000_000


def collapse_copies(df: DataFrame, copies: str = "_copies") -> DataFrame:
    """One row per distinct row and the number of its copies."""
    return df.groupBy(*map(named, df.columns)).agg(F.count(F.lit(1)).alias(copies))


def distinct_rows(df: DataFrame, key: Sequence[str] | None = None) -> DataFrame:
    """One row per distinct row, or per distinct key."""
    return df.dropDuplicates(list(key) if key else df.columns)


def _counting(first: Column, how_many: Column) -> Column:
    return F.sequence(first, first + how_many - 1)


def repeat_rows(df: DataFrame, times: str, position: str | None = None) -> DataFrame:
    """Every row as often as its column ``times`` says; that column is dropped.

    ``position`` numbers the repeats of a row from 1. Rows with ``times`` below 1 vanish.
    """
    rest = [named(name) for name in df.columns if name != times]
    n = named(times).cast("bigint")
    at = free_name("_at", df.columns)
    start, width = free_name("_start", df.columns), free_name("_width", df.columns)

    def kept(frame: DataFrame) -> DataFrame:
        return frame.select(*rest, *([F.col(at).alias(position)] if position else []))

    few = df.filter((n >= 1) & (n <= REPEATS_IN_PLACE))
    few = few.withColumn(at, F.explode(_counting(F.lit(1).cast("bigint"), n)))

    block = F.greatest(F.lit(REPEATS_IN_PLACE), F.ceil(n / MOST_BLOCKS)).cast("bigint")
    many = df.filter(n > REPEATS_IN_PLACE).withColumn(width, block)
    starts = F.sequence(F.lit(1).cast("bigint"), n, F.col(width))
    many = many.withColumn(start, F.explode(starts))
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    many = many.repartition(tasks, F.xxhash64(F.col(start), *rest))
    length = F.least(F.col(width), n - F.col(start) + 1)
    many = many.withColumn(at, F.explode(_counting(F.col(start), length)))

    return kept(few).unionByName(kept(many))


def number_copies(df: DataFrame, position: str = "row_num") -> DataFrame:
    """Every row, its copies numbered from 1."""
    count = free_name("_copies", df.columns)
    return repeat_rows(collapse_copies(df, count), count, position)


def extra_copies(df: DataFrame) -> DataFrame:
    """All copies of a row but one."""
    count = free_name("_copies", df.columns)
    collapsed = collapse_copies(df, count)
    return repeat_rows(collapsed.withColumn(count, F.col(count) - 1), count)


def copies_delta(left: DataFrame, right: DataFrame, delta: str = "_delta") -> DataFrame:
    """One row per distinct row that ``left`` and ``right`` hold unequally often, with the
    copies in ``left`` minus those in ``right``.

    Both sides go through one aggregate, so both directions of a bag difference cost one shuffle.
    """
    sides = left.withColumn(delta, F.lit(1)).unionByName(right.withColumn(delta, F.lit(-1)))
    net = sides.groupBy(*map(named, left.columns)).agg(F.sum(delta).alias(delta))
    return net.filter(F.col(delta) != 0)


def rows_missing(left: DataFrame, right: DataFrame) -> DataFrame:
    """The rows of ``left`` that ``right`` lacks, copies counted."""
    delta = free_name("_delta", left.columns)
    return repeat_rows(copies_delta(left, right, delta), delta)
