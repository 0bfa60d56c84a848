"""Sending rows to the clean layer or to quarantine, with a reason and without losing any.

``route`` does the one wide shuffle. Its result holds each distinct row once, with its marks in one
struct as the last column, under a name that no column of the rows has: ``kept`` tells whether a
copy of the row survives as the first of its key, ``extra`` how many further copies there are,
``reason`` why the first copy is refused, if it is. Clean rows, quarantine and quality report all
follow from it without another wide shuffle, so a run writes it out once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tierwork.functions.names import free_name, named, spelled
from tierwork.operators.copies import collapse_copies, repeat_rows

# The words and columns a quarantine table carries.
DUPLICATE = "duplicate row"
NULL_IN = "null in "
REASON_COLUMN = "reject_reason"
QUARANTINE_TIME_COLUMN = "quarantine_timestamp"

# Fixed value: why a record that does not fit its header is refused.
MALFORMED = "malformed record"


class DefaultMismatch(ValueError):
    """A default cannot be filled in: the column is missing or not text."""


def any_null(columns: Sequence[str]) -> Column:
    """True where at least one of the columns is null; never null itself."""
    return reduce(or_, (named(name).isNull() for name in columns), F.lit(False))


def first_null(columns: Sequence[str]) -> Column:
    """``null in X`` for the first null column in the given order, null if there is none."""
    tests = [F.when(named(name).isNull(), F.lit(NULL_IN + name)) for name in columns]
    return F.coalesce(*tests, F.lit(None).cast("string"))


def marks(routed: DataFrame) -> Column:
    """The marks of routed rows."""
    return named(routed.columns[-1])


def row_columns(routed: DataFrame) -> list[str]:
    return routed.columns[:-1]


def route(
    df: DataFrame,
    critical: Sequence[str],
    key: Sequence[str] | None = None,
    order: Sequence[str] = (),
    malformed: str | None = None,
) -> DataFrame:
    """Distinct rows of ``df`` with the marks described above.

    Without ``key`` two rows are duplicates if they agree in every column. With a key the first
    row of a key survives, by ``order`` and then by the remaining columns. Names match without
    case. Rows with something in the column ``malformed`` are refused for that.
    """
    columns = list(map(named, df.columns))
    copies, kept = free_name("_copies", df.columns), free_name("_kept", df.columns)
    key = None if key is None else spelled(key, df.columns)
    if key is None or set(key) >= set(df.columns):
        marked = collapse_copies(df, copies).withColumn(kept, F.lit(True))
    elif order:
        # The survivors go through the same aggregate as the rows, which so learn whether they are
        # one. Both aggregates fold on the map side: unlike with a window over the key, a key with
        # a third of all rows does not end in one task.
        n, first = free_name("_n", df.columns), free_name("_first", df.columns)
        rows = df.withColumns({n: F.lit(1), first: F.lit(False)})
        firsts = _first_rows(df, key, spelled(order, df.columns))
        firsts = firsts.withColumns({n: F.lit(0), first: F.lit(True)})
        marked = (
            rows.unionByName(firsts)
            .groupBy(*columns)
            .agg(F.sum(n).alias(copies), F.max(first).alias(kept))
        )
    else:
        raise ValueError("a key that is not the whole row needs an order to pick the survivor by")
    reason = first_null(spelled(critical, df.columns))
    if malformed is not None:
        reason = F.when(named(malformed).isNotNull(), F.lit(MALFORMED)).otherwise(reason)
    found = F.struct(
        F.col(kept).alias("kept"),
        (F.col(copies) - F.col(kept).cast("bigint")).alias("extra"),
        reason.alias("reason"),
    )
    return marked.select(*columns, found.alias(free_name("_marks", df.columns)))


def _first_rows(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key, by ``order`` and then by the remaining columns."""
    others = [name for name in dict.fromkeys((*order, *df.columns)) if name not in key]
    firsts = df.groupBy(*(named(name).alias(f"_key{i}") for i, name in enumerate(key))).agg(
        F.min(F.struct(*map(named, others))).alias("_first")
    )
    return firsts.select(
        *(F.col(f"_key{i}").alias(name) for i, name in enumerate(key)),
        *(F.col("_first").getField(name).alias(name) for name in others),
    )


def clean_rows(routed: DataFrame) -> DataFrame:
    """The rows that pass, as they came in."""
    mark = marks(routed)
    passed = routed.filter(mark["kept"] & mark["reason"].isNull())
    return passed.select(*map(named, row_columns(routed)))


def rejected_rows(routed: DataFrame) -> DataFrame:
    """The rows that do not pass, every copy of them, as they came in, with the reason."""
    mark, rows = marks(routed), row_columns(routed)
    cases = F.array_compact(
        F.array(
            F.when(
                mark["kept"] & mark["reason"].isNotNull(),
                F.struct(mark["reason"].alias("reason"), F.lit(1).cast("bigint").alias("n")),
            ),
            F.when(
                mark["extra"] > 0,
                F.struct(F.lit(DUPLICATE).alias("reason"), mark["extra"].alias("n")),
            ),
        )
    )
    refused = routed.filter((mark["extra"] > 0) | mark["reason"].isNotNull())
    case, n = free_name("_case", rows), free_name("_n", [*rows, REASON_COLUMN])
    listed = refused.select(*map(named, rows), F.explode(cases).alias(case))
    listed = listed.select(
        *map(named, rows),
        F.col(case)["reason"].alias(REASON_COLUMN),
        F.col(case)["n"].alias(n),
    )
    return repeat_rows(listed, n)


def quarantine(routed: DataFrame, at: Column | None = None) -> DataFrame:
    """The rejected rows and the time they were put aside."""
    at = F.current_timestamp() if at is None else at
    return rejected_rows(routed).withColumn(QUARANTINE_TIME_COLUMN, at)


def fill_defaults(df: DataFrame, defaults: Mapping[str, str]) -> DataFrame:
    """Put text defaults in place of nulls; empty text is not null and stays."""
    types = {field.name.lower(): field.dataType for field in df.schema}
    for name in defaults:
        if not isinstance(types.get(name.lower()), StringType):
            raise DefaultMismatch(f"{name} is not a text column of these rows")
    return df.na.fill(dict(defaults)) if defaults else df


def reconcile(source: DataFrame, clean: DataFrame, rejected: DataFrame) -> DataFrame:
    """Row counts of the three layers and whether the first is the sum of the others (one row)."""
    layers = {"source_rows": source, "clean_rows": clean, "rejected_rows": rejected}
    counts = [
        frame.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("layer"), "n")
        for name, frame in layers.items()
    ]
    one = reduce(DataFrame.unionByName, counts).agg(
        *(F.max(F.when(F.col("layer") == name, F.col("n"))).alias(name) for name in layers)
    )
    matched = F.col("source_rows") == F.col("clean_rows") + F.col("rejected_rows")
    return one.withColumn("matched", matched)
