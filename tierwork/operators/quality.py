"""Data-quality checks.

All counts come from one aggregate over the rows, whose single result row is then laid out as
report rows on the executors. A check that needs no duplicate count reads the rows without any
shuffle but that of the partial counts.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierwork.functions.measures import (
    FAIL,
    INFO,
    WARNING,
    percentage,
    percentage_text,
    status,
)
from tierwork.functions.names import free_name, named, spelled
from tierwork.operators.copies import collapse_copies
from tierwork.operators.routing import marks, row_columns

# Check names, row labels, wording and the time column of a report.
RECORD_COUNT = "RECORD_COUNT"
DUPLICATE_CHECK = "DUPLICATE_CHECK"
KEY_CHECK = "DUPLICATE_KEY_CHECK"
CRITICAL_NULL_CHECK = "CRITICAL_NULL_CHECK"
NULL_CHECK = "NULL_CHECK"
TOTAL_ROWS = "total_rows"
DUPLICATE_ROWS = "duplicate_rows"
KEY_ROWS = "rows_of_a_key_kept_elsewhere"
CRITICAL_COLUMNS = "critical_columns_with_nulls"
ALL_ROWS = "100%"
COLUMNS_AFFECTED = " columns affected"
REPORT_TIME_COLUMN = "report_timestamp"


class QualityGateFailed(RuntimeError):
    """Critical columns hold nulls and the gate was told not to let that pass."""


def _sum(values: Column) -> Column:
    return F.coalesce(F.sum(values), F.lit(0).cast("bigint"))


def counts_of(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: ``total`` and ``n0 .. nk``, the nulls of ``columns``; one pass, no wide shuffle."""
    present = df.agg(
        F.count(F.lit(1)).alias("total"),
        *(F.count(named(name)).alias(f"p{i}") for i, name in enumerate(columns)),
    )
    nulls = ((F.col("total") - F.col(f"p{i}")).alias(f"n{i}") for i in range(len(columns)))
    return present.select("total", *nulls)


def _weighted(columns: Sequence[str], weight: Column, extra: Column) -> list[Column]:
    """The same for rows that stand for ``weight`` rows each, and ``duplicates``."""
    return [
        _sum(weight).alias("total"),
        _sum(extra).alias("duplicates"),
        *(
            _sum(F.when(named(name).isNull(), weight)).alias(f"n{i}")
            for i, name in enumerate(columns)
        ),
    ]


def counts_with_duplicates(df: DataFrame) -> DataFrame:
    """Total, duplicates and nulls of every column; one pass and one shuffle of folded rows."""
    copies = free_name("_copies", df.columns)
    n = F.col(copies)
    return collapse_copies(df, copies).agg(*_weighted(df.columns, n, n - 1))


def routed_counts(routed: DataFrame) -> list[Column]:
    """The same as aggregates over routed rows, which need no shuffle any more, and ``rejected``,
    the rows that another row of their key was kept instead of. A row's copies are duplicates but
    for one, whether or not that one was kept, so the count is the same as without a key."""
    mark = marks(routed)
    kept = mark["kept"].cast("bigint")
    weight = kept + mark["extra"]
    return [*_weighted(row_columns(routed), weight, weight - 1), _sum(1 - kept).alias("rejected")]


Finding = tuple[str, str, Column]


def _record() -> Finding:
    return RECORD_COUNT, TOTAL_ROWS, F.col("total")


def _duplicates() -> Finding:
    return DUPLICATE_CHECK, DUPLICATE_ROWS, F.col("duplicates")


def _key_rejects() -> Finding:
    return KEY_CHECK, KEY_ROWS, F.col("rejected")


def _critical(columns: Sequence[str], critical: Sequence[str]) -> Finding:
    """How many critical columns hold a null, from a counts row over ``columns``."""
    places = [list(columns).index(name) for name in spelled(critical, columns)]
    hit = (F.when(F.col(f"n{i}") > 0, 1).otherwise(0) for i in places)
    return CRITICAL_NULL_CHECK, CRITICAL_COLUMNS, sum(hit, F.lit(0).cast("bigint"))


def _nulls(columns: Sequence[str], besides: Sequence[str] = ()) -> list[Finding]:
    found = ((NULL_CHECK, name, F.col(f"n{i}")) for i, name in enumerate(columns))
    return [finding for finding in found if finding[1] not in besides]


def _found(counts: DataFrame, findings: Sequence[Finding]) -> DataFrame:
    """A row per finding, in order: ``check_type, column_name, n`` and the total."""
    rows = F.array(
        *(
            F.struct(F.lit(check).alias("check_type"), F.lit(label).alias("column_name"), n.alias("n"))
            for check, label, n in findings
        )
    )
    return counts.select("total", F.inline(rows))


def _laid_out(counts: DataFrame, findings: Sequence[Finding], critical: int = 0) -> DataFrame:
    """Findings in the wording of a report; ``critical`` is the number of critical columns."""
    kind, n = F.col("check_type"), F.col("n")
    share = (
        F.when(kind == RECORD_COUNT, F.lit(ALL_ROWS))
        .when(kind == CRITICAL_NULL_CHECK, F.concat(n, F.lit(f"/{critical}{COLUMNS_AFFECTED}")))
        .otherwise(percentage_text(n, F.col("total")))
    )
    state = (
        F.when(kind == RECORD_COUNT, F.lit(INFO))
        .when(kind == CRITICAL_NULL_CHECK, status(n, FAIL))
        .otherwise(status(n, WARNING))
    )
    return _found(counts, findings).select(
        "check_type",
        "column_name",
        n.cast("string").alias("value"),
        share.alias("percentage"),
        state.alias("status"),
    )


def record_count(df: DataFrame) -> DataFrame:
    return _laid_out(counts_of(df, []), [_record()])


def null_check(df: DataFrame) -> DataFrame:
    return _laid_out(counts_of(df, df.columns), _nulls(df.columns))


def duplicate_check(df: DataFrame) -> DataFrame:
    return _laid_out(counts_with_duplicates(df), [_duplicates()])


def critical_check(df: DataFrame, critical: Sequence[str]) -> DataFrame:
    finding = _critical(critical, critical)
    return _laid_out(counts_of(df, critical), [finding], len(critical))


def report_of_counts(
    counts: DataFrame,
    columns: Sequence[str],
    critical: Sequence[str],
    keyed: bool = False,
    besides: Sequence[str] = (),
) -> DataFrame:
    """The report from one row of counts over ``columns``; ``keyed`` adds a row for the rows that
    are no copies but share their key with a row that was kept; the nulls of columns ``besides``
    those of the data are not reported."""
    findings = [
        _record(),
        _duplicates(),
        *([_key_rejects()] if keyed else []),
        _critical(columns, critical),
        *_nulls(columns, besides),
    ]
    return _laid_out(counts, findings, len(critical))


def quality_report(df: DataFrame, critical: Sequence[str]) -> DataFrame:
    """Record count, duplicates, critical columns, then nulls per column, in this order."""
    return report_of_counts(counts_with_duplicates(df), df.columns, critical)


def quality_report_of_routed(
    routed: DataFrame, critical: Sequence[str], keyed: bool = False
) -> DataFrame:
    counts = routed.agg(*routed_counts(routed))
    return report_of_counts(counts, row_columns(routed), critical, keyed)


def timed(report: DataFrame, at: Column | None = None) -> DataFrame:
    at = F.current_timestamp() if at is None else at
    return report.withColumn(REPORT_TIME_COLUMN, at)


def gate(report: DataFrame) -> DataFrame:
    """One row from a quality report: the decision and the two counts behind it."""

    def value_of(check: str) -> Column:
        return F.max(F.when(F.col("check_type") == check, F.col("value").cast("bigint")))

    found = report.agg(
        value_of(CRITICAL_NULL_CHECK).alias("critical_issues"),
        value_of(DUPLICATE_CHECK).alias("duplicate_rows"),
    )
    decision = F.when(F.col("critical_issues") == 0, F.lit("passed")).otherwise(F.lit("quarantine"))
    return found.select(decision.alias("decision"), "critical_issues", "duplicate_rows")


def enforce_gate(report: DataFrame, on_fail: str = "warn") -> None:
    """Stop or warn if critical columns hold nulls (reads one row)."""
    row = gate(report).first()
    if row["critical_issues"]:
        found = f"{row['critical_issues']} critical columns hold nulls"
        if on_fail == "raise":
            raise QualityGateFailed(found)
        warnings.warn(found, stacklevel=2)


def null_counts(df: DataFrame) -> DataFrame:
    """Nulls per column, as numbers."""
    found = _found(counts_of(df, df.columns), _nulls(df.columns))
    return found.select("column_name", F.col("n").alias("null_count"))


def null_percentages(df: DataFrame) -> DataFrame:
    """Share of nulls per column in percent."""
    found = _found(counts_of(df, df.columns), _nulls(df.columns))
    share = percentage(F.col("n"), F.col("total")).alias("null_percentage")
    return found.select("column_name", share)


def table_profile(df: DataFrame) -> DataFrame:
    """Rows and columns of a table (one row)."""
    return counts_of(df, []).select(
        F.col("total").alias("row_count"), F.lit(len(df.columns)).alias("column_count")
    )
