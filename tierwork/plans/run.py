"""All layers of a dataset, written as tables."""

from __future__ import annotations

import json
import warnings
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tierwork.functions.names import named
from tierwork.operators.quality import enforce_gate, report_of_counts, routed_counts, timed
from tierwork.operators.routing import quarantine, reconcile, row_columns
from tierwork.functions.names import named
from tierwork.plans import layers
from tierwork.plans.progress import Progress
from tierwork.sources.delimited import Facts, UnclosedQuote, inspect, listing_of, record_lines
from tierwork.sources.tables import overwrite_table
from tierwork.sources.work import written_and_counted
from tierwork.spec import DatasetSpec

#: The step that the intermediate table stands for, noted on the bronze table.
ROUTED = ".routed"

LAYERS = ("bronze", "quality", "silver", "quarantine", "gold")


class DatesLost(RuntimeError):
    """Dates are in none of the formats listed, and the run was told not to let that pass."""


class RowsLost(RuntimeError):
    """A layer does not hold all rows of the one before: bronze those of the files, or silver and
    quarantine together those of bronze."""


def run(
    spark: SparkSession, spec: DatasetSpec, path: str, location: str, resume: bool = False
) -> DataFrame:
    """Read ``path``, write the five tables under ``location``, return rows per layer.

    Each step starts from a written table, so the raw file is read once and the wide shuffle of
    the duplicate search runs once. The report is counted while its result is written, and lost
    dates while silver is; quarantine and silver are narrow reads of that. The next run writes the
    intermediate table over.
    An exception stops the run and leaves the tables of later layers as they were. With ``resume`` a run over
    the same files by the same rules goes on behind the last layer that is complete; its checks are made again.
    """
    inspected = spec.by_name or spec.multi_line is None
    facts = inspect(spark, path, spec.by_name) if inspected and not resume else None
    progress = Progress(spark, spec, facts.listing if facts else listing_of(spark, path), resume)

    def write(df: DataFrame, layer: str) -> DataFrame:
        return overwrite_table(df, spec.table(layer), f"{location}/{layer}")

    def layer(name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """The table of a layer, made unless it is complete."""
        if progress.done(name):
            return spark.table(spec.table(name))
        table = write(make(), name)
        progress.mark(name)
        return table

    if progress.done("bronze"):
        bronze = spark.table(spec.table("bronze"))
    else:
        if inspected and facts is None:
            facts = inspect(spark, path, spec.by_name)
        bronze = write(layers.bronze(spark, spec, path, facts=facts), "bronze")
        if facts:
            check_source(spark, path, facts, bronze, spec.malformed_column, spec.on_loss)
        progress.mark("bronze")
    if progress.done("bronze", ROUTED):
        routed = spark.read.parquet(f"{location}/routed")
        counts = routed.agg(*routed_counts(routed))
    else:
        routed = layers.routed(bronze, spec)
        routed, counts = written_and_counted(routed, "routed", routed_counts(routed), f"{location}/routed")
        progress.mark("bronze", ROUTED)
    columns, keyed = row_columns(routed), spec.duplicate_key is not None or spec.across_loads
    found = report_of_counts(counts, columns, spec.critical, keyed, [spec.malformed_column])
    report = layer("quality", lambda: timed(found))
    enforce_gate(report, spec.on_fail)
    # Few rejected rows come out of every scan task; rebalanced, they make few files.
    rejected = layer("quarantine", lambda: quarantine(routed).hint("rebalance"))
    if progress.done("silver"):
        clean, lost = spark.table(spec.table("silver")), json.loads(progress.noted("silver", "dates lost"))
    else:
        clean, lost = written_silver(routed, spec, lambda rows: write(rows, "silver"))
        progress.note("silver", "dates lost", json.dumps(lost))
        progress.mark("silver")
    check_dates(lost, spec.on_date_loss)
    check_rows(bronze, clean, rejected, spec.on_loss)
    layer("gold", lambda: layers.gold(clean, spec))
    return layer_rows(spark, spec)


def written_silver(
    routed: DataFrame, spec: DatasetSpec, write: Callable[[DataFrame], DataFrame]
) -> tuple[DataFrame, dict[str, int]]:
    """Silver as ``write`` leaves it, and per date column the values that were in no known format,
    counted while it was written."""
    losses = Observation()
    clean = write(layers.silver(routed, spec, losses))
    counts = losses.get.values() if spec.date_columns else ()
    return clean, dict(zip(spec.date_columns, counts))


def check_dates(lost: dict[str, int], on_loss: str = "warn") -> None:
    """Stop or warn if some column has dates that no format fits, which are null by now."""
    found = {name: count for name, count in lost.items() if count}
    if found:
        if on_loss == "raise":
            raise DatesLost(f"dates lost: {found}")
        warnings.warn(f"dates lost: {found}", stacklevel=2)


def check_source(
    spark: SparkSession, path: str, facts: Facts, bronze: DataFrame, malformed: str, on_loss: str = "raise"
) -> None:
    """Compare bronze with the lines that were counted apart from the CSV reader; stop or warn if a quote is never
    closed, or if there are fewer. Where all records are lines, parquet footers hold the count; else the line breaks
    inside of fields are counted too, and lines of blanks inside of them may make up for lost ones."""
    if facts.unclosed:
        if on_loss == "raise":
            raise UnclosedQuote(f"{facts.unclosed} files with an unclosed quote under {path}")
        warnings.warn(f"{facts.unclosed} files with an unclosed quote under {path}", stacklevel=2)
    wanted = record_lines(spark, path, facts)
    if facts.spanning:
        breaks = reduce(
            lambda one, other: one + other,
            (
                F.coalesce(F.length(named(f.name)) - F.length(F.replace(named(f.name), F.lit("\n"), F.lit(""))), F.lit(0))
                for f in bronze.schema
                if f.dataType.simpleString() == "string" and f.name != malformed
            ),
            F.lit(0),
        )
        if malformed in bronze.columns:
            own = F.length(named(malformed)) - F.length(F.replace(named(malformed), F.lit("\n"), F.lit("")))
            breaks = F.coalesce(own, breaks)
        found = bronze.agg(F.coalesce(F.sum(breaks + 1), F.lit(0))).first()[0]
    else:
        found = bronze.count()
    if found < wanted or (found > wanted and not facts.spanning):
        text = f"bronze has {found} lines of {wanted} under {path}"
        if on_loss == "raise":
            raise RowsLost(text)
        warnings.warn(text, stacklevel=2)


def check_rows(
    bronze: DataFrame, clean: DataFrame, rejected: DataFrame, on_loss: str = "raise"
) -> None:
    """Compare the row counts, which parquet footers hold; stop or warn at a difference."""
    counts = reconcile(bronze, clean, rejected).first()
    if not counts["matched"]:
        if on_loss == "raise":
            raise RowsLost(str(counts.asDict()))
        warnings.warn(f"rows lost: {counts.asDict()}", stacklevel=2)


def layer_rows(spark: SparkSession, spec: DatasetSpec) -> DataFrame:
    """Rows per layer table."""
    return reduce(
        DataFrame.unionByName,
        (
            spark.table(spec.table(layer))
            .agg(F.count(F.lit(1)).alias("row_count"))
            .select(F.lit(layer).alias("layer"), "row_count")
            for layer in LAYERS
        ),
    )
