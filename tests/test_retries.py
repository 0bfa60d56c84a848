"""Results when tasks fail and run again."""

from collections import Counter

import pytest
from pyspark import TaskContext
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tierwork.operators import changes, copies, metrics, quality, routing
from tierwork.sources import work


def shaky(df):
    """The same rows from tasks that fail on their first attempt, after handing the last row on."""

    def fails_once(batches):
        yield from batches
        context = TaskContext.get()
        if context.attemptNumber() == 0 and context.partitionId() % 2 == 0:
            raise RuntimeError("first attempt")

    return df.mapInPandas(fails_once, df.schema)


@pytest.fixture(scope="module")
def rows(spark):
    spark.sparkContext.setLogLevel("OFF")
    yield spark.range(4_000).select(
        F.when(F.col("id") % 7 > 0, F.concat(F.lit("n"), F.col("id") % 900)).alias("number"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.lit("cold")).alias("category"),
        F.lit(1.5).alias("hours"),
    )
    spark.sparkContext.setLogLevel("ERROR")


def snapshots(df):
    version = F.when(F.col("category") == "hot", 0).otherwise(1)
    time = F.lit("2024-01-01").cast("timestamp")
    return df.select(version.alias("_version"), time.alias("_commit_timestamp"), "number")


def bag(df):
    return Counter(map(tuple, df.collect()))


@pytest.mark.parametrize(
    "build",
    [
        lambda df: routing.rejected_rows(routing.route(df, ["number"])),
        lambda df: routing.rejected_rows(routing.route(df, [], key=["category"], order=["number"])),
        lambda df: copies.number_copies(df),
        lambda df: quality.quality_report(df, ["number"]),
        lambda df: metrics.metric_table(df, [metrics.CountBy("a", "number"), metrics.CountBy("b", "category")]),
    ],
)
def test_same_rows_after_retries(rows, build):
    assert bag(build(shaky(rows))) == bag(build(rows))


def test_same_feed_after_retries(spark, rows):
    commits = snapshots(rows).select("_version", "_commit_timestamp").distinct()
    assert bag(changes.change_feed(shaky(snapshots(rows)), 1, 1, commits)) == bag(
        changes.change_feed(snapshots(rows), 1, 1, commits)
    )


def test_counts_taken_while_writing_count_rows_once(spark, rows):
    total = F.sum("_copies").alias("total")
    kept, counts = work.written_and_counted(copies.collapse_copies(shaky(rows)), "x", [total])
    assert counts.first()["total"] == kept.agg(total).first()["total"] == 4_000
    seen = Observation()
    shaky(copies.collapse_copies(rows).observe(seen, total)).write.parquet(work.work_path(spark, "y"))
    assert seen.get["total"] == 4_000
