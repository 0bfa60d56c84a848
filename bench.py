"""Times the headline queries and prints one JSON line.

The incident rows and snapshots are made from the test tables once, untimed, and stored as the
tables a user would have; each query then runs to a sink that discards its rows, and the median of
its runs counts. ``layers`` is a whole run from CSV to gold, tables written; ``csv_spanning`` reads
a file some of whose records span lines. With ``BENCH_NAIVE=1`` the run is also timed in its
naive form, one action per count, a window per branch and one aggregate per metric, as
``layers_naive``, which does not count into the sum.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time
from collections.abc import Callable
from dataclasses import replace
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierwork.registry import shapes
from tierwork import INCIDENTS
from tierwork.functions import dates
from tierwork.operators import changes, copies, metrics, quality, routing, versions
from tierwork.plans import layers, run
from tierwork.settings import session_settings
from tierwork.sources import delimited, files, tables

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
NAIVE = os.environ.get("BENCH_NAIVE") == "1"
HEADERS = {new: old for old, new in INCIDENTS.renames.items()}


def session(scratch: str) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{CPUS}]")
    for name, value in session_settings(sum(x.stat().st_size for x in os.scandir(SF_DIR))).items():
        builder = builder.config(name, value)
    spark = (
        builder
        .appName("tierwork-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.checkpoint.dir", f"{scratch}/work")
        .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def prepare(spark: SparkSession, scratch: str) -> None:
    incidents = shapes.incidents(spark, SF_DIR).repartition(int(CPUS))
    incidents.write.parquet(f"{scratch}/incidents")
    text = shapes.with_text_dates(spark.read.parquet(f"{scratch}/incidents"))
    text.write.parquet(f"{scratch}/bronze")
    export = text.withColumnsRenamed(HEADERS)
    export.write.option("header", True).option("escape", '"').csv(f"{scratch}/incidents.csv")
    spanning = F.when(F.col("Priority").isNull(), F.lit('two\nlines of ""text""')).otherwise("x")
    spanning = export.withColumn("short_description", spanning).coalesce(1)
    spanning.write.option("header", True).option("escape", '"').csv(f"{scratch}/spanning.csv")
    text.repartition(64).write.parquet(f"{scratch}/small_files")
    layers.routed(text, INCIDENTS).write.parquet(f"{scratch}/routed")
    layers.silver(layers.routed(text, INCIDENTS), INCIDENTS).write.parquet(f"{scratch}/silver")
    snapshots = shapes.snapshots(spark, SF_DIR).repartition(int(CPUS))
    snapshots.write.partitionBy("_version").parquet(f"{scratch}/snapshots")


def headline(spark: SparkSession, scratch: str) -> dict[str, Callable[[], DataFrame]]:
    read = spark.read.parquet
    bronze, routed = read(f"{scratch}/bronze"), read(f"{scratch}/routed")
    silver, snapshots = read(f"{scratch}/silver"), read(f"{scratch}/snapshots")

    def whole_run() -> DataFrame:
        schema = f"bench_{uuid4().hex}"
        spark.sql(f"CREATE DATABASE {schema}")
        spec = replace(INCIDENTS, schema=schema)
        return run.run(spark, spec, f"{scratch}/incidents.csv", f"{scratch}/{schema}")

    def naive_run() -> DataFrame:
        return naive_layers(spark, f"{scratch}/incidents.csv", f"{scratch}/naive_{uuid4().hex}")

    def overwritten(rows: DataFrame) -> DataFrame:
        name = f"bench_{uuid4().hex}"
        return tables.overwrite_table(rows, name, f"{scratch}/{name}")

    def compacted() -> DataFrame:
        return files.compact(spark, f"{scratch}/small_files", f"{scratch}/{uuid4().hex}")

    key, order = ["User_ID", "Opened"], ["Updated", "Number"]
    timed = {
        "csv_to_bronze": lambda: layers.bronze(spark, INCIDENTS, f"{scratch}/incidents.csv"),
        "csv_spanning": lambda: delimited.read_csv(spark, f"{scratch}/spanning.csv"),
        "null_check": lambda: quality.null_check(bronze),
        "duplicate_check": lambda: quality.duplicate_check(bronze),
        "quality_report": lambda: quality.quality_report(bronze, INCIDENTS.critical),
        "distinct_rows": lambda: copies.distinct_rows(bronze),
        "row_number_dups": lambda: copies.number_copies(bronze),
        "route": lambda: layers.routed(bronze, INCIDENTS),
        "route_keyed": lambda: routing.route(bronze, INCIDENTS.critical, key, order),
        "quarantine": lambda: routing.rejected_rows(layers.routed(bronze, INCIDENTS)),
        "silver": lambda: layers.silver(layers.routed(bronze, INCIDENTS), INCIDENTS),
        "report_from_routed": lambda: quality.quality_report_of_routed(routed, INCIDENTS.critical),
        "quarantine_from_routed": lambda: routing.rejected_rows(routed),
        "silver_from_routed": lambda: layers.silver(routed, INCIDENTS),
        "gold_by_state": lambda: metrics.metric_table(silver, INCIDENTS.metrics[2:3]),
        "gold_metrics": lambda: metrics.metric_table(silver, INCIDENTS.metrics),
        "as_of_version": lambda: versions.as_of(snapshots, version=2),
        "version_history": lambda: versions.version_history(snapshots),
        "change_feed": lambda: changes.change_feed(snapshots, 1),
        "change_feed_keyed": lambda: changes.change_feed_keyed(snapshots, ["k"], 1, 2),
        "change_summary": lambda: changes.change_summary(changes.change_feed(snapshots, 1)),
        "overwrite": lambda: overwritten(bronze),
        "compact": compacted,
        "layers": whole_run,
    }
    return timed | ({"layers_naive": naive_run} if NAIVE else {})


def naive_layers(spark: SparkSession, path: str, target: str) -> DataFrame:
    """The same layers the way one would write them first."""
    raw = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(path)
    raw = layers.with_metadata(layers.usable_names(raw, INCIDENTS), F.lit("incidents.csv"))
    raw.write.parquet(f"{target}/bronze")
    rows = spark.read.parquet(f"{target}/bronze")
    for name in rows.columns:
        rows.filter(F.col(name).isNull()).count()
    rows.count()
    rows.count() - rows.distinct().count()
    for name in INCIDENTS.critical:
        rows.filter(F.col(name).isNull()).count()
    numbered = rows.withColumn(
        "n", F.row_number().over(Window.partitionBy(*rows.columns).orderBy("Number"))
    )
    first = numbered.filter("n = 1").drop("n")
    null = routing.any_null(INCIDENTS.critical)
    for name, branch in (("duplicates", numbered.filter("n > 1").drop("n")), ("nulls", first.filter(null))):
        branch.count()
        branch.write.parquet(f"{target}/{name}")
    filled = routing.fill_defaults(first.filter(~null), INCIDENTS.defaults)
    parsed = dates.parse_timestamps(filled, INCIDENTS.date_columns, INCIDENTS.date_formats)
    parsed.count()
    parsed.write.parquet(f"{target}/silver")
    silver = spark.read.parquet(f"{target}/silver")
    for place, metric in enumerate(INCIDENTS.metrics):
        table = metrics.metric_table(silver, [metric])
        table.count()
        table.write.parquet(f"{target}/gold{place}")
    return spark.read.parquet(f"{target}/gold0")


def seconds(build: Callable[[], DataFrame]) -> float:
    start = time.perf_counter()
    build().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    scratch = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark = session(scratch)
    prepare(spark, scratch)
    timings = {}
    for name, build in headline(spark, scratch).items():
        seconds(build)
        timings[name] = round(statistics.median(seconds(build) for _ in range(RUNS)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, median seconds each, summed",
                "value": round(sum(v for k, v in timings.items() if k != "layers_naive"), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
