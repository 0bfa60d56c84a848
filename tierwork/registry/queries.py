"""One query per operator, each over whole tables."""

from __future__ import annotations

import warnings
from collections.abc import Callable
from dataclasses import replace
from datetime import datetime
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierwork.registry import shapes
from tierwork import INCIDENTS, DatasetSpec
from tierwork.functions import dates, names
from tierwork.operators import changes, copies, metrics, quality, routing, versions
from tierwork.plans import layers, run
from tierwork.sources import delimited, files, snapshots, tables
from tierwork.sources.work import work_path, written

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = datetime(2024, 1, 15)
LOADED_AT = "2024-01-15 00:00:00"
HEADERS = {new: old for old, new in INCIDENTS.renames.items()}

_queries: dict[str, Query] = {}


def query(build: Query) -> Query:
    _queries[build.__name__] = build
    return build


def over_incidents(build: Callable[[DataFrame], DataFrame]) -> None:
    """Register a query that needs the incident rows only."""

    def run_query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(shapes.incidents(spark, sf_dir))

    _queries[build.__name__] = run_query


def over_snapshots(build: Callable[[DataFrame], DataFrame]) -> None:
    """Register a query that needs the version-tagged rows only."""

    def run_query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(shapes.snapshots(spark, sf_dir))

    _queries[build.__name__] = run_query


def queries() -> dict[str, Query]:
    return {name: _in_utc(build) for name, build in _queries.items()}


def _in_utc(build: Query) -> Query:
    def run_query(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return build(spark, sf_dir)

    return run_query


def _without_zone(df: DataFrame) -> DataFrame:
    """Timestamps as wall-clock values, the way DuckDB holds them."""
    kinds = {name: kind for name, kind in df.dtypes if kind == "timestamp"}
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in kinds})


def _loaded_at() -> Column:
    """A fixed time, for the columns that hold when something was done."""
    return F.lit(LOADED_AT).cast("timestamp_ntz")


def _numbered(rows: DataFrame, *order: Column) -> DataFrame:
    """A small ordered result with the place of each row, which a comparison of bags can see."""
    return rows.withColumn("position", F.row_number().over(Window.orderBy(*order))).orderBy("position")


def _raw_csv(spark: SparkSession, sf_dir: str) -> str:
    """The incident rows as an exported CSV with blanks in its header."""
    path = f"{work_path(spark, 'incidents-csv')}/incidents.csv"
    rows = shapes.with_text_dates(shapes.incidents(spark, sf_dir)).withColumnsRenamed(HEADERS)
    rows.write.option("header", True).option("escape", '"').csv(path)
    return path


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = shapes.with_text_dates(shapes.incidents(spark, sf_dir))
    return layers.silver(layers.routed(rows, INCIDENTS), INCIDENTS)


# Sources, sinks, namespace


@query
def csv_scan(spark, sf_dir):
    return delimited.read_csv(spark, _raw_csv(spark, sf_dir)).withColumnsRenamed(INCIDENTS.renames)


@query
def csv_scan_typed(spark, sf_dir):
    """Inferred types; ISO date text becomes a timestamp."""
    path = work_path(spark, "orders-csv")
    shapes.table(spark, sf_dir, "orders").withColumn(
        "o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    ).write.option("header", True).csv(path)
    typed = delimited.read_csv(spark, path, infer_types=True)
    return _without_zone(typed.withColumns({c: F.col(c).cast("bigint") for c in ("o_orderkey", "o_custkey")}))


@query
def csv_multi_line(spark, sf_dir):
    """Whole documents through CSV: line breaks, quotes and commas inside fields survive."""
    path = work_path(spark, "documents-csv")
    shapes.table(spark, sf_dir, "documents").write.option("header", True).option("escape", '"').csv(path)
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    return delimited.read_csv(spark, path, schema=schema)


def _as_text_file(rows: DataFrame, header: str, path: str) -> None:
    """Records as they are, under a header line in every file."""
    rows.toDF(header).write.option("header", True).option("sep", "\u0001").csv(path)


@query
def csv_malformed(spark, sf_dir):
    """Orders of which some have a field too many and some one too few: their text is kept."""
    path, orders = work_path(spark, "orders-csv"), shapes.table(spark, sf_dir, "orders")
    extra = F.when(F.col("o_orderstatus") == "P", F.lit("more"))
    priority = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority"))
    record = F.concat_ws(",", F.col("o_orderkey").cast("string"), "o_orderstatus", priority, extra)
    _as_text_file(orders.select(record), "o_orderkey,o_orderstatus,o_orderpriority", path)
    return delimited.read_csv(spark, path, malformed="malformed_record")


@query
def csv_mixed_headers(spark, sf_dir):
    """Orders in files with two headers, one of them in another order and with one column more."""
    paths = [work_path(spark, "orders-csv") for _ in range(2)]
    orders = shapes.table(spark, sf_dir, "orders")
    cheap = F.col("o_totalprice") < 150000
    headers = (["o_orderkey", "o_orderstatus"], ["o_orderstatus", "o_orderpriority", "o_orderkey"])
    for path, rows, columns in zip(paths, (orders.filter(cheap), orders.filter(~cheap)), headers):
        rows.select(*columns).write.option("header", True).csv(path)
    return delimited.read_csv(spark, paths, by_name=True)


@query
def table_scan(spark, sf_dir):
    name = f"incidents_{uuid4().hex}"
    path = work_path(spark, "incidents")
    shapes.incidents(spark, sf_dir).write.parquet(path)
    spark.catalog.createTable(name, path=path, source="parquet")
    return tables.table_scan(spark, name)


@query
def overwrite_roundtrip(spark, sf_dir):
    """A table overwritten with rows that were read from it."""
    name, location = f"incidents_{uuid4().hex}", work_path(spark, "incidents")
    tables.overwrite_table(shapes.incidents(spark, sf_dir), name, location)
    again = spark.table(name).filter(F.col("Updated").isNotNull())
    return tables.overwrite_table(again, name, location)


@query
def append_rows(spark, sf_dir):
    """The five orders of the lowest keys, added to the orders a second time."""
    name, location = f"orders_{uuid4().hex}", work_path(spark, "orders")
    orders = tables.overwrite_table(shapes.table(spark, sf_dir, "orders"), name, location)
    return tables.append_rows(orders.orderBy("o_orderkey").limit(5), name)


#: A table to be compacted has at least so many files, and one per so many bytes of the tables it is made from.
SMALL_FILES, BYTES_A_FILE = 16, 32 * 1024**2


def _small_files(spark: SparkSession, *paths: str) -> int:
    """How many files to cut a table into that is made from the ones given: their rows do not grow with it."""
    size = sum(files.table_detail(spark, path).first()["sizeInBytes"] for path in paths)
    return max(SMALL_FILES, -(-size // BYTES_A_FILE))


@query
def compact_roundtrip(spark, sf_dir):
    path = work_path(spark, "incidents")
    number = _small_files(spark, *(f"{sf_dir}/{name}.parquet" for name in ("orders", "lineitem")))
    shapes.incidents(spark, sf_dir).repartition(number).write.parquet(path)
    return files.compact(spark, path, work_path(spark, "incidents-compacted"))


@query
def table_detail(spark, sf_dir):
    """Files and bytes of a table before and after compaction."""
    path, target = work_path(spark, "orders"), work_path(spark, "orders-compacted")
    shapes.table(spark, sf_dir, "orders").repartition(16).write.parquet(path)
    files.compact(spark, path, target)
    found = ((state, files.table_detail(spark, place)) for state, place in (("before", path), ("after", target)))
    before, after = (
        detail.select(F.lit(state).alias("state"), "numFiles", (F.col("sizeInBytes") > 0).alias("has_bytes"))
        for state, detail in found
    )
    return before.unionByName(after)


@query
def use_namespace(spark, sf_dir):
    """A table found by its short name after the namespace was set."""
    schema, back = f"ns_{uuid4().hex}", spark.catalog.currentDatabase()
    location = work_path(spark, "namespace")
    spark.sql(f"CREATE DATABASE {schema} LOCATION '{location}/schema'")
    tables.use_namespace(spark, None, schema)
    try:
        orders = shapes.table(spark, sf_dir, "orders")
        tables.overwrite_table(orders, f"{schema}.orders", f"{location}/orders")
        return tables.table_scan(spark, "orders")
    finally:
        tables.use_namespace(spark, None, back)


@query
def set_table_property(spark, sf_dir):
    """A property set on a table outlives an overwrite."""
    name, location = f"orders_{uuid4().hex}", work_path(spark, "orders")
    orders = shapes.table(spark, sf_dir, "orders")
    tables.overwrite_table(orders, name, location)
    tables.set_table_property(spark, name, "change_tracking", "true")
    tables.overwrite_table(orders, name, location)
    value = F.lit(spark.sql(f"SHOW TBLPROPERTIES {name} ('change_tracking')").first()["value"])
    rows = spark.table(name).agg(F.count(F.lit(1)).alias("row_count"))
    return rows.withColumn("change_tracking", value)


# Projections and ingest


def rename_columns(inc):
    spaced = inc.withColumnsRenamed(HEADERS)
    return names.rename_columns(spaced, INCIDENTS.renames)


def sanitize_columns(inc):
    return names.sanitize_columns(inc.withColumnsRenamed(HEADERS)).withColumnsRenamed(
        {"Assignment_group": "Assignment_group_name", "Assigned_to": "Assigned_to_name"}
    )


def project(inc):
    return inc.select("Number", F.col("Priority").alias("group_column"), F.lit("by_priority").alias("kind"))


def cast_string(inc):
    hours = dates.hours_between(F.col("Opened"), F.col("Updated"))
    return inc.select("Number", hours.cast("string").alias("hours_text"))


def table_profile(inc):
    return quality.table_profile(inc)


over_incidents(rename_columns)
over_incidents(sanitize_columns)
over_incidents(project)
over_incidents(cast_string)
over_incidents(table_profile)


@query
def ingest_metadata(spark, sf_dir):
    orders = shapes.table(spark, sf_dir, "orders")
    return layers.with_metadata(orders, F.col("_metadata.file_name"), _loaded_at())


@query
def bronze(spark, sf_dir):
    return layers.bronze(spark, INCIDENTS, _raw_csv(spark, sf_dir), _loaded_at())


# Counts, filters, distinct rows


def row_count(inc):
    return inc.agg(F.count(F.lit(1)).alias("row_count"))


def null_counts(inc):
    return quality.null_counts(inc)


def null_percentages(inc):
    return quality.null_percentages(inc)


def distinct_rows(inc):
    return copies.distinct_rows(inc)


def critical_null_rows(inc):
    return inc.filter(routing.any_null(INCIDENTS.critical))


def critical_clean_rows(inc):
    return inc.filter(~routing.any_null(INCIDENTS.critical))


def nonneg_filter(inc):
    hours = dates.hours_between(F.col("Opened"), F.col("Updated"))
    return inc.select("Number", hours.alias("hours")).filter("hours >= 0")


def row_number_dups(inc):
    return copies.number_copies(inc)


def duplicate_rows(inc):
    return copies.extra_copies(inc)


def dedup_keep_first(inc):
    return routing.clean_rows(routing.route(inc, []))


def dedup_by_key(inc):
    """The first row per user and opening time."""
    routed = routing.route(inc, [], key=["User_ID", "Opened"], order=["Updated", "Number"])
    return routing.clean_rows(routed)


def dedup_by_key_rejects(inc):
    """What the previous query leaves out: every other row, copies included."""
    routed = routing.route(inc, [], key=["User_ID", "Opened"], order=["Updated", "Number"])
    return routing.rejected_rows(routed)


def limit_n(inc):
    keys = ["Number", "Opened", "User_ID"]
    return inc.filter(F.col("Number").isNotNull()).orderBy(*keys).limit(20)


for build in (
    row_count,
    null_counts,
    null_percentages,
    distinct_rows,
    critical_null_rows,
    critical_clean_rows,
    nonneg_filter,
    row_number_dups,
    duplicate_rows,
    dedup_keep_first,
    dedup_by_key,
    dedup_by_key_rejects,
    limit_n,
):
    over_incidents(build)


# Quality report


def dq_record_count(inc):
    return quality.record_count(inc)


def dq_null_check(inc):
    return quality.null_check(inc)


def dq_duplicate_check(inc):
    return quality.duplicate_check(inc)


def dq_critical_check(inc):
    return quality.critical_check(inc, INCIDENTS.critical)


def quality_report(inc):
    return quality.timed(quality.quality_report(inc, INCIDENTS.critical), _loaded_at())


def quality_report_keyed(inc):
    """With a key: copies are counted as without one, rows that lost against another by themselves."""
    routed = routing.route(inc, INCIDENTS.critical, ["user_id", "OPENED"], ["Updated", "Number"])
    return quality.quality_report_of_routed(routed, INCIDENTS.critical, keyed=True)


def quality_report_of_routed(inc):
    return quality.quality_report_of_routed(layers.routed(inc, INCIDENTS), INCIDENTS.critical)


def dq_gate(inc):
    return quality.gate(quality.quality_report(inc, INCIDENTS.critical))


for build in (
    dq_record_count,
    dq_null_check,
    dq_duplicate_check,
    dq_critical_check,
    quality_report,
    quality_report_keyed,
    quality_report_of_routed,
    dq_gate,
):
    over_incidents(build)


# Cleansing and quarantine


def reject_reason(inc):
    return inc.select("Number", routing.first_null(INCIDENTS.critical).alias("reject_reason"))


def quarantine(inc):
    return routing.quarantine(layers.routed(inc, INCIDENTS), _loaded_at())


def quarantine_by_reason(inc):
    rejected = routing.rejected_rows(layers.routed(inc, INCIDENTS))
    return metrics.count_by(rejected, "reject_reason", "row_count")


def union_quarantine(inc):
    """Both kinds of rejects computed one by one and put together by column name."""
    twice = copies.extra_copies(inc).withColumn("reject_reason", F.lit(routing.DUPLICATE))
    reason = routing.first_null(INCIDENTS.critical)
    incomplete = copies.distinct_rows(inc).withColumn("reject_reason", reason)
    return twice.unionByName(incomplete.filter(F.col("reject_reason").isNotNull()))


def fill_defaults(inc):
    return routing.fill_defaults(inc, INCIDENTS.defaults)


def parse_timestamps(inc):
    text = shapes.with_text_dates(inc)
    parsed = dates.parse_timestamps(text, INCIDENTS.date_columns, INCIDENTS.date_formats)
    return _without_zone(parsed)


def parse_losses(inc):
    """The priority column read as a date: all of its values are lost."""
    text = shapes.with_text_dates(inc)
    return dates.parse_losses(text, ["Opened", "Updated", "Priority"], INCIDENTS.date_formats)


def except_all(inc):
    """Incident rows that did not pass, found as a bag difference."""
    return copies.rows_missing(inc, routing.clean_rows(layers.routed(inc, INCIDENTS)))


def reconcile(inc):
    routed = layers.routed(inc, INCIDENTS)
    return routing.reconcile(inc, routing.clean_rows(routed), routing.rejected_rows(routed))


for build in (
    reject_reason,
    quarantine,
    quarantine_by_reason,
    union_quarantine,
    fill_defaults,
    parse_timestamps,
    parse_losses,
    except_all,
    reconcile,
):
    over_incidents(build)


@query
def silver(spark, sf_dir):
    return _without_zone(_silver(spark, sf_dir))


# Metrics


@query
def count_by(spark, sf_dir):
    return metrics.count_by(shapes.table(spark, sf_dir, "lineitem"), "l_returnflag", "incident_count")


def avg_by(inc):
    hours = dates.hours_between(F.col("Opened"), F.col("Updated"))
    return metrics.average_by(inc, "Channel", hours, "avg_hours")


def ordered_counts(inc):
    counts = metrics.count_by(inc, "Assignment_Group", "incident_count")
    ordered = metrics.largest_first(counts, "incident_count", "Assignment_Group")
    return _numbered(ordered, F.desc("incident_count"), F.asc("Assignment_Group"))


def ordered_months(inc):
    months = inc.select(dates.year_month(F.col("Opened"), pad=True).alias("year_month"))
    return _numbered(metrics.count_by(months, "year_month", "incident_count"), F.asc("year_month"))


def year_month_key(inc):
    opened = F.col("Opened")
    padded = dates.year_month(opened, pad=True)
    return inc.select("Number", dates.year_month(opened).alias("year_month"), padded.alias("padded"))


def duration_hours(inc):
    hours = dates.hours_between(F.col("Opened"), F.col("Updated"))
    return inc.select("Number", hours.alias("resolution_time_hours"))


for build in (avg_by, ordered_counts, ordered_months, year_month_key, duration_hours):
    over_incidents(build)


def _one_metric(place: int) -> Query:
    return lambda spark, sf_dir: metrics.metric_table(_silver(spark, sf_dir), [INCIDENTS.metrics[place]])


_queries["gold_by_priority"] = _one_metric(0)
_queries["gold_by_category"] = _one_metric(1)
_queries["gold_by_state"] = _one_metric(2)
_queries["gold_by_month"] = _one_metric(3)
_queries["gold_avg_resolution"] = _one_metric(4)


@query
def silver_losses(spark, sf_dir):
    """Finished orders open with a date in no listed format: how many silver loses, counted while
    it is written."""
    rows = shapes.with_text_dates(shapes.incidents(spark, sf_dir))
    odd = F.concat(F.lit("on "), "Opened")
    rows = rows.withColumn("Opened", F.when(F.col("State") == "F", odd).otherwise(F.col("Opened")))
    routed = layers.routed(rows, INCIDENTS)
    _, lost = run.written_silver(routed, INCIDENTS, lambda clean: written(clean, "silver"))
    return spark.createDataFrame(list(lost.items()), "column_name string, lost_values bigint")


@query
def gold_metrics(spark, sf_dir):
    return layers.gold(_silver(spark, sf_dir), INCIDENTS, _loaded_at())


def _whole_run(spark: SparkSession, sf_dir: str) -> tuple[DatasetSpec, DataFrame]:
    spec = replace(INCIDENTS, name=f"incidents_{uuid4().hex}", schema=f"layers_{uuid4().hex}")
    location = work_path(spark, "layers")
    spark.sql(f"CREATE DATABASE {spec.schema} LOCATION '{location}/schema'")
    with warnings.catch_warnings():
        warnings.simplefilter("ignore", UserWarning)
        return spec, run.run(spark, spec, _raw_csv(spark, sf_dir), location)


@query
def layer_rows(spark, sf_dir):
    """Rows per layer after a run over all of them, tables written and read back."""
    return _whole_run(spark, sf_dir)[1]


@query
def gold_table(spark, sf_dir):
    """The gold table that a run has written, read back."""
    spec, _ = _whole_run(spark, sf_dir)
    return spark.table(spec.table("gold")).drop("created_timestamp")


# The same layers for another dataset, told apart by its spec only

ORDERS = DatasetSpec(
    name="orders",
    renames={"order key": "o_orderkey"},
    critical=("o_orderkey", "o_orderpriority"),
    defaults={"o_orderstatus": "Unknown"},
    date_columns=("o_orderdate",),
    metrics=(
        metrics.CountBy("by_status", "o_orderstatus", "order_count"),
        metrics.CountByMonth("by_month", "o_orderdate", "order_count", pad=True),
        metrics.CountBy("by_customer", "o_custkey", "order_count"),
    ),
)


@query
def gold_of_orders(spark, sf_dir):
    """Orders through CSV, with status P and priority 4 left empty, up to gold."""
    path = work_path(spark, "orders-csv")
    orders = shapes.table(spark, sf_dir, "orders").withColumns(
        {
            "o_orderstatus": F.nullif(F.col("o_orderstatus"), F.lit("P")),
            "o_orderpriority": F.nullif(F.col("o_orderpriority"), F.lit("4-NOT SPECIFIED")),
            "o_orderdate": F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"),
        }
    )
    orders.withColumnRenamed("o_orderkey", "order key").write.option("header", True).csv(path)
    routed = layers.routed(layers.bronze(spark, ORDERS, path), ORDERS)
    return layers.gold(layers.silver(routed, ORDERS), ORDERS).drop("created_timestamp")


# Table history


@query
def version_history(spark, sf_dir):
    rows = shapes.snapshots(spark, sf_dir)
    return versions.newest_first(versions.version_history(rows, shapes.operations(spark)))


def version_bounds(snap):
    return versions.version_bounds(snap)


def as_of_version(snap):
    return versions.as_of(snap, version=1)


def as_of_timestamp(snap):
    return versions.as_of(snap, timestamp=datetime(2024, 1, 10))


def as_of_missing(snap):
    """A version that was never written reads as empty, next to the rows of one that was."""
    there = versions.as_of(snap, version=0).agg(F.count(F.lit(1)).alias("row_count"))
    gone = versions.as_of(snap, version=9, missing="empty").agg(F.count(F.lit(1)).alias("row_count"))
    return there.withColumn("version", F.lit(0)).unionByName(gone.withColumn("version", F.lit(9)))


def expired_versions(snap):
    return versions.expired_versions(snap, AS_OF)


def retain_versions(snap):
    return versions.retain_versions(snap, AS_OF)


def change_feed(snap):
    return changes.change_feed(snap, 1)


def change_feed_from_nothing(snap):
    return changes.change_feed(snap, 0, 1)


def change_feed_keyed(snap):
    return changes.change_feed_keyed(snap, ["k"], 0, 2)


def change_summary(snap):
    return changes.change_summary(changes.change_feed(snap, 2))


for build in (
    version_bounds,
    as_of_version,
    as_of_timestamp,
    as_of_missing,
    expired_versions,
    retain_versions,
    change_feed,
    change_feed_from_nothing,
    change_feed_keyed,
    change_summary,
):
    over_snapshots(build)


def _stored(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The four versions of the orders written one by one, and the list of commits."""
    location = work_path(spark, "orders")
    rows = shapes.snapshots(spark, sf_dir)
    for version, committed_at, _ in shapes.COMMITS:
        one = versions.as_of(rows, version=version, missing="empty")
        snapshots.write_version(one, location, version, committed_at)
    return snapshots.read_versions(spark, location), shapes.commits(spark)


@query
def stored_as_of(spark, sf_dir):
    """The version in force on January 10th, read from its folder only."""
    stored, commits = _stored(spark, sf_dir)
    return versions.as_of(stored, timestamp=datetime(2024, 1, 10), commits=commits)


@query
def stored_change_feed(spark, sf_dir):
    stored, commits = _stored(spark, sf_dir)
    return _without_zone(changes.change_feed(stored, 2, 3, commits))


@query
def table_versions(spark, sf_dir):
    """A table written, cut to fewer rows and compacted, each a version: its history."""
    location, at = work_path(spark, "orders"), shapes.COMMITS[0][1]
    compacted = work_path(spark, "orders-compacted")
    orders = shapes.table(spark, sf_dir, "orders")
    snapshots.write_version(orders, location, 0, at)
    snapshots.write_version(orders.filter("o_orderstatus <> 'P'"), location, 1, at)
    files.compact(spark, f"{location}/_version=1", compacted)
    rows = spark.read.parquet(compacted).drop("_commit_timestamp")
    snapshots.write_version(rows, location, 2, at)
    log = [(0, "CREATE TABLE"), (1, "WRITE"), (2, "OPTIMIZE")]
    log = spark.createDataFrame(log, "version int, operation string")
    return versions.version_history(snapshots.read_versions(spark, location), log).drop("timestamp")


@query
def appended_changes(spark, sf_dir):
    """The change feed of a table from before five of its own rows were added again."""
    location, orders = work_path(spark, "orders"), shapes.table(spark, sf_dir, "orders")
    again = orders.orderBy("o_orderkey").limit(5)
    for version, rows in enumerate((orders, orders.unionByName(again))):
        snapshots.write_version(rows, location, version, shapes.COMMITS[version][1])
    stored = snapshots.read_versions(spark, location)
    return changes.change_feed(stored, 1).drop("_commit_timestamp")


@query
def stored_retention(spark, sf_dir):
    """The versions left without those expired on January 15th, and their rows."""
    stored, commits = _stored(spark, sf_dir)
    kept = versions.retain_versions(stored, AS_OF, commits=commits)
    return _without_zone(versions.version_history(kept))
