"""Metrics: grouping sets against single groupings, months, durations, edge rounding."""

from collections import Counter

from pyspark.sql import functions as F

from tierwork import INCIDENTS
from tierwork.functions.dates import hours_between, parse_losses, parse_timestamps, year_month
from tierwork.operators import metrics
from tierwork.operators.metrics import AverageHours, CountBy, CountByMonth, average_by, metric_table
from tierwork.registry import queries

SCHEMA = "g string, s string, a timestamp, b timestamp"


def frame(spark, rows):
    return spark.createDataFrame(rows, "g string, s string, a string, b string").select(
        "g", "s", F.to_timestamp("a").alias("a"), F.to_timestamp("b").alias("b")
    )


METRICS = [
    CountBy("by_g", "g"),
    CountByMonth("by_month", "a"),
    AverageHours("hours", "g", "a", "b"),
    AverageHours("hours_by_s", "s", "a", "b"),
]
ROWS = [
    ("x", "1", "2024-01-05 00:00:00", "2024-01-05 01:00:00"),
    ("x", "1", "2024-01-05 00:00:00", "2024-01-05 00:59:50"),
    ("x", "2", "2024-10-05 00:00:00", "2024-01-05 01:00:00"),
    ("y", "2", None, "2024-01-05 01:00:00"),
    (None, "2", "2024-01-31 23:59:59", None),
    (None, "3", "2024-02-01 00:00:10", "2024-02-01 00:00:00"),
]


def bag(df):
    return Counter(map(tuple, df.collect()))


def test_long_table(spark):
    assert bag(metric_table(frame(spark, ROWS), METRICS)) == Counter(
        [
            ("by_g", "x", "row_count", "3"),
            ("by_g", "y", "row_count", "1"),
            ("by_g", None, "row_count", "2"),
            ("by_month", "2024-1", "row_count", "3"),
            ("by_month", "2024-10", "row_count", "1"),
            ("by_month", "2024-2", "row_count", "1"),
            ("hours", "x", "avg_hours", "1.0"),
            ("hours", None, "avg_hours", "0.0"),
            ("hours_by_s", "1", "avg_hours", "1.0"),
            ("hours_by_s", "3", "avg_hours", "0.0"),
        ]
    )


def test_together_or_one_by_one(spark):
    df = frame(spark, ROWS)
    single = sum((bag(metric_table(df, [m])) for m in METRICS), Counter())
    assert bag(metric_table(df, METRICS)) == single


def test_one_scan_and_one_shuffle_of_needed_columns(spark, tmp_path):
    path = str(tmp_path / "rows")
    frame(spark, ROWS).withColumn("unused", F.lit("u")).write.parquet(path)
    plan = metric_table(spark.read.parquet(path), METRICS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1
    assert "unused" not in plan and "partial_sum" in plan and "Sort" not in plan


def test_counts_add_up_to_rows(spark):
    df = frame(spark, ROWS * 7)
    table = metric_table(df, METRICS).groupBy("aggregation_type").agg(F.sum(F.col("value").cast("double")))
    sums = dict(map(tuple, table.collect()))
    assert sums["by_g"] == 42 and sums["by_month"] == 35


def test_empty_input(spark):
    assert metric_table(frame(spark, []), METRICS).isEmpty()


def test_short_negative_durations(spark):
    """Ten seconds too early round to zero and count, eighteen do not."""
    rows = [("x", "1", "2024-01-01 00:00:10", "2024-01-01 00:00:00"),
            ("y", "1", "2024-01-01 00:00:18", "2024-01-01 00:00:00")]
    hours = frame(spark, rows).select(hours_between(F.col("a"), F.col("b")))
    assert [r[0] for r in hours.collect()] == [0.0, -0.01]
    table = metric_table(frame(spark, rows), METRICS[2:3])
    assert bag(table) == Counter([("hours", "x", "avg_hours", "0.0")])


def test_mean_does_not_depend_on_the_order_of_rows(spark):
    """Sums of doubles differ in the last digit by order, sums of hundredths do not."""
    ends = [f"2024-01-{d:02d} {h:02d}:{m:02d}:00" for d in range(1, 29) for h in range(24) for m in (6, 42)]
    rows = [("x", "1", "2024-01-01 00:00:00", end) for end in ends]
    exact = sum(round((int(e[8:10]) - 1) * 2400 + int(e[11:13]) * 100 + int(e[14:16]) * 100 / 60) for e in ends)
    wanted = [("hours", "x", "avg_hours", str(round(exact / 100 / len(ends), 2)))]
    for parts in (1, 3, 8):
        table = metric_table(frame(spark, rows).repartition(parts), METRICS[2:3])
        assert list(map(tuple, table.collect())) == wanted


def test_month_keys(spark):
    day = spark.range(1).select(F.to_timestamp(F.lit("2024-01-09 00:00:00")).alias("d"))
    assert tuple(day.select(year_month(F.col("d")), year_month(F.col("d"), pad=True)).first()) == (
        "2024-1",
        "2024-01",
    )


def test_average_by(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.005), ("b", None)], "g string, v double")
    assert bag(average_by(df, "g", F.col("v"), "m")) == Counter([("a", 1.5), ("b", None)])


def test_text_dates(spark):
    df = spark.createDataFrame(
        [("2023-10-29 00:47:00",), ("29-10-2023 00:47",), ("29.10.2023",), (None,)], "d string"
    )
    one = parse_timestamps(df, ["d"], ["dd-MM-yyyy HH:mm"]).select(F.col("d").cast("string"))
    assert [r[0] for r in one.collect()] == [None, "2023-10-29 00:47:00", None, None]
    both = parse_timestamps(df, ["d"], INCIDENTS.date_formats).select(F.col("d").cast("string"))
    assert [r[0] for r in both.collect()] == ["2023-10-29 00:47:00"] * 2 + [None, None]
    assert tuple(parse_losses(df, ["d"], INCIDENTS.date_formats).first()) == ("d", 1)


def test_a_date_becomes_midnight(spark):
    df = spark.range(1).select(F.to_date(F.lit("2024-01-31")).alias("d"))
    parsed = parse_timestamps(df, ["d"], ["dd-MM-yyyy HH:mm"])
    assert parsed.dtypes == [("d", "timestamp")]
    assert str(parsed.first()[0]) == "2024-01-31 00:00:00"


def test_a_timestamp_is_left_as_it_is(spark):
    df = spark.range(1).select(F.to_timestamp_ntz(F.lit("2024-01-01 00:00:59")).alias("d"))
    assert parse_timestamps(df, ["d"], ["dd-MM-yyyy HH:mm"]).collect() == df.collect()


def test_ordered_results_are_in_order(spark, sf_dir):
    """The list itself: largest counts first and ties by name; months one after the other."""
    for name, order in (
        ("ordered_counts", lambda r: (-r["incident_count"], r["Assignment_Group"] or "")),
        ("ordered_months", lambda r: r["year_month"] or ""),
    ):
        rows = queries.queries()[name](spark, sf_dir).collect()
        assert len(rows) > 20 and rows == sorted(rows, key=order)
        assert [r["position"] for r in rows] == list(range(1, len(rows) + 1))
    counts = metrics.count_by(spark.range(9).selectExpr("id % 4 AS g"), "g", "n")
    assert [tuple(r) for r in metrics.largest_first(counts, "n", "g").collect()] == [(0, 3), (1, 2), (2, 2), (3, 2)]
