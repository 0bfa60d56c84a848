"""The quality report on small inputs with known answers."""

import pytest
from pyspark.sql import functions as F

from tierwork.functions.measures import percentage, percentage_text, status
from tierwork.operators import quality

SCHEMA = "id int, name string"


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_report_rows_and_order(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (None, None)], SCHEMA)
    assert rows(quality.quality_report(df, ["id", "name"])) == [
        ("RECORD_COUNT", "total_rows", "4", "100%", "INFO"),
        ("DUPLICATE_CHECK", "duplicate_rows", "1", "25.0%", "WARNING"),
        ("CRITICAL_NULL_CHECK", "critical_columns_with_nulls", "2", "2/2 columns affected", "FAIL"),
        ("NULL_CHECK", "id", "1", "25.0%", "WARNING"),
        ("NULL_CHECK", "name", "2", "50.0%", "WARNING"),
    ]


def test_empty_input_divides_by_nothing(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert rows(quality.quality_report(df, ["id"])) == [
        ("RECORD_COUNT", "total_rows", "0", "100%", "INFO"),
        ("DUPLICATE_CHECK", "duplicate_rows", "0", "0.0%", "PASS"),
        ("CRITICAL_NULL_CHECK", "critical_columns_with_nulls", "0", "0/1 columns affected", "PASS"),
        ("NULL_CHECK", "id", "0", "0.0%", "PASS"),
        ("NULL_CHECK", "name", "0", "0.0%", "PASS"),
    ]


def test_single_checks_agree_with_the_report(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, "b")], SCHEMA)
    single = (
        rows(quality.record_count(df))
        + rows(quality.duplicate_check(df))
        + rows(quality.critical_check(df, ["name"]))
        + rows(quality.null_check(df))
    )
    assert single == rows(quality.quality_report(df, ["name"]))


def test_odd_column_names(spark):
    df = spark.createDataFrame([(None, "x")], "`a.b` int, `c d` string")
    assert [r[1:3] for r in rows(quality.null_check(df))] == [("a.b", "1"), ("c d", "0")]


@pytest.mark.parametrize("name, decision", [("name", "passed"), ("id", "quarantine")])
def test_gate(spark, name, decision):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, "b")], SCHEMA)
    report = quality.quality_report(df, [name])
    assert quality.gate(report).first()["decision"] == decision
    quality.enforce_gate(report)
    if decision == "passed":
        quality.enforce_gate(report, "raise")
    else:
        with pytest.raises(quality.QualityGateFailed):
            quality.enforce_gate(report, "raise")


def test_null_check_is_one_narrow_pass(spark):
    df = spark.createDataFrame([(1, "a")], SCHEMA)
    plan = quality.null_check(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Exchange SinglePartition" in plan


def test_shares(spark):
    one = spark.range(1)
    part, whole = F.lit(1).cast("bigint"), F.lit(3).cast("bigint")
    shown = one.select(percentage(part, whole), percentage_text(part, whole), percentage(part, whole - 3))
    assert tuple(shown.first()) == (33.33, "33.33%", 0.0)
    assert tuple(one.select(status(part, "FAIL"), status(part - 1, "FAIL")).first()) == ("FAIL", "PASS")


def test_table_profile(spark):
    df = spark.createDataFrame([(1, "a"), (None, None)], SCHEMA)
    assert tuple(quality.table_profile(df).first()) == (2, 2)
