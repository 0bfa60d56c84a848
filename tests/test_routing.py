"""Routing rows to silver and quarantine: conservation, reasons, skew."""

from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tierwork.functions.names import UnknownColumn
from tierwork.operators import copies, quality, routing

CRITICAL = ("number", "category")
SCHEMA = "number string, category string, note string"
FEW = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
VALUES = st.sampled_from([None, "", "a", "b"])
ROWS = st.lists(st.tuples(VALUES, VALUES, VALUES), max_size=40)


def expected(rows):
    """Clean rows and rejected rows with reasons, one row after the other."""
    seen, clean, rejected = set(), Counter(), Counter()
    for row in rows:
        missing = [name for name, value in zip(CRITICAL, row) if value is None]
        if row in seen:
            rejected[(*row, "duplicate row")] += 1
        elif missing:
            rejected[(*row, f"null in {missing[0]}")] += 1
        else:
            clean[row] += 1
        seen.add(row)
    return clean, rejected


def bag(df):
    return Counter(map(tuple, df.collect()))


@FEW
@given(rows=ROWS)
def test_whole_row_duplicates_and_critical_nulls(spark, rows):
    routed = routing.route(spark.createDataFrame(rows, SCHEMA), CRITICAL)
    clean, rejected = expected(rows)
    assert bag(routing.clean_rows(routed)) == clean
    assert bag(routing.rejected_rows(routed)) == rejected


@FEW
@given(rows=ROWS)
def test_cleansing_twice_changes_nothing(spark, rows):
    once = routing.clean_rows(routing.route(spark.createDataFrame(rows, SCHEMA), CRITICAL))
    again = routing.route(once, CRITICAL)
    assert bag(routing.clean_rows(again)) == bag(once)
    assert routing.rejected_rows(again).isEmpty()


@FEW
@given(rows=st.lists(st.tuples(VALUES, st.integers(0, 3), VALUES), max_size=40))
def test_part_of_the_row_as_key(spark, rows):
    df = spark.createDataFrame(rows, "k string, at int, note string")
    routed = routing.route(df, ["note"], key=["k"], order=["at"])
    clean, rejected = routing.clean_rows(routed), routing.rejected_rows(routed)
    assert bag(clean.unionByName(rejected.drop("reject_reason"))) == Counter(rows)
    firsts = {}
    for row in rows:
        rank = (row[1], row[2] is not None, row[2] or "")
        firsts[row[0]] = min(firsts.get(row[0], rank), rank)
    wanted = Counter((k, at, note) for k, (at, there, note) in firsts.items() if there)
    assert bag(clean) == wanted
    nulls = rejected.filter("reject_reason = 'null in note'").count()
    assert nulls == sum(not there for _, there, _ in firsts.values())


def test_a_key_needs_an_order(spark):
    with pytest.raises(ValueError, match="order"):
        routing.route(spark.createDataFrame([("a", 1)], "k string, v int"), [], key=["k"])


def test_reason_names_the_first_null_in_list_order(spark):
    df = spark.createDataFrame([(None, None, "x"), ("a", None, "x"), ("a", "b", None)], SCHEMA)
    reasons = df.select(routing.first_null(CRITICAL)).collect()
    assert [r[0] for r in reasons] == ["null in number", "null in category", None]
    reasons = df.select(routing.first_null(CRITICAL[::-1])).collect()
    assert [r[0] for r in reasons] == ["null in category", "null in category", None]


def test_a_third_of_all_rows_are_one_row(spark):
    hot = spark.range(60_000).select(
        F.lit("n").alias("number"), F.lit(None).cast("string").alias("category"), F.lit("x").alias("note")
    )
    rest = spark.range(120_000).select(
        F.col("id").cast("string").alias("number"), F.lit("c").alias("category"), F.lit("x").alias("note")
    )
    routed = routing.route(hot.unionByName(rest), CRITICAL)
    assert routing.clean_rows(routed).count() == 120_000
    reasons = {r[0]: r[1] for r in routing.rejected_rows(routed).groupBy("reject_reason").count().collect()}
    assert reasons == {"null in category": 1, "duplicate row": 59_999}
    tasks = routing.rejected_rows(routed).groupBy(F.spark_partition_id()).count()
    assert tasks.agg(F.max("count")).first()[0] < 20_000


def test_a_third_of_all_rows_share_a_key(spark):
    rows = spark.range(30_000).select(
        F.when(F.col("id") < 10_000, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("at"),
    )
    routed = routing.route(rows, [], key=["k"], order=["at"])
    assert routing.clean_rows(routed).count() == 20_001
    assert routing.clean_rows(routed).filter("k = 'hot'").first()["at"] == 0
    assert routing.rejected_rows(routed).count() == 9_999
    plan = routed._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


@pytest.mark.parametrize("rows", [[], [("a", "b", "c")], [(None, None, None)] * 5, [("a", "b", "c")] * 250])
def test_edge_inputs_are_conserved(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    routed = routing.route(df, CRITICAL)
    clean, rejected = routing.clean_rows(routed), routing.rejected_rows(routed)
    assert routing.reconcile(df, clean, rejected).first()["matched"]
    assert (bag(clean), bag(rejected)) == expected(rows)


def test_reconcile_sees_a_lost_row(spark):
    df = spark.createDataFrame([("a", "b", "c")] * 3, SCHEMA)
    row = routing.reconcile(df, df.limit(1), df.limit(1)).first()
    assert row.asDict() == {"source_rows": 3, "clean_rows": 1, "rejected_rows": 1, "matched": False}


def test_empty_text_is_not_filled(spark):
    df = spark.createDataFrame([("a", "", None)], SCHEMA)
    filled = routing.fill_defaults(df, {"category": "U", "NOTE": "U"})
    assert tuple(filled.first()) == ("a", "", "U")


@pytest.mark.parametrize("name", ["missing", "id"])
def test_defaults_are_for_text_columns_that_exist(spark, name):
    df = spark.createDataFrame([(1, "a")], "id int, note string")
    with pytest.raises(routing.DefaultMismatch):
        routing.fill_defaults(df, {name: "U"})


def test_report_from_routed_rows_equals_report_from_rows(spark):
    rows = [("a", "b", None)] * 3 + [(None, "b", "c")] * 2 + [("d", "e", "f")]
    df = spark.createDataFrame(rows, SCHEMA)
    routed = routing.route(df, CRITICAL)
    assert quality.quality_report(df, CRITICAL).collect() == quality.quality_report_of_routed(
        routed, CRITICAL
    ).collect()


def test_quarantine_needs_no_wide_shuffle_after_routing(spark, tmp_path):
    df = spark.createDataFrame([("a", "b", "c")] * 3, SCHEMA)
    path = str(tmp_path / "routed")
    routing.route(df, CRITICAL).write.parquet(path)
    routed = spark.read.parquet(path)
    plan = routing.clean_rows(routed)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "EqualTo(_marks.kept,true), IsNull(_marks.reason)]" in plan
    plan = routing.rejected_rows(routed)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1, "only blocks of hot rows move"


def test_partial_counts_come_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", "b", "c")] * 3, SCHEMA)
    plan = copies.collapse_copies(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange") < plan.index("partial_count")
    assert "Window" not in plan


HELPERS = ("_extra", "_copies", "_kept", "_reason", "_n", "_first", "_marks", "_case")


@pytest.mark.parametrize("name", HELPERS)
def test_data_columns_named_like_helpers(spark, name):
    rows = spark.createDataFrame([(1, "x"), (1, "x"), (1, "y"), (2, None)], f"k int, {name} string")
    for key, order in ((None, ()), (["K"], [name.upper()])):
        routed = routing.route(rows, [name], key, order)
        clean, rejected = routing.clean_rows(routed), routing.rejected_rows(routed)
        assert clean.columns == ["k", name] and rejected.columns == ["k", name, "reject_reason"]
        assert clean.count() + rejected.count() == 4
        report = quality.quality_report_of_routed(routed, [name], keyed=key is not None)
        wanted = quality.quality_report(rows, [name])
        assert Counter(report.filter("check_type <> 'DUPLICATE_KEY_CHECK'").collect()) == Counter(wanted.collect())
        found = report.filter("check_type = 'DUPLICATE_KEY_CHECK'").collect()
        assert [r["value"] for r in found] == (["1"] if key else [])


def test_unknown_key(spark):
    with pytest.raises(UnknownColumn):
        routing.route(spark.range(1), [], ["nope"], ["id"])
