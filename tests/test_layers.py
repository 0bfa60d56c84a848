"""All layers from a small CSV whose numbers are known."""

from collections import Counter
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tierwork import INCIDENTS, DatasetSpec
from tierwork.functions.names import NameCollision
from tierwork.operators.metrics import CountBy
from tierwork.operators.quality import QualityGateFailed, enforce_gate, quality_report
from tierwork.plans import layers, run
from tierwork.sources.delimited import UnclosedQuote, inspect
from tierwork.sources.files import table_detail

# Fixed value: the header line of the incident export.
HEADER = (
    "Number,Opened,short_description,Caller,User ID,Priority,State,Category,Assignment group,"
    "Assigned to,Channel,Service,Service Family,Service Subcategory,Updated,Updated by"
)
LINES = [
    'N1,05-01-2024 10:00,"line one\nline ""two""",Ann,U1,1 - High,Open,Net,Ops,Bo,Mail,S,F,C,05-01-2024 12:30,Cy',
    "N2,2024-01-31 23:00:00,,,,2 - Low,Closed,Net,,,,,,,2024-02-01 00:00:00,",
    "N2,2024-01-31 23:00:00,,,,2 - Low,Closed,Net,,,,,,,2024-02-01 00:00:00,",
    "N3,not a date,x,Ann,U1,2 - Low,Open,App,Ops,Bo,Mail,S,F,C,05-02-2024 12:30,Cy",
    ",05-02-2024 10:00,x,Ann,U1,2 - Low,Open,,Ops,Bo,Mail,S,F,C,05-02-2024 12:30,Cy",
    "N5,05-02-2024 10:00,x,Ann,U1,,,App,Ops,Bo,Mail,S,F,C,05-02-2024 12:30,Cy",
    "N5,05-02-2024 10:00,x,Ann,U1,,,App,Ops,Bo,Mail,S,F,C,05-02-2024 12:30,Cy",
]


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("layers")
    source = folder / "incidents.csv"
    source.write_text("\n".join([HEADER, *LINES]) + "\n")
    spark.sql(f"CREATE DATABASE layers_test LOCATION '{folder}/schema'")
    spec = replace(INCIDENTS, schema="layers_test")
    summary = run.run(spark, spec, str(source), str(folder / "tables"))
    return spec, {r["layer"]: r["row_count"] for r in summary.collect()}, folder


def test_rows_per_layer(made):
    _, counts, _ = made
    assert counts == {"bronze": 7, "quality": 21, "silver": 3, "quarantine": 4, "gold": 2 + 2 + 2 + 1 + 2}


def test_bronze_has_sixteen_columns_and_metadata(spark, made):
    spec, _, _ = made
    bronze = spark.table(spec.table("bronze"))
    assert bronze.columns[16:] == ["malformed_record", "ingestion_timestamp", "source_file_name"]
    assert len(bronze.columns) == 19 and "Assignment_Group" in bronze.columns
    assert bronze.select("source_file_name").distinct().collect() == [("incidents.csv",)]
    text = bronze.filter("Number = 'N1'").first()["short_description"]
    assert text == 'line one\nline "two"'


def test_quality_report(spark, made):
    spec, _, _ = made
    report = {r["column_name"]: r for r in spark.table(spec.table("quality")).collect()}
    assert report["duplicate_rows"]["value"] == "2" and report["duplicate_rows"]["percentage"] == "28.57%"
    assert report["critical_columns_with_nulls"]["percentage"] == "4/4 columns affected"
    assert report["Channel"]["value"] == "2" and report["ingestion_timestamp"]["status"] == "PASS"


def test_quarantine(spark, made):
    spec, _, _ = made
    rejected = spark.table(spec.table("quarantine"))
    assert Counter(r[0] for r in rejected.select("reject_reason").collect()) == Counter(
        {"duplicate row": 2, "null in Number": 1, "null in Priority": 1}
    )
    assert len(rejected.columns) == 21 and dict(rejected.dtypes)["Opened"] == "string"
    assert rejected.filter("reject_reason = 'duplicate row' AND Number = 'N2'").first()["Channel"] is None


def test_quarantine_is_written_in_few_files(spark, made):
    _, _, folder = made
    detail = table_detail(spark, f"{folder}/tables/quarantine/a").first()
    assert detail["numFiles"] == 1


def test_silver(spark, made):
    spec, _, _ = made
    silver = {r["Number"]: r for r in spark.table(spec.table("silver")).collect()}
    assert silver["N2"]["short_description"] == "No Description"
    assert silver["N2"]["Assigned_To"] == "Unassigned" and silver["N2"]["Channel"] == "Unknown"
    assert str(silver["N2"]["Opened"]) == "2024-01-31 23:00:00"
    assert silver["N3"]["Opened"] is None and str(silver["N1"]["Updated"]) == "2024-01-05 12:30:00"


def test_gold(spark, made):
    spec, _, _ = made
    gold = spark.table(spec.table("gold")).select("aggregation_type", "group_column", "value")
    assert Counter(map(tuple, gold.collect())) == Counter(
        [
            ("by_priority", "1 - High", "1"),
            ("by_priority", "2 - Low", "2"),
            ("by_category", "Net", "2"),
            ("by_category", "App", "1"),
            ("by_state", "Open", "2"),
            ("by_state", "Closed", "1"),
            ("by_month", "2024-1", "2"),
            ("avg_resolution_time", "Ops", "2.5"),
            ("avg_resolution_time", "Unassigned", "1.0"),
        ]
    )


def test_report_equals_the_one_computed_from_bronze(spark, made):
    spec, _, _ = made
    wanted = quality_report(spark.table(spec.table("bronze")).drop("malformed_record"), spec.critical)
    written = spark.table(spec.table("quality")).drop("report_timestamp")
    assert Counter(written.collect()) == Counter(wanted.collect())


def test_no_rows_at_all(spark, made, tmp_path):
    spec, _, _ = made
    (tmp_path / "none.csv").write_text(HEADER + "\n")
    empty = replace(spec, name="empty", schema="layers_empty")
    spark.sql(f"CREATE DATABASE layers_empty LOCATION '{tmp_path}/schema'")
    summary = run.run(spark, empty, str(tmp_path / "none.csv"), str(tmp_path / "tables"))
    counts = {r["layer"]: r["row_count"] for r in summary.collect()}
    assert counts == {"bronze": 0, "quality": 21, "silver": 0, "quarantine": 0, "gold": 0}


def test_a_second_run_writes_the_same_folders(spark, made):
    spec, counts, folder = made
    for _ in range(2):
        again = run.run(spark, spec, str(folder / "incidents.csv"), str(folder / "tables"))
    assert {r["layer"]: r["row_count"] for r in again.collect()} == counts
    found = sorted(x.name for x in (folder / "tables").iterdir())
    assert found == ["bronze", "gold", "quality", "quarantine", "routed", "silver"]
    assert sorted(x.name for x in (folder / "tables" / "silver").iterdir()) == ["a", "b"]


def test_malformed_records_are_put_aside(spark, made, tmp_path):
    spec, _, _ = made
    (tmp_path / "bad.csv").write_text(HEADER + "\n" + LINES[1] + "\n" + LINES[1] + ",more\nN9,short\n")
    own = replace(spec, name="bad", schema="layers_test")
    summary = run.run(spark, own, str(tmp_path / "bad.csv"), str(tmp_path / "tables"))
    counts = {r["layer"]: r["row_count"] for r in summary.collect()}
    assert counts["bronze"] == 3 and counts["silver"] == 1 and counts["quarantine"] == 2
    rejected = spark.table(own.table("quarantine")).collect()
    assert {r["reject_reason"] for r in rejected} == {"malformed record"}
    assert {r["malformed_record"] for r in rejected} == {LINES[1] + ",more", "N9,short"}
    assert "malformed_record" not in spark.table(own.table("silver")).columns


def test_lost_dates_stop_or_warn(spark, made, tmp_path):
    spec, _, folder = made
    source, warned = str(folder / "incidents.csv"), replace(spec, name="warned")
    with pytest.warns(UserWarning, match="dates lost: {'Opened': 1}"):
        run.run(spark, warned, source, str(tmp_path / "warned"))
    strict = replace(spec, name="strict_dates", on_date_loss="raise")
    with pytest.raises(run.DatesLost, match="Opened"):
        run.run(spark, strict, source, str(tmp_path / "strict"))
    assert not spark.catalog.tableExists(strict.table("gold"))


def test_gate_warns(spark, made):
    spec, _, _ = made
    with pytest.warns(UserWarning, match="4 critical columns hold nulls"):
        enforce_gate(spark.table(spec.table("quality")))


@pytest.mark.parametrize("name", ["file_names", "on_fail", "on_loss", "on_date_loss"])
def test_misspelt_words_are_refused(name):
    with pytest.raises(ValueError, match=name):
        replace(INCIDENTS, **{name: "Raise"})


def test_a_file_with_a_metadata_column_is_refused(spark, tmp_path):
    (tmp_path / "in.csv").write_text("Number,Source_File_Name\nN1,keep me\n")
    with pytest.raises(NameCollision):
        layers.bronze(spark, INCIDENTS, str(tmp_path / "in.csv"))


def test_duplicates_across_loads(spark, tmp_path):
    for name in ("a.csv", "b.csv"):
        (tmp_path / name).write_text("Number,User ID\nN1,U1\nN2,U1\n")
    spec = replace(INCIDENTS, file_names="each", critical=("Number",), defaults={}, date_columns=())
    bronze = layers.bronze(spark, spec, str(tmp_path), F.lit("2024-01-01").cast("timestamp"))
    assert layers.silver(layers.routed(bronze, spec), spec).count() == 4
    once = replace(spec, across_loads=True)
    kept = layers.silver(layers.routed(bronze, once), once).collect()
    assert [(r["Number"], r["source_file_name"]) for r in sorted(kept)] == [("N1", "a.csv"), ("N2", "a.csv")]


def test_gate_can_stop_the_run(spark, made, tmp_path):
    spec, _, folder = made
    strict = replace(spec, name="strict", on_fail="raise")
    with pytest.raises(QualityGateFailed):
        run.run(spark, strict, str(folder / "incidents.csv"), str(tmp_path / "tables"))
    assert not spark.catalog.tableExists(strict.table("silver"))
    assert spark.catalog.tableExists(strict.table("bronze"))


def test_lost_rows_stop_or_warn(spark):
    rows = spark.range(3)
    run.check_rows(rows, rows.limit(2), rows.limit(1))
    with pytest.raises(run.RowsLost):
        run.check_rows(rows, rows.limit(1), rows.limit(1))
    with pytest.warns(UserWarning, match="rows lost"):
        run.check_rows(rows, rows.limit(1), rows.limit(1), "warn")


def test_each_row_can_name_its_own_file(spark, tmp_path):
    for name in ("a.csv", "b.csv"):
        (tmp_path / name).write_text("Number,User ID\nN1,U1\n")
    spec = replace(INCIDENTS, file_names="each", duplicate_key=("Number", "User_ID"),
                   duplicate_order=("source_file_name",), critical=("Number",), defaults={}, date_columns=())
    bronze = layers.bronze(spark, spec, str(tmp_path), F.lit("2024-01-01").cast("timestamp"))
    own = ["malformed_record", "ingestion_timestamp", "source_file_name"]
    assert bronze.columns == ["Number", "User_ID", *own]
    assert {r["source_file_name"] for r in bronze.collect()} == {"a.csv", "b.csv"}
    routed = layers.routed(bronze, spec)
    assert [r["source_file_name"] for r in layers.silver(routed, spec).collect()] == ["a.csv"]


def test_table_names():
    spec = replace(INCIDENTS, catalog="c", schema="s")
    assert spec.table("silver") == "c.s.silver_incidents"
    assert spec.table("quality") == "c.s.quality_report"


def test_a_run_misses_what_an_unclosed_quote_swallows(spark, tmp_path):
    """One stray quote among 1,000 records: the run stops, or warns and bronze has all the text."""
    path = tmp_path / "in.csv"
    lines = [f"{i},note {i},x" for i in range(1, 1001)]
    lines[299] = '300,"note 300,x'
    path.write_text("\n".join(["id,note,more", *lines]) + "\n")
    spec = DatasetSpec(name="strays", critical=("id",), metrics=(CountBy("by_more", "more", "n"),))
    with pytest.raises(UnclosedQuote):
        run.run(spark, spec, str(path), str(tmp_path / "t"))
    with pytest.warns(UserWarning, match="unclosed"):
        run.run(spark, replace(spec, on_loss="warn"), str(path), str(tmp_path / "t"))
    swallowed = spark.table("bronze_strays").filter("malformed_record is not null").collect()
    assert len(swallowed) == 1 and "1000,note 1000,x" in swallowed[0]["malformed_record"]


def test_bronze_is_compared_with_the_lines_of_the_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("id,note\n1,x\n2,y\n\n")
    (tmp_path / "in" / "b.csv").write_text('id,note\n3,"two\n\nlines"\n4,z\n')
    path, spec = str(tmp_path / "in"), DatasetSpec(name="counted")
    facts = inspect(spark, path)
    whole = layers.bronze(spark, spec, path, facts=facts)
    run.check_source(spark, path, facts, whole, spec.malformed_column)
    with pytest.raises(run.RowsLost, match="under"):
        run.check_source(spark, path, facts, whole.filter("id <> '3'"), spec.malformed_column)
    facts = inspect(spark, f"{path}/a.csv")
    one = layers.bronze(spark, spec, f"{path}/a.csv", facts=facts)
    for wrong in (one.filter("id = '1'"), one.union(one)):
        with pytest.warns(UserWarning, match="lines of 2"):
            run.check_source(spark, path, facts, wrong, spec.malformed_column, "warn")


@pytest.mark.parametrize("stopped_at", ["routed", "quality", "quarantine", "silver", "gold"])
def test_a_run_goes_on_where_it_stopped(spark, tmp_path, monkeypatch, stopped_at):
    """The file is not read again, layers that are complete are not made again, and the result is the same."""
    source = tmp_path / "incidents.csv"
    source.write_text("\n".join([HEADER, *LINES]) + "\n")
    schema = f"resumed_{stopped_at}"
    spark.sql(f"CREATE DATABASE {schema} LOCATION '{tmp_path}/schema'")
    spec, location = replace(INCIDENTS, schema=schema), str(tmp_path / "tables")

    def stop(*args, **kwargs):
        raise KeyboardInterrupt

    places = {"routed": (layers, "routed"), "quality": (run, "timed"), "quarantine": (run, "quarantine"),
              "silver": (layers, "silver"), "gold": (layers, "gold")}
    with monkeypatch.context() as patched, pytest.raises(KeyboardInterrupt):
        patched.setattr(*places[stopped_at], stop)
        run.run(spark, spec, str(source), location)
    made, whole = [], run.overwrite_table
    with monkeypatch.context() as patched:
        patched.setattr(run, "inspect", stop)
        patched.setattr(layers, "bronze", stop)
        patched.setattr(run, "overwrite_table", lambda df, name, at: made.append(name) or whole(df, name, at))
        found = {r["layer"]: r["row_count"] for r in run.run(spark, spec, str(source), location, resume=True).collect()}
    order = ["quality", "quarantine", "silver", "gold"]
    first = 0 if stopped_at == "routed" else order.index(stopped_at)
    assert [name.split(".")[1].split("_")[0] for name in made] == order[first:]
    again = {r["layer"]: r["row_count"] for r in run.run(spark, spec, str(source), str(tmp_path / "other")).collect()}
    assert found == again


def test_a_run_over_other_files_or_rules_begins_anew(spark, tmp_path):
    source = tmp_path / "in.csv"
    source.write_text("id,note\n1,x\n2,y\n")
    spec = DatasetSpec(name="anew", critical=("id",), metrics=(CountBy("by_note", "note", "n"),))
    location = str(tmp_path / "t")

    def rows(spec, resume):
        found = run.run(spark, spec, str(source), location, resume=resume).collect()
        return {r["layer"]: r["row_count"] for r in found}

    def loaded():
        return spark.table("bronze_anew").select(F.max("ingestion_timestamp")).first()[0]

    assert rows(spec, True)["bronze"] == 2
    first = loaded()
    assert rows(spec, True)["bronze"] == 2 and loaded() == first
    source.write_text("id,note\n1,x\n2,y\n3,z\n")
    assert rows(spec, True)["gold"] == 3 and loaded() > first
    second = loaded()
    assert rows(replace(spec, critical=("note",)), True)["bronze"] == 3 and loaded() > second
    third = loaded()
    assert rows(replace(spec, critical=("note",)), False)["bronze"] == 3 and loaded() > third
