"""Reading files, writing tables, file layout, names, the shared folder."""

from collections import Counter
from datetime import datetime
from uuid import uuid4

import pytest
from hypothesis import HealthCheck, given
from hypothesis import settings as settings_of
from hypothesis import strategies as st
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tierwork import settings
from tierwork.functions.names import NameCollision, rename_columns, sanitize_columns
from tierwork.operators import versions
from tierwork.sources import delimited, files, snapshots, tables, work


@pytest.fixture
def name():
    return f"t_{uuid4().hex}"


def bag(df):
    return Counter(map(tuple, df.collect()))


def test_csv_quoting(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text('id,note\n1,"he said ""x"", y\nz"\n2,""\n3,\n')
    rows = delimited.read_csv(spark, str(path))
    assert rows.dtypes == [("id", "string"), ("note", "string")]
    assert bag(rows) == Counter([("1", 'he said "x", y\nz'), ("2", None), ("3", None)])


def test_csv_types(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("id,at,code\n1,2024-01-01 10:00:00,007\n")
    assert delimited.read_csv(spark, str(path), infer_types=True).dtypes == [
        ("id", "int"),
        ("at", "timestamp"),
        ("code", "int"),
    ]
    given = delimited.read_csv(spark, str(path), schema="id bigint, at string, code string")
    assert tuple(given.first()) == (1, "2024-01-01 10:00:00", "007")


PLAIN = "id,note\n1,plain\n2,\"a, b\"\n3,\"say \"\"x\"\"\"\n4,\"\"\n5,\n\n6,\"\"\"\"\n"


@pytest.mark.parametrize(
    "text, alone",
    [
        (PLAIN, True),
        (PLAIN + '7,"two\nlines"\n', False),
        (PLAIN + '7,5" disk\n', False),
        (PLAIN + 'a"b,"x\ny",z"w\n', False),
        (PLAIN + '"x"y,"z"\n', False),
        (PLAIN + '7, "x"\n', False),
        (PLAIN + "7,a\rb\n", False),
        (PLAIN.replace("\n", "\r\n"), True),
        (PLAIN + "   \n", False),
        (PLAIN + '7,"' + 'x""' * 20_000 + '"\n', True),
    ],
)
def test_lines_that_stand_alone(spark, tmp_path, text, alone):
    path = tmp_path / "in.csv"
    path.write_bytes(text.encode())
    assert delimited.lines_stand_alone(spark, str(path)) is alone
    schema = StructType.fromDDL("id string, note string")
    whole = spark.read.schema(schema).csv(str(path), header=True, escape='"', multiLine=True)
    assert bag(delimited.read_csv(spark, str(path), schema)) == bag(whole)


PLAIN_FIELD = st.text("ab ", max_size=3)
QUOTED_FIELD = st.text('ab ,"\n', max_size=6).map(lambda text: '"' + text.replace('"', '""') + '"')
RECORD = st.tuples(*[PLAIN_FIELD | QUOTED_FIELD] * 2).map(",".join).filter(str.strip)


@settings_of(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(records=st.lists(RECORD, min_size=1, max_size=9), end=st.sampled_from(["\n", "\r\n"]))
def test_splitting_never_changes_the_rows(spark, tmp_path, records, end):
    """Blocks of some bytes: records begin, go on and end in different ones."""
    path = tmp_path / f"{uuid4().hex}.csv"
    path.write_bytes((end.join(["x,y", *records]) + end).encode())
    schema = StructType.fromDDL("x string, y string")
    whole = spark.read.schema(schema).csv(str(path), header=True, escape='"', multiLine=True)
    wanted = bag(whole)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9b")
    spark.conf.set("spark.sql.files.openCostInBytes", "9b")
    try:
        assert bag(delimited.read_csv(spark, str(path), schema)) == wanted
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_only_files_whose_records_span_lines_are_not_split(spark, tmp_path):
    plain, broken = str(tmp_path / "plain.csv"), str(tmp_path / "broken.csv")
    rows = spark.range(200_000).select("id", F.lit('x, "y" ' * 6).alias("s"))
    odd = spark.range(100).select("id", F.lit("two\nlines").alias("s"))
    for path, df in ((plain, rows), (broken, odd)):
        df.coalesce(1).write.option("header", True).option("escape", '"').csv(path)

    def tasks(path, **options):
        df = delimited.read_csv(spark, path, **options)
        return df.groupBy(F.spark_partition_id()).count().count(), df.distinct().count()

    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    try:
        split, count = tasks(plain)
        assert split > 4 and count == 200_000
        split, count = tasks([plain, broken])
        assert split > 5 and count == 200_100
        assert tasks(plain, multi_line=True) == (1, 200_000)
        assert tasks(plain, multi_line=False)[0] > 4
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def stray(tmp_path, place):
    """1,000 records, of which the 300th opens a quote that is never closed."""
    path = tmp_path / "in.csv"
    lines = [f"{i},note {i},x" for i in range(1, 1001)]
    lines[299] = place
    path.write_text("\n".join(["id,note,more", *lines]) + "\n")
    return str(path)


@pytest.mark.parametrize("place", ['300,"note 300,x', '"300,note 300,x', '300,note 300,"x'])
def test_nothing_vanishes_behind_an_unclosed_quote(spark, tmp_path, place):
    path = stray(tmp_path, place)
    with pytest.warns(UserWarning, match="unclosed quote"):
        rows = delimited.read_csv(spark, path, malformed="bad").collect()
    whole = spark.read.csv(path, header=True, escape='"', multiLine=True)
    assert len(rows) == whole.count() == 300
    last = next(r for r in rows if "1000,note 1000" in str(r))
    assert all(f"{i},note {i},x" in str(last["bad"] or last) for i in range(301, 1001))


@pytest.mark.parametrize(
    "text, unclosed",
    [
        (PLAIN, 0),
        (PLAIN + '7,"two\nlines"\n', 0),
        (PLAIN + '7,"""two""\n,""lines"""\n', 0),
        (PLAIN + '7,"\n\nlines\n"\n8,x\n', 0),
        (PLAIN + '7,5" disk\n', 0),
        (PLAIN + '7,"two\n8,lines\n', 1),
        (PLAIN + '"7,two\n8,lines\n', 1),
        (PLAIN + '7,"""two\n8,lines\n', 1),
    ],
)
def test_facts_of_a_file(spark, tmp_path, text, unclosed):
    path = tmp_path / "in.csv"
    path.write_text(text)
    facts = delimited.inspect(spark, str(path))
    assert (facts.files, facts.unclosed) == (1, unclosed)
    assert facts.lines == sum(bool(line.strip()) for line in text.split("\n"))
    assert delimited.record_lines(spark, str(path), facts) == facts.lines - 1
    assert delimited.inspect(spark, str(path), by_name=True).groups[0].header == "id,note"


@pytest.mark.parametrize("extra", ["", '9,"two\nlines"\n'])
def test_malformed_records_keep_their_text(spark, tmp_path, extra):
    path = tmp_path / "in.csv"
    path.write_text("id,note\n1,x\n2,x,LOST\n3\n" + extra)
    rows = delimited.read_csv(spark, str(path), malformed="bad", file_name="file")
    assert rows.columns == ["id", "note", "bad", "file"]
    found = {r["id"]: r for r in rows.collect()}
    assert found["2"]["bad"] == "2,x,LOST" and found["3"]["bad"] == "3" and found["1"]["bad"] is None
    assert {r["file"] for r in found.values()} == {"in.csv"}
    assert rows.select("id").count() == 3 + bool(extra)


def test_files_with_other_headers(spark, tmp_path):
    for name, text in (("a", "a,b\n1,x\n"), ("b", "b,a\ny,2\n"), ("c", "a,b,c\n3,z,more\n"), ("d", "a,b\n4,w\n")):
        (tmp_path / f"{name}.csv").write_text(text)
    with pytest.raises(Exception, match="header"):
        delimited.read_csv(spark, str(tmp_path)).collect()
    rows = delimited.read_csv(spark, str(tmp_path), by_name=True)
    assert rows.columns == ["a", "b", "c"]
    assert bag(rows) == Counter([("1", "x", None), ("2", "y", None), ("3", "z", "more"), ("4", "w", None)])
    (tmp_path / "e.csv").write_text('a,b\n5,"two\nlines"\n')
    with pytest.raises(Exception, match="header"):
        delimited.read_csv(spark, str(tmp_path)).collect()
    rows = delimited.read_csv(spark, str(tmp_path), by_name=True, schema="c string, a int, b string, d int", file_name="f")
    assert rows.dtypes == [("c", "string"), ("a", "int"), ("b", "string"), ("d", "int"), ("f", "string")]
    assert bag(rows.select("a", "b", "f").filter("a = 5")) == Counter([(5, "two\nlines", "e.csv")])
    assert rows.count() == 5 and rows.filter("d is null").count() == 5
    assert "Python" not in rows._jdf.queryExecution().toString() and "Arrow" not in rows._jdf.queryExecution().toString()


def test_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`User ID` int, `a.b-c` int, plain int")
    assert sanitize_columns(df).columns == ["User_ID", "a_b_c", "plain"]
    assert rename_columns(df, {"User ID": "u", "not there": "x"}).columns == ["u", "a.b-c", "plain"]
    clash = spark.createDataFrame([(1, 2)], "`a b` int, A_B int")
    with pytest.raises(NameCollision):
        sanitize_columns(clash)
    with pytest.raises(NameCollision):
        rename_columns(df, {"User ID": "Plain"})


def test_overwrite_from_itself(spark, tmp_path, name):
    location = str(tmp_path / "t")
    tables.overwrite_table(spark.range(10), name, location)
    tables.set_table_property(spark, name, "p", "1")
    assert tables.overwrite_table(spark.table(name).filter("id > 5"), name, location).count() == 4
    assert spark.sql(f"SHOW TBLPROPERTIES {name} ('p')").first()["value"] == "1"
    assert tables.overwrite_table(spark.table(name).filter("id > 7"), name, location).count() == 2
    assert sorted(x.name for x in (tmp_path / "t").iterdir()) == ["a", "b"], "no copy is left behind"


def test_schema_change_is_refused_unless_allowed(spark, tmp_path, name):
    location = str(tmp_path / "t")
    tables.overwrite_table(spark.range(3), name, location)
    with pytest.raises(tables.SchemaChanged):
        tables.overwrite_table(spark.range(3).withColumn("x", F.lit(1)), name, location)
    assert spark.table(name).columns == ["id"]
    changed = spark.range(3).withColumn("x", F.lit(1))
    assert tables.overwrite_table(changed, name, location, allow_schema_change=True).columns == ["id", "x"]


def test_versions_with_other_columns(spark, tmp_path):
    location = str(tmp_path / "t")
    snapshots.write_version(spark.range(3), location, 0, datetime(2024, 1, 1))
    wider = spark.range(3).withColumn("x", F.lit(1))
    snapshots.write_version(wider, location, 1, datetime(2024, 1, 2))
    merged = snapshots.read_versions(spark, location, merge_schema=True)
    assert bag(versions.as_of(merged, version=0).select("id", "x")) == Counter({(i, None): 1 for i in range(3)})
    assert versions.as_of(merged, version=1).filter("x = 1").count() == 3


def test_a_failed_overwrite_leaves_the_table(spark, tmp_path, name):
    location = str(tmp_path / "t")
    tables.overwrite_table(spark.range(3), name, location)
    bad = spark.range(3).select(F.raise_error(F.lit("no")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="no"):
        tables.overwrite_table(bad, name, location)
    assert spark.table(name).count() == 3
    assert tables.overwrite_table(spark.range(5), name, location).count() == 5


def test_partitioned_table(spark, tmp_path, name):
    rows = spark.range(10).withColumn("p", F.col("id") % 2)
    table = tables.overwrite_table(rows, name, str(tmp_path / "t"), partition_by=["p"])
    assert bag(table.groupBy("p").count()) == Counter([(0, 5), (1, 5)])
    again = tables.overwrite_table(rows.filter("id < 4"), name, str(tmp_path / "t"), partition_by=["p"])
    assert bag(again.groupBy("p").count()) == Counter([(0, 2), (1, 2)])
    even = tables.overwrite_table(rows.filter("p = 0"), name, str(tmp_path / "t"), partition_by=["p"])
    assert bag(even.groupBy("p").count()) == Counter([(0, 5)])


class Stopped(BaseException):
    """The driver ends here."""


def stop_at(monkeypatch, step, number=1):
    """Let the ``number``-th call of a step of the catalog end the driver."""
    calls, whole = [], getattr(tables, step)

    def call(*args):
        calls.append(args)
        if len(calls) == number:
            raise Stopped
        return whole(*args)

    monkeypatch.setattr(tables, step, call)


@pytest.mark.parametrize("partition_by", [(), ("p",)])
@pytest.mark.parametrize("step, number", [("_write", 1), ("_point", 1)])
def test_a_table_is_there_at_every_step(spark, tmp_path, name, monkeypatch, partition_by, step, number):
    rows = spark.range(10).withColumn("p", F.col("id") % 2)
    location = str(tmp_path / "t")
    tables.overwrite_table(rows, name, location, partition_by=partition_by)
    tables.set_table_property(spark, name, "k", "v")
    with monkeypatch.context() as patched, pytest.raises(Stopped):
        stop_at(patched, step, number)
        tables.overwrite_table(rows.filter("p = 0"), name, location, partition_by=partition_by)
    assert bag(spark.table(name)) == bag(rows), "the old rows are read"
    tables.overwrite_table(rows.filter("p = 0"), name, location, partition_by=partition_by)
    assert bag(spark.table(name)) == bag(rows.filter("p = 0"))
    assert spark.sql(f"SHOW TBLPROPERTIES {name} ('k')").first()["value"] == "v"


@pytest.mark.parametrize("step, number", [("_write", 1), ("_create", 1), ("_exchange", 1), ("_rename", 1), ("_rename", 2)])
def test_an_exchange_of_columns_can_fail_at_every_step(spark, tmp_path, name, monkeypatch, step, number):
    rows = spark.range(10).withColumn("p", F.col("id") % 2)
    location = str(tmp_path / "t")
    tables.overwrite_table(rows, name, location, partition_by=["p"])
    tables.set_table_property(spark, name, "k", "v")
    other = rows.select(F.col("id").cast("string").alias("id"), "p")
    with monkeypatch.context() as patched, pytest.raises(Stopped):
        stop_at(patched, step, number)
        tables.overwrite_table(other, name, location, partition_by=["p"], allow_schema_change=True)
    assert bag(spark.table(name)) == bag(rows)
    after = tables.overwrite_table(other, name, location, partition_by=["p"], allow_schema_change=True)
    assert dict(after.dtypes)["id"] == "string" and bag(after) == bag(other)
    assert spark.sql(f"SHOW TBLPROPERTIES {name} ('k')").first()["value"] == "v"


def test_a_table_left_between_two_renames_is_restored(spark, tmp_path, name):
    location = str(tmp_path / "t")
    tables.overwrite_table(spark.range(3), name, location)
    tables._rename(spark, name, f"{name}__before")
    tables.restore_table(spark, name)
    assert spark.table(name).count() == 3
    assert tables.overwrite_table(spark.range(4), name, location).count() == 4


def test_partitions_of_a_table_the_catalog_keeps(spark, tmp_path, name):
    """A table made elsewhere, whose partitions the catalog holds by folder."""
    rows = spark.range(10).withColumn("p", F.col("id") % 2)
    rows.write.partitionBy("p").option("path", str(tmp_path / "t" / "a")).saveAsTable(name)
    for kept in ("id < 4", "p = 0"):
        again = tables.overwrite_table(rows.filter(kept), name, str(tmp_path / "t"), partition_by=["p"])
        assert bag(again.select("id", "p")) == bag(rows.filter(kept))
    assert bag(tables.append_rows(rows.filter("id = 1"), name).select("id", "p")) == bag(rows.filter("p = 0 or id = 1"))


def test_columns_that_are_added(spark, tmp_path, name, monkeypatch):
    rows, location = spark.range(4).withColumn("p", F.col("id") % 2), str(tmp_path / "t")
    tables.overwrite_table(rows, name, location, partition_by=["p"])
    wider = rows.withColumn("x", F.lit("y"))
    with monkeypatch.context() as patched, pytest.raises(Stopped):
        stop_at(patched, "_point")
        tables.overwrite_table(wider, name, location, partition_by=["p"], allow_schema_change=True)
    assert bag(spark.table(name).select("id", "p")) == bag(rows)
    after = tables.overwrite_table(wider, name, location, partition_by=["p"], allow_schema_change=True)
    assert bag(after.select("id", "p", "x")) == bag(wider.select("id", "p", "x"))


def test_append_matches_columns_by_name(spark, tmp_path, name):
    rows = spark.createDataFrame([(1, "a")], "k int, v string")
    tables.overwrite_table(rows, name, str(tmp_path / "t"))
    after = tables.append_rows(rows.select("v", "k"), name)
    assert bag(after) == Counter({(1, "a"): 2})


def test_append_writes_the_new_rows_only(spark, tmp_path, name):
    location = tmp_path / "t"
    tables.overwrite_table(spark.range(1000).coalesce(1), name, str(location))
    before = {x.name for x in location.rglob("*.parquet")}
    assert tables.append_rows(spark.range(5).coalesce(1), name).count() == 1005
    after = {x.name for x in location.rglob("*.parquet")}
    assert before < after and len(after) == len(before) + 1


def test_property_text_is_taken_as_it_is(spark, tmp_path, name):
    tables.overwrite_table(spark.range(1), name, str(tmp_path / "it's"))
    tables.set_table_property(spark, name, "who's", "o'clock \\ x")
    found = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    assert found["who's"] == "o'clock \\ x"


def test_namespace(spark, tmp_path, name):
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/db'")
    tables.use_namespace(spark, "spark_catalog", name)
    try:
        assert spark.catalog.currentDatabase() == name
    finally:
        tables.use_namespace(spark, None, "default")
    with pytest.raises(AnalysisException):
        tables.use_namespace(spark, None, "no_such_schema")


def test_compaction_keeps_rows_and_saves_files(spark, tmp_path, name):
    path, target = str(tmp_path / "many"), str(tmp_path / "few")
    rows = spark.createDataFrame([(i % 7, "x") for i in range(500)], "k int, v string")
    rows.repartition(12).write.parquet(path)
    compacted = files.compact(spark, path, target)
    assert bag(compacted) == bag(rows)
    assert files.table_detail(spark, path).first()["numFiles"] == 12
    detail = files.table_detail(spark, target).first()
    assert detail["numFiles"] == 1 and detail["sizeInBytes"] > 0
    small = files.compact(spark, path, str(tmp_path / "some"), file_bytes=detail["sizeInBytes"])
    assert bag(small) == bag(rows)
    assert 1 < files.table_detail(spark, str(tmp_path / "some")).first()["numFiles"] <= 12


def test_compaction_of_partitions(spark, tmp_path):
    path, target = str(tmp_path / "many"), str(tmp_path / "few")
    rows = spark.range(300).withColumn("p", F.col("id") % 3)
    rows.repartition(8).write.partitionBy("p").parquet(path)
    compacted = files.compact(spark, path, target, partition_by=["p"])
    assert bag(compacted.select("id", "p")) == bag(rows)
    assert files.table_detail(spark, target).first()["numFiles"] == 3


@pytest.mark.parametrize("partition_by", [(), ("p",)])
def test_compaction_gives_files_of_the_size_asked_for(spark, tmp_path, partition_by):
    path, target = str(tmp_path / "large"), str(tmp_path / "cut")
    rows = spark.range(200_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("v"), (F.col("id") % 2).alias("p"))
    rows.repartition(2).write.partitionBy(*partition_by).parquet(path)
    before = files.table_detail(spark, path).first()
    wanted = before["sizeInBytes"] // 10
    assert files.compact(spark, path, target, wanted, partition_by).count() == 200_000
    after = files.table_detail(spark, target).first()
    assert before["numFiles"] <= 4 and 8 <= after["numFiles"] <= 24


def read_by_task(folder):
    """Bytes that each task wrote, by the task's number in the names of its files."""
    tasks = {}
    for x in folder.rglob("part-*.parquet"):
        task = x.name.split("-")[1]
        tasks[task] = tasks.get(task, 0) + x.stat().st_size
    return tasks


@pytest.mark.parametrize("in_place", [False, True])
def test_a_task_of_a_compaction_reads_no_more_than_a_file(spark, tmp_path, in_place):
    path, target, wanted = tmp_path / "uneven", tmp_path / "even", 2 * 2**20
    rows = spark.range(240_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("v"))
    rows.repartition(16).write.parquet(str(path))
    rows.limit(600).repartition(120).write.mode("append").parquet(str(path))
    large = [x.stat().st_size for x in path.glob("*.parquet") if x.stat().st_size > 2**18]
    assert len(large) == 16 and sum(large) > 4 * wanted, "large files beside many small ones"
    before = bag(spark.read.parquet(str(path)))
    settings_before = {x: spark.conf.get(x, None) for x in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.minPartitionNum")}
    if in_place:
        assert files.compact_small(spark, str(path), wanted)[0] == 136
        target = path
    else:
        files.compact(spark, str(path), str(target), wanted)
    assert max(read_by_task(target).values()) < 1.25 * wanted
    assert len(layout(target)) <= 2 * sum(large) // wanted
    assert bag(spark.read.parquet(str(target))) == before
    assert {x: spark.conf.get(x, None) for x in settings_before} == settings_before


def layout(folder):
    return {str(x.relative_to(folder)): x.stat().st_mtime_ns for x in folder.rglob("*") if x.is_file() and x.suffix == ".parquet"}


@pytest.mark.parametrize("partition_by", [(), ("p q",)])
def test_only_small_files_are_joined(spark, tmp_path, partition_by):
    path = tmp_path / "in it"
    rows = spark.range(40_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("v"), (F.col("id") % 2).alias("p q"))
    rows.repartition(2).write.partitionBy(*partition_by).parquet(str(path))
    large = layout(path)
    for _ in range(3):
        rows.limit(600).repartition(2).write.mode("append").partitionBy(*partition_by).parquet(str(path))
    wanted = bag(spark.read.parquet(str(path)))
    size = min((path / x).stat().st_size for x in large)
    replaced, made = files.compact_small(spark, str(path), size, partition_by)
    after = layout(path)
    assert replaced > made >= 1 and len(after) == len(large) + made
    assert large.items() <= after.items(), "large files are neither moved nor written"
    assert bag(spark.read.parquet(str(path))) == wanted
    assert not [x for x in path.iterdir() if x.name.startswith("_") and x.name != "_SUCCESS"]
    assert files.compact_small(spark, str(path), size, partition_by) == (0, 0)


@pytest.mark.parametrize("step, number", [("write", 1), ("move", 1), ("move", 2), ("remove", 1), ("remove", 3)])
def test_an_exchange_of_files_that_stops_is_finished(spark, tmp_path, monkeypatch, step, number):
    path = str(tmp_path / "t")
    rows = spark.range(900).withColumn("p", F.col("id") % 3)
    rows.repartition(4).write.partitionBy("p").parquet(path)
    calls, whole = [], getattr(work.Folder, step)

    def call(self, *args):
        calls.append(args)
        if len(calls) == number:
            raise Stopped
        return whole(self, *args)

    with monkeypatch.context() as patched, pytest.raises(Stopped):
        patched.setattr(work.Folder, step, call)
        files.compact_small(spark, path, partition_by=["p"])
    assert set(bag(spark.read.parquet(path))) == set(bag(rows)), "no row is missing meanwhile"
    files.finish_exchange(spark, path)
    assert bag(spark.read.parquet(path)) == bag(rows)
    files.compact_small(spark, path, partition_by=["p"])
    assert bag(spark.read.parquet(path)) == bag(rows) and len(layout(tmp_path / "t")) == 3


@pytest.mark.parametrize("size, partition", [(1, 128 * 2**20), (10**14, 1_810_193_360), (10**18, 2**31)])
def test_settings_follow_the_table_size(spark, size, partition):
    assert settings.partition_bytes(size) == pytest.approx(partition, rel=1e-6)
    chosen = settings.session_settings(size)
    assert int(chosen["spark.sql.shuffle.partitions"]) == max(1, -(-size // settings.partition_bytes(size)))
    assert all(spark.conf.isModifiable(name) for name in chosen)


def test_detail_of_no_files(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    assert tuple(files.table_detail(spark, str(tmp_path / "empty")).first()) == (0, 0)


def test_work_folder_is_the_one_the_session_names(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert work.work_path(spark, "x").startswith(base)
    kept = work.written(spark.range(5), "x")
    assert kept.count() == 5 and "Range" not in kept._jdf.queryExecution().executedPlan().toString()


def test_work_tables_are_listed_and_removed(spark, tmp_path):
    before = work.work_paths()
    one, other = (work.work_path(spark, name) for name in ("one", "other"))
    work.written(spark.range(3), "one", one)
    assert work.work_paths() == [*before, one, other]
    work.remove(spark, one)
    assert work.work_paths() == [*before, other] and not work.Folder(spark, one.rsplit("/", 1)[0]).read(one)
    with pytest.raises(AnalysisException):
        spark.read.parquet(one)
    work.remove(spark, other)
    assert work.work_paths() == before


def test_shuffles_of_written_tables_leave_no_files(spark):
    setting = work.SHUFFLE_CLEANUP
    before = spark.conf.get(setting)
    rows = work.written(spark.range(100).groupBy(F.col("id") % 7).count(), "x")
    assert rows.count() == 7 and spark.conf.get(setting) == before


@pytest.mark.parametrize("n", [0, 1, 1000])
def test_counts_taken_while_writing(spark, n):
    rows = spark.range(n).withColumn("g", F.col("id") % 3).groupBy("g").agg(F.count("id").alias("c"))
    total = F.coalesce(F.sum("c"), F.lit(0).cast("bigint")).alias("total")
    kept, counts = work.written_and_counted(rows, "x", [total, F.count("g").alias("groups")])
    assert counts.collect() == kept.agg(total, F.count("g").alias("groups")).collect()
    assert tuple(counts.first()) == (n, min(n, 3))


def test_a_cluster_has_to_name_the_folder():
    class Conf(dict):
        pass

    class Session:
        conf = Conf({"spark.master": "yarn"})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        work.work_path(Session(), "x")
