"""Delimited text files, read by Spark's own reader.

A record may span lines, inside quotes, and then no one can tell from the middle of a file whether a
line begins inside or outside of quotes. ``inspect`` looks at all lines in one parallel pass: files whose lines are
all whole records are split by Spark at line ends; files with records that span lines are read by
one task each, so such loads are as parallel as they have files. ``multi_line`` says it beforehand and saves the
pass. The same pass counts lines, apart from any CSV parser, which tells later whether
all of them arrived, and finds files in which a quote is opened and never closed: there everything
behind it becomes one field.

Records that do not fit their header, with fields too many or too few or of another type, keep
their text in a column of their own. Files of one load have the same header, else the read fails, or
with ``by_name`` files with the same header are read together and matched by column name.
"""

from __future__ import annotations

import csv
import warnings
from dataclasses import dataclass
from functools import reduce
from io import StringIO
from operator import xor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tierwork.functions.names import named

# A quoted field: at the start of a line or after a comma, up to a comma or the end of the line,
# quotes inside it doubled. The quantifiers give nothing back, so long fields cost no stack.
QUOTED_FIELD = r'(^|,)"[^"]*+(?:""[^"]*+)*+"(?=,|$)'
# What is left of a field that begins on a line or ends on it: an odd number of quotes at its edge. A line
# that begins with one before a comma or its end is taken to end a field.
OPENED = r'(?:^"(?:"")*+(?=[^",])|,"(?:"")*+(?!"))'
CLOSED = r'(?<!")"(?:"")*+(?=,|$)'


class UnclosedQuote(ValueError):
    """A file opens a quote and never closes it, so the rest of it is one field."""


@dataclass(frozen=True)
class Group:
    """Files of a load that are read together: how many, and which, where they are not all of it. ``header`` is
    their first line, if it was asked for."""

    header: str | None
    spanning: bool
    files: int
    paths: tuple[str, ...] | None


@dataclass(frozen=True)
class Facts:
    """What one pass over the lines of a load found: its groups of files, the number of ``files`` that have a line,
    the ``lines`` that are not blank, headers included, the number of files with an ``unclosed`` quote, and a
    digest of the files' paths, sizes and times (``listing``)."""

    groups: tuple[Group, ...]
    files: int
    lines: int
    unclosed: int
    listing: int

    @property
    def spanning(self) -> bool:
        return any(group.spanning for group in self.groups)


def inspect(spark: SparkSession, path: str | list[str], by_name: bool = False) -> Facts:
    """The facts of a load, from one parallel pass over its text; with ``by_name`` also the headers.

    A line is a record if it has no quote outside a complete quoted field, no carriage return but at
    its end, and is not blank without being empty; whatever is in doubt counts as part of a record that spans lines. The
    driver sees a row per header, and the names of the files, which its listing has anyway, if not all are read alike.
    """
    text = spark.read.option("lineSep", "\n").text(path)
    line = F.when(F.col("value").endswith("\r"), F.expr("left(value, length(value) - 1)")).otherwise(F.col("value"))
    lines = text.select(
        *file_identity(),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
        line.alias("line"),
    )
    # The patterns are only tried on lines with a quote, or with a blank at their start.
    quote = F.col("line").contains('"')
    left = F.when(quote, F.regexp_replace("line", QUOTED_FIELD, "$1")).otherwise("")
    blank = (F.col("line") < "!") & F.col("line").rlike(r"^[\x00-\x20]*$")
    lines = lines.withColumns({"left": left, "blank": blank})
    odd = quote & F.col("left").contains('"')
    spans = odd | F.col("line").contains("\r") | (F.col("blank") & (F.col("line") != ""))
    opened = F.count_if(odd & F.col("left").rlike(OPENED)) > F.count_if(odd & F.col("left").rlike(CLOSED))
    found = [F.count_if(~F.col("blank")).alias("lines"), opened.alias("unclosed")]
    if by_name:
        # A set of blocks is bounded, and with it the aggregate holds text without sorting the lines.
        first = F.when(~F.col("blank") & (F.col("block") == 0), F.col("place"))
        spanning = F.size(F.collect_set(F.when(spans, F.col("block")))) > 0
        found += [spanning.alias("spanning"), F.min_by("line", first).alias("header")]
    else:
        found += [(F.count_if(spans) > 0).alias("spanning"), F.lit(None).cast("string").alias("header")]
    files = lines.groupBy("file", "size", "modified").agg(*found)
    counts = files.groupBy("header", "spanning").agg(
        F.count_if(F.col("lines") > 0).alias("files"),
        F.sum("lines").alias("lines"),
        F.count_if("unclosed").alias("unclosed"),
        listing_digest().alias("listing"),
    )
    counts = sorted(counts.collect(), key=lambda x: (-x["files"], x["header"] or "", x["spanning"]))
    listing = reduce(xor, (x["listing"] for x in counts), 0)
    counts = [x for x in counts if x["files"]]
    files = files.filter("lines > 0")
    if len(counts) > 1:
        paths: dict[tuple, list[str]] = {}
        for row in files.select("header", "spanning", "file").orderBy("file").toLocalIterator():
            paths.setdefault((row["header"], row["spanning"]), []).append(row["file"])
        groups = [Group(*key, len(paths[key]), tuple(paths[key])) for key in ((x["header"], x["spanning"]) for x in counts)]
    else:
        groups = [Group(x["header"], x["spanning"], x["files"], None) for x in counts]
    return Facts(tuple(groups), *(sum(x[c] for x in counts) for c in ("files", "lines", "unclosed")), listing)


def file_identity() -> list[Column]:
    """Path, size and time of the file that a row is from."""
    fields = {"file": "file_path", "size": "file_size", "modified": "file_modification_time"}
    return [F.col(f"_metadata.{field}").alias(name) for name, field in fields.items()]


def listing_digest() -> Column:
    """A number for a set of files, as an aggregate over their identities."""
    return F.coalesce(F.bit_xor(F.xxhash64("file", "size", "modified")), F.lit(0).cast("bigint"))


def listing_of(spark: SparkSession, path: str | list[str]) -> int:
    """The ``listing`` of the facts of a load, from the folder listing; no file is opened. Empty files do not count."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(*file_identity()).filter("size > 0").agg(listing_digest()).first()[0]


def lines_stand_alone(spark: SparkSession, path: str | list[str]) -> bool:
    """Whether every line is a whole record, so that Spark may split files at line ends."""
    return not inspect(spark, path).spanning


def _options(spanning: bool, malformed: str | None = None) -> dict[str, str]:
    found = {"header": "true", "escape": '"', "enforceSchema": "false", "multiLine": str(spanning).lower()}
    if malformed:
        # With columns left out, Spark would not see that a record has too many fields.
        found |= {"columnNameOfCorruptRecord": malformed, "columnPruning": "false"}
    return found


def _read(
    spark: SparkSession,
    path: str | list[str],
    spanning: bool,
    schema: StructType | None,
    infer_types: bool,
    malformed: str | None,
    header: str | None = None,
) -> DataFrame:
    """Files with one header, by Spark's reader; its header check fails on others."""
    reader = spark.read.options(**_options(spanning, malformed))
    if schema is None and not infer_types and header and not spanning:
        schema = _text_schema(header)
    if malformed:
        if schema is None:
            schema = reader.option("inferSchema", infer_types).csv(path).schema
        schema = StructType([*schema, StructField(malformed, StringType())])
    return reader.schema(schema).csv(path) if schema else reader.option("inferSchema", infer_types).csv(path)


def _text_schema(header: str) -> StructType | None:
    """Text columns of a header line, if all its names are there and different; else Spark names them."""
    names = next(csv.reader(StringIO(header, newline="")), [])
    if not all(names) or len({name.lower() for name in names}) < len(names):
        return None
    return StructType([StructField(name, StringType()) for name in names])


def _inferred(rows: DataFrame, names: list[str]) -> DataFrame:
    """Text columns cast to the narrowest type that takes all their values, found in one pass."""
    kinds = ("int", "bigint", "double", "date", "timestamp", "boolean")
    day = r"^\d{4}-\d{2}-\d{2}$"

    def fits(name: str, kind: str) -> Column:
        value = named(name).try_cast(kind)
        return F.when(named(name).rlike(day), value) if kind == "date" else value

    counts = rows.agg(
        *(F.count(named(name)).alias(f"n{i}") for i, name in enumerate(names)),
        *(F.count(fits(name, kind)).alias(f"{kind}{i}") for i, name in enumerate(names) for kind in kinds),
    ).first()
    found = {
        name: next((k for k in kinds if counts[f"n{i}"] and counts[f"{k}{i}"] == counts[f"n{i}"]), "string")
        for i, name in enumerate(names)
    }
    return rows.withColumns({name: named(name).cast(kind) for name, kind in found.items() if kind != "string"})


def _read_by_name(
    spark: SparkSession,
    path: str | list[str],
    facts: Facts,
    schema: StructType | None,
    infer_types: bool,
    malformed: str | None,
    file_name: str | None,
) -> DataFrame:
    """Every group of files with a schema in its own order, put together by name."""
    kinds = {f.name.lower(): f.dataType for f in schema} if schema else {}
    extra = [x for x in (malformed, file_name) if x]
    parts, columns = [], []
    for group in facts.groups or (Group(None, False, 0, None),):
        paths = path if group.paths is None else list(group.paths)
        own = _read(spark, paths, group.spanning, None, False, None, group.header).schema
        columns += [name for name in own.fieldNames() if name.lower() not in {c.lower() for c in columns}]
        own = StructType([StructField(f.name, kinds.get(f.name.lower(), f.dataType)) for f in own])
        parts.append(_with_file(_read(spark, paths, group.spanning, own, False, malformed), file_name))
    rows = reduce(lambda one, other: one.unionByName(other, allowMissingColumns=True), parts)
    if schema is not None:
        missing = [f for f in schema if f.name.lower() not in {c.lower() for c in columns}]
        rows = rows.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing})
        columns = schema.fieldNames()
    elif infer_types:
        rows = _inferred(rows, columns)
    return rows.select(*map(named, [*columns, *extra]))


def _with_file(rows: DataFrame, file_name: str | None) -> DataFrame:
    return rows.select("*", F.col("_metadata.file_name").alias(file_name)) if file_name else rows


def record_lines(spark: SparkSession, path: str | list[str], facts: Facts) -> int:
    """The lines of a load that are neither blank nor part of a header."""
    headers = 0
    for group in facts.groups:
        paths = path if group.paths is None else list(group.paths)
        names = _read(spark, paths, True, None, False, None).columns if group.spanning else ()
        headers += group.files * (1 + sum(name.count("\n") for name in names))
    return facts.lines - headers


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | str | None = None,
    infer_types: bool = False,
    malformed: str | None = None,
    by_name: bool = False,
    file_name: str | None = None,
    multi_line: bool | None = None,
    facts: Facts | None = None,
) -> DataFrame:
    """CSV with a header line, doubled quotes as escape; an empty field is null.

    Without a schema every column is text; ``infer_types`` costs a pass over the data. ``multi_line`` says whether
    quoted fields may have line breaks; files are not split then. Without it, ``facts`` of the load tell, or a pass over the
    text, and only files with such records are not split. ``malformed`` names a column for the text of records
    that do not fit; without it such fields are null or cut off, as Spark has it. ``by_name`` matches files with other
    headers by name, columns that a file lacks are null; else other headers fail the read. ``file_name``
    names a column for the name of the file a record is from. A file with an unclosed quote is warned of; its last record has all
    that follows.
    """
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    if facts is None and (by_name or multi_line is None):
        facts = inspect(spark, path, by_name)
    if facts is not None and facts.unclosed:
        warnings.warn(f"{facts.unclosed} files with an unclosed quote under {path}", stacklevel=2)
    if by_name:
        return _read_by_name(spark, path, facts, schema, infer_types, malformed, file_name)
    if facts is None or multi_line is not None or len(facts.groups) < 2:
        spanning = facts.spanning if multi_line is None else multi_line
        return _with_file(_read(spark, path, spanning, schema, infer_types, malformed), file_name)
    # Some files have records that span lines: the others are split all the same.
    if schema is None:
        schema = _read(spark, path, True, None, infer_types, None).schema
    parts = [
        _with_file(_read(spark, list(g.paths), g.spanning, schema, False, malformed), file_name) for g in facts.groups
    ]
    return reduce(DataFrame.unionByName, parts)
