"""Row-level changes between consecutive versions of a version-tagged table.

A feed over versions ``start .. end`` lists what each of those versions changed against the one
before it; version 0 starts from nothing. Every row takes part twice, as new row of its version
and as old row of the next one, so all steps of a feed share one shuffle. What goes through it is a digest of each row; the
digests that do not cancel out pick the changed rows in a second read, and these alone are compared whole. Where more
digests change than may be broadcast, all rows are compared whole instead, in one read. Which
versions there are and when they were committed comes from ``commits`` (one row per version) if
given, else from the snapshots themselves, which do not show a last version without rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from tierwork.functions.digests import row_digest
from tierwork.functions.names import NameCollision, free_name, named, spelled
from tierwork.operators.copies import repeat_rows
from tierwork.operators.versions import COMMIT_TIME, VERSION, VersionNotAvailable, version_bounds
from tierwork.sources.work import written_and_counted

# The columns and words of a change feed.
CHANGE_TYPE = "_change_type"
COMMIT_VERSION = "_commit_version"
INSERT = "insert"
DELETE = "delete"
UPDATE_BEFORE = "update_preimage"
UPDATE_AFTER = "update_postimage"

# Digests of changed rows are broadcast up to this many, some 64 bytes each in memory.
MOST_BROADCAST_DIGESTS = 500_000

# Rows of fewer columns are hardly wider than their digests.
LEAST_DIGESTED_COLUMNS = 4

# Commit times of a feed are broadcast only up to this many versions, one small row each.
MOST_BROADCAST_VERSIONS = 10_000


def _feed_range(commits: DataFrame, start: int, end: int | None) -> tuple[int, int]:
    earliest, latest = version_bounds(commits).first()
    end = latest if end is None else end
    first_needed = max(start - 1, 0)
    if latest is None or start < 0 or start > end or end > latest or first_needed < earliest:
        raise VersionNotAvailable(
            f"changes of versions {start} to {end} need versions {first_needed} to {end}, "
            f"available are {earliest} to {latest}"
        )
    return start, end


def _data_columns(snapshots: DataFrame) -> list[str]:
    """The columns of the rows themselves; those of a feed must be free."""
    data = [name for name in snapshots.columns if name not in (VERSION, COMMIT_TIME)]
    taken = {name.lower() for name in data} & {CHANGE_TYPE, COMMIT_VERSION, COMMIT_TIME}
    if taken:
        raise NameCollision(f"the feed needs the column {min(taken)!r}, which the rows have")
    return data


def _net_rows(snapshots: DataFrame, start: int, end: int, net: str) -> DataFrame:
    """Rows per version that the version before it holds unequally often, with the difference, by
    hash aggregates that fold on the map side, for all versions at once."""
    version = F.col(VERSION).cast("bigint")
    both = F.array(
        F.struct(version.alias(COMMIT_VERSION), F.lit(1).alias(net)),
        F.struct((version + 1).alias(COMMIT_VERSION), F.lit(-1).alias(net)),
    )
    names = _data_columns(snapshots)
    data = list(map(named, names))
    one, two = free_name("_one", snapshots.columns), free_name("_two", snapshots.columns)
    digests = dict(zip((one, two), row_digest(snapshots, names)))

    def sides(*columns: Column) -> DataFrame:
        """Every row as a new row of its version and as an old row of the next one."""
        rows = snapshots.filter(F.col(VERSION).between(start - 1, end)).select(*columns, F.inline(both))
        return rows.filter(F.col(COMMIT_VERSION).between(start, end))

    def differing(rows: DataFrame, *keys: Column | str) -> DataFrame:
        return rows.groupBy(*keys, COMMIT_VERSION).agg(F.sum(net).alias(net)).filter(F.col(net) != 0)

    rows = sides(*data)
    if len(names) >= LEAST_DIGESTED_COLUMNS:
        narrow = differing(sides(*(column.alias(name) for name, column in digests.items())), one, two)
        changed, counts = written_and_counted(narrow.drop(net), "changed-digests", [F.count(F.lit(1)).alias("n")])
        if counts.first()["n"] <= MOST_BROADCAST_DIGESTS:
            rows = sides(*data, *(column.alias(name) for name, column in digests.items()))
            rows = rows.join(F.broadcast(changed), [one, two, COMMIT_VERSION], "left_semi")
    return differing(rows, *data)


def _with_times(changes: DataFrame, commits: DataFrame, start: int, end: int) -> DataFrame:
    times = (
        commits.filter(F.col(VERSION).between(start, end))
        .groupBy(F.col(VERSION).cast("bigint").alias(COMMIT_VERSION))
        .agg(F.min(COMMIT_TIME).alias(COMMIT_TIME))
    )
    if end - start < MOST_BROADCAST_VERSIONS:
        times = F.broadcast(times)
    # A version without rows has no time in the snapshots; its deletes are kept all the same.
    return changes.join(times, COMMIT_VERSION, "left")


def _feed_columns(snapshots: DataFrame) -> list[Column]:
    data = [name for name in snapshots.columns if name not in (VERSION, COMMIT_TIME)]
    return [*map(named, data), *map(F.col, (CHANGE_TYPE, COMMIT_VERSION, COMMIT_TIME))]


def change_feed(
    snapshots: DataFrame, start: int, end: int | None = None, commits: DataFrame | None = None
) -> DataFrame:
    """Inserted and deleted rows per version, without a key.

    Versions are compared as bags: an added exact copy is an insert, a changed row a delete and
    an insert.
    """
    commits = snapshots if commits is None else commits
    start, end = _feed_range(commits, start, end)
    n = free_name("_net", snapshots.columns)
    net = _net_rows(snapshots, start, end, n)
    change = F.when(F.col(n) > 0, F.lit(INSERT)).otherwise(F.lit(DELETE))
    listed = repeat_rows(net.withColumn(CHANGE_TYPE, change).withColumn(n, F.abs(n)), n)
    return _with_times(listed, commits, start, end).select(*_feed_columns(snapshots))


def change_feed_keyed(
    snapshots: DataFrame,
    key: Sequence[str],
    start: int,
    end: int | None = None,
    commits: DataFrame | None = None,
) -> DataFrame:
    """Inserts, deletes and updates per version for rows known by ``key``.

    An update gives the row before and after. The query fails if a key occurs twice in a version.
    """
    commits = snapshots if commits is None else commits
    start, end = _feed_range(commits, start, end)
    data = _data_columns(snapshots)
    key = spelled(key, data)
    n = free_name("_net", snapshots.columns)
    # Rows that did not change have cancelled out by now, so only changed ones are paired by key.
    net = _net_rows(snapshots, start, end, n)
    row = F.struct(*map(named, data))
    pairs = net.groupBy(F.col(COMMIT_VERSION), F.struct(*map(named, key)).alias("key")).agg(
        F.first(F.when(F.col(n) < 0, row), ignorenulls=True).alias("old"),
        F.first(F.when(F.col(n) > 0, row), ignorenulls=True).alias("new"),
    )

    def entry(kind: str, side: str) -> Column:
        return F.struct(F.lit(kind).alias("kind"), F.col(side).alias("row"))

    entries = (
        F.when(F.col("old").isNull(), F.array(entry(INSERT, "new")))
        .when(F.col("new").isNull(), F.array(entry(DELETE, "old")))
        .otherwise(F.array(entry(UPDATE_BEFORE, "old"), entry(UPDATE_AFTER, "new")))
    )
    listed = pairs.select(COMMIT_VERSION, F.explode(entries).alias("entry"))
    listed = listed.unionByName(_repeated_keys(snapshots, key, start, end, listed.schema["entry"].dataType))
    listed = listed.select(
        COMMIT_VERSION, F.col("entry.kind").alias(CHANGE_TYPE), F.col("entry.row").alias("row")
    ).select(COMMIT_VERSION, CHANGE_TYPE, "row.*")
    return _with_times(listed, commits, start, end).select(*_feed_columns(snapshots))


def _repeated_keys(
    snapshots: DataFrame, key: Sequence[str], start: int, end: int, entry: DataType
) -> DataFrame:
    """No rows, or an error if a key occurs twice in a version. Versions and keys alone are read,
    and counted with a fold on the map side, so a key that wrongly fills a third of a version fails
    the query without first being gathered in one task."""
    versions = snapshots.filter(F.col(VERSION).between(start - 1, end))
    counted = versions.groupBy(F.col(VERSION), *map(named, key)).agg(F.count(F.lit(1)).alias("rows in key"))
    message = f"key {', '.join(key)} is not unique within a version"
    failed = F.raise_error(F.lit(message)).cast(entry)
    return counted.filter(F.col("`rows in key`") > 1).select(
        F.col(VERSION).cast("bigint").alias(COMMIT_VERSION), failed.alias("entry")
    )


def change_summary(feed: DataFrame) -> DataFrame:
    """Changes per kind."""
    return feed.groupBy(CHANGE_TYPE).count()
