"""Reading a version-tagged table.

Such a table holds one full snapshot per version; rows carry ``_version`` and
``_commit_timestamp``. Stored, both are partition columns, so picking versions prunes folders.
Versions are consecutive numbers. Where only version numbers and times matter, the functions read
those two columns alone, or the far smaller ``commits`` frame (one row per version) if given.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierwork.functions.dates import moment

VERSION = "_version"
COMMIT_TIME = "_commit_timestamp"


class VersionNotAvailable(LookupError):
    """The version asked for was never written or has been retired."""


def version_history(snapshots: DataFrame, operations: DataFrame | None = None) -> DataFrame:
    """``version, timestamp, row_count`` per version, and ``operation`` if a log of ``version,
    operation`` and perhaps ``timestamp`` is given; the log also knows versions without rows."""
    history = snapshots.groupBy(F.col(VERSION).alias("version")).agg(
        F.min(COMMIT_TIME).alias("timestamp"), F.count(F.lit(1)).alias("row_count")
    )
    if operations is None:
        return history
    known = operations.withColumnsRenamed({"timestamp": "noted"})
    both = history.join(known, "version", "full")
    times = ["timestamp", "noted"] if "noted" in known.columns else ["timestamp"]
    return both.select(
        "version",
        F.coalesce(*times).alias("timestamp"),
        F.coalesce("row_count", F.lit(0).cast("bigint")).alias("row_count"),
        "operation",
    )


def newest_first(history: DataFrame) -> DataFrame:
    return history.orderBy(F.col("version").desc())


def version_bounds(snapshots: DataFrame) -> DataFrame:
    """Earliest and latest version (one row)."""
    return snapshots.agg(
        F.min(VERSION).alias("earliest_version"), F.max(VERSION).alias("latest_version")
    )


def _in_force(commits: DataFrame, at: datetime) -> Column:
    """The version a reader saw at ``at``, as a scalar subquery."""
    seen = commits.filter(F.col(COMMIT_TIME) <= moment(at))
    return seen.agg(F.max(VERSION)).scalar()


def as_of(
    snapshots: DataFrame,
    version: int | None = None,
    timestamp: datetime | None = None,
    missing: str = "raise",
    commits: DataFrame | None = None,
) -> DataFrame:
    """The rows of one version, or of the latest version not after ``timestamp``.

    A version that is not there raises ``VersionNotAvailable`` unless ``missing="empty"``; whether
    it is there is looked up in ``commits``, else by looking for one of its rows.
    """
    if (version is None) == (timestamp is None):
        raise ValueError("give either a version or a timestamp")
    if version is not None:
        wanted: int | Column = version
    else:
        wanted = _in_force(snapshots if commits is None else commits, timestamp)
    rows = snapshots.filter(F.col(VERSION) == wanted)
    known = rows if commits is None else commits.filter(F.col(VERSION) == wanted)
    if missing == "raise" and known.isEmpty():
        raise VersionNotAvailable(f"no rows for {version if version is not None else timestamp}")
    return rows.drop(VERSION, COMMIT_TIME)


def expired_versions(
    snapshots: DataFrame,
    as_of: datetime,
    retain_hours: int = 168,
    commits: DataFrame | None = None,
) -> DataFrame:
    """Versions that had been superseded before the retention period began; never the latest."""
    commits = snapshots if commits is None else commits
    oldest_kept = _in_force(commits, as_of - timedelta(hours=retain_hours))
    return version_history(snapshots.filter(F.col(VERSION) < oldest_kept))


def retain_versions(
    snapshots: DataFrame,
    as_of: datetime,
    retain_hours: int = 168,
    commits: DataFrame | None = None,
) -> DataFrame:
    """The snapshots without the expired versions, to be written to a new place."""
    commits = snapshots if commits is None else commits
    oldest_kept = _in_force(commits, as_of - timedelta(hours=retain_hours))
    earliest = commits.agg(F.min(VERSION)).scalar()
    return snapshots.filter(F.col(VERSION) >= F.coalesce(oldest_kept, earliest))
