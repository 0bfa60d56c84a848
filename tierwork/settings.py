"""Session settings for tables of a given size."""

from __future__ import annotations

from math import ceil, sqrt

SMALLEST_PARTITION = 128 * 1024**2
LARGEST_PARTITION = 2 * 1024**3
SHUFFLE_BLOCK = 32 * 1024


def partition_bytes(table_bytes: int) -> int:
    """How much of a table one task should get.

    Scan and shuffle tasks of p bytes each exchange blocks of p*p/table_bytes. The size keeps a
    block from falling under 32 KiB, where seeks would outweigh the reading, within 128 MiB to
    2 GiB per task: 128 MiB up to half a terabyte, about 1.8 GiB at 100 TB.
    """
    wanted = ceil(sqrt(SHUFFLE_BLOCK * table_bytes))
    return min(max(wanted, SMALLEST_PARTITION), LARGEST_PARTITION)


def session_settings(table_bytes: int) -> dict[str, str]:
    """Settings for runs over tables of up to ``table_bytes``; adaptive execution merges the
    shuffle partitions that smaller steps do not need."""
    size = partition_bytes(table_bytes)
    return {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.files.maxPartitionBytes": str(size),
        "spark.sql.shuffle.partitions": str(max(1, ceil(table_bytes / size))),
    }
