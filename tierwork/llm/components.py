"""Connected components of links between numbers, by stars that are hung on ever smaller centres.

Each round hangs the neighbours of every node on the smallest of them (first those larger than the node,
then those smaller), until every component is one star around its smallest node. Rounds grow with
the logarithm of the longest path. A star's links are rows of their own, so a hub is a skewed join
key, and never a list. Every round ends in a table in the shared folder, and the table of the round before is removed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierwork.sources.work import remove, work_path, written_and_counted


def _hung(links: DataFrame, path: str) -> tuple[DataFrame, tuple]:
    """One round over links ``a`` > ``b``, written to a path, and numbers that change as long as the links do."""
    both = links.union(links.select("b", "a")).toDF("a", "b")
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select("a", F.least("a", "m").alias("m"))
    larger = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    larger = larger.distinct()
    least = larger.groupBy("a").agg(F.min("b").alias("m"))
    smaller = larger.join(least, "a")
    smaller = smaller.filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    hung = smaller.union(least.select("a", F.col("m").alias("b"))).distinct()
    rows, seen = written_and_counted(
        hung,
        "links",
        [
            F.count("*").alias("n"),
            F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0).cast("bigint")).alias("mark"),
        ],
        path,
    )
    return rows, tuple(seen.first())


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component``, the smallest node of its component, for links ``a``, ``b`` in any
    order; nodes without a link are not in it, nor are links of a node to itself."""
    links = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    spark = links.sparkSession
    path = work_path(spark, "links")
    links, before = _hung(links.distinct(), path)
    while True:
        last, path = path, work_path(spark, "links")
        links, now = _hung(links, path)
        remove(spark, last)
        if now == before:
            break
        before = now
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
