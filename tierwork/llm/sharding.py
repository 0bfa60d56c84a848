"""Sharding by proportional stratified interleaving.

Rows are shuffled by a seeded digest within their source and ranked there; row ``r`` of ``n`` stands at
``(2r - 1) / 2n`` between 0 and 1. Sorting all rows by that place interleaves the sources in
proportion, and cutting the order into equal runs gives shards whose counts differ by one row at
most and whose sources all have the corpus's shares, to a row or two.

At scale: ranks come from counts of small ranges instead of one sort of a whole source. Digests are
even, so cutting them into ranges, ``RANGE_ROWS`` rows of a source each at most on average, gives
groups of bounded size however large a source is; a row's rank is its place in its range plus
the rows in the ranges before. The same is done again for the sorted places. Texts are read once,
only ids, sizes and digests move. One task sees a row for each ``BLOCK_RANGES`` ranges of the whole
order, one for two million rows.

Defined cases: a null source is a source of its own; a null text has no bytes, so size 8 and the
CRC of nothing, 0; rows that repeat a doc_id, or have none, are rows of their own, dealt by their text
too; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierwork.sources.work import written

SEED = "interleave-1"
#: Rows of one range, about; the ranges of a source differ by chance only.
RANGE_ROWS = 2048
#: Ranges whose counts are added up together.
BLOCK_RANGES = 1024
#: What a row takes in a shard besides its text.
ROW_BYTES = 8


def _stratum(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("null"))


def _rows_before(counts: DataFrame, within: list[str]) -> DataFrame:
    """Adds to each range the rows in the ranges ``before`` it, and the rows ``of`` all of them: by
    sums over blocks of ranges and sums within a block, so that no task sees all ranges."""
    counts = counts.withColumn("block", F.floor(F.col("range") / BLOCK_RANGES))
    blocks = counts.groupBy(*within, "block").agg(F.sum("n").alias("in_block"))
    earlier = Window.partitionBy(*within).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(
        *within,
        "block",
        F.coalesce(F.sum("in_block").over(earlier), F.lit(0)).alias("blocks_before"),
        F.sum("in_block").over(Window.partitionBy(*within)).alias("of"),
    )
    inside = Window.partitionBy(*within, "block").orderBy("range")
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    return counts.join(blocks, [*within, "block"]).select(
        *within, "range", (F.col("blocks_before") + F.col("inside")).alias("before"), "of"
    )


def places(documents: DataFrame, ranges: int, seed: str) -> DataFrame:
    """Every row with its place between 0 and 1, among the rows of its source."""
    text = documents["text"]
    crc = F.crc32(F.coalesce(text, F.lit("")).cast("binary"))
    own = F.coalesce(documents["doc_id"].cast("string"), F.lit(""))
    digest = F.md5(F.concat_ws(":", F.lit(seed), own, crc.cast("string")))
    rows = documents.select(
        documents["doc_id"],
        (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("bigint").alias("size"),
        crc.alias("text_crc32"),
        _stratum(documents["source"]).alias("stratum"),
        digest.alias("digest"),
    )
    first = F.conv(F.substring("digest", 1, 8), 16, 10).cast("bigint")
    rows = written(rows.withColumn("range", F.shiftright(first * ranges, 32)), "shard-rows")
    counts = _rows_before(rows.groupBy("stratum", "range").agg(F.count("*").alias("n")), ["stratum"])
    inside = Window.partitionBy("stratum", "range").orderBy("digest", "size", "text_crc32")
    ranked = rows.withColumn("rank", F.row_number().over(inside))
    ranked = ranked.join(counts, ["stratum", "range"])
    rank = F.col("rank") + F.col("before")
    return ranked.select(
        "doc_id",
        "size",
        "text_crc32",
        "digest",
        ((2 * rank - 1).cast("double") / (2 * F.col("of")).cast("double")).alias("place"),
    )


def interleaved(documents: DataFrame, shards: int, seed: str = SEED) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, the ``shard`` (from 0) and the ``slot`` in it (from 0)."""
    total = max(1, documents.count())
    ranges = max(1, total // RANGE_ROWS)
    placed = written(
        places(documents, ranges, seed).withColumn("range", F.floor(F.col("place") * ranges)),
        "shard-places",
    )
    counts = _rows_before(placed.groupBy("range").agg(F.count("*").alias("n")), []).drop("of")
    inside = Window.partitionBy("range").orderBy("place", "digest", "size", "text_crc32")
    ordered = placed.withColumn("rank", F.row_number().over(inside)).join(counts, "range")
    ordered = ordered.withColumn("rank", F.col("rank") + F.col("before") - 1)
    ordered = ordered.withColumn("shard", F.expr(f"rank * {shards} div {total}"))
    first = F.expr(f"(shard * {total} + {shards - 1}) div {shards}")
    return ordered.select(
        "doc_id",
        "size",
        "text_crc32",
        F.col("shard").cast("int").alias("shard"),
        (F.col("rank") - first).alias("slot"),
    )
