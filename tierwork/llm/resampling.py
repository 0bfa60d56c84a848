"""Documents drawn towards a target distribution, by importance weights of hashed word runs.

Every run of one to ``longest`` consecutive words falls into a bucket, its CRC-32 modulo ``buckets``. A
bucket's gain is the logarithm, in thousandths, of how much more often the target has it than the
corpus, both counts raised by one. A document's weight is the floored mean of its features' gains; with a Gumbel number of
its id added, the highest scores are a draw without replacement by weight.

1. Every text is read once and becomes an array of bucket numbers, two bytes each, in a written table.
2. The corpus's counts come from these arrays, a row per bucket and task at most; the gains, an array of
   ``buckets`` numbers, go to every task, which scores whole arrays at once. The scores are written.
3. The cutoff is found by bisection over the written numbers: a job counts exactly how many rows lie up to each of
   the next few midpoints. Where scores are tied at the cutoff, the same goes on over the ids of the tied
   rows, and so on over the keys that order them.
4. The rows up to the cutoff are dealt by ranges of the same keys and sorted within; a row's rank is its place
   in its range behind the sizes of the ranges before.

At scale: no shuffle moves texts or features; the counts shuffle a row per bucket and task, the draw
shuffles the drawn rows alone, and no group is ever in one task, as ranges are cut by keys that
end in a number of the row. What the driver holds is the counts of the buckets, some counts per job,
and a number per range.

Defined cases: null and empty texts have no features and weigh 0; null ids count as an empty text in the
Gumbel number and come behind all others of their score; rows of equal score and id go by their number of
features, and then as they were read; rows are drawn each for itself, so a repeated row may be drawn twice;
documents with fewer than ``least_words`` words are scored but not drawn; an empty target gives gains all the same; an
empty table gives no rows; other columns of the documents are not looked at.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierwork.llm.words import ALPHANUMERIC, Words, by_slices, words_of
from tierwork.sources.work import written

BUCKETS = 10_000
#: Levels of the bisection that one job goes down.
LEVELS = 4
#: Words of more bytes go through the library's CRC one by one.
LONG_WORD = 48

_LAST = (1 << 63) - 1


def _crc_table() -> np.ndarray:
    values = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        values = np.where(values & 1, (values >> 1) ^ np.uint32(0xEDB88320), values >> 1).astype(np.uint32)
    return values


_CRC = _crc_table()


def _fed(state: np.ndarray, words: Words, at: np.ndarray) -> np.ndarray:
    """The running CRCs ``state`` after the bytes of words ``at``."""
    state, starts = state.copy(), words.starts[at]
    lengths = words.ends[at] - starts
    for i in np.flatnonzero(lengths > LONG_WORD):
        text = words.data[starts[i] : starts[i] + lengths[i]].tobytes()
        state[i] = zlib.crc32(text, int(state[i]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
    left = np.flatnonzero(lengths <= LONG_WORD)
    for place in range(LONG_WORD):
        left = left[lengths[left] > place]
        if not len(left):
            break
        old = state[left]
        state[left] = _CRC[(old ^ words.data[starts[left] + place]) & 255] ^ (old >> np.uint32(8))
    return state


def run_crcs(words: Words, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """The CRC-32 of every run of one to ``longest`` words, joined by one blank, and the text it is of,
    in the order of the texts."""
    texts, crcs, owners = words.text_of(), [], []
    state = np.full(len(texts), 0xFFFFFFFF, np.uint32)
    begin = np.arange(len(texts))
    for length in range(longest):
        if length:
            inside = begin + length < len(texts)
            begin, state = begin[inside], state[inside]
            same = texts[begin] == texts[begin + length]
            begin, state = begin[same], state[same]
            state = _CRC[(state ^ np.uint32(0x20)) & 255] ^ (state >> np.uint32(8))
        state = _fed(state, words, begin + length)
        crcs.append(state ^ np.uint32(0xFFFFFFFF))
        owners.append(texts[begin])
    crc, owner = np.concatenate(crcs), np.concatenate(owners)
    if longest == 1:
        return crc, owner
    order = np.argsort(owner, kind="stable")
    return crc[order], owner[order]


def features(documents: DataFrame, longest: int, buckets: int) -> DataFrame:
    """Per row its number ``row``, ``doc_id``, ``n_words``, ``n_features`` and ``buckets``, the bucket of
    every feature as packed numbers."""
    size = np.dtype("<u2" if buckets <= 1 << 16 else "<u4")

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = words_of(batch.column("text"), ALPHANUMERIC)
        crc, owner = run_crcs(words, longest)
        counts = np.bincount(owner, minlength=len(batch))
        packed = (crc % np.uint32(buckets)).astype(size)
        ends = np.append(0, np.cumsum(counts * size.itemsize)).astype(np.int32)
        binary = pa.Array.from_buffers(
            pa.binary(), len(batch), [None, pa.py_buffer(ends), pa.py_buffer(packed.tobytes())]
        )
        return pa.RecordBatch.from_arrays(
            [batch.column("row"), batch.column("doc_id"), pa.array(words.counts), pa.array(counts), binary],
            ["row", "doc_id", "n_words", "n_features", "buckets"],
        )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return by_slices(batches, "text", one)

    rows = documents.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), "text"
    )
    return rows.mapInArrow(
        work, "row bigint, doc_id bigint, n_words bigint, n_features bigint, buckets binary"
    )


def _unpacked(column: pa.Array, size: np.dtype) -> np.ndarray:
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    return data[ends[0] : ends[-1]].view(size)


def bucket_counts(rows: DataFrame, buckets: int) -> np.ndarray:
    """How many features every bucket has: an array of ``buckets`` numbers."""
    size = np.dtype("<u2" if buckets <= 1 << 16 else "<u4")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            if len(batch):
                counts += np.bincount(_unpacked(batch.column("buckets"), size), minlength=buckets)
        found = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(counts[found])], ["bucket", "n"])

    counted = rows.select("buckets").mapInArrow(work, "bucket bigint, n bigint")
    found = counted.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(buckets, np.int64)
    counts[found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    return counts


def gains(own: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket the logarithm of its share of the target over its share of the corpus, in thousandths."""
    width, in_all, in_target = len(own), int(own.sum()), int(target.sum())
    return np.array(
        [
            math.floor(1000 * math.log(float((t + 1) * (in_all + width)) / float((s + 1) * (in_target + width))))
            for s, t in zip(own.tolist(), target.tolist())
        ],
        np.int64,
    )


def weighted(rows: DataFrame, gain: np.ndarray) -> DataFrame:
    """The rows of ``features`` with ``weight`` instead of their buckets."""
    size = np.dtype("<u2" if len(gain) <= 1 << 16 else "<u4")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            counts = batch.column("n_features").to_numpy()
            sums = np.append(0, np.cumsum(gain[_unpacked(batch.column("buckets"), size)]))
            ends = np.append(0, np.cumsum(counts))
            weight = (sums[ends[1:]] - sums[ends[:-1]]) // np.maximum(counts, 1)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("row", "doc_id", "n_words", "n_features")), pa.array(weight)],
                ["row", "doc_id", "n_words", "n_features", "weight"],
            )

    return rows.mapInArrow(work, "row bigint, doc_id bigint, n_words bigint, n_features bigint, weight bigint")


def gumbel(doc_id: Column, seed: int) -> Column:
    """A Gumbel number of the id, in thousandths, rounded down."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    drawn = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("bigint")
    return F.floor(-1000 * F.log(-F.log((drawn + F.lit(0.5)) / F.lit(4294967296.0)))).cast("bigint")


def cutoff(rows: DataFrame, keys: list[str], wanted: int) -> list[int]:
    """The least bounds such that ``wanted`` rows at least have keys up to them, compared in order. As many keys are
    bounded as are needed for exactly ``wanted``, if the keys tell all rows apart. The rows must be
    at least as many."""
    bounds: list[int] = []
    for key in keys:
        tied = rows.filter(reduce(Column.__and__, (F.col(k) == b for k, b in zip(keys, bounds)), F.lit(True)))
        low, high = tied.agg(F.min(key), F.max(key)).first()
        # Rows up to ``high`` suffice, those below ``low`` do not.
        while low < high:
            cuts = _midpoints(low, high, LEVELS)
            counts = tied.agg(*(F.count_if(F.col(key) <= cut).alias(str(i)) for i, cut in enumerate(cuts))).first()
            for cut, count in zip(cuts, counts):
                if count >= wanted:
                    high = cut
                    break
                low = cut + 1
        below, equal = tied.agg(F.count_if(F.col(key) < low), F.count_if(F.col(key) == low)).first()
        bounds.append(low)
        wanted -= below
        if equal == wanted:
            break
    return bounds


def _midpoints(low: int, high: int, levels: int) -> list[int]:
    """The values at which bisecting ``low`` to ``high`` may ask next, ``levels`` deep, in order."""
    if not levels or low >= high:
        return []
    middle = (low + high) // 2
    return [*_midpoints(low, middle, levels - 1), middle, *_midpoints(middle + 1, high, levels - 1)]


def _upto(keys: list[str], bounds: list[int]) -> Column:
    """Whether the keys, compared in order, are not above the bounds."""
    found = F.lit(True)
    for key, bound in reversed(list(zip(keys, bounds))):
        found = (F.col(key) < bound) | ((F.col(key) == bound) & found)
    return found


def drawn(scored: DataFrame, least_words: int, percent: int) -> DataFrame:
    """All rows with ``rank``: 1 for the highest score among those of at least ``least_words`` words, up to ``percent``
    of their number, rounded down; null for the rest. ``scored`` must be a written table."""
    keys = ["worse", "id", "n_features", "row"]
    keyed = scored.withColumns(
        {"worse": -F.col("score"), "id": F.coalesce("doc_id", F.lit(_LAST)), "able": F.col("n_words") >= least_words}
    )
    able = keyed.filter("able").select(keys)
    wanted = able.count() * percent // 100
    out = ["doc_id", "n_features", "weight", "score"]
    if not wanted:
        return scored.select(*out, F.lit(None).cast("bigint").alias("rank"))
    taken = F.col("able") & _upto(keys, cutoff(able, keys, wanted))
    best = keyed.filter(taken).repartitionByRange(*keys).sortWithinPartitions(*keys)
    # The number holds the range and the place in it.
    best = written(best.select(*out, F.monotonically_increasing_id().alias("place")), "drawn")
    in_range, bits = F.shiftright("place", 33), (1 << 33) - 1
    sizes = dict(best.groupBy(in_range.alias("range")).count().collect())
    before, ahead = [], 0
    for number in sorted(sizes):
        before.append((number, ahead))
        ahead += sizes[number]
    offsets = best.sparkSession.createDataFrame(before, "range bigint, ahead bigint")
    rank = F.col("ahead") + F.col("place").bitwiseAND(bits) + 1
    ranked = best.withColumn("range", in_range).join(F.broadcast(offsets), "range").select(*out, rank.alias("rank"))
    return ranked.union(keyed.filter(~taken).select(*out, F.lit(None).cast("bigint")))


def resampled(
    documents: DataFrame,
    target: DataFrame,
    least_words: int,
    percent: int,
    seed: int,
    longest: int = 1,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Per document ``doc_id``, ``n_features``, ``weight``, ``score`` and ``rank`` among the drawn ones, null for
    the others. ``target`` has a column ``text``."""
    rows = written(features(documents, longest, buckets), "features")
    wanted = features(target.select(F.lit(None).alias("doc_id"), "text"), longest, buckets)
    gain = gains(bucket_counts(rows, buckets), bucket_counts(wanted, buckets))
    scored = weighted(rows, gain).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))
    return drawn(written(scored, "scores"), least_words, percent)
