"""Collocations: phrases whose words stand together more often than their parts explain, per language, counted by
dynamic itemset counting.

The documents are dealt to ``SHARDS`` shards of equal size, which are scanned one after the other, around and around. A
phrase of one word is counted from the first scan on, and a longer one from the scan after both its subphrases, without the
last and without the first word, have reached the threshold in what was counted so far. Every phrase is counted until it has
seen each shard once, wherever it began, so its count is exact, and lengths are counted interleaved: most
longer phrases are done in little more than one cycle, as frequent parts are known after a shard or two.

What a scan has to know is, for every phrase, in which scan its counting begins. That is kept in tables of ``SLOTS`` bytes,
one per length, by a hash of the phrase: the scan behind that in which the first phrase of the slot reached the threshold. A
slot is set once and never changes, so all scans agree on when a phrase began. Phrases that share a slot
with a frequent one begin without need, and are counted as exactly as all others.

Counts are folded per slice of text, per task and then by a shuffle, together with the counts so far of phrases that are
not done. Phrases that are done with fewer than the threshold go; each scan ends in a written table, and the one before is
removed.

A phrase cut behind its first ``k`` words scores ``1000000 a a / (l r)`` for counts ``a`` of the phrase, ``l`` and ``r`` of
the parts, rounded down, in decimals of 38 digits; its lowest cut counts. A phrase that lies inside a longer frequent one
goes, if that has at least ``cover`` percent of its count.

At scale: the texts are copied once, by shard, and read from there some two or three times. Shuffles carry
phrases that were active, with counts. Broadcast are the slot tables, whatever the corpus; the driver sees
slots, at most ``SLOTS`` per length. The best of a language are chosen in parts and then among the parts' best.

Defined cases: null texts are empty and have no phrases; a null language is ``und``, together with rows whose
language is that; repeated rows and ids count each time; a language without a candidate has no row; an
empty table gives no rows; other columns of the documents are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierwork.llm.words import Words, mix, text_slices, words_of
from tierwork.sources.work import remove, work_path, written

SHARDS = 2
#: Bytes of the table that says when phrases of a length begin.
SLOTS = 1 << 24
#: In that table: no phrase of the slot is frequent so far.
NEVER = 255
SLICE_BYTES = 1 << 20
#: Parts of a language whose best phrases are chosen apart.
PARTS = 64

_PIECE_END = np.zeros(256, bool)
_PIECE_END[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
_WORD = ~_PIECE_END
_WORD[[0x20, 0x09]] = False
_FACTOR = np.uint64(0xD6E8FEB86659FD93)
_COUNTS = "key string, tag int, f bigint"


def _keys(words: Words, marks: np.ndarray) -> np.ndarray:
    """A number per word, by its letters and the mark of its text's language."""
    return mix(words.hashes + marks[words.text_of()])


def _longer(keys: np.ndarray, word_keys: np.ndarray) -> np.ndarray:
    """The numbers of phrases with a word more."""
    return mix(keys * _FACTOR + word_keys)


def _slots(keys: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The places of phrases in a slot table."""
    return (keys & np.uint64(len(table) - 1)).astype(np.int64)


def _phrases(words: Words, at: np.ndarray, length: int, langs: pa.Array) -> pa.Array:
    """The words of the phrases that begin at words ``at``, joined by a blank, a tab and the language."""
    each = at[:, None] + np.arange(length)
    starts = words.starts[each].ravel()
    sizes = words.ends[each].ravel() - starts + 1
    ends = np.cumsum(sizes)
    # Every word is taken with the byte behind it, which becomes the separator.
    data = words.data[np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)]
    data[ends - 1] = 0x20
    stops = ends[length - 1 :: length]
    data[stops - 1] = 0x09
    offsets = pa.py_buffer(np.append(0, stops).astype(np.int32))
    texts = pa.Array.from_buffers(pa.string(), len(at), [None, offsets, pa.py_buffer(data)])
    return pc.binary_join_element_wise(texts, langs.take(pa.array(words.text_of()[at])), "")


def slice_counts(batch: pa.RecordBatch, begins: list[np.ndarray], scan: int, shards: int) -> Iterator[pa.RecordBatch]:
    """The phrases of some texts that are active in a scan, with their counts: ``key`` (words, tab, language), ``tag``
    (256 times the length plus the scan it began in) and ``f``. ``begins`` has a slot table per length but the longest."""
    words = words_of(batch.column("text"), _WORD)
    if not len(words.starts):
        return
    marks = batch.column("mark").to_numpy(zero_copy_only=False).view(np.uint64)
    word_keys = _keys(words, marks)
    pieces, texts = np.cumsum(_PIECE_END[words.data])[words.starts], words.text_of()
    joined = (pieces[1:] == pieces[:-1]) & (texts[1:] == texts[:-1])
    at, keys, begun = np.arange(len(word_keys)), word_keys, np.zeros(len(word_keys), np.int64)
    for length in range(1, len(begins) + 2):
        if length > 1:
            # Per phrase of a word less when its frequent followers may begin, by its place.
            ready = np.full(len(word_keys) + 1, NEVER, np.int64)
            table = begins[length - 2]
            ready[at] = np.maximum(begun, table[_slots(keys, table)])
            behind = at + length - 1
            longer = np.flatnonzero(behind < len(word_keys))
            longer = longer[joined[behind[longer] - 1]]
            begun = np.maximum(ready[at[longer]], ready[at[longer] + 1])
            longer, begun = longer[begun < NEVER], begun[begun < NEVER]
            at, keys = at[longer], _longer(keys[longer], word_keys[behind[longer]])
        active = np.flatnonzero((begun <= scan) & (scan < begun + shards))
        if len(active):
            _, first, counts = np.unique(keys[active], return_index=True, return_counts=True)
            first = active[first]
            yield pa.RecordBatch.from_arrays(
                [
                    _phrases(words, at[first], length, batch.column("lang")),
                    pa.array((length * 256 + begun[first]).astype(np.int32)),
                    pa.array(counts.astype(np.int64)),
                ],
                ["key", "tag", "f"],
            )


def _scanned(texts: DataFrame, begins, scan: int, shards: int) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in text_slices(batch.column("text"), SLICE_BYTES):
                yield from slice_counts(batch.slice(start, stop - start), begins.value, scan, shards)

    return texts.mapInArrow(work, _COUNTS)


def _new_slots(counts: DataFrame, begins, length: int) -> np.ndarray:
    """The slots of the phrases of a length in ``counts`` that are not set so far."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            words = words_of(batch.column("phrase"), _WORD)
            word_keys = _keys(words, batch.column("mark").to_numpy(zero_copy_only=False).view(np.uint64))
            keys = word_keys.reshape(-1, length)[:, 0]
            for place in range(1, length):
                keys = _longer(keys, word_keys.reshape(-1, length)[:, place])
            table = begins.value[length - 1]
            slots = np.unique(_slots(keys, table))
            slots = slots[table[slots] == NEVER]
            yield pa.RecordBatch.from_arrays([pa.array(slots.astype(np.int32))], ["slot"])

    rows = counts.select(_phrase().alias("phrase"), F.xxhash64(_lang()).alias("mark"))
    return rows.mapInArrow(work, "slot int").distinct().toArrow().column("slot").to_numpy()


def _phrase():
    return F.substring_index("key", "\t", 1)


def _lang():
    return F.expr("substr(key, instr(key, '\t') + 1)")


def by_shards(documents: DataFrame, shards: int) -> list[DataFrame]:
    """``text``, ``lang`` and a ``mark`` of the language for all texts, in written tables of equal numbers of rows."""
    spark = documents.sparkSession
    rows = documents.select("text", F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))
    rows = rows.filter(F.length("text") > 0).withColumn("mark", F.xxhash64("lang"))
    path = work_path(spark, "phrase-shards")
    shard = F.pmod(F.monotonically_increasing_id(), F.lit(shards))
    rows.withColumn("shard", shard).write.partitionBy("shard").parquet(path)
    # A shard without rows has no folder.
    stored = spark.read.schema(f"{_ddl(rows)}, shard int").parquet(path)
    return [stored.filter(F.col("shard") == number).drop("shard") for number in range(shards)]


def _ddl(rows: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)


@contextmanager
def _plain_aggregates(spark: SparkSession) -> Iterator[None]:
    """Without the small first map that Spark puts before the one of an aggregate: nearly all phrases are new to a task,
    so it holds hardly any that come again and costs a quarter of the time."""
    setting = "spark.sql.codegen.aggregate.map.twolevel.enabled"
    before = spark.conf.get(setting, "true")
    spark.conf.set(setting, "false")
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def phrase_counts(
    documents: DataFrame, longest: int, least: int, shards: int = SHARDS
) -> tuple[DataFrame, DataFrame]:
    """``lang``, ``phrase``, ``length`` and ``f`` of all phrases of up to ``longest`` words that occur ``least`` times or
    more, and ``lang`` and ``n``, the number of words of each language."""
    if longest + 1 > 100 or shards * (longest + 1) >= NEVER:
        raise ValueError("too many lengths or shards")
    spark = documents.sparkSession
    texts = by_shards(documents, shards)
    begins = [np.full(SLOTS, NEVER, np.uint8) for _ in range(longest - 1)]
    length, end = F.shiftright("tag", 8), F.col("tag").bitwiseAND(255) + shards - 1
    done, totals, before, held, scan, last = [], None, None, None, 0, shards - 1
    while scan <= last:
        sent = spark.sparkContext.broadcast(begins)
        rows = _scanned(texts[scan % shards], sent, scan, shards)
        rows = rows if before is None else rows.union(before)
        path = work_path(spark, f"phrases-{scan}")
        with _plain_aggregates(spark):
            counts = written(rows.groupBy("key", "tag").agg(F.sum("f").alias("f")), "phrases", path)
        if held:
            remove(spark, held)
        frequent = counts.filter(F.col("f") >= least)
        done.append(written(frequent.filter(end == scan), f"frequent-{scan}"))
        if scan == shards - 1:
            words = counts.filter(length == 1).groupBy(_lang().alias("lang")).agg(F.sum("f").alias("n"))
            totals = written(words, "words")
        for place in range(longest - 1):
            slots = _new_slots(frequent.filter(length == place + 1), sent, place + 1)
            if len(slots):
                begins[place][slots] = scan + 1
                last = max(last, scan + shards)
        before, held = counts.filter(end > scan), path
        sent.destroy()
        scan += 1
    remove(spark, held)
    found = done[0]
    for rows in done[1:]:
        found = found.union(rows)
    return found.select(_lang().alias("lang"), _phrase().alias("phrase"), length.alias("length"), "f"), totals


def scored(frequent: DataFrame) -> DataFrame:
    """``lang``, ``phrase``, ``length``, ``a``, ``l``, ``r`` and ``score`` of the phrases of two words or more."""
    phrases = frequent.filter("length > 1").withColumnRenamed("f", "a")
    cuts = phrases.withColumn("k", F.expr("explode(sequence(1, length - 1))"))
    cuts = cuts.withColumns(
        {
            "left": F.expr("substring_index(phrase, ' ', k)"),
            "right": F.expr("substring_index(phrase, ' ', k - length)"),
        }
    )
    parts = frequent.select("lang", F.col("phrase").alias("part"), "f")
    left = parts.select("lang", F.col("part").alias("left"), F.col("f").alias("l"))
    right = parts.select("lang", F.col("part").alias("right"), F.col("f").alias("r"))
    cuts = cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"])
    a, l, r = (F.col(x).cast("decimal(19,0)") for x in "alr")
    cuts = cuts.withColumns({"over": a * a * F.lit(1_000_000).cast("decimal(7,0)"), "under": l * r})
    cuts = cuts.withColumn("score", F.expr("over div under"))
    lowest = F.min(F.struct("score", "k", "l", "r")).alias("x")
    found = cuts.groupBy("lang", "phrase", "length", "a").agg(lowest)
    return found.select("lang", "phrase", "length", "a", "x.l", "x.r", "x.score")


def uncovered(phrases: DataFrame, cover: int) -> DataFrame:
    """The scored phrases but for those inside a longer one with ``cover`` percent of their count or more."""
    inside = F.expr(
        "explode(array_distinct(flatten(transform(sequence(2, length - 1), m -> transform("
        "sequence(1, length - m + 1), i -> array_join(slice(split(phrase, ' '), i, m), ' '))))))"
    )
    longer = phrases.filter("length > 2").select("lang", F.col("a").alias("longer"), inside.alias("phrase"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    found = phrases.join(longer, ["lang", "phrase"], "left")
    covered = F.col("longer").cast("decimal(19,0)") * 100 >= F.col("a").cast("decimal(19,0)") * cover
    return found.filter(~F.coalesce(covered, F.lit(False))).drop("longer")


def collocations(
    documents: DataFrame,
    longest: int = 3,
    least: int = 10,
    cover: int = 50,
    best: int = 2000,
    shards: int = SHARDS,
) -> DataFrame:
    """The ``best`` phrases of two to ``longest`` words of each language, by score, then count, then the phrase: ``lang``,
    ``rank`` (from 1), ``phrase``, ``a``, ``l``, ``r``, ``n`` and ``score``."""
    frequent, totals = phrase_counts(documents, longest, least, shards)
    found = uncovered(written(scored(frequent), "scored-phrases"), cover)
    order = [F.desc("score"), F.desc("a"), "phrase"]
    part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS))
    found = found.withColumn("part", part)
    for keys in (["lang", "part"], ["lang"]):
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        found = found.withColumn("rank", rank).filter(F.col("rank") <= best)
    found = found.join(totals, "lang")
    return found.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
