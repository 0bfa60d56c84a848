"""Benchmark decontamination by winnowing.

Documents and items become words; every ``GRAM`` consecutive words get a hash, and of every ``REACH``
consecutive hashes the smallest is kept as a fingerprint (all of them, if several are equal). Two
texts that share ``GRAM + REACH - 1 = 10`` words in a row keep the same fingerprint inside them, so
joining the kept fingerprints finds every shared window. A fingerprint carries the words around it;
a joined pair is extended to both sides, and ten or more equal words are a hit. Items of fewer than
ten words are one window each and are looked up whole, at every place of every document.

At scale: one pass over the documents, without a shuffle of texts. A bit table of fixed size with
the fingerprints of the benchmark drops nearly all fingerprints of the documents before the join;
what it lets through by chance the join drops. The benchmark side is repeated ``SALTS`` times and the
documents are dealt over the copies, so a passage that a third of all documents quote is not one
task's work.

Defined cases: a null or empty text has no words, no hits and no items; items without words occur
nowhere; an item of a null id occurs but is not listed; rows that repeat a doc_id give one row each;
columns other than ``doc_id``, ``item_id`` and ``text`` are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierwork.llm.rows import text_digest, without_rows
from tierwork.llm.words import (
    ALPHANUMERIC,
    Words,
    by_slices,
    gram_hashes,
    grams_inside,
    lists,
    mix,
    signed,
    words_of,
)
from tierwork.sources.work import written

WINDOW = 10
GRAM = 5
REACH = WINDOW - GRAM + 1
#: Words on each side of a fingerprint that a window around it can hold.
SIDE = WINDOW - GRAM
SPAN = GRAM + 2 * SIDE
#: Bits of the table that drops fingerprints which no item has; fixed, so it can be sent anywhere.
TABLE_BITS = 23
SALTS = 16

_FINGERPRINTS = "at array<int>, print array<bigint>, around array<binary>"


def kept_grams(hashes: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Places of the fingerprints: grams that are smallest in some run of ``REACH`` grams that one
    text holds (``whole``, for each place a window can begin at)."""
    runs = len(whole)
    if runs <= 0:
        return np.zeros(0, np.int64)
    least = hashes[:runs].copy()
    for step in range(1, REACH):
        np.minimum(least, hashes[step : step + runs], out=least)
    kept = np.zeros(len(hashes), bool)
    for step in range(REACH):
        kept[step : step + runs] |= whole & (hashes[step : step + runs] == least)
    return np.flatnonzero(kept)


def _surroundings(words: Words, places: np.ndarray) -> list[bytes]:
    """The word hashes from ``SIDE`` before a gram to ``SIDE`` after it; 0 beyond the text."""
    texts = words.text_of()
    at = places[:, None] + np.arange(-SIDE, GRAM + SIDE)
    inside = (at >= 0) & (at < len(texts))
    at = np.clip(at, 0, max(0, len(texts) - 1))
    inside &= texts[at] == texts[places][:, None]
    around = np.where(inside, words.hashes[at] | np.uint64(1), np.uint64(0))
    return [row.tobytes() for row in around]


def _whole_prints(words: Words, length: int) -> np.ndarray:
    """The number of ``length`` words as a whole window, unlike any number of a fingerprint."""
    return mix(gram_hashes(words.hashes, length) + np.uint64(length))


def _slot(prints: np.ndarray) -> np.ndarray:
    return (prints >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


def _per_text(words: Words, places: np.ndarray) -> np.ndarray:
    return np.bincount(words.text_of()[places], minlength=len(words.counts))


def _item_prints(batch: pa.RecordBatch) -> pa.RecordBatch:
    words = words_of(batch.column("text"), ALPHANUMERIC)
    prints, lengths, around, owners = [], [], [], []
    places = kept_grams(gram_hashes(words.hashes, GRAM), grams_inside(words, WINDOW))
    prints.append(gram_hashes(words.hashes, GRAM)[places] if len(places) else np.zeros(0, np.uint64))
    lengths.append(np.zeros(len(places), np.int32))
    around += _surroundings(words, places) if len(places) else []
    owners.append(words.text_of()[places])
    for length in range(1, WINDOW):
        short = np.flatnonzero(words.counts == length)
        if len(short):
            prints.append(_whole_prints(words, length)[words.first[short]])
            lengths.append(np.full(len(short), length, np.int32))
            around += [b""] * len(short)
            owners.append(short)
    owner = pa.array(np.concatenate(owners).astype(np.int64))
    return pa.RecordBatch.from_arrays(
        [
            batch.column("item_id").take(owner),
            pa.array(signed(np.concatenate(prints))),
            pa.array(np.concatenate(lengths)),
            pa.array(around, pa.binary()),
            pa.array(_slot(np.concatenate(prints))),
        ],
        ["item_id", "print", "length", "around", "slot"],
    )


def item_fingerprints(items: DataFrame) -> DataFrame:
    """Distinct fingerprints of the items, numbered, with their surroundings and the items that have them:
    ``length`` is 0 for a winnowed fingerprint, else the number of words of a short item."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return by_slices(batches, "text", _item_prints)

    kind = items.schema["item_id"].dataType.simpleString()
    schema = f"item_id {kind}, print bigint, length int, around binary, slot bigint"
    prints = items.select("item_id", "text").mapInArrow(work, schema)
    found = prints.groupBy("print", "length", "around", "slot").agg(F.collect_set("item_id").alias("items"))
    return found.withColumn("number", F.monotonically_increasing_id())


def document_fingerprints(documents: DataFrame, table: np.ndarray, shorts: list[int]) -> DataFrame:
    """Per document its number of words and the fingerprints that ``table`` lets through, and for
    every length in ``shorts`` the windows of that many words that it lets through."""
    session = documents.sparkSession
    sent = session.sparkContext.broadcast(np.packbits(table))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(sent.value).astype(bool)

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            words = words_of(batch.column("text"), ALPHANUMERIC)
            grams = gram_hashes(words.hashes, GRAM)
            places = kept_grams(grams, grams_inside(words, WINDOW))
            places = places[bits[_slot(grams[places])]]
            found, prints = [places], [grams[places]]
            lengths = [np.zeros(len(places), np.int32)]
            around = [_surroundings(words, places)] if len(places) else []
            for length in shorts:
                whole = _whole_prints(words, length)
                at = np.flatnonzero(bits[_slot(whole)] & grams_inside(words, length))
                found.append(at)
                prints.append(whole[at])
                lengths.append(np.full(len(at), length, np.int32))
                around.append([b""] * len(at))
            at = np.concatenate(found)
            order = np.argsort(at, kind="stable")
            counts = _per_text(words, at)
            begin = words.first[:-1][words.text_of()[at]] if len(at) else at
            near = pa.array([x for part in around for x in part], pa.binary())
            return pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    batch.column("doc_id"),
                    batch.column("copy"),
                    batch.column("copy2"),
                    pa.array(words.counts.astype(np.int64)),
                    lists(pa.array((at - begin)[order].astype(np.int32)), counts),
                    lists(pa.array(signed(np.concatenate(prints)[order])), counts),
                    lists(pa.array(np.concatenate(lengths)[order]), counts),
                    lists(near.take(pa.array(order)), counts),
                ],
                ["row", "doc_id", "copy", "copy2", "n_words", "at", "print", "length", "around"],
            )

        return by_slices(batches, "text", one)

    kind = documents.schema["doc_id"].dataType.simpleString()
    schema = (
        f"row bigint, doc_id {kind}, copy bigint, copy2 bigint, n_words bigint, at array<int>, "
        "print array<bigint>, length array<int>, around array<binary>"
    )
    rows = documents.select(F.monotonically_increasing_id().alias("row"), "doc_id", *text_digest(), "text")
    return rows.mapInArrow(work, schema)


def _extended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Joined fingerprints extended over equal words: the hit words of the document, if a whole
    window is equal."""
    for batch in batches:
        length = batch.column("length").to_numpy(zero_copy_only=False)
        at = batch.column("at").to_numpy(zero_copy_only=False).astype(np.int64)
        first, last = at.copy(), at + length
        winnowed = np.flatnonzero(length == 0)
        keep = length > 0
        if len(winnowed):
            sides = [
                np.frombuffer(b"".join(batch.column(c).take(pa.array(winnowed)).to_pylist()), np.uint64)
                for c in ("around", "item_around")
            ]
            ours, theirs = (side.reshape(-1, SPAN) for side in sides)
            same = (ours == theirs) & (ours != 0)
            left = np.cumprod(same[:, :SIDE][:, ::-1], axis=1).sum(axis=1)
            right = np.cumprod(same[:, SIDE + GRAM :], axis=1).sum(axis=1)
            whole = same[:, SIDE : SIDE + GRAM].all(axis=1)
            keep[winnowed] = whole & (left + right + GRAM >= WINDOW)
            first[winnowed] = at[winnowed] - left
            last[winnowed] = at[winnowed] + GRAM + right
        chosen = pa.array(np.flatnonzero(keep))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("row").take(chosen),
                pa.array(first[keep]),
                pa.array(last[keep]),
                batch.column("number").take(chosen),
            ],
            ["row", "first", "last", "number"],
        )


def hits(prints: DataFrame, items: DataFrame) -> DataFrame:
    """Document words ``first`` up to ``last`` that equal words of items, by ``row``, with the ``number`` of the
    items' fingerprint; the lists of items, which may be long, are joined later."""
    found = prints.select(
        "row",
        F.explode(F.arrays_zip("at", "print", "length", "around")).alias("x"),
    ).select("row", "x.*", F.pmod(F.xxhash64("row"), F.lit(SALTS)).alias("salt"))
    copies = items.select(
        "print",
        "length",
        "number",
        F.col("around").alias("item_around"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))).alias("salt"),
    )
    joined = found.join(copies, ["print", "length", "salt"])
    return joined.select("row", "at", "length", "around", "item_around", "number").mapInArrow(
        _extended, "row bigint, first bigint, last bigint, number bigint"
    )


def _covered(spans):
    """The number of words under sorted spans."""
    return F.aggregate(
        F.array_sort(spans),
        F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("end")),
        lambda seen, span: F.struct(
            (seen["n"] + F.greatest(F.lit(0), span["last"] - F.greatest(span["first"], seen["end"]))).alias("n"),
            F.greatest(seen["end"], span["last"]).alias("end"),
        ),
        lambda seen: seen["n"],
    )


def contaminated_rows(documents: DataFrame, items: DataFrame) -> DataFrame:
    """``contamination`` with ``copy`` and ``copy2``, the digest of the document's text."""
    wanted = written(item_fingerprints(items), "item-fingerprints")
    slots = wanted.select("slot").distinct().toPandas()["slot"].to_numpy(dtype=np.int64)
    table = np.zeros(1 << TABLE_BITS, bool)
    table[slots] = True
    shorts = [x.length for x in wanted.filter("length > 0").select("length").distinct().collect()]
    prints = written(document_fingerprints(documents, table, sorted(shorts)), "fingerprints")
    found = written(hits(prints.filter(F.size("at") > 0), wanted), "hits")
    spans = found.groupBy("row").agg(F.collect_set(F.struct("first", "last")).alias("spans"))
    named = found.select("row", "number").distinct().join(wanted.select("number", "items"), "number")
    named = named.groupBy("row").agg(F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"))
    per_row = spans.join(named, "row")
    base = prints.select("row", "doc_id", "copy", "copy2", "n_words")
    return base.join(per_row, "row", "left").select(
        "doc_id",
        "copy",
        "copy2",
        "n_words",
        F.coalesce(_covered(F.col("spans")), F.lit(0).cast("bigint")).alias("n_hit"),
        F.coalesce(F.array_sort("spans"), F.array().cast(per_row.schema["spans"].dataType)).alias("spans"),
        F.array_sort(F.transform(F.coalesce("items", F.array()), lambda x: x.cast("string"))).alias("items"),
    )


def contamination(documents: DataFrame, items: DataFrame) -> DataFrame:
    """Per document: ``doc_id``, ``n_words``, ``n_hit`` (words inside an occurrence of an item's
    window), ``spans`` (the hit words, as ranges), ``items`` (ids, sorted as text)."""
    return contaminated_rows(documents, items).drop("copy", "copy2")


def decontaminated(documents: DataFrame, items: DataFrame) -> DataFrame:
    """The documents without a hit, with all their columns. A row goes for its own text, never for
    another row of its id."""
    bad = contaminated_rows(documents, items).filter("n_hit > 0")
    return without_rows(documents, bad.select("doc_id", "copy", "copy2"))
