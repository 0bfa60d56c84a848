"""Language identification with language-bitmask n-gram filters.

One Bloom filter per language, stored bit-sliced: a slot holds one bit for each language, so the same
few slots answer for all languages at once, and the AND of an n-gram's slots is the set of the languages
that may contain it. A text's n-grams are looked up and the bits of each language counted. A filter
that is fuller answers yes more often by chance, so each count is corrected by its filter's own
rate of false answers, the share of its bits that are set to the power of the probes. The language with
the largest corrected share of n-grams wins.

N-grams are runs of ``GRAM`` bytes of the lower-cased text in which everything but letters is one blank.

The filters are filled from a bounded sample: at most ``SAMPLE_TEXTS`` labelled texts in all, the
same number for every language, taken by a digest of the id, of at most ``samples.LONGEST_BYTES`` bytes
each and about ``SAMPLE_BYTES`` in all; n-grams seen less than ``LEAST_SEEN`` times in a language are left out. Everything else covers all rows.

At scale: one count of texts per language, one pass to draw the sample, one pass that predicts; no text
is shuffled. The filter has a fixed size for up to 64 languages, and a multiple of it beyond.

Defined cases: a null text, an empty one and one without letters is ``und`` with score 0; a text none of
whose n-grams is known goes to the first language by name, with score 0; equal shares go to the
first by name; without any labelled text everything is ``und``; rows that repeat a doc_id are predicted
each; only ``doc_id``, ``text`` and ``lang`` are looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierwork.functions.names import free_name
from tierwork.llm import samples
from tierwork.llm.words import by_slices, laid_out, mix, text_slices

GRAM = 5
SLOT_BITS = 21
PROBES = 2
LEAST_SEEN = 2
#: Bounds of the sample the filters are filled from.
SAMPLE_TEXTS = 4_000
SAMPLE_BYTES = 16 << 20
UNDETERMINED = "und"
#: Standard errors that a share of few n-grams may be below what is asked for.
BENEFIT = 3.0

_BLANK = 0x20
_LETTER = np.full(256, _BLANK, np.uint8)
for _code in range(ord("a"), ord("z") + 1):
    _LETTER[_code] = _LETTER[_code - 32] = _code
_LETTER[0x80:] = np.arange(0x80, 0x100)


def text_grams(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of all texts, one after another, and for each the text it is from."""
    data, origin = laid_out(column)
    letters = _LETTER[data]
    keep = letters != _BLANK
    keep[1:] |= keep[:-1]
    texts = np.repeat(np.arange(len(column)), np.diff(origin))[keep]
    letters = letters[keep].astype(np.uint64)
    count = len(letters) - GRAM + 1
    if count <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    grams = np.zeros(count, np.uint64)
    for place in range(GRAM):
        grams = (grams << np.uint64(8)) | letters[place : place + count]
    inside = texts[:count] == texts[GRAM - 1 :]
    return grams[inside], texts[:count][inside]


def _slots(grams: np.ndarray) -> list[np.ndarray]:
    mixed = mix(grams)
    mask = np.uint64((1 << SLOT_BITS) - 1)
    return [
        ((mixed >> np.uint64(probe * 64 // PROBES)) & mask).astype(np.int64) for probe in range(PROBES)
    ]


@dataclass
class Filters:
    """``slots`` holds a row of 64-bit masks per slot, one mask for each 64 languages."""

    languages: list[str]
    slots: np.ndarray

    def false_rates(self) -> np.ndarray:
        """Per language how often its filter says yes to an n-gram it was never given."""
        if not len(self.languages):
            return np.zeros(0)
        full = [
            np.count_nonzero(self.slots[:, number // 64] & np.uint64(1 << (number % 64)))
            for number in range(len(self.languages))
        ]
        return (np.array(full) / len(self.slots)) ** PROBES

    def shares(self, column: pa.Array) -> np.ndarray:
        """Per text and language the corrected share of the text's n-grams that the language has."""
        grams, texts = text_grams(column)
        total = np.bincount(texts, minlength=len(column))
        found = [self.slots[slots] for slots in _slots(grams)]
        masks = found[0]
        for other in found[1:]:
            masks = masks & other
        counts = np.zeros((len(column), len(self.languages)))
        for number in range(len(self.languages)):
            bits = (masks[:, number // 64] >> np.uint64(number % 64)) & np.uint64(1)
            counts[:, number] = np.bincount(texts, weights=bits, minlength=len(column))
        rates = self.false_rates()
        shares = counts / np.maximum(total, 1)[:, None]
        return np.clip((shares - rates) / np.maximum(1 - rates, 1e-9), 0, 1)


def filters_of(texts: dict[str, pa.Array]) -> Filters:
    """The filters of some labelled texts per language."""
    languages = sorted(texts)
    slots = np.zeros((1 << SLOT_BITS, -(-len(languages) // 64) or 1), np.uint64)
    for number, language in enumerate(languages):
        seen, times = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for start, stop in text_slices(texts[language]):
            more, often = np.unique(text_grams(texts[language][start:stop])[0], return_counts=True)
            both, at = np.unique(np.concatenate([seen, more]), return_inverse=True)
            times = np.bincount(at, np.concatenate([times, often])).astype(np.int64)
            seen = both
        for probe in _slots(seen[times >= LEAST_SEEN]):
            slots[probe, number // 64] |= np.uint64(1 << (number % 64))
    return Filters(languages, slots)


def held_out(doc_id: Column) -> Column:
    return samples.crc_remainder(doc_id, 4) == 2


def learned(documents: DataFrame) -> Filters:
    """The filters, from a sample of the texts that are labelled and not held out."""
    text, language = documents["text"], documents["lang"]
    learnable = language.isNotNull() & (F.octet_length(text) <= samples.LONGEST_BYTES)
    rows = documents.filter(learnable & ~held_out(documents["doc_id"]))
    digest = F.md5(F.concat(F.lit("lang:"), documents["doc_id"].cast("string")))
    bucket = F.conv(F.substring(digest, 1, 8), 16, 10)
    rows = rows.select(
        language.cast("string").alias("language"),
        text.alias("sample"),
        (bucket.cast("bigint") / float(1 << 32)).alias("draw"),
        F.octet_length(text).alias("bytes"),
    )
    counts = {
        x.language: (x.n, x.bytes)
        for x in rows.groupBy("language")
        .agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"))
        .orderBy(F.desc("n"), "language")
        .limit(SAMPLE_TEXTS)
        .collect()
    }
    if not counts:
        return Filters([], np.zeros((1 << SLOT_BITS, 1), np.uint64))
    texts_each, bytes_each = SAMPLE_TEXTS / len(counts), SAMPLE_BYTES / len(counts)
    share = {k: min(1.0, texts_each / n, bytes_each / max(b, 1)) for k, (n, b) in counts.items()}
    pairs = [x for k, v in share.items() for x in (F.lit(k), F.lit(v))]
    drawn = rows.filter(F.col("draw") < F.create_map(*pairs)[F.col("language")])
    drawn = drawn.orderBy("draw").limit(2 * SAMPLE_TEXTS).select("language", "sample").toArrow()
    drawn = drawn.combine_chunks()
    labels = np.array(drawn.column("language").to_pylist(), dtype=object)
    column = drawn.column("sample").combine_chunks()
    return filters_of({k: column.take(pa.array(np.flatnonzero(labels == k))) for k in set(labels)})


def predicted(documents: DataFrame, filters: Filters) -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score`` of every document: the corrected share of its n-grams
    that the language has."""
    sent = documents.sparkSession.sparkContext.broadcast(filters)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            names, scores = [UNDETERMINED] * len(batch), np.zeros(len(batch))
            if known.languages:
                shares = known.shares(batch.column("text"))
                best = shares.argmax(axis=1)
                for row in np.flatnonzero(batch.column("letters").to_numpy(zero_copy_only=False)):
                    names[row] = known.languages[best[row]]
                    scores[row] = shares[row, best[row]]
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(names), pa.array(scores)],
                ["doc_id", "lang_pred", "score"],
            )

        return by_slices(batches, "text", one)

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text", has_letters("text").alias("letters")).mapInArrow(
        work, f"doc_id {kind}, lang_pred string, score double"
    )


def has_letters(column: str) -> Column:
    return F.coalesce(F.col(column).rlike("\\p{L}"), F.lit(False))


def highest_share(shares: np.ndarray, total: np.ndarray) -> np.ndarray:
    """The upper end of Wilson's interval of ``BENEFIT`` standard errors about shares of ``total`` n-grams: near the share
    for many, and far above for few."""
    wide = BENEFIT**2
    middle = shares * total + wide / 2
    half = BENEFIT * np.sqrt(shares * (1 - shares) * total + wide / 4)
    return (middle + half) / (total + wide)


def accepted(documents: DataFrame, filters: Filters, least: float) -> DataFrame:
    """The documents whose language is determined with a share of ``least`` or more, with all their
    columns. A share of few n-grams is judged by the ``highest_share`` that it may stand for. Texts without a letter, or none
    of whose n-grams is known, are rejected; those with letters, but too short for an n-gram, are kept."""
    sent = documents.sparkSession.sparkContext.broadcast(filters)
    columns = documents.columns
    letters = free_name("letters", columns)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = batch.drop_columns([letters])
            if not known.languages:
                return rows.slice(0, 0)
            total = np.bincount(text_grams(batch.column("text"))[1], minlength=len(batch))
            best = known.shares(batch.column("text")).max(axis=1)
            keep = (total == 0) | ((best > 0) & (highest_share(best, total) >= least))
            return rows.filter(pa.array(keep & batch.column(letters).to_numpy(zero_copy_only=False)))

        return by_slices(batches, "text", one)

    rows = documents.select(*columns, has_letters("text").alias(letters))
    return rows.mapInArrow(work, documents.schema)
