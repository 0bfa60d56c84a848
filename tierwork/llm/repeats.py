"""Substring deduplication by hashing lines.

A unit is a line, normalised to its lower-cased words of letters and digits. A passage can also be
pasted into the middle of a line, which hashes of whole lines never notice; lines are therefore cut
into smaller units behind words whose hash is the smallest among their ``REACH`` neighbours on either
side. Where a line is cut depends on the words around the cut alone, so a passage is cut alike
wherever it stands, but for its two ends.

Short units repeat by chance, the more so the larger the corpus. What is compared inside of lines are
therefore windows: from every unit on as many units as have ``LEAST_WORDS`` words together, and from the
end of every line back as many. With ``lines``, as the query has it, whole lines are compared too,
whatever their length. Digests of these spans are
grouped over all documents. The span of the smallest doc_id stays, in that document the first;
the units of all others are removed, and their original character offsets are kept, with the
document that has the first occurrence. What is removed from a document stands in one of a smaller id, or
earlier in itself, so the first occurrence of everything stays.

At scale: digests are 128 bits; the global step moves ids and digests, first folded on the map side, so a
line that a third of all documents hold costs its reducer a row per map task. The join that marks
spans is on digests and split by Spark where it is skewed. Texts move once, by document. Spans are
computed again where they are needed rather than stored.

Defined cases: a null text stays null and an empty one empty; lines without words are not compared; rows that share a doc_id count as one document, none of them loses what another of them has,
only what it repeats itself; a null doc_id ranks behind all others, and spans that only such rows
have stay; an empty table gives no rows; all columns of the documents are kept, in a struct, so
no name clashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierwork.llm.words import ALPHANUMERIC, Words, by_slices, lists, mix, signed, words_of

REACH = 4
LEAST_WORDS = 12

_FACTORS = (np.uint64(0x9FB21C651E98DF25), np.uint64(0xC2B2AE3D27D4EB4F))


def begins_line(words: Words) -> np.ndarray:
    """For every word whether it is the first of its line."""
    count = len(words.hashes)
    line = np.cumsum(words.data == ord("\n"))[words.starts]
    texts = words.text_of()
    fresh = np.ones(count, bool)
    fresh[1:] = (line[1:] != line[:-1]) | (texts[1:] != texts[:-1])
    return fresh


def unit_starts(words: Words) -> np.ndarray:
    """The first word of every unit."""
    count = len(words.hashes)
    if not count:
        return np.zeros(0, np.int64)
    fresh = begins_line(words)
    line = np.cumsum(fresh)
    least = np.ones(count, bool)
    for step in range(1, min(REACH, count - 1) + 1):
        other = line[step:] != line[:-step]
        left, right = words.hashes[:-step], words.hashes[step:]
        least[:-step] &= other | (left <= right)
        least[step:] &= other | (right < left)
    fresh[1:] |= least[:-1]
    return np.flatnonzero(fresh)


def span_digests(words: Words, starts: np.ndarray, stops: np.ndarray) -> list[np.ndarray]:
    """Two numbers per span of words, from ``starts`` up to ``stops``, that depend on all its words and
    their order and on nothing else: sums of words times powers, up to either end."""
    found = []
    for number, factor in enumerate(_FACTORS):
        inverse = np.uint64(pow(int(factor), -1, 1 << 64))
        count = len(words.hashes) + 1
        powers, undone = (np.cumprod(np.full(count, x)) for x in (factor, inverse))
        sums = np.append(np.uint64(0), np.cumsum(mix(words.hashes + np.uint64(number)) * powers[:-1]))
        values = (sums[stops] - sums[starts]) * undone[starts]
        found.append(mix(values + (stops - starts).astype(np.uint64)))
    return found


@dataclass
class Spans:
    """Units of some texts (``starts``, their first words, and ``before``, the units before each
    text), and the spans of units that are compared, by their beginning: from unit ``first`` up to
    ``stop``; the spans before each text (``spans_before``); two digests; and whether a span
    repeats an earlier one of its text (``again``)."""

    words: Words
    starts: np.ndarray
    before: np.ndarray
    first: np.ndarray
    stop: np.ndarray
    spans_before: np.ndarray
    digests: list[np.ndarray]
    again: np.ndarray

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.before) - 1), np.diff(self.before))


def spans_of(column: pa.Array, lines: bool) -> Spans:
    """The windows of every text; with ``lines`` also its whole lines, of any length, and the last window
    of every line, each span once."""
    words = words_of(column, ALPHANUMERIC)
    starts = unit_starts(words)
    before = np.searchsorted(starts, words.first)
    texts = np.repeat(np.arange(len(column)), np.diff(before))
    upto = np.append(starts, len(words.hashes))
    stops = np.searchsorted(upto, starts + LEAST_WORDS)
    first = np.flatnonzero(stops <= before[1:][texts])
    stop = stops[first]
    if lines:
        line = np.flatnonzero(begins_line(words)[starts])
        line_stop = np.append(line[1:], len(starts))[: len(line)]
        last = np.searchsorted(upto, upto[line_stop] - LEAST_WORDS, "right") - 1
        inside = last >= line
        width = len(starts) + 1
        firsts = np.concatenate([first, line, last[inside]])
        found = np.concatenate([stop, line_stop, line_stop[inside]])
        first, stop = np.divmod(np.unique(firsts * width + found), width)
    pair = span_digests(words, upto[first], upto[stop])
    owner = texts[first]
    again = np.zeros(len(first), bool)
    order = np.lexsort((pair[1], pair[0], owner))
    same = np.ones(max(0, len(order) - 1), bool)
    for key in (owner, *pair):
        same &= key[order][1:] == key[order][:-1]
    again[order[1:][same]] = True
    return Spans(words, starts, before, first, stop, np.searchsorted(first, before), pair, again)


def _digest_rows(batch: pa.RecordBatch, lines: bool) -> pa.RecordBatch:
    found = spans_of(batch.column("text"), lines)
    texts = found.text_of()[found.first]
    number = (np.arange(len(texts)) - found.spans_before[:-1][texts]).astype(np.int32)
    fresh = ~found.again
    counts = np.bincount(texts[fresh], minlength=len(batch))
    return pa.RecordBatch.from_arrays(
        [
            batch.column("doc_id"),
            batch.column("copy"),
            lists(pa.array(number[fresh]), counts),
            lists(pa.array(signed(found.digests[0][fresh])), counts),
            lists(pa.array(signed(found.digests[1][fresh])), counts),
        ],
        ["doc_id", "copy", "span", "digest", "digest2"],
    )


def digests(documents: DataFrame, lines: bool) -> DataFrame:
    """A row per document and different span: the number of the first such span and its digest."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return by_slices(batches, "text", lambda batch: _digest_rows(batch, lines))

    kind = documents.schema["doc_id"].dataType.simpleString()
    rows = documents.select("doc_id", F.xxhash64("text").alias("copy"), "text").mapInArrow(
        work,
        f"doc_id {kind}, copy bigint, span array<int>, digest array<bigint>, digest2 array<bigint>",
    )
    return rows.select(
        "doc_id", "copy", F.explode(F.arrays_zip("span", "digest", "digest2")).alias("x")
    ).select("doc_id", "copy", "x.*")


def marked(documents: DataFrame, lines: bool) -> DataFrame:
    """Per ``doc_id`` and ``copy`` (a digest of the text) the spans that a smaller doc_id has, by
    number, with that doc_id."""
    spans = digests(documents, lines)
    first = (
        spans.groupBy("digest", "digest2")
        .agg(F.min("doc_id").alias("first_doc"), F.count("*").alias("n"))
        .filter("n > 1")
        .drop("n")
    )
    later = spans.join(first, ["digest", "digest2"]).filter(~F.col("doc_id").eqNullSafe(F.col("first_doc")))
    return later.groupBy("doc_id", "copy").agg(
        F.collect_set(F.struct("span", "first_doc")).alias("gone")
    )


def _cut(batch: pa.RecordBatch, kind: pa.DataType, lines: bool) -> pa.RecordBatch:
    found = spans_of(batch.column("text"), lines)
    words, starts, before, texts = found.words, found.starts, found.before, found.text_of()
    rows, count = len(batch), len(starts)
    gone = batch.column("gone")
    lengths = np.diff(gone.offsets.to_numpy(zero_copy_only=False)) if rows else np.zeros(0, np.int64)
    lengths = np.where(gone.is_null().to_numpy(zero_copy_only=False), 0, lengths)
    entries = gone.flatten()
    number = entries.field("span").to_numpy(zero_copy_only=False).astype(np.int64)
    at = found.spans_before[np.repeat(np.arange(rows), lengths)] + number
    source = np.full(len(found.first), -1)
    source[at] = np.arange(len(at))
    marked_spans = np.flatnonzero((source >= 0) | found.again)
    cover = np.zeros(count + 1, np.int64)
    np.add.at(cover, found.first[marked_spans], 1)
    np.add.at(cover, found.stop[marked_spans], -1)
    mark = np.cumsum(cover[:-1]) > 0
    # A run of removed units begins where a removed span does; the longest of these is named.
    origin = np.full(count, -1)
    origin[found.first[marked_spans]] = marked_spans
    edge = np.ones(count, bool)
    edge[1:] = (mark[1:] != mark[:-1]) | (texts[1:] != texts[:-1])
    edges = np.append(np.flatnonzero(edge), count)
    runs = np.flatnonzero(mark[edges[:-1]])
    first, behind = edges[:-1][runs], edges[1:][runs]
    owner = texts[first]
    begin = words.starts[starts[first]]
    ends_text = behind == before[1:][owner]
    next_unit = words.starts[starts[np.minimum(behind, max(0, count - 1))]] if count else behind
    end = np.where(ends_text, words.origin[1:][owner] - 1, next_unit)
    chars = np.append(0, np.cumsum((words.data & 0xC0) != 0x80))
    first_char = chars[words.origin[:-1]][owner]
    span_from, span_to = chars[begin] - first_char, chars[end] - first_char
    by = source[origin[first]]
    first_doc = entries.field("first_doc").take(pa.array(by, mask=by < 0))
    cuts = np.searchsorted(owner, np.arange(rows + 1))
    n_removed = np.bincount(texts[mark], minlength=rows)
    out = batch.column("text").to_pylist()
    for row in np.flatnonzero(np.diff(cuts)):
        text, kept, at_char = out[row], [], 0
        for span in range(cuts[row], cuts[row + 1]):
            kept.append(text[at_char : span_from[span]])
            at_char = span_to[span]
        out[row] = "".join([*kept, text[at_char:]])
    spans = pa.StructArray.from_arrays(
        [pa.array(span_from.astype(np.int32)), pa.array(span_to.astype(np.int32)), first_doc.cast(kind)],
        ["start", "end", "first_doc"],
    )
    return pa.RecordBatch.from_arrays(
        [
            batch.column("others"),
            pa.array(out, pa.string()),
            pa.array(np.diff(before).astype(np.int64)),
            pa.array(n_removed.astype(np.int64)),
            lists(spans, np.diff(cuts)),
        ],
        ["others", "text", "n_units", "n_removed", "removed"],
    )


def deduplicated(documents: DataFrame, lines: bool = False) -> DataFrame:
    """Per document ``document`` (its columns, with what is left of the text, and ``n_chars``, if it
    has it, counted again), ``n_units``, ``n_removed`` of these, and ``removed``: per run of removed
    units the characters from ``start`` up to ``end`` of the original text, and ``first_doc``, where
    its beginning stays; null where that is the document itself. Without ``lines`` windows alone are
    compared, and repeated lines of fewer words stay."""
    kind = documents.schema["doc_id"].dataType
    arrow_kind = documents.select("doc_id").limit(0).toArrow().schema.field("doc_id").type

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return by_slices(batches, "text", lambda batch: _cut(batch, arrow_kind, lines))

    others = [c for c in documents.columns if c != "text"]
    rows = documents.select(
        F.struct(*others).alias("others"),
        F.col("doc_id").alias("own_id"),
        "text",
        F.xxhash64("text").alias("own_copy"),
    )
    gone = marked(documents, lines)
    same = rows["own_id"].eqNullSafe(gone["doc_id"]) & (rows["own_copy"] == gone["copy"])
    joined = rows.join(gone, same, "left").select("others", "text", "gone")
    span = T.StructType().add("start", T.IntegerType()).add("end", T.IntegerType())
    span = span.add("first_doc", kind)
    schema = T.StructType([joined.schema["others"], joined.schema["text"]])
    schema = schema.add("n_units", T.LongType()).add("n_removed", T.LongType()).add("removed", T.ArrayType(span))
    found = joined.mapInArrow(work, schema)

    def column(name: str) -> Column:
        if name == "text":
            return F.col("text")
        own = F.col("others")[name]
        if name != "n_chars":
            return own.alias(name)
        size = F.char_length("text").cast(documents.schema[name].dataType)
        return F.when(F.size("removed") > 0, size).otherwise(own).alias(name)

    document = F.struct(*map(column, documents.columns))
    return found.select(document.alias("document"), "n_units", "n_removed", "removed")


def without_repeats(documents: DataFrame) -> DataFrame:
    """The documents with all their columns and what is left of their texts. Documents that lost all
    their words are left out."""
    found = deduplicated(documents, lines=True)
    lost = (F.size("removed") > 0) & ~F.col("document.text").rlike("[\\p{L}\\p{N}]")
    return found.filter(~F.coalesce(lost, F.lit(False))).select("document.*")
