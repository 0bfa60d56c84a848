"""Words of Arrow text columns as numpy arrays.

Texts are read from the buffer that Arrow lays them out in, a few megabytes at a time: bytes are
mapped by a table, runs of word bytes are found with array comparisons, and every word becomes a
64-bit number. No Python object is made per word. Separators are single bytes below 0x80 in all
word rules used here, so UTF-8 characters are never cut.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text that are turned into arrays at once; a longer single text is taken whole.
SLICE_BYTES = 1 << 20
#: Bytes whose places and values are held at once while words are hashed, or those of one word.
HASHED_BYTES = 4 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

#: Word bytes after lower-casing: digits, small letters and all bytes of other characters.
ALPHANUMERIC = np.zeros(256, bool)
ALPHANUMERIC[ord("0") : ord("9") + 1] = True
ALPHANUMERIC[ord("a") : ord("z") + 1] = True
ALPHANUMERIC[0x80:] = True

#: Word bytes: all but the blank and the controls from tab to carriage return.
NOT_BLANK = np.ones(256, bool)
NOT_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False

_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_GRAM_FACTOR = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit numbers evenly; equal numbers stay equal, different ones different."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64))
_powers = np.ones(1, np.uint64)


def _factor_powers(n: int) -> np.ndarray:
    global _powers
    while len(_powers) < n:
        step = _powers[-1:] * _FACTOR
        _powers = np.concatenate([_powers, _powers * step])
    return _powers


@dataclass
class Words:
    """The words of some texts: ``hashes``, byte ranges ``starts`` to ``ends`` in ``data``, and
    ``first``, where word ``first[t]`` to ``first[t + 1]`` are those of text ``t``, whose bytes
    begin at ``origin[t]``."""

    data: np.ndarray
    origin: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        """The text each word is in."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def text_slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of a text column with at most ``most`` bytes each, or of one row."""
    sizes = column.fill_null("").cast(pa.large_binary())
    ends = np.frombuffer(sizes.buffers()[1], np.int64)[sizes.offset : sizes.offset + len(column) + 1]
    start = 0
    while start < len(column):
        stop = max(start + 1, int(np.searchsorted(ends, ends[start] + most, "right")) - 1)
        yield start, stop
        start = stop


def laid_out(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of the texts with one blank after each, and where each text begins; the last
    number is the end. Null is the empty text."""
    raw = column.fill_null("").cast(pa.large_binary())
    ends = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset : raw.offset + len(column) + 1]
    data = np.frombuffer(raw.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    cuts = ends[1:] - ends[0]
    return np.insert(data, cuts, 0x20), np.append(0, cuts + np.arange(1, len(cuts) + 1))


def words_of(column: pa.Array, word_bytes: np.ndarray, lower: bool = True) -> Words:
    """The words of every text: longest runs of ``word_bytes``, A to Z lower-cased first."""
    data, origin = laid_out(column)
    if lower:
        data = _LOWER[data]
    inside = word_bytes[data]
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if len(inside) and inside[0]:
        edges = np.append(0, edges)
    starts, ends = edges[::2], edges[1::2]
    del inside
    hashes = np.zeros(len(starts), np.uint64)
    done = 0
    while done < len(starts):
        upto = max(done + 1, int(np.searchsorted(ends, starts[done] + HASHED_BYTES, "right")))
        hashes[done:upto] = _word_hashes(data, starts[done:upto], ends[done:upto])
        done = upto
    return Words(data, origin, starts, ends, hashes, np.searchsorted(starts, origin))


def _word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    lengths = ends - starts
    begin = np.append(0, np.cumsum(lengths)[:-1])
    place = np.arange(lengths.sum()) - np.repeat(begin, lengths)
    powers = _factor_powers(int(lengths.max()))
    values = _BYTE_VALUES[data[np.repeat(starts, lengths) + place]] * powers[place]
    return mix(np.add.reduceat(values, begin) + lengths.astype(np.uint64))


def gram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """A number for every ``n`` consecutive words; empty where there are fewer."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(count, n, np.uint64)
    for place in range(n):
        total = total * _GRAM_FACTOR + hashes[place : place + count]
    return mix(total)


def grams_inside(words: Words, n: int) -> np.ndarray:
    """For every ``n`` consecutive words whether one text holds them all."""
    texts = words.text_of()
    return texts[: max(0, len(texts) - n + 1)] == texts[n - 1 :]


def by_slices(
    batches: Iterator[pa.RecordBatch],
    text: str,
    work: Callable[[pa.RecordBatch], pa.RecordBatch],
) -> Iterator[pa.RecordBatch]:
    """``work`` on pieces of the batches with bounded text, so that memory does not follow the
    size of a batch."""
    for batch in batches:
        for start, stop in text_slices(batch.column(text)):
            yield work(batch.slice(start, stop - start))


def signed(hashes: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's long."""
    return hashes.view(np.int64)


def lists(values: pa.Array, counts: np.ndarray) -> pa.ListArray:
    """A list column whose rows hold ``counts`` consecutive ``values``."""
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)), pa.int32()), values)
