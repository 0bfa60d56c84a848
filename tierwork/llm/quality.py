"""Quality by supervised subword embeddings.

Every word, and every run of ``GRAM`` characters of the text, is hashed to a row of a table of vectors; one
more row stands for a word that repeats the word before it. The vectors of a document are averaged,
with ``EMPTY_ROWS`` vectors of zero so that a few words decide little, and a softmax over the average
gives its label. Vectors and softmax are
learned together, by numpy stochastic gradient descent over labelled documents. Case and
punctuation are kept, they tell much here.

For scoring, the average can be taken of what each row adds to the log odds instead of its
vector: the same number, one lookup per word or run.

The fit uses a bounded sample, at most ``SAMPLE_DOCUMENTS`` labelled documents of at most
``samples.LONGEST_BYTES`` bytes each and ``samples.SAMPLE_BYTES`` together; every document is scored, whole. The table has a fixed size.

At scale: one pass over the labels, one over the documents for the sample, one that scores; only the
labels drawn, of bounded number, are sent to the documents, and no text is shuffled.

Defined cases: a null or empty text, or one of blanks, has the score of the softmax's bias alone; without
any label every score is a half; rows that repeat a doc_id are scored each; only ``doc_id`` and
``text`` of the documents are looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierwork.llm import samples
from tierwork.llm.words import NOT_BLANK, by_slices, mix, words_of

SAMPLE_DOCUMENTS = 3_000
ROW_BITS = 17
DIMENSIONS = 8
GRAM = 4
REPEATED = 2 << ROW_BITS
EMPTY_ROWS = 50
EPOCHS = 6
RATE = 0.2
#: Bytes whose runs of characters are made at once.
RUN_BYTES = 2 << 20
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def features_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of all words and runs, and for each the text it is from: words have the lower
    half of the table, runs the upper one, and a repeated word the last row."""
    words = words_of(column, NOT_BLANK, lower=False)
    shift = np.uint64(64 - ROW_BITS)
    rows = [(words.hashes >> shift).astype(np.int32)]
    texts = [words.text_of().astype(np.int32)]
    again = np.zeros(len(words.hashes), bool)
    again[1:] = (words.hashes[1:] == words.hashes[:-1]) & (texts[0][1:] == texts[0][:-1])
    rows.append(np.full(np.count_nonzero(again), REPEATED, np.int32))
    texts.append(texts[0][again])
    data, origin = words.data, words.origin
    del words, again
    # Some bytes at a time, each piece with the runs that begin in it: a run has at most 4 bytes per character.
    for start in range(0, len(data), RUN_BYTES):
        codes, begins = characters(data[start : start + RUN_BYTES + 4 * GRAM])
        count = min(len(codes) - GRAM + 1, int(np.searchsorted(begins, RUN_BYTES)))
        if count > 0:
            grams = np.zeros(count, np.uint64)
            for place in range(GRAM):
                grams = grams * _FACTOR + codes[place : place + count]
            owner = (np.searchsorted(origin, begins + start, "right") - 1).astype(np.int32)
            inside = owner[:count] == owner[GRAM - 1 : GRAM - 1 + count]
            rows.append((mix(grams[inside]) >> shift).astype(np.int32) + np.int32(1 << ROW_BITS))
            texts.append(owner[:count][inside])
    return np.concatenate(rows), np.concatenate(texts)


def characters(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of every character that is whole as one number, and where it begins."""
    begins = np.flatnonzero((data & 0xC0) != 0x80)
    first = data[begins]
    size = 1 + (first >= 0xC0).astype(np.int8) + (first >= 0xE0) + (first >= 0xF0)
    whole = begins + size <= len(data)
    begins, size = begins[whole], size[whole]
    codes = data[begins].astype(np.uint64)
    for place in range(1, 4):
        longer = np.flatnonzero(size > place)
        codes[longer] = (codes[longer] << np.uint64(8)) | data[begins[longer] + place]
    return codes, begins


@dataclass
class Model:
    """``vectors`` per row, and the softmax over labels 0 and 1."""

    vectors: np.ndarray
    softmax: np.ndarray
    bias: np.ndarray

    def odds_per_row(self) -> np.ndarray:
        return (self.vectors @ (self.softmax[1] - self.softmax[0])).astype(np.float64)


def scores(odds_per_row: np.ndarray, bias: float, column: pa.Array) -> np.ndarray:
    """The softmax's probability of label 1 of every text."""
    rows, texts = features_of(column)
    sums = np.bincount(texts, odds_per_row[rows], minlength=len(column))
    total = np.bincount(texts, minlength=len(column))
    odds = sums / (total + EMPTY_ROWS) + bias
    return 1 / (1 + np.exp(-np.clip(odds, -60, 60)))


def fitted(texts: pa.Array, labels: np.ndarray) -> Model:
    """Steps of one document each, in a new order every epoch, ever smaller ones. Documents of the
    rarer label weigh more, so that both labels weigh the same."""
    generator = np.random.default_rng(7)
    vectors = generator.uniform(-1, 1, (REPEATED + 1, DIMENSIONS)).astype(np.float32) / DIMENSIONS
    model = Model(vectors, np.zeros((2, DIMENSIONS), np.float32), np.zeros(2, np.float32))
    bags = []
    for at in range(len(labels)):
        rows, times = np.unique(features_of(texts[at : at + 1])[0], return_counts=True)
        bags.append((rows.astype(np.int32), (times / (times.sum() + EMPTY_ROWS)).astype(np.float32)))
    share = np.bincount(labels, minlength=2) / max(1, len(labels))
    weight = np.where(share > 0, 0.5 / np.maximum(share, 1e-9), 0)
    steps, done = EPOCHS * len(labels), 0
    for _ in range(EPOCHS):
        for at in generator.permutation(len(labels)):
            rate = RATE * (1 - done / steps)
            done += 1
            rows, parts = bags[at]
            mean = parts @ model.vectors[rows]
            odds = model.softmax @ mean + model.bias
            error = np.exp(odds - odds.max())
            error = (error / error.sum()).astype(np.float32)
            error[labels[at]] -= 1
            error *= np.float32(weight[labels[at]] * rate)
            back = error @ model.softmax
            model.softmax -= np.outer(error, mean)
            model.bias -= error
            # The average thins out a step over many rows; scaled by this it moves by the step.
            if len(rows):
                model.vectors[rows] -= np.outer(parts / (parts @ parts), back)
    return model


def held_out(doc_id: Column) -> Column:
    return samples.crc_remainder(doc_id, 5) == 0


def learned(documents: DataFrame, labels: DataFrame) -> Model:
    learn_from = ~held_out(F.col("doc_id"))
    return fitted(*samples.labelled(documents, labels, "quality", learn_from, SAMPLE_DOCUMENTS))


def scored(documents: DataFrame, model: Model) -> DataFrame:
    """``doc_id`` and ``score``, the probability of label 1."""
    known = model.odds_per_row(), float(model.bias[1] - model.bias[0])
    sent = documents.sparkSession.sparkContext.broadcast(known)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = scores(*sent.value, batch.column("text"))
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found)], ["doc_id", "score"]
            )

        return by_slices(batches, "text", one)

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(work, f"doc_id {kind}, score double")
