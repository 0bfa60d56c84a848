"""Toxicity by multiple-instance learning.

A document is a bag of sentences, and only the document is labelled. A sentence's probability is
logistic in its words and in how its words begin; a document is toxic if one of its sentences is, so the probabilities are
combined by noisy-or, ``1 - prod(1 - p)``. The weights are fitted to the documents' labels through the
noisy-or, by numpy gradient descent, and then name the sentences that make a document toxic.

The fit uses a bounded sample, at most ``SAMPLE_DOCUMENTS`` labelled documents of at most
``samples.LONGEST_BYTES`` bytes each and ``samples.SAMPLE_BYTES`` together; every document is scored, whole. The model is a fixed number of weights.

At scale: one pass over the labels, one over the documents for the sample, one that scores; only the
labels drawn, of bounded number, are sent to the documents, and no text is shuffled.

Defined cases: a null or empty text, or one without words, has score 0 and no sentences; without labels of
both kinds nothing is learned and all scores are next to 0; sentences end at full stops, question and
exclamation marks and line ends; rows that repeat a doc_id are scored each; only ``doc_id`` and
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
from tierwork.llm.words import ALPHANUMERIC, Words, by_slices, lists, mix, text_slices, words_of

SAMPLE_DOCUMENTS = 8_000
WEIGHT_BITS = 18
NO_WEIGHT = 1 << WEIGHT_BITS
#: Bytes of a word's beginnings that are features of their own.
BEGINNINGS = (4, 5, 6)
EPOCHS = 10
BATCH = 128
RATE = 0.8
#: What a sentence of unknown words has as log odds before the fit.
FIRST_BIAS = -10.0
#: What a weight loses with every step, so that only weights which the labels hold up remain.
SHRINK = 2e-4
OFFENDING = 0.5

_ENDS = np.zeros(256, bool)
_ENDS[[ord("."), ord("!"), ord("?"), ord("\n")]] = True


def features_of(words: Words) -> np.ndarray:
    """Per word a number for the word and one for each beginning that it has; shorter words have the
    number of no weight instead."""
    shift = np.uint64(64 - WEIGHT_BITS)
    found = np.full((len(words.hashes), 1 + len(BEGINNINGS)), NO_WEIGHT, np.int32)
    found[:, 0] = words.hashes >> shift
    begin = np.zeros(len(words.hashes), np.uint64)
    last = max(0, len(words.data) - 1)
    for place in range(BEGINNINGS[-1]):
        begin = (begin << np.uint64(8)) | words.data[np.minimum(words.starts + place, last)]
        if place + 1 in BEGINNINGS:
            longer = words.ends - words.starts > place
            column = 1 + BEGINNINGS.index(place + 1)
            found[longer, column] = mix(begin[longer] + np.uint64(place << 56)) >> shift
    return found


@dataclass
class Sentences:
    """Per word the numbers of its features, none for a word that the sentence had already; the
    first word of each sentence, the sentences before each text."""

    words: Words
    features: np.ndarray
    starts: np.ndarray
    before: np.ndarray


def sentences_of(column: pa.Array) -> Sentences:
    words = words_of(column, ALPHANUMERIC)
    ended = np.cumsum(_ENDS[words.data])[words.starts]
    texts = words.text_of()
    fresh = np.ones(len(ended), bool)
    fresh[1:] = (ended[1:] != ended[:-1]) | (texts[1:] != texts[:-1])
    starts = np.flatnonzero(fresh)
    features = features_of(words)
    sentence = np.cumsum(fresh)
    order = np.lexsort((words.hashes, sentence))
    again = (words.hashes[order][1:] == words.hashes[order][:-1]) & (sentence[order][1:] == sentence[order][:-1])
    features[order[1:][again]] = NO_WEIGHT
    return Sentences(words, features, starts, np.searchsorted(starts, words.first))


@dataclass
class Model:
    weights: np.ndarray
    bias: float

    def odds(self, found: Sentences) -> np.ndarray:
        """Log odds of every sentence."""
        if not len(found.starts):
            return np.zeros(0)
        return np.add.reduceat(self.of_words(found.features), found.starts) + self.bias

    def of_words(self, features: np.ndarray) -> np.ndarray:
        return self.weights[features].sum(axis=1, dtype=np.float64)

    def scores(self, found: Sentences) -> tuple[np.ndarray, np.ndarray]:
        """Per text the noisy-or, and the probability of each sentence."""
        odds = self.odds(found)
        texts = np.repeat(np.arange(len(found.before) - 1), np.diff(found.before))
        together = np.bincount(texts, np.logaddexp(0, odds), minlength=len(found.before) - 1)
        return -np.expm1(-together), 1 / (1 + np.exp(-np.clip(odds, -60, 60)))


def _bags(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, first words of sentences and sentences before each text, made slice by slice."""
    features, starts, before = [], [], [np.zeros(1, np.int64)]
    words = sentences = 0
    for start, stop in text_slices(texts):
        found = sentences_of(texts[start:stop])
        features.append(found.features)
        starts.append(found.starts + words)
        before.append(found.before[1:] + sentences)
        words, sentences = words + len(found.features), sentences + len(found.starts)
    return np.concatenate(features), np.concatenate(starts), np.concatenate(before)


def fitted(texts: pa.Array, labels: np.ndarray) -> Model:
    """The weights that explain the labels of whole documents, by steps scaled per weight."""
    model = Model(np.zeros(NO_WEIGHT + 1, np.float32), FIRST_BIAS)
    toxic = labels == 1
    if not len(labels) or toxic.all() or not toxic.any():
        return model
    features_all, starts, before = _bags(texts)
    ends = np.append(starts[1:], len(features_all)) if len(starts) else starts
    squares, bias_square = np.full(len(model.weights), 1e-6), 1e-6
    generator = np.random.default_rng(5)
    for _ in range(EPOCHS):
        order = generator.permutation(len(labels))
        for batch in np.split(order, range(BATCH, len(order), BATCH)):
            rows = [np.arange(before[t], before[t + 1]) for t in batch]
            sentence = np.concatenate(rows)
            if not len(sentence):
                continue
            owner = np.repeat(np.arange(len(batch)), [len(x) for x in rows])
            sizes = ends[sentence] - starts[sentence]
            first = np.append(0, np.cumsum(sizes)[:-1])
            word = np.arange(sizes.sum()) - np.repeat(first - starts[sentence], sizes)
            features = features_all[word]
            odds = np.add.reduceat(model.of_words(features), first) + model.bias
            together = np.bincount(owner, np.logaddexp(0, odds), minlength=len(batch))
            slope = np.where(toxic[batch], -1 / np.expm1(np.clip(together, 1e-6, 50)), 1.0)
            pull = slope[owner] / (1 + np.exp(-np.clip(odds, -60, 60))) / len(batch)
            step = np.bincount(
                features.ravel(), np.repeat(pull, sizes * features.shape[1]), minlength=len(model.weights)
            )
            step[NO_WEIGHT] = 0
            used = np.flatnonzero(step)
            squares[used] += step[used] ** 2
            moved = model.weights[used] - RATE * step[used] / np.sqrt(squares[used])
            model.weights[used] = np.maximum(moved - SHRINK, 0)
            bias_square += pull.sum() ** 2
            model.bias -= 0.05 * RATE * pull.sum() / np.sqrt(bias_square)
    return model


def held_out(doc_id: Column) -> Column:
    return samples.crc_remainder(doc_id, 3) == 1


def learned(documents: DataFrame, labels: DataFrame) -> Model:
    learn_from = ~held_out(F.col("doc_id"))
    return fitted(*samples.labelled(documents, labels, "toxic", learn_from, SAMPLE_DOCUMENTS))


def scored(documents: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``score``, and ``sentences``: those that offend, as bytes from ``start`` up to ``end``
    of the text with their probability."""
    sent = documents.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = sentences_of(batch.column("text"))
            scores, each = known.scores(found)
            texts = np.repeat(np.arange(len(batch)), np.diff(found.before))
            bad = np.flatnonzero(each >= OFFENDING)
            last = np.append(found.starts[1:], len(found.features))[bad] - 1
            origin = found.words.origin[:-1][texts[bad]]
            spans = pa.StructArray.from_arrays(
                [
                    pa.array((found.words.starts[found.starts[bad]] - origin).astype(np.int32)),
                    pa.array((found.words.ends[last] - origin).astype(np.int32)),
                    pa.array(each[bad]),
                ],
                ["start", "end", "probability"],
            )
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores), lists(spans, np.bincount(texts[bad], minlength=len(batch)))],
                ["doc_id", "score", "sentences"],
            )

        return by_slices(batches, "text", one)

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(
        work, f"doc_id {kind}, score double, sentences array<struct<start: int, end: int, probability: double>>"
    )
