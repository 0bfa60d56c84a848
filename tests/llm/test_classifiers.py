"""Toxicity and quality: held-out accuracy on made-up texts, sentences, odd rows."""

import math
import re

import numpy as np
import pytest
from llm_cases import ODD_ROWS, documents, rng
from pyspark.sql import functions as F

from tierwork.llm import quality, samples, toxicity

LABELS = "doc_id long, quality int, toxic int, text string, label string"


def labels_of(spark, rows):
    return spark.createDataFrame([(i, q, t, "x", "y") for i, q, t in rows], LABELS)


def sentence(r, vocabulary):
    return " ".join(r.choice(vocabulary) for _ in range(r.randint(4, 12)))


@pytest.fixture(scope="module")
def made(spark):
    """Documents of plain sentences; one bad word somewhere makes a document toxic, and shouting or
    one word over and over of low quality."""
    r, rows, labels = rng(12), [], []
    vocabulary = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in "lmnrst"]
    bad = [f"{stem}{end}" for stem in ("snarf", "gribb") for end in ("", "ing", "ed", "ish", "ous", "ly")]
    for i in range(1_500):
        parts = [sentence(r, vocabulary) for _ in range(r.randint(2, 12))]
        toxic, low = r.random() < 0.3, r.random() < 0.25
        if toxic:
            at = r.randrange(len(parts))
            parts[at] = f"{parts[at]} {r.choice(bad)} {sentence(r, vocabulary)}"
        if low:
            parts = [x.upper() + "!!" for x in parts] if r.random() < 0.5 else [*parts, (r.choice(vocabulary) + " ") * 40]
        rows.append((i, ". ".join(parts) + "."))
        if r.random() < 0.9:
            labels.append((i, int(not low), int(toxic)))
    return documents(spark, rows), labels_of(spark, labels), dict(rows), {i: (q, t) for i, q, t in labels}


def accuracy(found, truth, limit):
    right = [(r["score"] >= limit) == bool(truth[r["doc_id"]]) for r in found if r["doc_id"] in truth]
    assert len(right) > 100
    return np.mean(right)


def test_toxic_documents_and_their_sentences(spark, made):
    docs, labels, texts, truth = made
    found = toxicity.scored(docs, toxicity.learned(docs, labels))
    held = found.filter(toxicity.held_out(F.col("doc_id"))).collect()
    assert accuracy(held, {i: t for i, (_, t) in truth.items()}, 0.7) >= 0.97
    named = [r for r in held if r["doc_id"] in truth and truth[r["doc_id"]][1] and r["sentences"]]
    assert len(named) > 80
    for row in named:
        raw = texts[row["doc_id"]].lower().encode()
        assert any(b"snarf" in raw[s["start"] : s["end"]] or b"gribb" in raw[s["start"] : s["end"]] for s in row["sentences"])


def test_quality_of_held_out_documents(spark, made):
    docs, labels, _, truth = made
    found = quality.scored(docs, quality.learned(docs, labels)).filter(quality.held_out(F.col("doc_id"))).collect()
    assert accuracy(found, {i: q for i, (q, _) in truth.items()}, 0.3) >= 0.97


@pytest.mark.parametrize("operator", [toxicity, quality])
def test_labels_of_held_out_rows_are_never_learned(spark, made, operator):
    docs, labels, _, _ = made
    column = "toxic" if operator is toxicity else "quality"
    turned = labels.withColumn(column, F.when(operator.held_out(F.col("doc_id")), 1 - F.col(column)).otherwise(F.col(column)))
    few = docs.filter("doc_id < 200")
    one = operator.scored(few, operator.learned(docs, labels)).select("doc_id", "score").collect()
    other = operator.scored(few, operator.learned(docs, turned)).select("doc_id", "score").collect()
    assert sorted(one) == sorted(other)


@pytest.mark.parametrize("operator", [toxicity, quality])
@pytest.mark.parametrize("labels", [[], [(3, 1, 0), (4, 0, 1), (None, 1, 1), (6, None, None)], [(4, 1, 1)]])
def test_odd_rows(spark, operator, labels):
    docs = documents(spark, ODD_ROWS)
    found = operator.scored(docs, operator.learned(docs, labels_of(spark, labels))).collect()
    assert len(found) == len(ODD_ROWS)
    assert all(r["score"] is not None and 0 <= r["score"] <= 1 for r in found)
    empty = documents(spark, [])
    assert operator.scored(empty, operator.learned(empty, labels_of(spark, labels))).collect() == []


def test_the_sample_is_bounded_and_the_same_every_time(spark, made):
    docs, labels, _, _ = made
    one = samples.labelled(docs, labels, "toxic", F.lit(True), 50)
    other = samples.labelled(docs.repartition(5), labels.repartition(3), "toxic", F.lit(True), 50)
    assert len(one[0]) == 50 and one[0].to_pylist() == other[0].to_pylist() and (one[1] == other[1]).all()


def test_scores_equal_those_of_averaged_vectors(made):
    """One number per row gives the same odds as averaging vectors first."""
    import pyarrow as pa

    r = np.random.default_rng(5)
    shape = (quality.REPEATED + 1, quality.DIMENSIONS)
    model = quality.Model(r.normal(size=shape).astype(np.float32), r.normal(size=(2, quality.DIMENSIONS)), np.array([0.1, 0.3]))
    texts = pa.array(["some words some words", "x", "", "Same same SAME"])
    fast = quality.scores(model.odds_per_row(), 0.2, texts)
    for at in range(len(texts)):
        rows, _ = quality.features_of(texts[at : at + 1])
        mean = model.vectors[rows].sum(axis=0) / (len(rows) + quality.EMPTY_ROWS)
        odds = model.softmax @ mean + model.bias
        assert abs(np.exp(odds)[1] / np.exp(odds).sum() - fast[at]) < 1e-6


MASK = (1 << 64) - 1


def plain_mix(x):
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & MASK
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & MASK
    return x ^ (x >> 31)


VALUES = [plain_mix(b + 1) for b in range(256)]


def plain_hash(word):
    total, power = len(word), 1
    for byte in word:
        total, power = (total + VALUES[byte] * power) & MASK, (power * 0x9E3779B97F4A7C15) & MASK
    return plain_mix(total)


def test_toxicity_of_all_documents_by_a_plain_noisy_or(spark, sf_dir):
    """Every score of the table from sentences, dictionaries and products."""
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = toxicity.learned(table, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    weights, shift = model.weights.astype(float).tolist(), 64 - toxicity.WEIGHT_BITS

    def of_word(word):
        found = weights[plain_hash(word) >> shift]
        for size in toxicity.BEGINNINGS:
            if len(word) >= size:
                found += weights[plain_mix((int.from_bytes(word[:size], "big") + ((size - 1) << 56)) & MASK) >> shift]
        return found

    memory = {}
    found = {r["doc_id"]: r["score"] for r in toxicity.scored(table, model).collect()}
    rows = table.select("doc_id", "text").collect()
    assert len(found) == len(rows)
    for doc_id, text in rows:
        lower = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
        clean = 1.0
        for sentence in re.split(rb"[.!?\n]", lower):
            own = set(re.findall(rb"[0-9a-z\x80-\xff]+", sentence))
            if own:
                odds = sum(memory.setdefault(w, of_word(w)) for w in own) + model.bias
                clean *= 1 / (1 + math.exp(min(60, odds)))
        assert abs(found[doc_id] - (1 - clean)) < 1e-6


def test_quality_of_all_documents_by_a_plain_softmax(spark, sf_dir):
    """Every score of the table from words, runs of characters and averages of their vectors."""
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = quality.learned(table, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    shift = 64 - quality.ROW_BITS
    factor = 0x9E3779B97F4A7C15
    per_row = model.odds_per_row().tolist()

    def of_run(run):
        code = 0
        for character in run:
            code = (code * factor + int.from_bytes(character.encode(), "big")) & MASK
        return per_row[(plain_mix(code) >> shift) + (1 << quality.ROW_BITS)]

    words, runs = {}, {}
    found = {r["doc_id"]: r["score"] for r in quality.scored(table, model).collect()}
    rows = table.select("doc_id", "text").collect()
    assert len(found) == len(rows)
    for doc_id, text in rows:
        own = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        parts = [words.setdefault(w, per_row[plain_hash(w.encode()) >> shift]) for w in own]
        parts += [per_row[quality.REPEATED] for one, other in zip(own, own[1:]) if one == other]
        laid = (text or "") + " "
        for at in range(len(laid) - quality.GRAM + 1):
            run = laid[at : at + quality.GRAM]
            if run not in runs:
                runs[run] = of_run(run)
            parts.append(runs[run])
        odds = sum(parts) / (len(parts) + quality.EMPTY_ROWS) + float(model.bias[1] - model.bias[0])
        assert abs(found[doc_id] - 1 / (1 + math.exp(-odds))) < 1e-6


def test_runs_are_of_characters():
    import pyarrow as pa

    laid = "aé漢🙂  x "
    codes, begins = quality.characters(np.frombuffer(laid.encode(), np.uint8))
    assert codes.tolist() == [int.from_bytes(c.encode(), "big") for c in laid]
    assert begins.tolist() == [len(laid[:at].encode()) for at in range(len(laid))]
    cut = np.frombuffer("aé漢🙂".encode()[1:-1], np.uint8)
    assert quality.characters(cut)[0].tolist() == [int.from_bytes(c.encode(), "big") for c in "é漢"]
    # Pieces of any size give the same runs.
    texts = pa.array(["aé漢🙂 some text", None, "x", "", "wörter und 漢字 " * 9])
    whole = quality.features_of(texts)
    for size in (1, 2, 3, 7, 50):
        with pytest.MonkeyPatch.context() as patched:
            patched.setattr(quality, "RUN_BYTES", size)
            pieces = quality.features_of(texts)
        assert sorted(zip(*(x.tolist() for x in pieces))) == sorted(zip(*(x.tolist() for x in whole)))


def test_the_sample_is_bounded_in_bytes(spark, monkeypatch):
    monkeypatch.setattr(samples, "SAMPLE_BYTES", 10_000)
    text = "some words of a text " * 100
    docs = documents(spark, [(i, text[: 1_000 + i % 7]) for i in range(200)])
    labels = labels_of(spark, [(i, i % 2, i % 2) for i in range(200)])
    for most in (5, 200):
        found, kinds = samples.labelled(docs, labels, "toxic", F.lit(True), most)
        assert len(found) == len(kinds) == min(most, 9) and sum(map(len, found.to_pylist())) <= 10_000
    monkeypatch.setattr(samples, "SAMPLE_BYTES", 10)
    assert len(samples.labelled(docs, labels, "toxic", F.lit(True), 5)[0]) == 0
