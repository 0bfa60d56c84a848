"""Importance resampling against a plain version over words, dictionaries and sorted lists."""

import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import ODD_ROWS, documents, random_text, rng, words

from tierwork.llm import resampling as rs
from tierwork.llm.words import ALPHANUMERIC, words_of


def runs(text, longest):
    own = words(text)
    return [" ".join(own[i : i + n]) for n in range(1, longest + 1) for i in range(len(own) - n + 1)]


def plain(rows, target, least_words, percent, seed, longest, buckets):
    def bucket(run):
        return zlib.crc32(run.encode()) % buckets

    own = [[bucket(x) for x in runs(text, longest)] for _, text in rows]
    s = Counter(b for x in own for b in x)
    t = Counter(bucket(x) for text in target for x in runs(text, longest))
    in_all, in_target = sum(s.values()), sum(t.values())
    gain = {
        b: math.floor(1000 * math.log((t[b] + 1) * (in_all + buckets) / ((s[b] + 1) * (in_target + buckets)))) for b in s
    }
    scored = []
    for (doc_id, text), x in zip(rows, own):
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in x) // len(x) if x else 0
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))
        scored.append([doc_id, len(x), weight, score, None])
    able = [x for x, (_, text) in zip(scored, rows) if len(words(text)) >= least_words]
    able.sort(key=lambda x: (-x[3], x[0] is None, x[0] or 0, x[1]))
    for place, x in enumerate(able[: len(able) * percent // 100]):
        x[4] = place + 1
    return sorted(map(str, scored))


def check(spark, rows, target, least_words=20, percent=10, seed=2024, longest=1, buckets=10_000):
    items = spark.createDataFrame([(x,) for x in target], "text string")
    found = rs.resampled(documents(spark, rows), items, least_words, percent, seed, longest, buckets)
    assert found.dtypes == [(c, "bigint") for c in ("doc_id", "n_features", "weight", "score", "rank")]
    got = sorted(str(list(r)) for r in found.collect())
    assert got == plain([row[:2] for row in rows], target, least_words, percent, seed, longest, buckets)
    return got


VOCABULARY = [f"w{i}" for i in range(60)] + ["Straße", "été", "漢字", "x" * 70, "It"]


@pytest.mark.parametrize("longest, buckets", [(1, 10_000), (2, 97), (3, 70_000)])
def test_random_texts(spark, longest, buckets):
    r = rng(longest)
    rows = [(i * 3, random_text(r, VOCABULARY, 0, 60)) for i in range(300)]
    target = [random_text(r, VOCABULARY[:20], 5, 40) for _ in range(20)] + [None, ""]
    check(spark, rows, target, percent=37, longest=longest, buckets=buckets)


def test_odd_rows(spark):
    check(spark, ODD_ROWS, ["some words to count", None], least_words=1, percent=60)


def test_ties_are_cut_by_id_and_repeated_rows_one_by_one(spark):
    """A third of the rows have no id and one text, others share an id."""
    text = " ".join(["same"] * 25)
    rows = [(None, text)] * 40 + [(7, text)] * 40 + [(i, text) for i in range(100, 140)]
    for percent in (1, 20, 50, 80, 100):
        check(spark, rows, ["same words"], percent=percent)
    # Of rows with equal score and id the one with fewer features goes first.
    check(spark, [(7, text), (7, text + " same"), (7, text)] * 10, ["same"], percent=50)


def test_ids_of_the_whole_range(spark):
    text = " ".join(["same"] * 25)
    rows = [(x, text) for x in (-(2**63), -1, 0, 5, 2**63 - 1)] * 4
    check(spark, rows, ["same"], percent=55)


def test_empty_tables_and_draws(spark):
    assert check(spark, [], ["a b"]) == []
    check(spark, [(1, "a b c"), (2, None)], [])
    check(spark, [(i, "too few words") for i in range(20)], ["few"], percent=50)


def test_cutoff_counts_every_row(spark):
    r = rng(3)
    rows = [(r.randrange(-30, 30), r.randrange(4), i) for i in range(500)]
    frame = spark.createDataFrame(rows, "a long, b long, c long")
    for wanted in (1, 2, 250, 499, 500):
        bounds = rs.cutoff(frame, ["a", "b", "c"], wanted)
        assert frame.filter(rs._upto(["a", "b", "c"], bounds)).count() == wanted
        assert sorted(rows)[wanted - 1][: len(bounds)] == tuple(bounds)


def test_crcs_are_those_of_the_library():
    r = np.random.default_rng(5)
    texts = ["".join(chr(c) for c in r.integers(97, 123, n)) for n in r.integers(0, 200, 300)]
    words_found = words_of(pa.array([" ".join(texts)]), ALPHANUMERIC)
    crc, owner = rs.run_crcs(words_found, 1)
    assert crc.tolist() == [zlib.crc32(x.encode()) for x in texts if x] and not owner.any()
