"""Collocations against a plain version with counters, and the counting itself."""

import re
from collections import Counter

import numpy as np
import pytest
from llm_cases import LOWER, ODD_ROWS, documents, rng

from tierwork.llm import collocations as co


def plain_counts(rows, longest):
    counts = Counter()
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            for n in range(1, longest + 1):
                counts.update(("und" if lang is None else lang, tuple(w[i : i + n])) for i in range(len(w) - n + 1))
    return counts


def plain(rows, longest, least, cover, best):
    counts = plain_counts(rows, longest)
    found, covered = {}, Counter()
    for (lang, w), a in counts.items():
        if len(w) > 1 and a >= least:
            cuts = []
            for k in range(1, len(w)):
                l, r = counts[lang, w[:k]], counts[lang, w[k:]]
                cuts.append((1_000_000 * a * a // (l * r), k, l, r))
            found.setdefault(lang, []).append((w, a, min(cuts)))
            for m in range(2, len(w)):
                for i in range(len(w) - m + 1):
                    covered[lang, w[i : i + m]] = max(covered[lang, w[i : i + m]], a)
    out = []
    for lang, phrases in found.items():
        n = sum(f for (x, w), f in counts.items() if x == lang and len(w) == 1)
        left = [x for x in phrases if 100 * covered[lang, x[0]] < cover * x[1]]
        left.sort(key=lambda x: (-x[2][0], -x[1], " ".join(x[0]).encode()))
        for rank, (w, a, (score, _, l, r)) in enumerate(left[:best]):
            out.append((lang, rank + 1, " ".join(w), a, l, r, n, score))
    return sorted(out)


def check(spark, rows, longest=3, least=10, cover=50, best=2000, shards=co.SHARDS):
    docs = documents(spark, [(i, text, lang, "s") for i, (text, lang) in enumerate(rows)])
    found = co.collocations(docs, longest, least, cover, best, shards)
    assert dict(found.dtypes) == {
        "lang": "string", "phrase": "string", **{c: "bigint" for c in ("rank", "a", "l", "r", "n", "score")}
    }
    got = sorted(tuple(r) for r in found.collect())
    assert got == plain(rows, longest, least, cover, best)
    return got


VOCABULARY = ["the", "The", "of", "and", "été", "漢字", "\x00odd", "x-y", "(z)"] + [f"w{i}" for i in range(20)]


def random_rows(seed, count):
    r = rng(seed)
    rows = []
    for _ in range(count):
        parts = []
        for _ in range(r.randint(0, 60)):
            parts.append(r.choice(VOCABULARY) if r.random() < 0.7 else "in spite of it")
            parts.append(r.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\r\n", "\x0b"]))
        rows.append(("".join(parts), r.choice(["en", "en", "de", None, "und", "a\tb"])))
    return rows


@pytest.mark.parametrize("longest, shards", [(3, 4), (2, 1), (5, 3)])
def test_random_texts(spark, longest, shards):
    assert len(check(spark, random_rows(longest, 120), longest, shards=shards)) > 10


def test_phrases_that_become_frequent_late(spark):
    """Words that pass the threshold only with the last shards, so longer phrases begin in later cycles."""
    rows = [(f"filler{i} and more{i % 7}", "en") for i in range(60)] + [("one two three four", "en")] * 11
    r = rng(8)
    r.shuffle(rows)
    found = check(spark, rows, longest=4, least=11)
    assert any(x[2] == "one two three four" and x[3] == 11 for x in found)


def test_slots_that_many_phrases_share(spark, monkeypatch):
    monkeypatch.setattr(co, "SLOTS", 16)
    check(spark, random_rows(11, 60), least=5)


def test_the_best_are_cut_after_ties(spark):
    rows = [(f"a{i % 9} b{i % 9}, c{i % 5} d{i % 5}", "en") for i in range(180)]
    assert len(check(spark, rows, best=4)) == 4


def test_odd_rows_and_empty_tables(spark):
    rows = [(text, lang) for _, text, *more in ODD_ROWS for lang in [more[0]]]
    check(spark, rows, least=2)
    assert check(spark, []) == []
    assert check(spark, [(None, None), ("", "en"), ("...", "en"), ("word", "en")]) == []


def test_exact_beyond_64_bits(spark):
    """Counts whose products need up to 37 digits."""
    a, l, r = 9 * 10**14 + 7, 10**15 + 9, 3 * 10**15 + 1
    frequent = spark.createDataFrame(
        [("en", "x y", 2, a), ("en", "x", 1, l), ("en", "y", 1, r)], "lang string, phrase string, length int, f long"
    )
    assert [tuple(x) for x in co.scored(frequent).collect()] == [("en", "x y", 2, a, l, r, 1_000_000 * a * a // (l * r))]


def test_counts_are_exact_in_any_number_of_scans(spark):
    rows = random_rows(21, 80)
    counts = {(lang, " ".join(w)): f for (lang, w), f in plain_counts(rows, 3).items() if f >= 6}
    for shards in (1, 2, 7):
        docs = documents(spark, [(i, *row, "s") for i, row in enumerate(rows)])
        frequent, totals = co.phrase_counts(docs, 3, 6, shards)
        assert {(x["lang"], x["phrase"]): x["f"] for x in frequent.collect()} == counts
        assert sum(x["n"] for x in totals.collect()) == sum(f for (_, w), f in plain_counts(rows, 1).items())
