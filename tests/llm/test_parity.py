"""Parity-sketch joins against comparing all pairs."""

import numpy as np
import pytest
from llm_cases import ODD_ROWS, documents, near_components, rng, shingles
from test_near_duplicates import edited, families

from tierwork.llm import near_duplicates as nd
from tierwork.llm import parity
from tierwork.sources import work


def check(spark, rows, rule=parity.ALIKE):
    found = parity.jaccard_components(documents(spark, [(i, t, "en", "s") for i, t in rows]), rule).collect()
    sets = [shingles(t, rule.shingle) for _, t in rows]
    parts = near_components(rows, rule.shingle, rule.percent)
    wanted = sorted(str((i, len(x), p if x else i)) for (i, _), x, p in zip(rows, sets, parts))
    assert sorted(str(tuple(r)) for r in found) == wanted
    return parts


def test_families(spark):
    rows = families(1, [2, 3, 3, 5, 8, 40], 90, 4)
    rows += [(500 + i, f"alone {i} with some words of its own {i * 7} here") for i in range(20)]
    rows += [(600, "short one"), (601, "Short  ONE"), (602, "one"), (603, "four words are few"), (604, "x " * 50)]
    parts = check(spark, rows)
    assert 30 < len(set(parts)) < len(rows) - 10


def test_short_and_long_sets(spark):
    """Sizes about every edge of the first bands, with a word changed or added at either end."""
    rows, r = [], rng(5)
    for size in [*range(1, 40), 60, 120, 400, 1_500]:
        base = [f"s{size}w{i}" for i in range(size)]
        rows += [" ".join(base), " ".join([*base, "more"]), " ".join(base[1:]), edited(r, base, 1)]
    check(spark, list(enumerate(rows)))


def test_another_rule(spark):
    check(spark, families(7, [4, 10, 20], 40, 8), nd.Rule(shingle=2, percent=60))


def test_a_hot_bucket(spark, monkeypatch):
    monkeypatch.setattr(parity, "BUCKET_ROWS", 10)
    monkeypatch.setattr(nd, "BLOCK_ROWS", 12)
    monkeypatch.setattr(nd, "PIVOTS", 2)
    check(spark, families(2, [120, 2, 30], 90, 4))


def test_odd_rows(spark):
    check(spark, [row[:2] for row in ODD_ROWS])
    assert check(spark, []) == []


def test_a_third_of_all_rows_without_an_id(spark):
    text = " ".join(f"n{i}" for i in range(30))
    near = [(None, f"{text} m{i % 40}") for i in range(200)]
    check(spark, [*near, *((i, f"own text number {i} of a row with an id") for i in range(100)), (1000, text)])


def linked_pair(r, size, percent):
    """Two sets that are just linked, the second as large or larger."""
    one = r.integers(0, 2**64, size, np.uint64)
    grown = int(r.integers(size, size * 100 // percent + 1))
    # common >= percent / (100 + percent) * (both sizes)
    common = -(-percent * (size + grown) // (100 + percent))
    other = np.append(one[:common], r.integers(0, 2**64, grown - common, np.uint64))
    return np.unique(one), np.unique(other)


@pytest.mark.parametrize("spare", [0, 1, 2])
@pytest.mark.parametrize("percent", [60, 75, 90, 97])
def test_linked_sets_share_a_signature(percent, spare, monkeypatch):
    monkeypatch.setattr(parity, "SPARE", spare)
    r = np.random.default_rng(percent + spare)
    for _ in range(300):
        one, other = linked_pair(r, int(r.integers(1, 300)), percent)
        common = len(np.intersect1d(one, other))
        assert 100 * common >= percent * (len(one) + len(other) - common)
        if len(np.setxor1d(one, other)):
            found, counts = parity.signatures([one, other], percent)
            assert set(found[: counts[0]].tolist()) & set(found[counts[0] :].tolist())
        sketch = parity.small_sketches([one, other])
        assert parity.may_link(sketch, np.array([len(one), len(other)]), percent)[0, 1]


def test_unlike_sets_share_few_signatures():
    r = np.random.default_rng(1)
    sets = [np.unique(r.integers(0, 2**64, int(n), np.uint64)) for n in r.integers(9, 600, 2_000)]
    found, counts = parity.signatures(sets, 90)
    assert len(np.unique(found)) > 0.999 * len(found)
    assert counts.sum() < 0.25 * sum(map(len, sets))


def test_bands_cover_every_size_once():
    for percent in (60, 75, 90, 97):
        low, high = parity.size_bands(50_000, percent)
        assert (low[1:] == high[:-1] + 1).all() and high[-1] >= 50_000
        assert parity.differences(int(low[0]), percent) == 1 and parity.differences(int(low[0]) - 1, percent) == 0


def test_large_unlike_sets_are_no_candidates():
    """What sets of thousands of shingles may differ in is more than half of 512 bits."""
    r = np.random.default_rng(3)
    sizes = np.array([1_500, 2_500, 4_000, 4_100, 9_000, 20_000])
    sketches = parity.small_sketches([np.unique(r.integers(0, 2**64, int(n), np.uint64)) for n in sizes])
    assert (parity.may_link(sketches, sizes, 90) == np.eye(len(sizes), dtype=bool)).all()


@pytest.mark.parametrize("size", [1_150, 1_210, 2_400, 4_800])
def test_linked_sets_about_a_change_of_width(size):
    r = np.random.default_rng(size)
    widths = set()
    for _ in range(20):
        pair = linked_pair(r, size, 90)
        sizes = np.array([len(x) for x in pair])
        sketches = parity.small_sketches(list(pair))
        widths.add(tuple(len(x) for x in sketches))
        assert parity.may_link(sketches, sizes, 90).all()
        differ = len(np.setxor1d(*pair))
        assert (parity.distances(sketches) <= differ).all()
    assert any(one < other for one, other in widths)


@pytest.mark.parametrize("size", [10, 60, 400])
def test_words_are_not_equal_by_chance(size):
    """Sets of one band, many more than there are words of one or two bits."""
    r = np.random.default_rng(size)
    sets = [np.unique(r.integers(0, 2**64, size, np.uint64)) for _ in range(200_000 // size)]
    found, _ = parity.signatures(sets, 90)
    # But for words of zero, of which small sets have more.
    again = len(found) - len(np.unique(found))
    assert again <= (0 if size > 10 else len(found) // 100)


def recorded(monkeypatch):
    """The names, columns and rows of the tables that are written from now on."""
    tables = []

    def noted(df, purpose, path=None, inner=nd.written):
        rows = inner(df, purpose, path)
        tables.append((purpose, rows.columns, rows.count()))
        return rows

    monkeypatch.setattr(nd, "written", noted)
    monkeypatch.setattr(parity, "written", noted)
    return tables


def test_near_copies_are_compared_once(spark, monkeypatch):
    """Signatures that one cluster shares go no further, and texts go to its blocks, not sets."""
    tables = recorded(monkeypatch)
    rows = families(4, [30] * 10, 200, 1)
    check(spark, rows)
    sets = [np.arange(0, 198, dtype=np.uint64)] * len(rows)
    shared = sum(n for purpose, _, n in tables if purpose == "shared-signatures")
    assert 0 < shared < 0.4 * parity.signatures(sets, 90)[1].sum()
    assert not [purpose for purpose, columns, _ in tables if "shingles" in columns]


def test_wide_tables_are_removed(spark, monkeypatch):
    monkeypatch.setattr(nd, "BLOCK_ROWS", 12)
    monkeypatch.setattr(nd, "PIVOTS", 2)
    before = set(work.work_paths())
    check(spark, families(8, [60, 10], 90, 6))
    left = [spark.read.parquet(path) for path in set(work.work_paths()) - before]
    assert left
    assert not [df.columns for df in left if {"text", "signatures", "sketch", "bucket", "shingles"} & set(df.columns)]
