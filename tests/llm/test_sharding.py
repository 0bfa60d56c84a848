"""Shards: counts, slots, mixture."""

import zlib
from collections import Counter

import pytest
from llm_cases import ODD_ROWS, documents

from tierwork.llm import sharding


def shards_of(docs, shards=24):
    return sharding.interleaved(docs, shards).collect()


def test_counts_slots_and_mixture(spark, monkeypatch):
    monkeypatch.setattr(sharding, "RANGE_ROWS", 20)
    monkeypatch.setattr(sharding, "BLOCK_RANGES", 4)
    sources = ["hot"] * 700 + ["b"] * 200 + ["c"] * 90 + ["d"] * 11 + [None] * 46
    docs = documents(spark, [(i, f"text {i}", "en", s) for i, s in enumerate(sources)])
    rows = shards_of(docs)
    assert len(rows) == len(sources) and {r["doc_id"] for r in rows} == set(range(len(sources)))
    sizes = Counter(r["shard"] for r in rows)
    assert set(sizes) == set(range(24)) and max(sizes.values()) - min(sizes.values()) <= 1
    for shard, size in sizes.items():
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(size))
    mixture = Counter((r["shard"], sources[r["doc_id"]]) for r in rows)
    for source, n in Counter(sources).items():
        for shard in sizes:
            assert abs(mixture[shard, source] - n / 24) < 2.5
    own = Counter(r["doc_id"] // 100 for r in rows if r["shard"] == 0 and r["doc_id"] < 700)
    assert len(own) >= 5, "rows are shuffled within their source"


def test_same_shards_whatever_the_partitions(spark):
    docs = documents(spark, [(i, f"text {i}", "en", f"s{i % 3}") for i in range(300)])
    assert sorted(shards_of(docs)) == sorted(shards_of(docs.repartition(7)))


def test_odd_rows(spark):
    rows = shards_of(documents(spark, ODD_ROWS), 5)
    assert len(rows) == len(ODD_ROWS)
    wanted = Counter(
        (row[0], len((row[1] or "").encode()) + 8, zlib.crc32((row[1] or "").encode())) for row in ODD_ROWS
    )
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == wanted
    assert sorted(Counter(r["shard"] for r in rows).values()) == [2, 2, 2, 3, 3]


@pytest.mark.parametrize("n", [0, 1, 23])
def test_fewer_rows_than_shards(spark, n):
    rows = shards_of(documents(spark, [(i, "x") for i in range(n)]))
    assert len(rows) == n and len({r["shard"] for r in rows}) == n and {r["slot"] for r in rows} <= {0}
