"""Neighbours against all inner products."""

import numpy as np
import pytest

from tierwork.llm import vantage

SCHEMA = "vec_id long, embedding array<float>, row string, shard string, score string"


def frame(spark, rows):
    return spark.createDataFrame(
        [(i, None if v is None else [None if x is None else float(x) for x in v], "a", "b", "c") for i, v in rows], SCHEMA
    )


def brute(rows, every, k):
    good = [
        (i, np.array(v, np.float32).astype(float))
        for i, v in rows
        if i is not None and v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
    ]
    found = []
    for i, q in good:
        if i % every == 0:
            others = [(-float((q * v).sum()), j) for j, v in good if j != i and len(v) == len(q)]
            found += [(i, n + 1, j, -s) for n, (s, j) in enumerate(sorted(others)[:k])]
    return found


def search(spark, rows, every=20, k=20, factor=1.0):
    got = vantage.neighbours(frame(spark, rows), every, k, factor).collect()
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got)


def rows_of(seed, n, dim=16):
    r = np.random.default_rng(seed)
    return [(i, r.normal(size=dim).round(2)) for i in range(n)]


def same(got, wanted):
    assert [x[:3] for x in got] == [x[:3] for x in sorted(wanted)]
    assert np.allclose([x[3] for x in got], [x[3] for x in sorted(wanted)], rtol=1e-12, atol=1e-12)


def test_factor_one_is_exact(spark):
    rows = rows_of(1, 600)
    vectors = vantage.written(vantage.usable(frame(spark, rows)), "vectors")
    cells = vantage.cells_of(vectors, cell_rows=150)
    placed = vantage.in_cells(vectors, cells)
    cells = vantage.counted(placed, cells, shard_rows=100)
    trees = vantage.written(vantage.index(placed, cells), "trees")
    assert trees.count() == 600 and len(cells[16].pivots) == 4 < trees.select("shard").distinct().count()
    queries = vectors.filter("vec_id % 20 = 0")
    got = vantage.nearest(trees, cells, queries, 20, 1.0, block_queries=7).collect()
    same(sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got), brute(rows, 20, 20))


def test_many_equal_vectors(spark):
    """Ties go to the smaller id, also where a third of all vectors are equal."""
    rows = [(i, v if i % 3 else np.ones(16)) for i, v in rows_of(2, 300)]
    same(search(spark, rows), brute(rows, 20, 20))


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1, 2]), (20, [2, 1]), (20, [2, 1]), (40, None), (60, []), (80, [0, 0]), (100, [nan, 1]), (120, [inf, 1]),
        (140, [None, 1]), (None, [1, 1]), (160, [1, 2, 3]), (1, [3, 3]), (2, [-1, 0]), (180, [1]),
    ]
    got = search(spark, rows, k=3)
    wanted = brute(rows, 20, 3)
    assert sorted(x[:3] for x in got) == sorted(x[:3] for x in wanted)
    assert not any(q in (40, 60, 80, 100, 120, 140, 160, 180) for q, *_ in got)


@pytest.mark.parametrize("rows", [[], [(20, [1.0, 2.0])]])
def test_nothing_to_find(spark, rows):
    assert search(spark, rows) == []


def test_recall_with_the_factor_in_use(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    got = vantage.neighbours(table, 20, 20).collect()
    wanted = {x[:1] + x[2:3] for x in brute(rows, 20, 20)}
    found = {(r["query_id"], r["vec_id"]) for r in got}
    assert len(found & wanted) / len(wanted) >= 0.99


def tree_of(vectors):
    most = (vectors**2).sum(axis=1).max()
    order, bounds = vantage.tree_order(vantage._lifted(vectors, most))
    return vantage.Tree(vectors[order], order, bounds, most)


def clustered(r, clusters, each, dim=64):
    """Unit vectors about random centres."""
    vectors = np.repeat(r.normal(size=(clusters, dim)), each, axis=0) + 0.25 * r.normal(size=(clusters * each, dim))
    return vectors / np.linalg.norm(vectors, axis=1)[:, None]


def test_bounds_hold():
    """No vector of a leaf is nearer to a query than the leaf's bound."""
    r = np.random.default_rng(3)
    tree = tree_of(r.normal(size=(500, 8)))
    queries = r.normal(size=(20, 8))
    ranges, least, points = tree.leaf_bounds(queries)
    assert sorted([*points, *(x for a, b in ranges for x in range(a, b))]) == list(range(500))
    lifted, own = np.column_stack([queries, np.zeros(20)]), vantage._lifted(tree.vectors, tree.most)
    for leaf, (start, stop) in enumerate(ranges):
        distance = np.linalg.norm(lifted[:, None] - own[None, start:stop], axis=2).min(axis=1)
        assert (least[:, leaf] <= distance + 1e-9).all()


def test_bounds_of_cells_hold():
    r = np.random.default_rng(4)
    vectors = np.concatenate([r.normal(size=(400, 8)), np.ones((50, 8)), clustered(r, 5, 40, 8)])
    cells = vantage.Cells((vectors**2).sum(axis=1).max(), vectors[r.choice(len(vectors), 12)])
    cell, away = cells.of_vectors(vectors)
    count = np.bincount(cell, minlength=12)
    cells.shards = (count > 0).astype(int)
    cells.low, cells.high = (np.array([f(away[cell == c]) if n else 0 for c, n in enumerate(count)]) for f in (np.min, np.max))
    queries = np.concatenate([r.normal(size=(20, 8)), vectors[:20]])
    own, bounds = cells.bounds(queries)
    lifted, points = np.column_stack([queries, np.zeros(40)]), vantage._lifted(vectors, cells.most)
    distance = np.linalg.norm(lifted[:, None] - points[None], axis=2)
    for c in np.flatnonzero(count):
        assert (bounds[:, c] <= distance[:, cell == c].min(axis=1) + 1e-7).all()
    assert cells.shards[own].all()


@pytest.mark.parametrize("factor", [1.0, 1.2, 3.0])
def test_vantage_points_are_found_at_any_factor(factor):
    r = np.random.default_rng(6)
    vectors = clustered(r, 10, 100)
    tree = tree_of(vectors)
    points = tree.leaf_bounds(vectors[:1])[2]
    assert len(points) > 10
    # Every vantage point is its own nearest vector, under another id.
    scores, ids = tree.search(tree.vectors[points], np.full(len(points), -1), 1, factor)
    assert (ids[:, 0] == tree.ids[points]).all() and np.allclose(scores[:, 0], 1)


def searched_in_cells(vectors, pivots, factor, k=20):
    """Every twentieth vector through its own cell's tree and then through those its bounds let it visit: the share of
    true neighbours found, and of pairs compared."""
    most = (vectors**2).sum(axis=1).max() * (1 + 1e-12)
    cells = vantage.Cells(most, vectors[np.random.default_rng(0).choice(len(vectors), pivots, replace=False)])
    cell, away = cells.of_vectors(vectors)
    cells.shards = np.ones(pivots, int)
    cells.low, cells.high = (np.array([f(away[cell == c]) for c in range(pivots)]) for f in (np.min, np.max))
    trees = []
    for c in range(pivots):
        order, bounds = vantage.tree_order(vantage._lifted(vectors[cell == c], most))
        rows = np.flatnonzero(cell == c)[order]
        trees.append(vantage.Tree(vectors[rows], rows, bounds, most))
    found, queries = 0, np.arange(0, len(vectors), 20)
    home, bounds = cells.bounds(vectors[queries])
    for place, row in enumerate(queries):
        query, own = vectors[row : row + 1], np.array([row])
        scores, ids = trees[home[place]].search(query, own, k, factor)
        floor, best = scores[0, -1:], list(zip(-scores[0], ids[0]))
        kth = np.sqrt(max((query**2).sum() + most - 2 * floor[0], 0)) + 1e-9
        for c in np.flatnonzero(bounds[place] * factor <= kth):
            if c != home[place]:
                scores, ids = trees[c].search(query, own, k, factor, floor)
                best += [x for x in zip(-scores[0], ids[0]) if np.isfinite(x[0])]
        order = np.argsort(-(vectors @ query[0]), kind="stable")
        found += len({x[1] for x in sorted(best)[:k]} & set(order[order != row][:k].tolist()))
    return found / len(queries) / k, sum(tree.scored for tree in trees) / len(queries) / len(vectors)


def test_clustered_vectors_are_mostly_passed_over():
    vectors = clustered(np.random.default_rng(7), 40, 100)
    recall, share = searched_in_cells(vectors, 64, 1.0)
    assert recall == 1 and share < 0.5
    recall, relaxed = searched_in_cells(vectors, 64, vantage.FACTOR)
    assert recall >= 0.99 and relaxed < share


def test_a_hot_cell_is_several_shards(spark, monkeypatch):
    """Half of all vectors in one small cluster, a third equal; cells and shards of few rows."""
    monkeypatch.setattr(vantage.counted, "__defaults__", (40,))
    monkeypatch.setattr(vantage.cells_of, "__defaults__", (8, 60))
    r = np.random.default_rng(8)
    vectors = np.concatenate([np.tile(np.ones(8), (200, 1)), 1 + 0.01 * r.normal(size=(100, 8)), r.normal(size=(300, 8))])
    rows = [(i, v.round(3)) for i, v in enumerate(vectors[r.permutation(600)])]
    same(search(spark, rows), brute(rows, 20, 20))
