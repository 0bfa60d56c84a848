"""Nearest neighbours by inner product, with vantage-point trees over shards of metric cells.

A vector ``x`` gets one coordinate more, ``sqrt(M^2 - |x|^2)`` with the largest norm ``M`` of all, and a query gets 0 there.
Then ``|q - x|^2 = |q|^2 + M^2 - 2 q.x``: the largest inner product is the smallest distance, and distances obey the
triangle inequality.

1. Up to ``CELLS`` vectors, drawn by a digest of their row, are pivots. A vector belongs to the cell of its nearest
   pivot; of every cell the smallest and the largest distance to the pivot are known. A cell is dealt to shards of some
   ``SHARD_ROWS`` vectors by a digest of the row, equal vectors included.
2. A shard is a vantage-point tree: a node is a vantage point; the other vectors below it are sorted by their distance to
   it and halved, and of each half the smallest and largest distance are kept, which bound the distance of a query to all
   vectors in it. Leaves have ``LEAF_ROWS`` vectors at most.
3. A query first searches one shard of its own cell, and takes its ``k``-th best there along. It then goes only to the
   shards of cells that may hold something nearer, by the distances to their pivots and by the plane halfway to its own
   pivot, and in a shard only to the leaves that may.

A cell or a leaf is passed over if its bound times ``factor`` is beyond the ``k``-th best so far: a factor of one is
exact, a larger one stops sooner. Vantage points are compared when they are passed, whatever the factor.

The index is a table: the vectors of a shard in the order of the tree, with the bounds on the row of
each vantage point. Halving follows from the number of rows, so nothing else needs to be stored. The pivots and the bounds
of their cells are as many numbers as ``CELLS`` allows, and go to every task.

At scale: a hot cell is more shards, not a larger one. Queries come in blocks; a task holds one shard and one
block, whatever the number of either. A task returns ``k`` rows per query at most, and none that are worse than the ``k``-th
the query came with; Spark keeps the best of them before it shuffles. How many shards a query visits follows from the
vectors: few where they are clustered, all where they are spread evenly in many dimensions.

Defined cases: vectors that are null, empty or zero, or hold a null or a number that is not finite, and
rows without an id, take no part; vectors of different lengths are not compared; equal scores go to the
smaller id; a row never finds rows of its own id; rows that repeat an id are vectors, and queries, of
their own; fewer candidates than ``k`` are all returned; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierwork.sources.work import written

CELLS = 512
#: There are as many pivots as make cells of some this many vectors, up to ``CELLS``.
CELL_ROWS = 1024
SHARD_ROWS = 8192
LEAF_ROWS = 64
BLOCK_QUERIES = 4096
#: Measured against brute force in the tests and the README.
FACTOR = 1.1

_INDEX = (
    "dim int, shard bigint, at int, vec_id bigint, vector array<double>, "
    "inner_low double, inner_high double, outer_low double, outer_high double"
)
_FOUND = "query bigint, query_id bigint, vec_id bigint, score double"
_FOUND_ARROW = pa.schema(
    [("query", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())]
)
_NO_ID = np.iinfo(np.int64).max


def usable(embeddings: DataFrame, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The vectors that take part, in double precision, with a number for each row."""
    values = F.col(vector).cast("array<double>")
    finite = F.forall(
        values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return embeddings.select(
        F.col(id_column).cast("bigint").alias("vec_id"), values.alias("vector")
    ).filter(
        F.col("vec_id").isNotNull() & finite & F.exists("vector", lambda x: x != 0)
    ).select(
        F.monotonically_increasing_id().alias("row"),
        "vec_id",
        "vector",
        F.size("vector").alias("dim"),
    )


def _matrix(column: pa.ChunkedArray | pa.Array, rows: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)


def tree_order(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of the rows in the tree, and per row the bounds of the two halves below it."""
    order = np.arange(len(points))
    bounds = np.full((len(points), 4), np.nan)
    open_parts = [(0, len(points))]
    while open_parts:
        start, stop = open_parts.pop()
        if stop - start <= LEAF_ROWS:
            continue
        rest = order[start + 1 : stop]
        distance = np.sqrt(((points[rest] - points[order[start]]) ** 2).sum(axis=1))
        by = np.argsort(distance, kind="stable")
        order[start + 1 : stop] = rest[by]
        distance = distance[by]
        middle = start + 1 + len(rest) // 2
        half = middle - start - 1
        bounds[start] = distance[0], distance[half - 1], distance[half], distance[-1]
        # The farthest vector of a half is its vantage point: it sees the others at varied distances.
        for low, high in ((start + 1, middle), (middle, stop)):
            order[low], order[high - 1] = order[high - 1], order[low]
            open_parts.append((low, high))
    return order, bounds


def _distances(queries: np.ndarray, points: np.ndarray, most: float) -> np.ndarray:
    """Distances of lifted queries to lifted vectors whose largest square norm is ``most``."""
    squares = (queries**2).sum(axis=1)
    return np.sqrt(np.maximum(squares[:, None] + most - 2 * (queries @ points.T), 0))


def _lifted(vectors: np.ndarray, most: float | None = None) -> np.ndarray:
    squares = (vectors**2).sum(axis=1)
    most = squares.max(initial=0) if most is None else most
    return np.column_stack([vectors, np.sqrt(np.maximum(most - squares, 0))])


@dataclass
class Cells:
    """The cells of the vectors of one length: the largest square norm ``most``, the ``pivots``; and, once they are
    counted, per cell the ``low`` and ``high`` distance to its pivot and its number of ``shards``, which
    begin at ``first``."""

    most: float
    pivots: np.ndarray
    low: np.ndarray | None = None
    high: np.ndarray | None = None
    first: np.ndarray | None = None
    shards: np.ndarray | None = None

    def of_vectors(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The cell of every vector and its distance to the pivot."""
        lifted, pivots = _lifted(vectors, self.most), _lifted(self.pivots, self.most)
        squares = (lifted**2).sum(axis=1)[:, None] + (pivots**2).sum(axis=1) - 2 * lifted @ pivots.T
        cell = squares.argmin(axis=1)
        return cell, np.linalg.norm(lifted - pivots[cell], axis=1)

    def bounds(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest cell of every query, of those with vectors, and a bound of its distance to each cell's vectors."""
        distance = _distances(queries, self.pivots, self.most)
        there = self.shards > 0
        own = np.where(there, distance, np.inf).argmin(axis=1)
        bound = np.maximum(self.low - distance, distance - self.high)
        # A vector of a cell is nearer to its pivot than to any other, so it lies behind the plane halfway to it.
        pivots = _lifted(self.pivots, self.most)
        between = np.linalg.norm(pivots[own][:, None, :] - pivots[None], axis=2)
        nearest = distance[np.arange(len(own)), own][:, None]
        plane = (distance**2 - nearest**2) / (2 * np.maximum(between, 1e-12))
        bound = np.maximum(bound, np.where(between > 1e-9, plane, 0))
        return own, np.where(there, np.maximum(bound, 0), np.inf)


def cells_of(vectors: DataFrame, cells: int = CELLS, cell_rows: int = CELL_ROWS) -> dict[int, Cells]:
    """Per length of the ``usable`` vectors their cells, not counted so far. The driver gets the pivots."""
    sizes = vectors.groupBy("dim").agg(
        F.count("*").alias("n"), F.max(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)).alias("most")
    )
    wanted = F.least(F.lit(cells), F.ceil(F.col("n") / cell_rows))
    place = F.row_number().over(Window.partitionBy("dim").orderBy("drawn", "row"))
    drawn = vectors.select("dim", "row", "vector", F.xxhash64("row", F.lit(3)).alias("drawn"))
    drawn = drawn.withColumn("place", place).filter(F.col("place") <= cells)
    drawn = drawn.join(sizes, "dim").filter(F.col("place") <= wanted)
    found: dict[int, list] = {}
    for row in drawn.orderBy("dim", "place").toLocalIterator():
        found.setdefault(row["dim"], []).append(row)
    return {
        # A little more than the largest, so that sums in another order do not pass it.
        dim: Cells(rows[0]["most"] * (1 + 1e-12), np.array([row["vector"] for row in rows]))
        for dim, rows in found.items()
    }


def _by_dim(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch, np.ndarray]]:
    dims = batch.column("dim").to_numpy()
    for dim in np.unique(dims).tolist():
        own = batch.filter(pa.array(dims == dim))
        yield dim, own, _matrix(own.column("vector"), len(own))


def in_cells(vectors: DataFrame, cells: dict[int, Cells]) -> DataFrame:
    """The vectors with their ``cell`` and their distance ``away`` from its pivot."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, own, values in _by_dim(batch):
                cell, away = cells[dim].of_vectors(values)
                yield pa.RecordBatch.from_arrays(
                    [*own.columns, pa.array(cell.astype(np.int32)), pa.array(away)], [*own.schema.names, "cell", "away"]
                )

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in vectors.schema)
    return vectors.mapInArrow(work, f"{schema}, cell int, away double")


def counted(placed: DataFrame, cells: dict[int, Cells], shard_rows: int = SHARD_ROWS) -> dict[int, Cells]:
    """The cells with their bounds and shards, from the vectors in them."""
    rows = placed.groupBy("dim", "cell").agg(
        F.count("*").alias("n"), F.min("away").alias("low"), F.max("away").alias("high")
    )
    found = {dim: Cells(c.most, c.pivots) for dim, c in cells.items()}
    for c in found.values():
        c.low, c.high = np.zeros(len(c.pivots)), np.zeros(len(c.pivots))
        c.shards = np.zeros(len(c.pivots), np.int64)
    for row in rows.collect():
        c, cell = found[row["dim"]], row["cell"]
        c.low[cell], c.high[cell], c.shards[cell] = row["low"], row["high"], -(-row["n"] // shard_rows)
    for c in found.values():
        c.first = np.append(0, np.cumsum(c.shards)[:-1])
    return found


def index(placed: DataFrame, cells: dict[int, Cells]) -> DataFrame:
    """The trees over all vectors ``in_cells``, of cells that are ``counted``."""
    spans = [(dim, cell, int(c.first[cell]), int(n)) for dim, c in cells.items() for cell, n in enumerate(c.shards) if n]
    if not spans:
        return placed.sparkSession.createDataFrame([], _INDEX)
    spans = placed.sparkSession.createDataFrame(spans, "dim int, cell int, first bigint, shards bigint")

    def built(key: tuple, shard: pa.Table) -> pa.Table:
        return _built(key, shard, cells[key[0].as_py()].most)

    shard = F.col("first") + F.pmod(F.xxhash64("row"), F.col("shards"))
    dealt = placed.join(F.broadcast(spans), ["dim", "cell"]).withColumn("shard", shard)
    return dealt.select("dim", "shard", "row", "vec_id", "vector").groupBy("dim", "shard").applyInArrow(built, _INDEX)


def _built(key: tuple, shard: pa.Table, most: float) -> pa.Table:
    shard = shard.sort_by([("vec_id", "ascending"), ("row", "ascending")])
    vectors = _matrix(shard.column("vector"), len(shard))
    order, bounds = tree_order(_lifted(vectors, most))
    values = pa.array(vectors[order].ravel())
    ends = pa.array(np.arange(len(shard) + 1) * vectors.shape[1], pa.int32())
    return pa.table(
        {
            "dim": pa.array(np.full(len(shard), key[0].as_py()), pa.int32()),
            "shard": pa.array(np.full(len(shard), key[1].as_py()), pa.int64()),
            "at": pa.array(np.arange(len(shard)), pa.int32()),
            "vec_id": shard.column("vec_id").combine_chunks().take(pa.array(order)),
            "vector": pa.ListArray.from_arrays(ends, values),
            **{
                name: pa.array(bounds[:, place])
                for place, name in enumerate(("inner_low", "inner_high", "outer_low", "outer_high"))
            },
        }
    )


class Tree:
    """One shard of the index; ``most`` is the largest square norm of all vectors. ``scored`` counts the pairs of a query and
    a vector that were compared."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, bounds: np.ndarray, most: float):
        self.vectors, self.ids, self.bounds, self.most = vectors, ids, bounds, most
        self.scored = 0

    def leaf_bounds(self, queries: np.ndarray) -> tuple[list[tuple[int, int]], np.ndarray, np.ndarray]:
        """The row ranges of the leaves, for every query a bound of its distance to each, and the vantage points."""
        ranges, found, points = [], [], []
        open_parts = [(0, len(self.ids), np.zeros(len(queries)))]
        while open_parts:
            start, stop, least = open_parts.pop()
            if stop - start <= LEAF_ROWS:
                ranges.append((start, stop))
                found.append(least)
                continue
            distance = _distances(queries, self.vectors[start : start + 1], self.most)[:, 0]
            points.append(start)
            inner_low, inner_high, outer_low, outer_high = self.bounds[start]
            middle = start + 1 + (stop - start - 1) // 2
            for low, high, near, far in (
                (start + 1, middle, inner_low, inner_high),
                (middle, stop, outer_low, outer_high),
            ):
                bound = np.maximum(least, np.maximum(near - distance, distance - far))
                open_parts.append((low, high, bound))
        return ranges, np.column_stack(found), np.array(points, np.int64)

    def search(
        self, queries: np.ndarray, own: np.ndarray, k: int, factor: float, floor: np.ndarray | None = None
    ) -> tuple[np.ndarray, np.ndarray]:
        """Scores and ids of the best ``k`` found per query, best first; -inf where there are fewer. Scores below the
        query's ``floor`` are not looked for."""
        ranges, bounds, points = self.leaf_bounds(queries)
        slack = 1e-9 * (1 + np.sqrt(self.most))
        squares = (queries**2).sum(axis=1) + self.most
        scores = np.full((len(queries), k), -np.inf)
        ids = np.full((len(queries), k), _NO_ID)
        floor = np.full(len(queries), -np.inf) if floor is None else floor
        self._offer(np.arange(len(queries)), points, queries, own, scores, ids, floor)
        # Leaves that are near to many queries come first.
        for leaf in np.argsort(bounds.mean(axis=0), kind="stable"):
            least = np.maximum(scores[:, -1], floor)
            kth = np.sqrt(np.maximum(squares - 2 * least, 0))
            rows = np.flatnonzero(bounds[:, leaf] * factor <= kth + slack)
            self._offer(rows, np.arange(*ranges[leaf]), queries, own, scores, ids, floor)
        return scores, ids

    def _offer(self, rows, columns, queries, own, scores, ids, floor) -> None:
        """Let some vectors compete for the best of some queries."""
        if not len(rows) or not len(columns):
            return
        self.scored += len(rows) * len(columns)
        least = np.maximum(scores[rows, -1], floor[rows])
        close = queries[rows] @ self.vectors[columns].T >= least[:, None] - 1e-9 * (1 + self.most)
        close &= own[rows][:, None] != self.ids[columns][None, :]
        worth = close.any(axis=1)
        rows, close = rows[worth], close[worth]
        if not len(rows):
            return
        # Row sums, not the matrix product: equal vectors get equal scores wherever they stand.
        row, column = np.nonzero(close)
        found = np.full(close.shape, -np.inf)
        for start in range(0, len(row), 1 << 16):
            part = slice(start, start + (1 << 16))
            found[row[part], column[part]] = (queries[rows[row[part]]] * self.vectors[columns[column[part]]]).sum(axis=1)
        all_scores = np.concatenate([scores[rows], found], axis=1)
        all_ids = np.concatenate([ids[rows], np.broadcast_to(self.ids[columns], found.shape)], axis=1)
        all_ids = np.where(np.isneginf(all_scores), _NO_ID, all_ids)
        best = np.lexsort((all_ids, -all_scores), axis=1)[:, : scores.shape[1]]
        scores[rows] = np.take_along_axis(all_scores, best, axis=1)
        ids[rows] = np.take_along_axis(all_ids, best, axis=1)


def _searched(trees: DataFrame, routes: DataFrame, cells: dict[int, Cells], k: int, factor: float, blocks: int) -> DataFrame:
    """What the queries of ``routes`` (``query``, ``query_id``, ``vector``, ``dim``, ``shard``, ``floor``) find in their shards."""
    most = {dim: c.most for dim, c in cells.items()}

    def search(key: tuple, shard: pa.Table, block: pa.Table) -> pa.Table:
        if not len(shard) or not len(block):
            return _FOUND_ARROW.empty_table()
        shard = shard.sort_by("at")
        bounds = np.column_stack(
            [shard.column(c).to_numpy() for c in ("inner_low", "inner_high", "outer_low", "outer_high")]
        )
        vectors, ids = _matrix(shard.column("vector"), len(shard)), shard.column("vec_id").to_numpy()
        tree = Tree(vectors, ids, bounds, most[key[0].as_py()])
        own, query = block.column("query_id").to_numpy(), block.column("query").to_numpy()
        queries, floor = _matrix(block.column("vector"), len(block)), block.column("floor").to_numpy()
        parts = []
        for start in range(0, len(block), 1024):
            part = slice(start, start + 1024)
            scores, found = tree.search(queries[part], own[part], k, factor, floor[part])
            row, place = np.nonzero(~np.isneginf(scores))
            arrays = [query[part][row], own[part][row], found[row, place], scores[row, place]]
            parts.append(pa.Table.from_arrays([pa.array(x) for x in arrays], schema=_FOUND_ARROW))
        return pa.concat_tables(parts)

    numbers = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<bigint>"))
    left = trees.withColumn("block", numbers)
    right = routes.withColumn("block", F.pmod(F.xxhash64("query"), F.lit(blocks)))
    keys = ["dim", "shard", "block"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(search, _FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


_ROUTE = "query bigint, query_id bigint, vector array<double>, dim int, shard bigint, floor double"


def nearest(
    trees: DataFrame,
    cells: dict[int, Cells],
    queries: DataFrame,
    k: int,
    factor: float = FACTOR,
    block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """The ``k`` nearest that each query finds: ``query_id``, ``rank`` (from 1), ``vec_id`` and ``score``.
    ``queries`` has the columns of ``usable``."""
    blocks = max(1, -(-queries.count() // block_queries))

    def routed(batches: Iterator[pa.RecordBatch], further: bool) -> Iterator[pa.RecordBatch]:
        """Every query with a shard of its cell, or with the further shards that its ``floor`` lets it visit."""
        for batch in batches:
            for dim, own, values in _by_dim(batch):
                c, rows = cells[dim], own.column("row").to_numpy()
                # Some queries at a time: a row may go to every shard.
                for start in range(0, len(own), 256):
                    part = slice(start, start + 256)
                    home, bounds = c.bounds(values[part])
                    at = c.first[home] + rows[part] % c.shards[home]
                    floor = np.full(len(home), -np.inf)
                    if further:
                        floor = own.column("floor").to_numpy(zero_copy_only=False)[part]
                        squares = (values[part] ** 2).sum(axis=1) + c.most
                        kth = np.sqrt(np.maximum(squares - 2 * floor, 0)) + 1e-9 * (1 + np.sqrt(c.most))
                        row, cell = np.nonzero(bounds * factor <= kth[:, None])
                        row, count = np.repeat(row, c.shards[cell]), c.shards[cell]
                        begin = np.repeat(c.first[cell] - np.append(0, np.cumsum(count)[:-1]), count)
                        shard = begin + np.arange(len(row))
                        row, shard = row[shard != at[row]], shard[shard != at[row]]
                    else:
                        row, shard = np.arange(len(home)), at
                    chosen = own.take(pa.array(row + start))
                    yield pa.RecordBatch.from_arrays(
                        [
                            chosen.column("row"),
                            chosen.column("vec_id"),
                            chosen.column("vector"),
                            chosen.column("dim"),
                            pa.array(shard.astype(np.int64)),
                            pa.array(floor[row]),
                        ],
                        ["query", "query_id", "vector", "dim", "shard", "floor"],
                    )

    def first(batches):
        return routed(batches, False)

    def then(batches):
        return routed(batches, True)

    at_home = _searched(trees, queries.mapInArrow(first, _ROUTE), cells, k, factor, blocks)
    at_home = written(_best(at_home, k), "found-at-home")
    floors = at_home.filter(F.col("rank") == k).select(F.col("query").alias("row"), F.col("score").alias("floor"))
    known = queries.join(floors, "row", "left").withColumn("floor", F.coalesce("floor", F.lit(float("-inf"))))
    further = _searched(trees, known.mapInArrow(then, _ROUTE), cells, k, factor, blocks)
    found = _best(at_home.drop("rank").union(further), k)
    return found.select("query_id", "rank", "vec_id", "score")


def neighbours(embeddings: DataFrame, every: int, k: int, factor: float = FACTOR) -> DataFrame:
    """The nearest of the rows whose id is divisible by ``every``, among all rows."""
    vectors = written(usable(embeddings), "vectors")
    cells = cells_of(vectors)
    placed = written(in_cells(vectors, cells), "vectors-in-cells")
    cells = counted(placed, cells)
    trees = written(index(placed, cells), "vantage-trees")
    return nearest(trees, cells, vectors.filter(F.col("vec_id") % every == 0), k, factor)
