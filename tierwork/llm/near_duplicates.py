"""Near-duplicate documents by HyperMinHash.

A document's set is its different shingles of five words. Its sketch has 128 registers of 16 bits: the
shingle's hash names a bucket, and the smallest hash of a bucket is kept as the number of its leading
zeros and the ten bits behind the first one. An empty bucket borrows from another one, in an order of its
own, so small sets have whole sketches too. Four registers make a band of 64 bits; documents that
share a band are candidates. Two sets of similarity 0.75 miss each other in all 32 bands once in
200,000 times. Sets of few shingles fill few registers, and the chance would be higher; sets of up to ``SMALL``
shingles are therefore found exactly: of a set that can be linked to one, as many of its shingles of the smallest hashes are
buckets of their own that two linked sets must share one, and the sets themselves are compared there.

From candidates to links:

1. Equal sets are one class, and only classes go on.
2. In a bucket of a band all members are compared by sketch (in one of a shingle by their sets): the share of equal registers, less the
   share that collides by chance. Members with an estimate of ``LEAST_ESTIMATE`` or more, directly or
   through others, are one cluster with all that buckets hang on to it. A bucket of more than
   ``BUCKET_ROWS`` members is one cluster without an estimate, in no task as a whole.
3. Clusters are cut into blocks of bounded size. Every block compares its full sets, all with all,
   exactly, by counting common shingles with a matrix product, and gives the links that hold it together.
   Blocks of the same cluster share some pivots. Texts go to the blocks, and are shingled there.
4. Where a cluster of several blocks is not one component by then, its documents outside of the largest
   component are compared with all others of the cluster, block by block. So no pair of a cluster that
   could still make a link goes untested.

At scale: texts are read twice and move once, those of clusters twice; sketches, bands and links are narrow. Hot groups are split:
equal sets fold on the map side, buckets and clusters are dealt by blocks whose number follows their size.
No task holds a group that grows with the corpus, and nothing is collected. Sketches and the texts of clusters are removed
behind the step that reads them last.

Defined cases: documents without words, or null, have no shingles, link with nothing and are kept; fewer
than five words are one shingle; rows that repeat a doc_id are linked each by its own text, and the
component's id is the smallest doc_id in it, whose rows are all ``kept``; null ids do not count for it, and a
component of null ids only has null and is ``kept``; ``without_near_duplicates`` leaves one row of every component, also
where several rows have its id or none has one; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierwork.llm.components import components
from tierwork.llm.rows import text_digest, without_rows
from tierwork.llm.words import NOT_BLANK, by_slices, gram_hashes, lists, mix, signed, words_of
from tierwork.sources.work import remove, work_path, written


@dataclass(frozen=True)
class Rule:
    """Sets are shingles of ``shingle`` words; links have ``100 * common >= percent * all``."""

    shingle: int
    percent: int


NEAR = Rule(shingle=5, percent=75)
REGISTERS = 128
MANTISSA_BITS = 10
BAND = 4
BANDS = REGISTERS // BAND
#: Lowest estimate that is verified: six standard errors below the similarity of a link.
LEAST_ESTIMATE = 0.52
#: Sets of at most so many shingles are found by shared shingles, not by bands.
SMALL = 31
#: The largest set that one of these can be linked with.
SMALL_REACH = SMALL * 100 // NEAR.percent
BUCKET_ROWS = 1024
BLOCK_ROWS = 512
BLOCK_SHINGLES = 1 << 20
PIVOTS = 16

_BUCKET_BITS = np.uint64(REGISTERS.bit_length() - 1)
_BORROW = np.argsort(
    mix(np.arange(REGISTERS * REGISTERS, dtype=np.uint64) + np.uint64(7)).reshape(REGISTERS, -1), axis=1
)


def shingle_sets(column: pa.Array, shingle: int = NEAR.shingle) -> list[np.ndarray]:
    """Per text its different shingles, sorted, as 64-bit numbers."""
    words = words_of(column, NOT_BLANK)
    grams = gram_hashes(words.hashes, shingle)
    found = []
    for start, stop in zip(words.first[:-1], words.first[1:]):
        if stop - start >= shingle:
            found.append(np.unique(grams[start : stop - shingle + 1]))
        elif stop > start:
            found.append(gram_hashes(words.hashes[start:stop], int(stop - start)))
        else:
            found.append(np.zeros(0, np.uint64))
    return found


def registers_of(shingles: np.ndarray) -> np.ndarray:
    """The registers of one set that is not empty."""
    bucket = (shingles >> (np.uint64(64) - _BUCKET_BITS)).astype(np.int64)
    first = np.append(True, bucket[1:] != bucket[:-1])
    rest = shingles[first] << _BUCKET_BITS
    length = np.frexp((rest >> np.uint64(11)).astype(np.float64))[1]
    zeros = np.where(length > 0, 53 - length, 53).astype(np.uint64)
    tail = (rest << zeros << np.uint64(1)) >> np.uint64(64 - MANTISSA_BITS)
    found = np.zeros(REGISTERS, np.uint16)
    found[bucket[first]] = ((zeros + np.uint64(1)) << np.uint64(MANTISSA_BITS)) | tail
    empty = found == 0
    if empty.any():
        order = _BORROW[empty]
        lender = order[np.arange(len(order)), (~empty)[order].argmax(axis=1)]
        found[empty] = found[lender]
    return found


def chance_of_collision(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """How often two registers of unrelated sets of ``n`` and ``m`` members are equal. The two smallest
    hashes fall into one cell; a cell at x is x / 2**MANTISSA_BITS wide, times 1 / (2 ln 2) on average
    over an octave, and the densities of both, n exp(-nx) and m exp(-mx), are integrated over it."""
    n, m = n.astype(np.float64), m.astype(np.float64)
    return n * m / (n + m) ** 2 / (2 * np.log(2)) / (1 << MANTISSA_BITS)


def estimates(registers: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The similarity of all pairs of sketches, corrected for collisions."""
    equal = np.empty((len(registers), len(registers)), np.float64)
    for row, own in enumerate(registers):
        equal[row] = (registers == own).mean(axis=1)
    chance = chance_of_collision(sizes[:, None], sizes[None, :])
    return (equal - chance) / (1 - chance)


def linked_parts(adjacent: np.ndarray) -> np.ndarray:
    """Per node of an adjacency matrix the first node of its component."""
    part = np.full(len(adjacent), -1)
    for node in range(len(adjacent)):
        if part[node] < 0:
            front = np.array([node])
            part[node] = node
            while len(front):
                reached = adjacent[front].any(axis=0) & (part < 0)
                front = np.flatnonzero(reached)
                part[front] = node
    return part


def common_counts(sets: list[np.ndarray]) -> np.ndarray:
    """How many members every two sets share: a product of 0/1 matrices over the shared members."""
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    fresh = np.append(True, values[1:] != values[:-1])[: len(values)]
    member = np.cumsum(fresh) - 1
    often = np.bincount(member) > 1 if len(member) else np.zeros(0, bool)
    column = np.cumsum(often) - 1
    keep = often[member] if len(member) else np.zeros(0, bool)
    owner, column = owner[keep], column[member[keep]] if len(member) else owner[keep]
    counts = np.zeros((len(sets), len(sets)), np.float32)
    width = 2048
    for start in range(0, int(column.max(initial=-1)) + 1, width):
        low, high = np.searchsorted(column, [start, start + width])
        part = np.zeros((len(sets), width), np.float32)
        part[owner[low:high], column[low:high] - start] = 1
        counts += part @ part.T
    return counts


def links_within(sets: list[np.ndarray], percent: int = NEAR.percent) -> np.ndarray:
    """Which pairs of sets are similar enough, exactly; float32 counts are exact to 16 million."""
    sizes = np.array([len(x) for x in sets], np.float64)
    if len(sets) == 2:
        common = np.zeros((2, 2))
        common[0, 1] = common[1, 0] = len(np.intersect1d(*sets, assume_unique=True))
    else:
        common = common_counts(sets).astype(np.float64)
    return (100 * common >= percent * (sizes[:, None] + sizes[None, :] - common)) & ~np.eye(len(sets), dtype=bool)


def _sketch(batch: pa.RecordBatch) -> pa.RecordBatch:
    sets = shingle_sets(batch.column("text"))
    sketches = [registers_of(x).view(np.int64) if len(x) > SMALL else np.zeros(0, np.int64) for x in sets]
    small = [x if len(x) <= SMALL_REACH else x[:0] for x in sets]
    one, two = set_digests(sets)
    return pa.RecordBatch.from_arrays(
        [
            batch.column("row"),
            batch.column("doc_id"),
            batch.column("copy"),
            batch.column("copy2"),
            pa.array([len(x) for x in sets], pa.int64()),
            pa.array(signed(one)),
            pa.array(signed(two)),
            lists(pa.array(np.concatenate(sketches)), np.array([len(x) for x in sketches])),
            lists(pa.array(signed(np.concatenate(small))), np.array([len(x) for x in small])),
        ],
        ["row", "doc_id", "copy", "copy2", "n_shingles", "digest", "digest2", "registers", "small"],
    )


def set_digests(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that are equal for equal sets only."""
    sums = [(x.sum(dtype=np.uint64), mix(x ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)) for x in sets]
    sizes = np.array([len(x) for x in sets], np.uint64)
    pairs = np.array(sums, np.uint64).reshape(-1, 2)
    return mix(pairs[:, 0] + sizes), mix(pairs[:, 1] + sizes)


def sketches(documents: DataFrame) -> DataFrame:
    """Per row a number of its own, ``doc_id``, a digest of its text, the size and a digest of its
    set, its registers, four to a long, and the set itself, if it is small."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return by_slices(batches, "text", _sketch)

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", *text_digest(), "text"
    ).mapInArrow(
        work,
        f"row bigint, doc_id {kind}, copy bigint, copy2 bigint, n_shingles bigint, digest bigint, digest2 bigint, "
        "registers array<bigint>, small array<bigint>",
    )


def by_groups(
    frame: DataFrame,
    keys: list[str],
    work: Callable[[pa.RecordBatch], list[tuple[int, int]]],
    shingle: int | None = None,
) -> DataFrame:
    """Links ``a``, ``b`` that ``work`` finds in the rows of each key. A partition is sorted by key and
    read as a stream, so many small groups cost little and one group is in memory at a time. With ``shingle``
    it gets the rows ``with_sets``: the texts move, which are half as long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches if shingle is None else with_sets(batches, shingle), keys):
            found = work(group)
            if found:
                a, b = zip(*found)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return frame.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "a bigint, b bigint")


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        changed = np.zeros(len(batch) - 1, bool)
        for column in columns:
            changed |= column[1:] != column[:-1]
        edges = [0, *(np.flatnonzero(changed) + 1).tolist(), len(batch)]
        if held and any(held[-1].column(k)[-1] != batch.column(k)[0] for k in keys):
            yield _joined(held)
            held = []
        for start, stop in zip(edges, edges[1:]):
            if start:
                yield _joined(held)
                held = []
            held.append(batch.slice(start, stop - start))
    if held:
        yield _joined(held)


def _joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return batches[0] if len(batches) == 1 else pa.concat_batches(batches)


def arrays(column: pa.ListArray, kind: type) -> list[np.ndarray]:
    ends = column.offsets.to_numpy(zero_copy_only=False)
    values = column.values.to_numpy(zero_copy_only=False)
    return [values[start:stop].view(kind) for start, stop in zip(ends, ends[1:])]


def _alike_in_bucket(group: pa.RecordBatch) -> list[tuple[int, int]]:
    nodes = group.column("cls").to_numpy(zero_copy_only=False)
    if group.column("blocks")[0].as_py() > 1:
        centre = group.column("centre")[0].as_py()
        return [(centre, node) for node in nodes.tolist() if node != centre]
    if group.column("exact")[0].as_py():
        part = linked_parts(links_within(arrays(group.column("small"), np.uint64)))
        return [(int(nodes[p]), int(node)) for p, node in zip(part, nodes) if nodes[p] != node]
    registers = np.stack(arrays(group.column("registers"), np.uint16))
    sizes = group.column("n_shingles").to_numpy(zero_copy_only=False)
    part = linked_parts(estimates(registers, sizes) >= LEAST_ESTIMATE)
    return [(int(nodes[p]), int(node)) for p, node in zip(part, nodes) if nodes[p] != node]


def candidate_links(classes: DataFrame) -> DataFrame:
    """Links ``a``, ``b`` between classes that share a bucket and are alike by their sketches, directly
    or through others of the bucket."""
    bands = classes.select("cls", F.posexplode("registers").alias("band", "value"))
    bands = bands.select("cls", F.lit(False).alias("exact"), F.xxhash64("band", "value").alias("bucket"))
    # Two sets with 100 * common >= percent * all share one of so many of their smallest shingles.
    few = F.col("n_shingles") - F.ceil(F.col("n_shingles") * NEAR.percent / 100) + 1
    first = classes.filter(F.col("n_shingles") <= SMALL_REACH)
    first = first.select("cls", F.explode(F.slice("small", 1, few.cast("int"))).alias("shingle"))
    bands = bands.union(first.select("cls", F.lit(True), F.xxhash64(F.lit(-1), "shingle")))
    shared = (
        bands.groupBy("bucket", "exact")
        .agg(
            F.count("*").alias("n"),
            F.min("cls").alias("centre"),
            F.bit_xor(F.xxhash64("cls")).alias("mark"),
            F.bit_xor(F.xxhash64("cls", F.lit(1))).alias("mark2"),
        )
        .filter("n > 1")
    )
    # Buckets with the same members need one comparison only.
    shared = shared.groupBy("n", "centre", "mark", "mark2", "exact").agg(F.min("bucket").alias("bucket"))
    blocks = F.ceil(F.col("n") / BUCKET_ROWS)
    shared = shared.select("bucket", "exact", "centre", blocks.alias("blocks"))
    members = bands.join(shared, ["bucket", "exact"])
    members = members.join(classes.select("cls", "n_shingles", "registers", "small"), "cls")
    members = members.withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")))
    return by_groups(members, ["bucket", "exact", "block"], _alike_in_bucket)


def with_sets(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    """The rows with ``shingles``, the set of each text, in place of ``text``."""

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = shingle_sets(batch.column("text"), shingle)
        values = pa.array(signed(np.concatenate(sets)))
        shingles = lists(values, np.array([len(x) for x in sets]))
        others = [c for c in batch.schema.names if c != "text"]
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in others), shingles], [*others, "shingles"])

    return by_slices(batches, "text", one)


def full_texts(documents: DataFrame, wanted: DataFrame) -> DataFrame:
    """The texts of ``wanted`` classes (``cls``, ``doc_id``, ``copy``, ``copy2``, ``rows``, how many rows the class has, and
    more columns): ``text``, one row per class, but for a class of several rows one per task at most."""
    rows = documents.select(F.col("doc_id").alias("own_id"), F.col("text"), *text_digest())
    rows = rows.withColumnsRenamed({"copy": "own_copy", "copy2": "own_copy2"})
    same = (
        rows["own_id"].eqNullSafe(wanted["doc_id"])
        & (rows["own_copy"] == wanted["copy"])
        & (rows["own_copy2"] == wanted["copy2"])
    )
    joined = rows.join(wanted, same).drop("own_id", "own_copy", "own_copy2", "doc_id", "copy", "copy2")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            # Rows that repeat a class have the same text.
            keep = np.ones(len(batch), bool)
            several = np.flatnonzero(batch.column("rows").to_numpy() > 1)
            for place, number in zip(several.tolist(), batch.column("cls").to_numpy()[several].tolist()):
                keep[place] = number not in seen
                seen.add(number)
            yield batch if keep.all() else batch.filter(pa.array(keep))

    return joined.mapInArrow(work, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in joined.schema))


def full_sets(documents: DataFrame, wanted: DataFrame, shingle: int = NEAR.shingle) -> DataFrame:
    """``full_texts`` with ``shingles``, their sets, in place of the texts."""
    texts = full_texts(documents, wanted)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in texts.schema if f.name != "text")
    return texts.mapInArrow(partial(with_sets, shingle=shingle), f"{schema}, shingles array<bigint>")


def _different(group: pa.RecordBatch) -> tuple[pa.RecordBatch, np.ndarray, list[np.ndarray]]:
    """A group with every class once, its classes and their sets."""
    nodes, at = np.unique(group.column("cls").to_numpy(zero_copy_only=False), return_index=True)
    group = group.take(pa.array(at))
    return group, nodes, arrays(group.column("shingles"), np.uint64)


def _links_in_block(group: pa.RecordBatch, percent: int) -> list[tuple[int, int]]:
    _, nodes, sets = _different(group)
    if len(nodes) < 2:
        return []
    part = linked_parts(links_within(sets, percent))
    return [(int(nodes[p]), int(node)) for p, node in zip(part, nodes) if nodes[p] != node]


def _links_across(group: pa.RecordBatch, percent: int) -> list[tuple[int, int]]:
    """Links between classes outside the largest component and those of one block, one for every
    component of the block that a class has a link to."""
    group, nodes, sets = _different(group)
    parts = group.column("component").to_numpy(zero_copy_only=False)
    linked = links_within(sets, percent) & (parts[:, None] != parts[None, :])
    found = []
    for row in np.flatnonzero(linked.any(axis=1)):
        others = np.flatnonzero(linked[row])
        _, first = np.unique(parts[others], return_index=True)
        found += [(int(nodes[row]), int(nodes[x])) for x in others[first]]
    return found


def _blocks(rows: Column, shingles: Column) -> Column:
    return F.ceil(F.greatest(rows / BLOCK_ROWS, shingles / BLOCK_SHINGLES)).cast("bigint")


def verified_links(
    documents: DataFrame, classes: DataFrame, clusters: DataFrame, rule: Rule = NEAR
) -> DataFrame:
    """Links between classes whose full sets are similar enough, as many as hold every component
    together. ``clusters``: ``node`` and ``component`` of the candidate links."""
    wanted = classes.select("cls", "doc_id", "copy", "copy2", "rows", "n_shingles").join(
        clusters.select(F.col("node").alias("cls"), F.col("component").alias("cluster")), "cls"
    )
    sizes = wanted.groupBy("cluster").agg(
        F.count("*").alias("in_cluster"), F.sum("n_shingles").alias("in_all")
    )
    blocks = _blocks(F.col("in_cluster"), F.col("in_all"))
    sizes = sizes.select("cluster", blocks.alias("blocks"), "in_cluster")
    wanted = wanted.join(sizes, "cluster")
    path = work_path(documents.sparkSession, "cluster-texts")
    texts = written(full_texts(documents, wanted), "cluster-texts", path)
    order = F.pmod(F.xxhash64("cls"), F.col("in_cluster"))
    pivot = (F.col("blocks") > 1) & (order < PIVOTS)
    own = F.pmod(F.xxhash64("cls", F.lit(2)), F.col("blocks"))
    placed = texts.select(
        "cls",
        "cluster",
        "text",
        F.explode(F.when(pivot, F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array(own))).alias("block"),
    )
    links = by_groups(placed, ["cluster", "block"], partial(_links_in_block, percent=rule.percent), rule.shingle)
    links = written(links, "block-links")
    split = texts.filter("blocks > 1")
    if not split.isEmpty():
        links = links.union(_links_between_blocks(split, links, rule))
    remove(documents.sparkSession, path)
    return links


def _links_between_blocks(split: DataFrame, links: DataFrame, rule: Rule) -> DataFrame:
    parts = components(links).withColumnRenamed("node", "cls")
    part = F.coalesce("component", "cls").alias("component")
    found = split.join(parts, "cls", "left").select(split["*"], part)
    sizes = found.groupBy("cluster", "component").agg(
        F.countDistinct("cls").alias("n"), F.sum("n_shingles").alias("in_all")
    )
    in_all = sizes.groupBy("cluster").agg(
        F.max(F.struct("n", "component"))["component"].alias("largest"),
        F.sum("n").alias("all_rows"),
        F.max("n").alias("most"),
        F.sum("in_all").alias("all_shingles"),
    )
    in_all = in_all.filter("all_rows > most").select(
        "cluster",
        "largest",
        _blocks(F.col("all_rows") - F.col("most"), F.col("all_shingles") * (F.col("all_rows") - F.col("most")) / F.col("all_rows")).alias("chunks"),
    )
    path = work_path(split.sparkSession, "texts-between")
    found = written(found.join(in_all, "cluster"), "texts-between", path)
    block = F.pmod(F.xxhash64("cls", F.lit(2)), F.col("blocks"))
    chunk = F.pmod(F.xxhash64("cls", F.lit(3)), F.col("chunks"))
    columns = ["cls", "cluster", "component", "text"]
    inside = found.select(
        *columns, block.alias("block"), F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk")
    )
    outside = found.filter("component <> largest").select(
        *columns, F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), chunk.alias("chunk")
    )
    keys = ["cluster", "block", "chunk"]
    across = by_groups(inside.union(outside), keys, partial(_links_across, percent=rule.percent), rule.shingle)
    across = written(across, "links-between")
    remove(split.sparkSession, path)
    return across


def linked_rows(
    documents: DataFrame,
    sketched: DataFrame,
    candidates: Callable[[DataFrame], DataFrame] = candidate_links,
    rule: Rule = NEAR,
) -> DataFrame:
    """``near_duplicates`` from sketches (the columns of ``sketches``, or others in place of ``registers`` that
    ``candidates`` knows), with ``copy`` and ``copy2``, the digest of the row's text, and ``component``, the number of its
    component; null where a row has no shingles. Sketches are written twice, for all rows and for classes, and both tables
    go as soon as their narrow columns are in one of their own."""
    spark = documents.sparkSession
    row_path, class_path = work_path(spark, "sketches"), work_path(spark, "class-sketches")
    rows = written(sketched, "sketches", row_path)
    plain = written(rows.select("doc_id", "copy", "copy2", "n_shingles", "digest", "digest2"), "sketched-rows")
    classes = rows.filter("n_shingles > 0").groupBy("digest", "digest2").agg(
        F.min("row").alias("cls"), F.min("doc_id").alias("least"), F.count("*").alias("rows")
    )
    classes = written(classes, "classes")
    members = rows.withColumnRenamed("row", "cls").drop("digest", "digest2").join(classes, "cls")
    members = written(members, "class-sketches", class_path)
    remove(spark, row_path)
    candidate = written(candidates(members), "candidate-links")
    members = written(members.select("cls", "doc_id", "copy", "copy2", "rows", "n_shingles"), "class-rows")
    remove(spark, class_path)
    links = verified_links(documents, members, components(candidate), rule)
    parts = components(links)
    numbered = classes.join(parts.withColumnRenamed("node", "cls"), "cls", "left").withColumn(
        "component", F.coalesce("component", "cls")
    )
    least = numbered.groupBy("component").agg(F.min("least").alias("component_id"))
    known = numbered.join(least, "component").select("digest", "digest2", "component", "component_id")
    linked = plain.filter("n_shingles > 0").join(known, ["digest", "digest2"])
    alone = plain.filter("n_shingles = 0").withColumns(
        {"component": F.lit(None).cast("bigint"), "component_id": F.col("doc_id")}
    )
    columns = ["doc_id", "copy", "copy2", "n_shingles", "component", "component_id"]
    return (
        linked.select(columns)
        .unionByName(alone.select(columns))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def near_duplicates(documents: DataFrame) -> DataFrame:
    """Per row ``doc_id``, ``n_shingles``, ``component_id`` (the smallest doc_id that links lead to)
    and ``kept`` (whether that is its own)."""
    found = linked_rows(documents, sketches(documents))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def without_near_duplicates(documents: DataFrame) -> DataFrame:
    """One row of each component, with all its columns: that of the smallest id, null ids last; of several such rows
    that of the smallest digest of its text, and one of those that repeat id and text. A row goes for its own text,
    never for another row of its id; rows without words all stay."""
    found = linked_rows(documents, sketches(documents))
    found = written(found.filter("component is not null"), "linked-rows")
    gone = found.filter(~F.col("kept")).select("doc_id", "copy", "copy2")
    kept = found.filter("kept")
    several = kept.groupBy("component").agg(
        F.min(F.struct("doc_id", "copy", "copy2")).alias("one"), F.count("*").alias("n")
    )
    several = written(several.filter("n > 1").select("component", "one.*"), "several-kept")
    if several.isEmpty():
        return without_rows(documents, gone)
    # All rows of these components go, and one row of each comes back.
    again = kept.join(several.select("component"), "component", "left_semi")
    gone = gone.union(again.select("doc_id", "copy", "copy2"))
    whole = F.struct(*(documents[c] for c in documents.columns)).alias("document")
    rows = documents.select(whole, documents["doc_id"].alias("own_id"), *text_digest())
    one = several.toDF("component", "one_id", "one_copy", "one_copy2")
    same = (
        rows["own_id"].eqNullSafe(one["one_id"])
        & (rows["copy"] == one["one_copy"])
        & (rows["copy2"] == one["one_copy2"])
    )
    back = rows.join(one, same, "left_semi").dropDuplicates(["own_id", "copy", "copy2"])
    return without_rows(documents, gone).union(back.select("document.*"))
