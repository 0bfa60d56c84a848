"""Documents whose word shingles agree almost wholly, joined by parity sketches.

A document's set is its different shingles. Two sets linked at ``percent`` differ in few shingles: the smaller of size
``n`` and the larger together in ``n (100 - percent) / percent`` at most, and the larger has at most ``n 100 / percent``.

Sizes are cut into size bands, and each band into parts: one more than sets of the band may differ in, and
``SPARE`` more. A hash deals every shingle to a part, and a part's word is the XOR of the hashes of the shingles in it: 64
parities. All words of a set together are its parity sketch for the band: a shingle that another set has not changes one of them
at most. So linked sets differ in fewer words than there are parts, and at least one more than ``SPARE`` words are equal;
words of parts with different shingles are equal once in 2**40 times or less. A set gives a signature for every word of its own band, and of lower bands
that a linked smaller set can be of.

A word of zero, mostly a part without shingles, says nothing. As ``SPARE`` more words than needed are equal, zero words can be
left out wherever one of the two sets has no more than ``SPARE`` of them. Sets with more zero words give those
words as signatures too; two such sets meet there. So no link is lost.

Sets that share a signature are candidates, if a second sketch is no farther than their sizes allow: bits that every shingle
turns one of, 512 or as many times twice that as linked sets of the size need for unlike ones to be farther; the wider of two is
folded to the other. The signatures of the first ``FIRST_PLACES`` parts of each band are looked at before the others, and of those
only ones that are shared by sets of different clusters, as the others would add nothing. The candidates' clusters are then verified exactly, by the shingles of the whole texts, as
``near_duplicates`` does with its own candidates: equal sets are one class, clusters are compared in blocks of bounded size,
and a bucket of more than ``BUCKET_ROWS`` classes is one cluster in no task as a whole.

At scale: texts are read twice and move once, those of clusters twice; what is shuffled is some 0.2 signatures per shingle of
different sets, of which the shared ones go on, in the first round a bounded number per set, in the second between clusters only.
Tables of signatures go when they are no longer read. Nothing is collected or broadcast.

Defined cases: documents without words, or null, have an empty set and link with nothing; fewer words than a
shingle are one shingle; rows that repeat a doc_id are linked each by its own text; the component's id is the smallest doc_id
in it, null if all are; an empty table gives no rows; other columns of the documents are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierwork.llm.components import components
from tierwork.llm.near_duplicates import Rule, arrays, by_groups, linked_parts, linked_rows, set_digests, shingle_sets
from tierwork.llm.rows import text_digest
from tierwork.llm.words import by_slices, lists, mix, signed
from tierwork.sources.work import remove, work_path, written

ALIKE = Rule(shingle=3, percent=90)
#: Equal words that linked sets have beyond the one they need.
SPARE = 2
#: Largest over smallest number of differences in a size band.
WIDTH = 1.25
#: Least bits of the sketch that candidates are compared by, and bits for each shingle that linked sets may differ in.
SKETCH_BITS = 512
BITS_PER_DIFFERENCE = 4
#: Parts of a band whose signatures are looked at first.
FIRST_PLACES = 4
BUCKET_ROWS = 1024

_SALTS = mix(np.arange(1, 4, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def differences(size: np.ndarray | int, percent: int):
    """In how many members a set of that size and a linked one, not smaller, differ at most."""
    return size * (100 - percent) // percent


def size_bands(most: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The smallest and the largest size of every band, up to one that holds ``most``. Smaller sets
    than those of the first band differ from no set they are linked with."""
    low, high = [], []
    size = -(-percent // (100 - percent))
    while not low or high[-1] < most:
        allowed = int(max(differences(size, percent), differences(size, percent) * WIDTH))
        low.append(size)
        # The largest size that allows no more.
        high.append(((allowed + 1) * percent - 1) // (100 - percent))
        size = high[-1] + 1
    return np.array(low), np.array(high)


def _owned(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes = np.array([len(x) for x in sets], np.int64)
    return np.concatenate(sets), sizes, np.repeat(np.arange(len(sets)), sizes)


def parity_words(
    hashes: np.ndarray, parts: np.ndarray, before: np.ndarray, count: int, bits: np.ndarray | None = None
) -> np.ndarray:
    """``count`` words of 64 bits: every hash turns its ``bits``, or one bit, of one of the ``parts`` words behind its
    ``before``."""
    part = ((hashes >> np.uint64(32)) * parts.astype(np.uint64)) >> np.uint64(32)
    words = np.zeros(count, np.uint64)
    if bits is None:
        bits = np.uint64(1) << (hashes & np.uint64(63))
    np.bitwise_xor.at(words, before + part.astype(np.int64), bits)
    return words


def signatures(sets: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The signatures of every set, one after the other, and how many each has. Those of the first parts are odd."""
    values, sizes, owner = _owned(sets)
    low, high = size_bands(int(sizes.max(initial=1)), percent)
    parts = differences(high, percent) + 1 + SPARE
    # The bands that meet the sizes of linked smaller sets, and its own.
    first = np.searchsorted(high, -(-sizes * percent // 100))
    last = np.searchsorted(low, sizes, "right") - 1
    hashed = mix(values ^ _SALTS[0])
    found, owners = [], []
    for step in range(int((last - first).max(initial=-1)) + 1):
        band = first + step
        given = band <= last
        count = np.where(given, parts[np.minimum(band, len(parts) - 1)], 0)
        before = np.append(0, np.cumsum(count))
        chosen = given[owner]
        who = owner[chosen]
        own = mix(hashed[chosen] + band[who].astype(np.uint64))
        words = parity_words(own, count[who], before[who], int(before[-1]), own)
        of = np.repeat(np.arange(len(sets)), count)
        place = np.arange(len(words)) - before[of]
        many_zeros = np.bincount(of[words == 0], minlength=len(sets)) > SPARE
        keep = (words != 0) | many_zeros[of]
        where = (band[of].astype(np.uint64) << np.uint64(32)) + place.astype(np.uint64)
        mixed = mix(words ^ mix(where ^ _SALTS[1])) & ~np.uint64(1)
        found.append((mixed | (place < FIRST_PLACES).astype(np.uint64))[keep])
        owners.append(of[keep])
    owners = np.concatenate(owners) if owners else np.zeros(0, np.int64)
    order = np.argsort(owners, kind="stable")
    all_found = np.concatenate(found) if found else np.zeros(0, np.uint64)
    return all_found[order], np.bincount(owners, minlength=len(sets))


def sketch_widths(sizes: np.ndarray, percent: int) -> np.ndarray:
    """How many words of 64 bits the sketches of sets of these sizes have, powers of two."""
    bits = np.maximum(BITS_PER_DIFFERENCE * 2 * sizes * (100 - percent) // (100 + percent), SKETCH_BITS)
    return SKETCH_BITS // 64 << np.ceil(np.log2(bits / SKETCH_BITS)).astype(np.int64)


def small_sketches(sets: list[np.ndarray], percent: int = ALIKE.percent) -> list[np.ndarray]:
    """The bits of parity of every set, as 64-bit words."""
    values, sizes, owner = _owned(sets)
    width = sketch_widths(sizes, percent)
    ends = np.cumsum(width)
    words = parity_words(mix(values ^ _SALTS[2]), width[owner], (ends - width)[owner], int(ends[-1]))
    return np.split(words, ends[:-1])


def sketches(documents: DataFrame, rule: Rule = ALIKE) -> DataFrame:
    """Per row a number of its own, ``doc_id``, a digest of its text, the size and a digest of its set, its
    ``signatures`` and its ``sketch``."""

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = shingle_sets(batch.column("text"), rule.shingle)
        digests = set_digests(sets)
        found, counts = signatures(sets, rule.percent)
        sketch = small_sketches(sets, rule.percent)
        return pa.RecordBatch.from_arrays(
            [
                *(batch.column(c) for c in ("row", "doc_id", "copy", "copy2")),
                pa.array([len(x) for x in sets], pa.int64()),
                *(pa.array(signed(x)) for x in digests),
                lists(pa.array(signed(found)), counts),
                lists(pa.array(signed(np.concatenate(sketch))), np.array([len(x) for x in sketch])),
            ],
            ["row", "doc_id", "copy", "copy2", "n_shingles", "digest", "digest2", "signatures", "sketch"],
        )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return by_slices(batches, "text", one)

    kind = documents.schema["doc_id"].dataType.simpleString()
    rows = documents.select(F.monotonically_increasing_id().alias("row"), "doc_id", *text_digest(), "text")
    return rows.mapInArrow(
        work,
        f"row bigint, doc_id {kind}, copy bigint, copy2 bigint, n_shingles bigint, digest bigint, digest2 bigint, "
        "signatures array<bigint>, sketch array<bigint>",
    )


def distances(sketches: list[np.ndarray]) -> np.ndarray:
    """In how many bits every two sketches differ. A word of half as many is the XOR of two neighbours."""
    widths = np.array([len(x) for x in sketches])
    distance = np.zeros((len(widths), len(widths)), np.int64)
    # Pairs of wider sketches are compared again, as wide as they are.
    for width in np.unique(widths):
        own = np.flatnonzero(widths >= width)
        folded = np.stack([np.bitwise_xor.reduce(sketches[x].reshape(width, -1), axis=1) for x in own])
        found = np.zeros((len(own), len(own)), np.int64)
        for column in folded.T:
            found += np.bitwise_count(column[:, None] ^ column[None, :])
        distance[np.ix_(own, own)] = found
    return distance


def may_link(sketches: list[np.ndarray], sizes: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs are no farther in their sketches, and in size, than linked sets are."""
    both = sizes[:, None] + sizes[None, :]
    return (distances(sketches) * (100 + percent) <= both * (100 - percent)) & (
        100 * np.minimum(sizes[:, None], sizes) >= percent * np.maximum(sizes[:, None], sizes)
    )


def _alike_in_bucket(group: pa.RecordBatch, percent: int) -> list[tuple[int, int]]:
    nodes = group.column("cls").to_numpy(zero_copy_only=False)
    if group.column("blocks")[0].as_py() > 1:
        centre = group.column("centre")[0].as_py()
        return [(centre, node) for node in nodes.tolist() if node != centre]
    sizes = group.column("n_shingles").to_numpy(zero_copy_only=False)
    part = linked_parts(may_link(arrays(group.column("sketch"), np.uint64), sizes, percent))
    return [(int(nodes[p]), int(node)) for p, node in zip(part, nodes) if nodes[p] != node]


def _links_in_buckets(classes: DataFrame, given: DataFrame, percent: int) -> DataFrame:
    """Links between classes that share a ``bucket`` of the ``given`` ones (``cls``, ``part``, ``bucket``) and may link. A
    bucket of classes of one part needs no comparison."""
    path = work_path(classes.sparkSession, "shared-signatures")
    own = Window.partitionBy("bucket")
    members = given.select(
        "bucket",
        "cls",
        F.count("*").over(own).alias("n"),
        F.min("cls").over(own).alias("centre"),
        (F.min("part").over(own) < F.max("part").over(own)).alias("several"),
    )
    members = written(members.filter("several").drop("several"), "shared-signatures", path)
    # Signatures with the same classes need one comparison only.
    buckets = members.groupBy("bucket", "n", "centre").agg(
        F.bit_xor(F.xxhash64("cls")).alias("mark"), F.bit_xor(F.xxhash64("cls", F.lit(1))).alias("mark2")
    )
    buckets = buckets.groupBy("n", "centre", "mark", "mark2").agg(F.min("bucket").alias("bucket")).select("bucket")
    members = members.join(buckets, "bucket").withColumn("blocks", F.ceil(F.col("n") / BUCKET_ROWS))
    members = members.join(classes.select("cls", "n_shingles", "sketch"), "cls")
    members = members.withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")))
    links = written(by_groups(members, ["bucket", "block"], partial(_alike_in_bucket, percent=percent)), "bucket-links")
    remove(classes.sparkSession, path)
    return links


def candidate_links(classes: DataFrame, rule: Rule = ALIKE) -> DataFrame:
    """Links ``a``, ``b`` between classes that share a signature and may link, directly or through others that share it, or
    through those that the first parts led to: as many as hold the clusters together."""
    few = F.expr("filter(signatures, x -> x % 2 <> 0)")
    given = classes.select("cls", F.col("cls").alias("part"), F.explode(few).alias("bucket"))
    first = _links_in_buckets(classes, given, rule.percent)
    parts = components(first).toDF("cls", "part")
    others = F.expr("filter(signatures, x -> x % 2 = 0)").alias("signatures")
    given = classes.select("cls", others).join(parts, "cls", "left")
    given = given.select("cls", F.coalesce("part", "cls").alias("part"), F.explode("signatures").alias("bucket"))
    return first.union(_links_in_buckets(classes, given, rule.percent))


def jaccard_components(documents: DataFrame, rule: Rule = ALIKE) -> DataFrame:
    """Per row ``doc_id``, ``n_shingles`` and ``component_id``, the smallest doc_id that links lead to."""
    found = linked_rows(documents, sketches(documents, rule), partial(candidate_links, rule=rule), rule)
    return found.select("doc_id", "n_shingles", "component_id")
