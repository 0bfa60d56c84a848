"""Bounded samples of labelled documents, to fit classifiers on."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Longer texts are scored like all others, only nothing is learned from them.
LONGEST_BYTES = 32 << 10
#: Texts of a sample have so many bytes together at most.
SAMPLE_BYTES = 48 << 20


def crc_remainder(doc_id: Column, divisor: int) -> Column:
    """The remainder of the CRC-32 of the id as text."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(divisor))


def labelled(
    documents: DataFrame, labels: DataFrame, label: str, learn_from: Column, most: int
) -> tuple[pa.Array, np.ndarray]:
    """At most ``most`` labelled texts and their labels, of ``SAMPLE_BYTES`` bytes together at most. They are taken by
    a digest of the id from the ``labels`` that ``learn_from`` holds for; only their rows, which the bound makes few, are
    sent to the documents. The sizes come first, and only if they are too many, fewer ids are taken."""
    order = F.md5(F.concat(F.lit(f"{label}:"), F.col("doc_id").cast("string")))
    drawn = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & learn_from)
    drawn = drawn.orderBy(order, label).limit(most)
    drawn = drawn.select("doc_id", F.col(label).cast("int").alias("label"), order.alias("place"))
    texts = documents.select("doc_id", "text").filter(F.octet_length("text") <= LONGEST_BYTES)
    joined = texts.join(F.broadcast(drawn), "doc_id")
    sizes = joined.groupBy("place").agg(F.sum(F.octet_length("text")).alias("bytes")).orderBy("place").collect()
    upto, left = None, SAMPLE_BYTES
    for row in sizes:
        left -= row["bytes"]
        if left < 0:
            break
        upto = row["place"]
    if left < 0:
        joined = joined.filter(F.col("place") <= upto) if upto else joined.limit(0)
    found = joined.orderBy("doc_id", "text").limit(most)
    found = found.select("text", "label").toArrow().combine_chunks()
    text = found.column("text")
    text = text.combine_chunks() if isinstance(text, pa.ChunkedArray) else text
    if isinstance(text, pa.ChunkedArray):
        text = pa.concat_arrays(text.chunks) if text.num_chunks else pa.array([], pa.string())
    return text, found.column("label").to_numpy()
