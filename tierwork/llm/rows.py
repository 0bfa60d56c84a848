"""Rows told apart by id and text, where ids may be null or repeat."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def text_digest() -> list[Column]:
    """128 bits of the text, as ``copy`` and ``copy2``."""
    return [F.xxhash64("text").alias("copy"), F.xxhash64(F.lit(1), "text").alias("copy2")]


def without_rows(documents: DataFrame, gone: DataFrame) -> DataFrame:
    """The documents, with all their columns, but for the rows of an id and a text that ``gone``
    (``doc_id``, ``copy``, ``copy2``) has."""
    whole = F.struct(*(documents[c] for c in documents.columns)).alias("document")
    rows = documents.select(whole, documents["doc_id"].alias("own_id"), *text_digest())
    gone = gone.distinct().toDF("gone_id", "gone_copy", "gone_copy2")
    same = (
        rows["own_id"].eqNullSafe(gone["gone_id"])
        & (rows["copy"] == gone["gone_copy"])
        & (rows["copy2"] == gone["gone_copy2"])
    )
    return rows.join(gone, same, "left_anti").select("document.*")
