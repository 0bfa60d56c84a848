"""A training corpus from the documents table: five stages, each over all that the one before kept.

``STAGES`` names them in order. A stage takes the session, the documents its predecessor kept and the
folder of the tables, and gives documents with the same columns; the last one gives the digests of the
token ids instead. ``run`` applies all of them to the documents table, writing each result to the
shared folder and reading it back, so that a lost executor costs a stage's work at most.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tierwork.llm import decontamination, languages, near_duplicates, repeats
from tierwork.llm.queries import digests_of_pieces
from tierwork.sources.work import written

#: Share of a document's n-grams that its language must know; prose of a learned language has nearly all.
LEAST_LANGUAGE_SHARE = 0.2


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones teach."""
    return languages.accepted(docs, languages.learned(docs), LEAST_LANGUAGE_SHARE)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near-duplicates."""
    return near_duplicates.without_near_duplicates(docs)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that earlier documents have, unless nothing is left of them."""
    return repeats.without_repeats(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.decontaminated(docs, items)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The number and digest of each document's token ids, and the digest of the text they give back."""
    return digests_of_pieces(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("language", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("substrings", substring_stage),
    ("decontamination", decontamination_stage),
    ("tokens", token_stage),
]

#: SQL can't express language filters, hashes of lines or the tokenizer; the tests compare with plain
#: Python versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
