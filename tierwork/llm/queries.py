"""One query per operator of this package, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierwork.llm import (
    collocations,
    decontamination,
    languages,
    near_duplicates,
    parity,
    pieces,
    quality,
    repeats,
    resampling,
    sharding,
    toxicity,
    vantage,
    warc,
)

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sharding.interleaved(table(spark, sf_dir, "documents"), shards=24)
    return found.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.revisit_resolution(table(spark, sf_dir, "pages"))


def op4_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vantage.neighbours(table(spark, sf_dir, "embeddings"), every=20, k=20)


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    found = toxicity.scored(documents, toxicity.learned(documents, table(spark, sf_dir, "labels")))
    return found.select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
        "sentences",
    )


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    found = quality.scored(documents, quality.learned(documents, table(spark, sf_dir, "labels")))
    return found.select(
        "doc_id",
        quality.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return digests_of_pieces(documents, public_tokenizers.path("piece_bpe_32k.model"))


def digests_of_pieces(documents: DataFrame, model_path: str) -> DataFrame:
    with open(model_path, "rb") as file:
        found = pieces.encoded_and_decoded(documents, file.read())
    return found.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    found = languages.predicted(documents, languages.learned(documents))
    return found.select("doc_id", languages.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op10_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.deduplicated(table(spark, sf_dir, "documents"), lines=True)
    return found.select(
        "document.doc_id",
        "document.text",
        "n_units",
        "n_removed",
        "removed",
    )


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(
        table(spark, sf_dir, "documents"), longest=3, least=10, cover=50, best=2000
    )


def op12_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parity.jaccard_components(table(spark, sf_dir, "documents"))


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resampled(
        table(spark, sf_dir, "documents"),
        table(spark, sf_dir, "benchmark"),
        least_words=20,
        percent=10,
        seed=2024,
    )


def queries() -> dict[str, Query]:
    return {name: build for name, build in globals().items() if name.startswith("op")}
