"""The training corpus in five stages, each written as Parquet and read again by the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import decontaminate, language, neardup, packing, quality
from ledgerline.llm.queries import TOKENIZER
from ledgerline.llm.tables import free_name, version, without
from ledgerline.session import scratch_path, ship_package

#: Least cosine with the profile of the predicted language.
LEAST_COSINE = 0.1


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current policy keeps."""
    return quality.accepted(docs)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages that the labelled documents teach."""
    profiles = language.learn(docs)
    name = free_name(docs, "_language")
    found = docs.withColumn(name, language.predicted(profiles, docs["text"]))
    known = (F.col(name)["lang"] != language.UNKNOWN) & (F.col(name)["score"] >= LEAST_COSINE)
    return found.where(known).drop(name)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that fingerprints of three-word shingles link within three bits: the one with the smallest doc_id."""
    return neardup.survivors(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    keyed = docs.select(F.struct("doc_id", version(F.col("text")).alias("version")).alias("key"), "text")
    found = decontaminate.search(decontaminate.index(keyed, key="key"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return without(docs, found.where(F.size("matches") > 0).select("doc_id.*"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 4096 tokens with every source in its proportion."""
    return packing.pack(packing.encode_queues(docs, TOKENIZER, end=2))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", pack),
]

#: Language profiles, fingerprints and token ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
