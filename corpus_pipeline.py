"""A pipeline over documents: quality, near duplicates, secrets, packing.

Each stage takes (spark, docs, sf_dir) and what its predecessor kept; all but the
last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.llm.minhash import near_duplicates
from inkwell.llm.packing import pack
from inkwell.llm.quality import filter_quality
from inkwell.llm.secrets import redact
from inkwell.session import stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps."""
    return filter_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, the one with the smallest id; rows without id stay.

    Where rows repeat an id they are told apart by a row number, so that different texts of one id are
    different documents, and of equal rows with words one stays.
    """
    node = "node".ljust(max(map(len, docs.columns)) + 1, "_")  # longer than any column's name
    repeated = docs.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1")
    if repeated.isEmpty():
        found = near_duplicates(docs, words=5, percent=80)
        dropped = found.where("doc_id IS NOT NULL AND NOT kept").select("doc_id")
        return docs.join(dropped, "doc_id", "left_anti").select(*[f"`{name}`" for name in docs.columns])
    number = F.when(F.col("doc_id").isNotNull(), F.monotonically_increasing_id())
    # Written, so that a repeated task gives a row no other number.
    rows = stored(docs.withColumn(node, number), "numbered")
    found = stored(near_duplicates(rows, words=5, percent=80, id_col=node).where("doc_id IS NOT NULL"), "near-duplicates")
    found = found.withColumnRenamed("doc_id", node).join(rows.select(F.col("doc_id"), node), node)
    first = found.groupBy("component_id").agg(F.min(F.struct("doc_id", node)).getField(node).alias(node))
    kept = rows.join(first.select(node), node, "left_semi").unionByName(rows.where("doc_id IS NULL"))
    return kept.select(*[f"`{name}`" for name in docs.columns])


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts masked and n_chars to match."""
    masked = redact(docs)
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else masked


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_duplicates", deduplicate),
    ("secrets", secrets),
    ("packing", packing),
]

#: The stages rest on models and tokenizers, which SQL can't express; tests hold them against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents, each to what its predecessor wrote."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
