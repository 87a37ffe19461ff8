"""Queries over the test tables, one for each operator, with DuckDB SQL of the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Callable], Callable]:
    """Register a query under its function's name, with its SQL if there is any."""

    def register(function: Callable) -> Callable:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLE_SQL[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the test data."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("SELECT sha256(text) AS text_hash, doc_id, count(*) OVER (PARTITION BY sha256(text)) AS n_docs FROM documents WHERE text IS NOT NULL QUALIFY n_docs > 1")
def exact_dup_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG2: documents that share a content hash, a row for each; null texts share none."""
    docs = table(spark, sf_dir, "documents").where("text IS NOT NULL").select("doc_id", F.sha2("text", 256).alias("text_hash"))
    repeated = docs.groupBy("text_hash").agg(F.count("*").alias("n_docs")).where("n_docs > 1")
    return docs.join(repeated, "text_hash").select("text_hash", "doc_id", "n_docs")
