"""The registered queries of this subpackage, one for each operator, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the test data."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode every document."""
    import public_tokenizers

    from inkwell.llm.bpe import encode_documents

    return encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), keep_ids=False)


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License places and labels of every document."""
    from inkwell.llm.licenses import scan

    return scan(table(spark, sf_dir, "documents"))


def op3_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate vectors."""
    from inkwell.llm.vectors import near_duplicates

    return near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.9)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pack every document into sequences of 2048 tokens."""
    import public_tokenizers

    from inkwell.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity and verdict of every document."""
    from inkwell.llm.quality import perplexities

    return perplexities(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score every document by a hidden Markov model."""
    from inkwell.llm.hmm import score

    return score(table(spark, sf_dir, "documents"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document."""
    from inkwell.llm.secrets import scan

    return scan(table(spark, sf_dir, "documents"))


def op8_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    from inkwell.llm.html import extract

    return extract(table(spark, sf_dir, "pages"))


def op9_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store every document as an image, read it back, compute features."""
    from inkwell.llm.media import round_trip

    return round_trip(table(spark, sf_dir, "documents"))


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of every document."""
    from inkwell.llm.minhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85)


def op11_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of every vector by codebooks of its parts."""
    from inkwell.llm.codes import compress

    return compress(table(spark, sf_dir, "embeddings"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened components of every vector."""
    from inkwell.llm.whitening import whiten

    return whiten(table(spark, sf_dir, "embeddings"))


def op13_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest rows of the rows whose id is divisible by 50."""
    from inkwell.llm.forest import neighbours

    return neighbours(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_licenses": op2_licenses,
    "op3_vectors": op3_vectors,
    "op4_packing": op4_packing,
    "op5_quality": op5_quality,
    "op6_hmm": op6_hmm,
    "op7_secrets": op7_secrets,
    "op8_html": op8_html,
    "op9_media": op9_media,
    "op10_minhash": op10_minhash,
    "op11_codes": op11_codes,
    "op12_whitening": op12_whitening,
    "op13_neighbours": op13_neighbours,
}

ORACLE_SQL: dict[str, str] = {}
