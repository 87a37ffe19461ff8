"""Queries for encodings: documents, with letters turned into ideographs, are encoded and have to be recognised."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.plans.registry import query, table
from inkwell.sources import encodings as E

#: What the documents are encoded in.
USED = ("utf-8", "utf-8-sig", "gb18030", "big5", "utf-16-le")
_LETTERS, _SIGNS = "abcdefghijklmnopqrstuvwxyz", "的一是不了人我在有他中大上小方成心山水火木金土日月工"


def _encoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document in each encoding: doc_id, used, content; signs that an encoding lacks become question marks."""

    @F.pandas_udf("binary")
    def encode(text: pd.Series, name: pd.Series) -> pd.Series:
        return pd.Series([value.encode(used, "replace") for value, used in zip(text, name, strict=True)])

    signs = F.translate(F.lower(F.coalesce("text", F.lit(""))), _LETTERS, _SIGNS)
    once = table(spark, sf_dir, "documents").select("doc_id", signs.alias("text"))  # before there are five rows of each
    docs = once.select("doc_id", "text", F.explode(F.array(*map(F.lit, USED))).alias("used"))
    return docs.select("doc_id", "used", encode("text", "used").alias("content"))


@query()
def encoding_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SC7: encoding, confidence and margin of every document in five encodings; tests hold them against a plain version."""
    return _encoded(spark, sf_dir).withColumn("d", E.file_encoding(F.col("content"))).select("doc_id", "used", "d.*")


@query()
def body_encodings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SC8: the encoding of every document as a response whose header names it, names a wrong one, or none."""
    header = F.when(F.col("used") == "gb18030", "text/html; charset=GB18030").when(F.col("used") == "big5", "text/html; charset=ascii").otherwise("text/html")
    return _encoded(spark, sf_dir).select("doc_id", "used", E.body_encoding(F.col("content"), header).alias("encoding"))


@query()
def whole_encodings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SC9: the best guess on the whole of every document in five encodings."""
    return _encoded(spark, sf_dir).select("doc_id", "used", E.whole_encoding("content").alias("encoding"))
