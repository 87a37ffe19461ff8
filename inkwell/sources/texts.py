"""Text files: discovery, encodings, JSON lines, sinks."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Encodings that are tried in order. Fixed values.
ENCODINGS = ("utf-8", "gb18030", "big5")
#: Fractions of a file at which sample windows lie. Fixed values.
SAMPLES = (0.0, 0.18, 0.38, 0.62, 0.82, 1.0)


def discover(spark: SparkSession, root: str, archive_root: str | None = None, pattern: str = "*.txt") -> DataFrame:
    """path, modified, size of text files, without what lies below ``archive_root``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
    found = files.select("path", F.col("modificationTime").alias("modified"), F.col("length").alias("size"))
    return found.where(~F.col("path").contains(archive_root)) if archive_root else found


def scan_status(modified: Column, now: Column, chars: Column, replaced: Column, stable_seconds: int = 600, least_chars: int = 100) -> Column:
    """unstable for young files, quarantine where signs were lost, invalid for short texts, else ok."""
    return (
        F.when(F.unix_timestamp(now) - F.unix_timestamp(modified) < stable_seconds, "unstable")
        .when(replaced > 0, "quarantine").when(chars < least_chars, "invalid").otherwise("ok")
    )


def bom(content: Column) -> Column:
    """The encoding that a byte order mark names, or null."""
    head = F.hex(F.substring(content, 1, 3))
    return F.when(head.startswith("EFBBBF"), "utf-8-sig").when(head.startswith("FFFE"), "utf-16-le").when(head.startswith("FEFF"), "utf-16-be")


def sample_windows(content: Column, size: int = 4096) -> Column:
    """Byte windows at fixed fractions of a file."""
    room = F.greatest(F.octet_length(content) - size, F.lit(0))
    return F.array(*[F.substring(content, (F.floor(room * f) + 1).cast("int"), F.lit(size)) for f in SAMPLES])


def decoded(files: DataFrame, content: str = "content") -> DataFrame:
    """Adds text and encoding: the first of ENCODINGS that decodes strictly, else latin-1."""
    schema = T.StructType([T.StructField("text", T.StringType()), T.StructField("encoding", T.StringType())])

    @F.pandas_udf(schema)
    def decode(values: pd.Series) -> pd.DataFrame:
        rows = []
        for raw in values:
            marked = {b"\xff\xfe": "utf-16-le", b"\xfe\xff": "utf-16-be"}.get(bytes(raw or b"")[:2])
            for name in (*([marked] if marked else ()), *ENCODINGS, "latin-1"):
                try:
                    rows.append((bytes(raw or b"").decode(name).removeprefix("﻿"), name))
                    break
                except UnicodeDecodeError:
                    continue
        return pd.DataFrame(rows, columns=["text", "encoding"])

    made = files.withColumn("__decoded", decode(F.col(content)))
    return made.select(*files.columns, "__decoded.text", "__decoded.encoding")


def read_json_lines(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """Good rows, and malformed lines as they are."""
    raw = spark.read.text(path)
    parsed = raw.withColumn("r", F.from_json("value", f"{schema}, _bad string", {"columnNameOfCorruptRecord": "_bad"}))
    bad = F.col("r").isNull() | F.col("r._bad").isNotNull()
    return parsed.where(~bad).select("r.*").drop("_bad"), parsed.where(bad & (F.trim("value") != "")).select("value")


def write_json_lines(rows: DataFrame, path: str, *order: str) -> None:
    """One JSON object a line, in order within and across files; Spark's commit makes it whole or absent."""
    (rows.orderBy(*order) if order else rows).write.mode("overwrite").json(path)
