"""Zip archives and books in EPUB: inventory, safety, sections."""

from __future__ import annotations

import io
import posixpath
import zipfile
from collections.abc import Iterator
from urllib.parse import unquote
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.sources.html import section

# Limits of an archive.
MOST_MEMBERS, MOST_BYTES, MOST_MEMBER_BYTES, MOST_RATIO = 20_000, 2 << 30, 256 << 20, 200


def read_files(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """Files below a root with path, size, time and content."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)


def members(files: DataFrame) -> DataFrame:
    """One row per archive member: path, name, size, packed, encrypted, symlink; name is null for a broken archive."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for path, content in zip(frame["path"], frame["content"], strict=True):
                try:
                    with zipfile.ZipFile(io.BytesIO(content)) as archive:
                        rows += [(path, i.filename, i.file_size, i.compress_size, bool(i.flag_bits & 1), (i.external_attr >> 16) & 0o170000 == 0o120000) for i in archive.infolist()]
                except zipfile.BadZipFile:
                    rows.append((path, None, 0, 0, False, False))
            yield pd.DataFrame(rows, columns=["path", "name", "size", "packed", "encrypted", "symlink"])

    return files.select("path", "content").mapInPandas(run, "path string, name string, size long, packed long, encrypted boolean, symlink boolean")


def unsafe_name() -> Column:
    """Whether a member's name leaves the archive's folder."""
    return F.col("name").rlike(r"^/|^[A-Za-z]:|\\|(^|/)\.\.(/|$)|\x00")


def archive_issues(inventory: DataFrame) -> DataFrame:
    """path and issues of each archive, an empty array where it is safe."""
    ratio = F.when(F.col("packed") > 0, F.col("size") / F.col("packed")).otherwise(0)
    named = inventory.groupBy("path").agg(
        F.count("*").alias("members"), F.sum("size").alias("size"), F.max("size").alias("largest"), F.max(ratio).alias("ratio"), F.bool_or("encrypted").alias("encrypted"), F.bool_or("symlink").alias("symlink"),
        F.bool_or(unsafe_name()).alias("unsafe"), F.countDistinct("name").alias("names"), F.bool_or(F.col("name").isNull()).alias("broken"),
    )
    issue = lambda test, name: F.when(test, name)
    return named.select(
        "path",
        F.array_compact(
            F.array(
                issue(F.col("broken"), "broken"), issue(F.col("members") > MOST_MEMBERS, "members"), issue(F.col("size") > MOST_BYTES, "size"), issue(F.col("largest") > MOST_MEMBER_BYTES, "member_size"),
                issue(F.col("ratio") > MOST_RATIO, "ratio"), issue(F.col("encrypted"), "encrypted"), issue(F.col("symlink"), "symlink"), issue(F.col("unsafe"), "unsafe_path"), issue(~F.col("broken") & (F.col("names") < F.col("members")), "repeated_path"),
            )
        ).alias("issues"),
    )


def _tag(element: ElementTree.Element) -> str:
    return element.tag.rpartition("}")[2]


def book_sections(content: bytes) -> list[tuple[int, str, str]]:
    """(order, title, text) of an EPUB's spine; ValueError for one that is encrypted or broken."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        names = set(book.namelist())
        if "META-INF/encryption.xml" in names:
            raise ValueError("encrypted")
        container = ElementTree.fromstring(book.read("META-INF/container.xml"))
        package = next(e.attrib["full-path"] for e in container.iter() if _tag(e) == "rootfile")
        base = posixpath.dirname(package)
        root = ElementTree.fromstring(book.read(package))
        items = {e.attrib["id"]: e.attrib for e in root.iter() if _tag(e) == "item"}
        resolve = lambda href: posixpath.normpath(posixpath.join(base, unquote(href.partition("#")[0])))
        titles: dict[str, str] = {}
        for item in items.values():
            if item.get("media-type") == "application/x-dtbncx+xml" and resolve(item["href"]) in names:
                for point in ElementTree.fromstring(book.read(resolve(item["href"]))).iter():
                    if _tag(point) == "navPoint":
                        label = next(("".join(e.itertext()).strip() for e in point.iter() if _tag(e) == "navLabel"), "")
                        target = next((e.attrib.get("src", "") for e in point.iter() if _tag(e) == "content"), "")
                        titles.setdefault(resolve(target), label)
        found = []
        for reference in (e for e in root.iter() if _tag(e) == "itemref"):
            path = resolve(items[reference.attrib["idref"]]["href"])
            title, text = section(book.read(path).decode("utf-8", "replace"), titles.get(path), len(found) + 1)
            if text:
                found.append((len(found) + 1, title, text))
        return found


def books(files: DataFrame) -> DataFrame:
    """path, order, title, text of every section; error tells why a book has none."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for path, content in zip(frame["path"], frame["content"], strict=True):
                try:
                    rows += [(path, *part, None) for part in book_sections(content)]
                except (ValueError, KeyError, StopIteration, zipfile.BadZipFile, ElementTree.ParseError) as error:
                    rows.append((path, None, None, None, str(error) or type(error).__name__))
            yield pd.DataFrame(rows, columns=["path", "order", "title", "text", "error"]).astype({"order": "Int64"})

    return files.select("path", "content").mapInPandas(run, "path string, order long, title string, text string, error string")
