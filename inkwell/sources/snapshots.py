"""Versions of a group of tables as Parquet, with a pointer to the one that counts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from inkwell.session import drop_path


class Snapshots:
    """Tables under a path that all executors share; a version of all of them counts once its pointer is written.

    Data of a version lie in a folder of their own, written first; then a pointer file with the version's number is created,
    which fails if there is one already. So a run that is killed leaves the version before it as it was, and of two
    runs on the same version one fails. Readers take the highest pointer that has its text.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._files = self._at("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}".rstrip("/"))

    def _pointers(self) -> dict[int, str]:
        """Versions that count and their folders."""
        if not self._files.exists(self._at("pointers")):
            return {}
        found = {}
        for status in self._files.listStatus(self._at("pointers")):
            stream = self._files.open(status.getPath())
            try:
                text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            finally:
                stream.close()
            if text.endswith("\n"):  # else its writer died
                found[int(status.getPath().getName())] = text.strip()
        return found

    def version(self) -> int | None:
        """The newest version, none before the first."""
        return max(self._pointers(), default=None)

    def read(self, table: str, version: int | None = None) -> DataFrame:
        """A table of a version, the newest if none is named."""
        folders = self._pointers()
        return self.spark.read.parquet(f"{self.path}/{folders[max(folders) if version is None else version]}/{table}")

    def commit(self, tables: dict[str, DataFrame], base: int | None) -> int:
        """Write the version after ``base``; it is an error if another run has done so."""
        folder = f"data-{uuid.uuid4().hex}"
        for name, frame in tables.items():
            frame.write.parquet(f"{self.path}/{folder}/{name}")
        names = [int(status.getPath().getName()) for status in self._files.listStatus(self._at("pointers"))] if self._files.exists(self._at("pointers")) else []
        if self.version() != base:
            drop_path(self.spark, f"{self.path}/{folder}")
            raise RuntimeError(f"{self.path} has changed since version {base}")
        version = max(names, default=0) + 1  # beyond pointers whose writer died
        stream = self._files.create(self._at(f"pointers/{version:012d}"), False)
        stream.write(bytearray(f"{folder}\n".encode()))
        stream.close()
        return version

    def keep(self, count: int) -> None:
        """Delete the data and pointers of all but the newest ``count`` versions."""
        folders = self._pointers()
        for version in sorted(folders)[: -max(1, count)]:
            drop_path(self.spark, f"{self.path}/pointers/{version:012d}")
            drop_path(self.spark, f"{self.path}/{folders[version]}")
