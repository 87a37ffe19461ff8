"""Media columns: archives of lossless images behind a Spark data source.

Texts become payloads, payloads 8-bit greyscale PNG images, 64 samples wide, one
byte a sample. Executors write the images as members of tar archives in the shared
folder; the last member of an archive lists the offsets of all others, under a
checksum. The data source ``media_archive`` plans byte ranges over the archives: a
range owns the members whose headers begin in it and streams them in Arrow batches. A
member is found by its offset alone, so a read that fails is tried again for that
member and not for the archive. A member, list or archive that stays unreadable,
whatever is damaged, missing or cut off, raises: no row is lost silently.

Results on unusual rows: a null or empty text has the payload of 64 zero bytes;
equal texts have equal values; a null id and repeated ids are carried along, as the
id travels inside the member; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
import json
import math
import struct
import tarfile
import time
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from inkwell.session import fresh_path

#: Samples in a row of an image; payloads are padded to a multiple of it.
WIDTH = 64
#: Bytes of a planned range, payload bytes in an Arrow batch, and reads of a member before giving up.
RANGE, BATCH, TRIES = 32 << 20, 8 << 20, 4

_HEAD = 512
_LIST = ".offsets"
#: Behind the offsets: how many there are, and the hash of them and their number.
_TRAILER = struct.Struct("<Q32s")
_SIGNATURE = b"\x89PNG\r\n\x1a\n"


def payload_of(text: str | None) -> bytes:
    """UTF-8 bytes and zeros up to a positive multiple of WIDTH."""
    raw = (text or "").encode()
    return raw + bytes(max(WIDTH, -(-len(raw) // WIDTH) * WIDTH) - len(raw))


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def encode_image(payload: bytes) -> bytes:
    """A greyscale PNG whose samples are the payload."""
    rows = np.zeros((len(payload) // WIDTH, WIDTH + 1), np.uint8)  # a filter byte, none, before each row
    rows[:, 1:] = np.frombuffer(payload, np.uint8).reshape(-1, WIDTH)
    head = struct.pack(">IIBBBBB", WIDTH, len(rows), 8, 0, 0, 0, 0)
    return _SIGNATURE + _chunk(b"IHDR", head) + _chunk(b"IDAT", zlib.compress(rows.tobytes(), 1)) + _chunk(b"IEND", b"")


def decode_image(image: bytes) -> bytes:
    """The samples of an 8-bit greyscale PNG without row filters, with all checksums held."""
    if image[:8] != _SIGNATURE:
        raise ValueError("no PNG signature")
    at, data, size = 8, b"", (0, 0)
    while at < len(image):
        length, kind = struct.unpack(">I4s", image[at : at + 8])
        body = image[at + 8 : at + 8 + length]
        if struct.unpack(">I", image[at + 8 + length : at + 12 + length])[0] != zlib.crc32(kind + body):
            raise ValueError("chunk checksum")
        if kind == b"IHDR":
            size = struct.unpack(">II", body[:8])
        elif kind == b"IDAT":
            data += body
        at += 12 + length
    rows = np.frombuffer(zlib.decompress(data), np.uint8).reshape(size[1], size[0] + 1)
    if rows[:, 0].any():
        raise ValueError("row filters aren't supported")
    return rows[:, 1:].tobytes()


def feature_of(payload: bytes) -> str:
    """Image features: height, mean, deviation, entropy of the samples in bits, mean step between samples."""
    samples = np.frombuffer(payload, np.uint8)
    share = np.bincount(samples, minlength=256) / len(samples)
    some = share[share > 0]
    mean = float((share * np.arange(256)).sum())
    deviation = math.sqrt(max(0.0, float((share * np.arange(256) ** 2).sum()) - mean * mean))
    step = float(np.abs(np.diff(samples.astype(np.int16))).mean())
    return f"h={len(samples) // WIDTH};mean={mean:.4f};dev={deviation:.4f};bits={-(some * np.log2(some)).sum():.4f};step={step:.4f}"


def _store(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))


def write_archives(docs: DataFrame, path: str) -> DataFrame:
    """Write one archive per task to ``path``; rows (archive, members, bytes), once they are in place.

    An archive is written under a name of its own attempt and renamed at the end,
    so a task that runs again leaves one whole archive.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context = TaskContext.get()
        store, folder = _store(path)
        name = f"part-{context.partitionId():06d}.tar"
        attempt = f"{folder}/_{name}.{context.taskAttemptId()}"
        members = 0
        store.create_dir(folder, recursive=True)
        with store.open_output_stream(attempt) as raw:
            # A plain writer: tarfile asks for positions that output streams of stores may lack.
            offsets, at = array("Q"), 0
            for batch in batches:
                for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    payload = payload_of(text)
                    image = encode_image(payload)
                    info = tarfile.TarInfo(f"{context.partitionId():06d}/{members:09d}.png")
                    info.size = len(image)
                    # The id and the unpadded size travel in fields that the format leaves free.
                    info.linkname = json.dumps([key, len((text or "").encode())])
                    raw.write(info.tobuf(tarfile.USTAR_FORMAT))
                    raw.write(image)
                    raw.write(bytes(-len(image) % _HEAD))
                    members += 1
                    offsets.append(at)
                    at += 2 * _HEAD + (len(image) - 1) // _HEAD * _HEAD
            listed = offset_list(np.frombuffer(offsets, np.uint64))
            info = tarfile.TarInfo(_LIST)
            info.size = len(listed)
            raw.write(info.tobuf(tarfile.USTAR_FORMAT) + listed + bytes(2 * _HEAD))
        store.move(attempt, f"{folder}/{name}")
        size = store.get_file_info(f"{folder}/{name}").size
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([members], pa.int64()), pa.array([size], pa.int64())], ["archive", "members", "bytes"])

    return docs.mapInArrow(run, "archive string, members long, bytes long")


def offset_list(offsets: np.ndarray) -> bytes:
    """The offsets, zeros, and the trailer, in whole blocks."""
    body = offsets.astype("<u8").tobytes()
    trailer = _TRAILER.pack(len(offsets), hashlib.sha256(body + len(offsets).to_bytes(8, "little")).digest())
    return body + bytes(-(len(body) + len(trailer)) % _HEAD) + trailer


class ByteRange(InputPartition):
    """The members of an archive whose headers begin in [start, end)."""

    def __init__(self, archive: str, start: int, end: int):
        self.archive, self.start, self.end = archive, start, end


class MediaArchive(DataSource):
    """``spark.read.format("media_archive").load(folder)``: members of tar archives by byte ranges."""

    @classmethod
    def name(cls) -> str:
        return "media_archive"

    def schema(self) -> str:
        return "doc_key long, n_bytes long, archive string, offset long, image binary"

    def reader(self, schema) -> MediaReader:  # noqa: ANN001
        return MediaReader(self.options)


class MediaReader(DataSourceReader):
    """Plans ranges on the driver; reads members on the executors."""

    def __init__(self, options):  # noqa: ANN001
        self.options = dict(options)
        self.path = options["path"]
        self.range = int(options.get("rangeBytes", RANGE))
        self.tries = int(options.get("tries", TRIES))

    def partitions(self) -> list[ByteRange]:
        store, folder = _store(self.path)
        found = store.get_file_info(pyarrow.fs.FileSelector(folder, allow_not_found=True))
        archives = sorted((x.base_name, x.size) for x in found if x.is_file and x.base_name.endswith(".tar") and x.base_name[0] != "_")
        for expected, seen in (("archives", len(archives)), ("bytes", sum(size for _, size in archives))):
            if expected in self.options and int(self.options[expected]) != seen:
                raise OSError(f"{self.path}: {expected} are {seen}, not {self.options[expected]}")
        return [ByteRange(name, start, min(start + self.range, size)) for name, size in archives for start in range(0, size, self.range)] or [ByteRange("", 0, 0)]

    def _tried(self, path: str, read):  # noqa: ANN001, ANN202
        """What ``read`` gives for the newly opened file, tried again after a failure."""
        store, inside = _store(path)
        for attempt in range(self.tries):
            try:
                with store.open_input_file(inside) as file:
                    return read(file)
            except (OSError, ValueError, IndexError, zlib.error, struct.error, tarfile.TarError) as error:
                if attempt + 1 == self.tries:
                    raise OSError(f"{path}: {type(error).__name__} {error}") from error
                time.sleep(0.2 * 2**attempt)
        raise AssertionError

    def offsets(self, path: str) -> np.ndarray:
        """Where the members begin, and at the end where the list itself does."""

        def read(file) -> np.ndarray:  # noqa: ANN001
            end = file.size() - 2 * _HEAD
            file.seek(end - _TRAILER.size)
            count, digest = _TRAILER.unpack(file.read(_TRAILER.size))
            size = -(-(8 * count + _TRAILER.size) // _HEAD) * _HEAD
            if size + _HEAD > end:
                raise ValueError("no list of offsets")
            file.seek(end - size)
            body = file.read(8 * count)
            if hashlib.sha256(body + count.to_bytes(8, "little")).digest() != digest:
                raise ValueError("the list of offsets is damaged")
            return np.append(np.frombuffer(body, "<u8").astype(np.int64), end - size - _HEAD)

        return self._tried(path, read)

    @staticmethod
    def member(block: bytes) -> tuple[int | None, int, bytes]:
        """The id, unpadded size and image of one member's bytes, checked."""
        info = tarfile.TarInfo.frombuf(block[:_HEAD], "utf-8", "strict")
        image = block[_HEAD : _HEAD + info.size]
        if _HEAD + -(-info.size // _HEAD) * _HEAD != len(block):
            raise ValueError("a member of another size")
        key, n_bytes = json.loads(info.linkname)
        decode_image(image)
        return key, n_bytes, image

    def read(self, partition: ByteRange) -> Iterator[pa.RecordBatch]:
        if not partition.archive:
            return
        path = f"{self.path.rstrip('/')}/{partition.archive}"
        bounds = self.offsets(path)
        first, last = np.searchsorted(bounds[:-1], [partition.start, partition.end])
        keys, sizes, offsets, images, held = [], [], [], [], 0
        window, window_at = b"", 0
        for at, end in zip(bounds[first:last].tolist(), bounds[first + 1 : last + 1].tolist(), strict=True):
            if at < window_at or end > window_at + len(window):

                def stretch(file, at: int = at, size: int = max(end - at, 4 << 20)) -> bytes:  # noqa: ANN001
                    file.seek(at)
                    return file.read(size)

                window, window_at = self._tried(path, stretch), at
            try:
                key, n_bytes, image = self.member(window[at - window_at : end - window_at])
            except (ValueError, IndexError, zlib.error, struct.error, tarfile.TarError):

                def alone(file, at: int = at, size: int = end - at) -> tuple:  # noqa: ANN001
                    file.seek(at)
                    return self.member(file.read(size))

                key, n_bytes, image = self._tried(path, alone)
            keys.append(key)
            sizes.append(n_bytes)
            offsets.append(at)
            images.append(image)
            held += len(image)
            if held >= BATCH:
                yield self._batch(partition.archive, keys, sizes, offsets, images)
                keys, sizes, offsets, images, held = [], [], [], [], 0
        if keys:
            yield self._batch(partition.archive, keys, sizes, offsets, images)

    @staticmethod
    def _batch(archive: str, keys: list, sizes: list, offsets: list, images: list) -> pa.RecordBatch:
        count = len(keys)
        return pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.int64()), pa.array(sizes, pa.int64()), pa.array([archive] * count), pa.array(offsets, pa.int64()), pa.array(images, pa.binary())],
            ["doc_key", "n_bytes", "archive", "offset", "image"],
        )


def media_features(members: DataFrame) -> DataFrame:
    """Digests and features of members that the data source gave."""
    schema = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for image in batch.column(2).to_pylist():
                payload = decode_image(image)
                rows.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(image), hashlib.sha256(image).hexdigest(), feature_of(payload)))
            columns = list(zip(*rows, strict=True)) or [()] * 6
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"],
            )

    return members.select("doc_key", "n_bytes", "image").mapInArrow(run, schema)


def store_media(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> dict[str, int]:
    """Write the archives of all texts; how many archives, members and bytes there are."""
    source = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    total = lambda name: F.coalesce(F.sum(name), F.lit(0)).alias(name)
    return write_archives(source, path).agg(F.count("*").alias("archives"), total("members"), total("bytes")).first().asDict()


def read_media(spark: SparkSession, path: str, **options: object) -> DataFrame:
    """The members of the archives in a folder.

    With the options ``archives`` and ``bytes``, as ``store_media`` gives them, a folder that
    holds other archives raises.
    """
    spark.dataSource.register(MediaArchive)
    return spark.read.format("media_archive").options(**{k: str(v) for k, v in options.items()}).load(path)


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Store every text as an image, read the stored bytes back and compute features: one row per document."""
    path = fresh_path(docs.sparkSession, "media")
    stored = store_media(docs, path, id_col, text_col)
    return media_features(read_media(docs.sparkSession, path, archives=stored["archives"], bytes=stored["bytes"]))
