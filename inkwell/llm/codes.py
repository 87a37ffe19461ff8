"""Vector code compression: codebooks by Lloyd rounds over heaps.

Vectors become integers and are cut in equal parts; each part position has a codebook of its own. Every vector part
stands in the heap of its nearest entry, in the block of vectors that one task reads. Its key is the lower bound of
the distance to any other entry minus the upper bound of the distance to its own, plus the drift that the entry's
heap had gathered by then. A round moves the entries, which adds to each heap's drift the way of its own entry and
the longest way of another; parts whose key the drift has passed may have changed their nearest entry. These alone
are popped and compared with all entries, exactly, in integers. What is left in a heap is sure to be where it was.

Blocks with their heaps are written to the shared folder after each round and the round before is deleted, so a lost
executor costs its own tasks. Of a round the driver gets one number for each component of each entry.

Results on unusual rows: a vector that is null or holds null or non-finite components is left out; an empty vector
counts as zeros, and so does what a vector lacks to the longest one's length, or that one to a multiple of ``parts``.
A null id is kept and listed last when codebooks start. Components beyond the bound that keeps squared distances in 63
bits (2 ** 27 after scaling at 64 components) count as that bound. With fewer rows than entries the codebooks are
as long as there are rows. Repeated rows count as often as they stand there. A label error beyond 63 bits is null.
An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.session import drop_stored, stored

#: Vectors in a block, whose heaps are one row of the table between rounds.
BLOCK = 1_024
#: Bounds are square roots in double precision; a slack below this counts as none. Part distances stay below 2 ** 31.
CLOSE = 1e-3


def finite(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def matrix(column: pa.Array, width: int, fill: float = 0) -> np.ndarray:
    """Rows of a list column, filled up to ``width``."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    lengths = np.asarray(column.value_lengths())
    if len(lengths) and (lengths == width).all():
        return flat.reshape(-1, width)
    rows = np.full((len(column), width), fill, flat.dtype)
    rows[np.arange(width)[None, :] < lengths[:, None]] = flat
    return rows


def integers(rows: np.ndarray, scale: int) -> np.ndarray:
    """The floor of each scaled component, within what keeps squared distances in 63 bits."""
    most = 2.0 ** ((62 - int(rows.shape[1] - 1).bit_length()) // 2 - 1)
    with np.errstate(over="ignore"):
        return np.clip(np.floor(rows * float(scale)), -most, most).astype(np.int64)


def nearest(part: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of each part, ties to the lower index, and how much farther the next one is."""
    away = ((part[:, None, :] - book[None, :, :]) ** 2).sum(2)
    near = away.argmin(1)
    own = np.sqrt(away[np.arange(len(part)), near].astype(float))
    away[np.arange(len(part)), near] = np.iinfo(np.int64).max
    return near, (np.sqrt(away.min(1).astype(float)) if away.shape[1] > 1 else np.inf) - own


class Block:
    """A block of vectors, the heaps of their parts, and the count and sums of each entry."""

    def __init__(self, x: np.ndarray, parts: int, entries: int):
        self.x = x.reshape(len(x), parts, -1)
        self.heaps: list[list[list[tuple[float, int]]]] = [[[] for _ in range(entries)] for _ in range(parts)]
        self.sums = np.zeros((parts, entries, 1 + self.x.shape[2]), np.int64)

    def place(self, part: int, rows: np.ndarray, books: np.ndarray, drift: np.ndarray) -> None:
        """Put parts in the heaps of their nearest entries."""
        if not len(rows):
            return
        near, slack = nearest(self.x[rows, part], books[part])
        np.add.at(self.sums[part], near, np.hstack([np.ones((len(rows), 1), np.int64), self.x[rows, part]]))
        for row, entry, key in zip(rows.tolist(), near.tolist(), (slack + drift[part, near]).tolist(), strict=True):
            heapq.heappush(self.heaps[part][entry], (key, row))

    def settle(self, books: np.ndarray, drift: np.ndarray) -> None:
        """Pop the parts whose bounds the drift has passed, and place them anew."""
        for part, heaps in enumerate(self.heaps):
            loose = []
            for entry, heap in enumerate(heaps):
                passed = drift[part, entry] + CLOSE
                first = len(loose)
                while heap and heap[0][0] <= passed:
                    loose.append(heapq.heappop(heap)[1])
                gone = np.array(loose[first:], np.int64)
                self.sums[part, entry, 0] -= len(gone)
                self.sums[part, entry, 1:] -= self.x[gone, part].sum(0)
            self.place(part, np.array(loose, np.int64), books, drift)

    def codes(self) -> np.ndarray:
        found = np.zeros(self.x.shape[:2], np.uint8)
        for part, heaps in enumerate(self.heaps):
            for entry, heap in enumerate(heaps):
                found[[row for _, row in heap], part] = entry
        return found

    def columns(self) -> list[pa.Array]:
        """The block as a row: its integers in as few bytes as hold them, and its heaps one after another."""
        kind = next(k for k in (np.int16, np.int32, np.int64) if not self.x.size or np.abs(self.x).max() <= np.iinfo(k).max)
        heaps = [heap for of_part in self.heaps for heap in of_part]
        flat = [item for heap in heaps for item in heap]
        held = (
            self.x.astype(kind), np.array([key for key, _ in flat]), np.array([row for _, row in flat], np.uint16),
            np.array([len(heap) for heap in heaps], np.uint16),
        )
        size = pa.array([np.dtype(kind).itemsize], pa.int32())
        return [size, *(pa.array([part.tobytes()], pa.binary()) for part in held), pa.array([self.sums.ravel().tolist()], pa.list_(pa.int64()))]

    @classmethod
    def read(cls, row: dict, parts: int, entries: int, width: int) -> Block:
        x = np.frombuffer(row["x"], {2: np.int16, 4: np.int32, 8: np.int64}[row["size"]]).astype(np.int64)
        block = cls(x.reshape(-1, width), parts, entries)
        block.sums = np.array(row["sums"], np.int64).reshape(block.sums.shape)
        keys, rows = np.frombuffer(row["keys"]).tolist(), np.frombuffer(row["rows"], np.uint16).tolist()
        ends = np.cumsum(np.frombuffer(row["sizes"], np.uint16).astype(int)).tolist()
        for at, (first, end) in enumerate(zip([0, *ends[:-1]], ends, strict=True)):
            block.heaps[at // entries][at % entries] = list(zip(keys[first:end], rows[first:end], strict=True))
        return block


_HELD = "size int, x binary, keys binary, rows binary, sizes binary, sums array<bigint>"
_NAMES = ["ids", "labels", "size", "x", "keys", "rows", "sizes", "sums"]


def updated(blocks: DataFrame, books: np.ndarray) -> np.ndarray:
    """Each entry's new place: the floor of its parts' mean, in whole numbers of any size."""
    parts, entries, wide = books.shape
    rows = blocks.select(F.posexplode("sums").alias("at", "sum")).groupBy("at").agg(F.sum(F.col("sum").cast("decimal(38,0)")).alias("sum"))
    sums = np.zeros(parts * entries * (1 + wide), object)
    for row in rows.collect():  # a number for each component of the codebooks
        sums[row["at"]] = int(row["sum"])
    sums = sums.reshape(parts, entries, 1 + wide)
    new = books.copy()
    for part, entry in zip(*np.nonzero(sums[:, :, 0]), strict=True):
        new[part, entry] = sums[part, entry, 1:] // sums[part, entry, 0]
    return new


def compress(
    vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """One row per vector: vec_id, code, error, label_error, codebooks_sha256."""
    spark = vectors.sparkSession
    vector = vectors[vector_col].cast("array<double>")
    kept = vectors.select(vectors[id_col].cast("long").alias("vec_id"), vectors[label_col].alias("label"), vector.alias("embedding")).where(finite(F.col("embedding")))
    longest = kept.agg(F.max(F.size("embedding"))).first()[0]
    label = kept.schema["label"].dataType.simpleString()
    if longest is None:
        return spark.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    width = max(1, -(-longest // parts)) * parts
    starts = kept.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").select("embedding").limit(entries).toArrow()
    entries = starts.num_rows
    first = integers(matrix(starts["embedding"].combine_chunks(), width), scale)
    books = first.reshape(entries, parts, -1).transpose(1, 0, 2).copy()
    drift = np.zeros((parts, entries))

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(at, BLOCK)
                block = Block(integers(matrix(batch["embedding"], width), scale), parts, entries)
                for part in range(parts):
                    block.place(part, np.arange(batch.num_rows), books, drift)
                one = pa.array([0, batch.num_rows], pa.int32())
                lists = [pa.ListArray.from_arrays(one, pa.concat_arrays([batch[name]])) for name in ("vec_id", "label")]
                yield pa.RecordBatch.from_arrays([*lists, *block.columns()], _NAMES)

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(whole.num_rows):
                batch = whole.slice(at, 1)
                block = Block.read(batch.select(_NAMES[2:]).to_pylist()[0], parts, entries, width)
                block.settle(books, drift)
                yield pa.RecordBatch.from_arrays([batch["ids"], batch["labels"], *block.columns()], _NAMES)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(whole.num_rows):
                batch = whole.slice(at, 1)
                block = Block.read(batch.select(_NAMES[2:]).to_pylist()[0], parts, entries, width)
                block.settle(books, drift)
                codes = block.codes()
                errors = ((block.x - books[np.arange(parts)[None, :], codes]) ** 2).sum((1, 2))
                text = pa.array([row.tobytes().hex() for row in codes], pa.string())
                yield pa.RecordBatch.from_arrays([batch["ids"].flatten(), batch["labels"].flatten(), text, pa.array(errors, pa.int64())], ["vec_id", "label", "code", "error"])

    held = f"ids array<bigint>, labels array<{label}>, {_HELD}"
    blocks = stored(kept.mapInArrow(begin, held), "codes")
    for turn in range(rounds):
        new = updated(blocks, books)
        way = np.sqrt(((new - books) ** 2).sum(2).astype(float))
        others = np.array([[max([0.0, *np.delete(of_part, entry)]) for entry in range(entries)] for of_part in way])
        books, drift = new, drift + way + others
        if turn < rounds - 1:
            after = stored(blocks.mapInArrow(again, held), "codes")
            drop_stored(blocks)
            blocks = after
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    rows = stored(blocks.mapInArrow(coded, f"vec_id bigint, label {label}, code string, error bigint"), "coded")
    drop_stored(blocks)
    sums = rows.groupBy(F.col("label").alias("of")).agg(F.expr("try_cast(sum(cast(error AS decimal(38,0))) AS bigint)").alias("label_error"))
    return rows.join(sums, rows["label"].eqNullSafe(sums["of"])).select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
