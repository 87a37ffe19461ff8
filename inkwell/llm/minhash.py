"""MinHash near-duplicates with odd sketches.

Every text is read once: its set of word shingles gives a fingerprint, MinHash
samples, band keys and an odd sketch, a bitmap that each (position, sample) flips
one bit of. The number of bits in which two odd sketches differ tells how many
samples differ, and does so best where texts are most alike. Copies with equal
sets become one class. Classes that share a band key and whose sketches differ in
few enough bits, with a margin of five standard deviations, are candidates.

Neither candidates nor links are listed pair by pair. A task holds two blocks of a
band's classes and passes on a forest that joins all near ones; what these forests
connect is a candidate group. Then a task holds two blocks of a group's full sets,
counts all their intersections by products of membership columns, and passes on
a forest of the confirmed links. Blocks are bounded, so a band or group of any
size is dealt out over many tasks.

Results on unusual rows: a text that is null, empty or without words has no
shingles and is linked with nothing; with fewer words than a shingle has, all of
them form one; equal texts fall into one component; rows that repeat an id are
one node; a null id takes no part in links, its component_id is null and kept is
false; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.llm.workers import give_back
from inkwell.operators.graph import connected_components
from inkwell.session import stored

#: MinHash samples of a document and bits of its odd sketch.
SAMPLES, BITS = 120, 512
#: Rows of a band or group in a block; a task holds two blocks.
BLOCK = 256
#: A key with one row in so many is joined by broadcast.
HOT = 1_000
#: Most words whose hashes a worker remembers within a task.
CACHE = 300_000

_WORDS: dict[bytes, int] = {}


def word_hashes(text: bytes) -> np.ndarray:
    """64-bit hashes of the words between ASCII white space, A-Z in lower case."""
    words = text.lower().split()
    if len(_WORDS) > CACHE:
        _WORDS.clear()
    found = list(map(_WORDS.get, words))
    if None in found:
        for at, known in enumerate(found):
            if known is None:
                word = words[at]
                found[at] = _WORDS[word] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
    return np.array(found, np.uint64)


def forget_words() -> None:
    """Forget the words that ``word_hashes`` remembers; the next task's memory is its own."""
    _WORDS.clear()
    give_back()


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads all bits."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def shingle_set(text: bytes | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes."""
    hashes = word_hashes(text or b"")
    if not len(hashes):
        return hashes
    width = min(words, len(hashes))
    count = len(hashes) - width + 1
    total = np.full(count, width, np.uint64)
    for k in range(width):
        total = mixed(total * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + count])
    return np.unique(total)


def band_rows(threshold: float) -> int:
    """Samples in a band: the most that miss a pair at the threshold once in 100,000 times at most."""
    fits = [r for r in range(1, 13) if (1 - threshold**r) ** (SAMPLES // r) <= 1e-5]
    return max(fits, default=1)


def most_differing_bits(threshold: float) -> int:
    """Bits in which sketches of a pair at the threshold differ, plus five standard deviations."""
    flips = 2 * SAMPLES * (1 - threshold)
    mean = BITS / 2 * (1 - (1 - 2 / BITS) ** flips)
    slope = 2 * (1 - 2 / BITS) ** flips
    variance = slope**2 * SAMPLES * threshold * (1 - threshold) + BITS / 4 * (1 - (1 - 4 / BITS) ** flips)
    return math.ceil(mean + 5 * math.sqrt(variance))


def signatures(docs: DataFrame, words: int, rows: int) -> DataFrame:
    """doc_id, n_shingles, f1, f2 (the set's fingerprint), bands, sketch of every row."""
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_shingles long, f1 long, f2 long, bands array<long>, sketch array<long>"
    count = SAMPLES // rows

    def sign(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        random = np.random.default_rng(7)
        factors = random.integers(0, 1 << 32, SAMPLES, np.uint32) | np.uint32(1)
        shifts = random.integers(0, 1 << 32, SAMPLES, np.uint32)
        starts = np.cumsum([0, *map(len, sets[:-1])])
        flat = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
        samples = np.empty((len(sets), SAMPLES), np.uint32)
        for j in range(SAMPLES):
            samples[:, j] = np.minimum.reduceat(flat * factors[j] + shifts[j], starts)
        wide = samples.astype(np.uint64)
        keys = np.empty((len(sets), count), np.uint64)
        for band in range(count):
            key = np.full(len(sets), band + 1, np.uint64)
            for j in range(band * rows, band * rows + rows):
                key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + wide[:, j])
            keys[:, band] = key
        bits = np.zeros((len(sets), BITS), np.uint8)
        every = np.arange(len(sets))
        for j in range(SAMPLES):
            bits[every, (mixed(wide[:, j] + np.uint64((j + 1) << 32)) % np.uint64(BITS)).astype(np.int64)] ^= 1
        return keys.view(np.int64), np.packbits(bits, axis=1).view(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, 256):
                batch = whole.slice(first, 256)
                sets = [shingle_set(text, words) for text in batch.column(1).to_pylist()]
                some = [i for i, x in enumerate(sets) if len(x)]
                bands: list = [[] for _ in sets]
                sketches: list = [[] for _ in sets]
                if some:
                    keys, bits = sign([sets[i] for i in some])
                    for at, i in enumerate(some):
                        bands[i], sketches[i] = keys[at], bits[at]
                prints = [np.array([x.sum(dtype=np.uint64), mixed(x ^ np.uint64(0x5555555555555555)).sum(dtype=np.uint64)]).view(np.int64) for x in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array([len(x) for x in sets], pa.int64()),
                        pa.array([int(x[0]) for x in prints], pa.int64()),
                        pa.array([int(x[1]) for x in prints], pa.int64()),
                        pa.array(bands, pa.list_(pa.int64())),
                        pa.array(sketches, pa.list_(pa.int64())),
                    ],
                    ["doc_id", "n_shingles", "f1", "f2", "bands", "sketch"],
                )
            batch = whole = None
            give_back()
        forget_words()

    return docs.mapInArrow(run, schema)


def full_sets(docs: DataFrame, words: int) -> DataFrame:
    """id and the whole set of shingle hashes, for confirming."""
    schema = f"id {docs.schema['doc_id'].dataType.simpleString()}, n long, shingles array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, 256):
                batch = whole.slice(first, 256)
                sets = [shingle_set(text, words).view(np.int64) for text in batch.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(map(len, sets), pa.int64()), pa.array(sets, pa.list_(pa.int64()))], ["id", "n", "shingles"]
                )
            batch = whole = None
            give_back()
        forget_words()

    return docs.mapInArrow(run, schema)


def forest(linked: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (id, smallest id reachable) of a symmetric boolean matrix, for ids that aren't the smallest."""
    label = ids.copy()
    most = np.iinfo(np.int64).max
    while True:
        least = np.minimum(label, np.where(linked, label[None, :], most).min(1))
        if (least == label).all():
            return ids[label != ids], label[label != ids]
        label = least


def common_counts(flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of all pairs of sets, by products of membership columns."""
    rows = np.repeat(np.arange(len(sizes)), sizes)
    _, column, count = np.unique(flat, return_inverse=True, return_counts=True)
    several = count > 1
    place = np.cumsum(several) - 1
    kept = several[column]
    rows, column = rows[kept], place[column[kept]]
    order = np.argsort(column, kind="stable")
    rows, column = rows[order], column[order]
    total = np.zeros((len(sizes), len(sizes)), np.float32)
    for first in range(0, int(several.sum()), 4096):
        low, high = np.searchsorted(column, [first, first + 4096])
        held = np.zeros((len(sizes), 4096), np.float32)
        held[rows[low:high], column[low:high] - first] = 1
        total += held @ held.T
    return total


def grouped(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Runs of rows with equal leading key columns, from batches sorted by them."""
    held: list[pa.RecordBatch] = []
    key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [np.asarray(batch.column(k)) for k in range(keys)]
        change = np.zeros(batch.num_rows, bool)
        for column in columns:
            change[1:] |= column[1:] != column[:-1]
        starts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for first, last in zip(starts, starts[1:], strict=False):
            now = tuple(column[first] for column in columns)
            if held and now != key:
                yield pa.Table.from_batches(held)
                held = []
            key = now
            held.append(batch.slice(first, last - first))
    if held:
        yield pa.Table.from_batches(held)


def in_blocks(rows: DataFrame, key: str) -> DataFrame:
    """Rows of each key in blocks of about BLOCK, each pair of blocks together: columns key, block, other come first.

    ``rows`` has id, and size, the number of rows of its key.
    """
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    own = rows.withColumn("own", F.pmod(F.xxhash64("id"), blocks).cast("int"))
    spread = own.select("*", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("with"))
    placed = spread.withColumn("block", F.least("own", "with")).withColumn("other", F.greatest("own", "with"))
    order = [key, "block", "other"]
    rest = [c for c in rows.columns if c not in (key, "size")]
    return placed.select(*order, *rest).repartition(*order).sortWithinPartitions(*order)


def sketch_forest(banded: DataFrame, percent: int, limit: int) -> DataFrame:
    """Edges a, b that join all members of a band whose sketches are near enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(batches, 3):
            if table.num_rows > 1:
                ids, sizes = (np.asarray(table[c].combine_chunks()) for c in ("id", "n_shingles"))
                # Unsigned: of a negative number, numpy counts the bits of its absolute value.
                bits = np.asarray(table["sketch"].combine_chunks().flatten()).view(np.uint64).reshape(len(ids), -1)
                far = np.zeros((len(ids), len(ids)), np.int32)
                for word in bits.T:
                    far += np.bitwise_count(word[:, None] ^ word[None, :])
                near = (far <= limit) & (100 * np.minimum.outer(sizes, sizes) >= percent * np.maximum.outer(sizes, sizes))
                a, b = forest(near, ids)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])
        give_back()

    return in_blocks(banded, "key").mapInArrow(run, "a long, b long")


def confirmed_forest(members: DataFrame, percent: int) -> DataFrame:
    """Edges a, b that join what is linked on full sets within a candidate group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(batches, 3):
            if table.num_rows > 1:
                ids = np.asarray(table["id"].combine_chunks())
                sets = table["shingles"].combine_chunks()
                sizes = np.asarray(sets.value_lengths()).astype(np.int64)
                common = common_counts(np.asarray(sets.flatten()), sizes).astype(np.int64)
                a, b = forest(100 * common >= percent * (sizes[:, None] + sizes[None, :] - common), ids)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])
        give_back()

    return in_blocks(members, "group").mapInArrow(run, "a long, b long")


def joined_by_class(rows: DataFrame, classes: DataFrame, keys: list[str], total: int) -> DataFrame:
    """``rows`` left-joined with one row for each key; ``classes`` has the column size, the number of rows with its key.

    Keys that hold a thousandth of all rows or more, so 1,000 at most, are broadcast, and only the rows of
    the others are shuffled.
    """
    many = F.col("size") * HOT >= total
    hot = F.broadcast(classes.where(many).drop("size"))
    rest = rows.join(hot.select(*keys), keys, "left_anti").join(classes.where(~many).drop("size"), keys, "left")
    return rows.join(hot, keys).unionByName(rest)


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Documents are linked where 100 * intersection >= ``percent`` * union of their
    sets of ``words``-word shingles. Ids are cast to long.
    """
    source = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("binary").alias("text"))
    rows, limit = band_rows(percent / 100), most_differing_bits(percent / 100)
    signed = stored(signatures(source, words, rows), "signatures")
    print_cols = ["n_shingles", "f1", "f2"]
    some = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = stored(some.groupBy(*print_cols).agg(F.min("doc_id").alias("class_id"), F.count("*").alias("size")), "classes")
    total = signed.count()
    classed = joined_by_class(some, classes, print_cols, total)
    rest = signed.where("NOT (n_shingles > 0 AND doc_id IS NOT NULL) OR doc_id IS NULL").withColumn("class_id", F.lit(None).cast("long"))
    member = stored(classed.unionByName(rest).select("doc_id", "n_shingles", "class_id", "bands", "sketch"), "members")
    heads = member.where("doc_id = class_id").select(F.col("doc_id").alias("id"), "n_shingles", "bands", "sketch")

    banded = heads.select("id", F.explode("bands").alias("key"))
    crowded = banded.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    shared = banded.join(crowded, "key").join(heads.select("id", "n_shingles", "sketch"), "id")
    candidates = stored(sketch_forest(shared, percent, limit).distinct(), "candidates")
    groups = connected_components(candidates, "a", "b").select(F.col("node").alias("id"), F.col("component").alias("group"))
    sized = stored(groups.join(groups.groupBy("group").agg(F.count("*").alias("size")), "group"), "groups")
    sets = full_sets(source.join(sized.select(F.col("id").alias("doc_id")), "doc_id", "left_semi").dropDuplicates(["doc_id"]), words)
    links = stored(confirmed_forest(sized.join(sets.drop("n"), "id"), percent), "links")
    parts = connected_components(links, "a", "b")
    labels = parts.select(F.col("node").alias("class_id"), "component").join(classes.select("class_id", "size"), "class_id")
    slim = member.select("doc_id", "n_shingles", "class_id")
    joined = joined_by_class(slim, labels, ["class_id"], total)
    component = F.coalesce("component", "class_id", "doc_id")
    return joined.select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), component).alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept")
    )
