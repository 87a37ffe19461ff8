"""Embedding near-duplicates by an inverted multi-index.

Vectors are scaled to length one and cut in halves; each half has a codebook of
its own, and the pair of nearest codewords is a vector's cell in the product grid.
From each vector a multi-sequence traversal visits cells by rising excess, the sum
over the halves of how much farther a codeword is than the nearest one, until a
cutoff. The cutoff is a multiple of where the links of sampled vectors, found by brute
force over all vectors, are reached to the target recall. Visits are verified by cosine in
double precision, so no link below the threshold is ever reported.

Exact copies are one class and visit once. A cell's vectors and its visitors are
split in blocks of bounded size; a task holds one block of each, counts links, and
passes on sums and a spanning forest of its links, never the links themselves.

Results on unusual rows: a vector that is null, empty, zero or holds null or
non-finite components has no links and is its own component; vectors of different
lengths aren't compared; rows that repeat an id and its vector are one vector; a
null id takes no part, with component_id null and kept false; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.operators.graph import connected_components
from inkwell.session import stored

#: Vectors that the codebooks are fitted on, about, and most whose links set the cutoff.
FITTED, PROBES = 10_000, 1_000
#: Vectors that a cell is to hold about, and most codewords of a half.
CELL, CODEWORDS = 100, 2_048
#: Share of the sampled links that the traversal must reach.
RECALL = 0.9999
#: The cutoff is this many times the excess that reaches them.
MARGIN = 4.0
#: Vectors and visitors in a block.
BLOCK = 1_024
#: Vectors whose distances to all codewords a worker holds at once.
SLICE = 512
#: Bins of excess when the cutoff is set.
_BINS, _MOST = 4_000, 4.0

Books = dict[int, tuple[np.ndarray, np.ndarray]]


def units(column: pa.Array) -> np.ndarray:
    """Rows of a list column of equal lengths as unit vectors in double precision."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = flat.reshape(len(column), -1)
    # First by the largest component: squares must neither overflow nor vanish.
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt(np.einsum("ij,ij->i", rows, rows))[:, None]


def distances(half: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Squared distances to codewords."""
    return np.maximum((half * half).sum(1)[:, None] + (book * book).sum(1)[None, :] - 2 * half @ book.T, 0)


def fit_book(half: np.ndarray, size: int) -> np.ndarray:
    """A codebook by k-means from evenly spaced starts."""
    book = half[np.linspace(0, len(half) - 1, size).astype(int)].copy()
    for _ in range(8):
        near = distances(half, book).argmin(1)
        count = np.bincount(near, minlength=size)
        sums = np.zeros_like(book)
        np.add.at(sums, near, half)
        book[count > 0] = sums[count > 0] / count[count > 0, None]
    return book


def excesses(rows: np.ndarray, books: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """How much farther each codeword is than the nearest, for both halves."""
    cut = rows.shape[1] // 2
    first, second = distances(rows[:, :cut], books[0]), distances(rows[:, cut:], books[1])
    return first - first.min(1, keepdims=True), second - second.min(1, keepdims=True)


def traverse(first: np.ndarray, second: np.ndarray, cutoff: float) -> list[int]:
    """Cells by rising excess up to the cutoff: the multi-sequence walk over two sorted lists."""
    order1, order2 = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    sorted1, sorted2 = first[order1].tolist(), second[order2].tolist()
    cells, heap = [], [(sorted1[0] + sorted2[0], 0, 0)]
    while heap and heap[0][0] <= cutoff:
        _, i, j = heapq.heappop(heap)
        cells.append(int(order1[i]) * len(second) + int(order2[j]))
        if j + 1 < len(sorted2):
            heapq.heappush(heap, (sorted1[i] + sorted2[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(sorted1):
            heapq.heappush(heap, (sorted1[i + 1] + sorted2[0], i + 1, 0))
    return cells


def by_length(batches: Iterator[pa.RecordBatch], name: str) -> Iterator[tuple[int, pa.RecordBatch]]:
    """The rows of each vector length, in slices of SLICE at most."""
    for whole in batches:
        for first in range(0, whole.num_rows, SLICE):
            batch = whole.slice(first, SLICE)
            lengths = np.array(batch.column(name).value_lengths())
            for length in np.unique(lengths):
                yield int(length), batch.filter(pa.array(lengths == length))


def set_cutoff(classes: DataFrame, probes: dict[int, np.ndarray], books: Books, threshold: float) -> float:
    """The excess within which the probes' links over all vectors are reached to RECALL."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(_BINS, np.int64)
        known = {length: excesses(rows, books[length]) for length, rows in probes.items()}
        for length, batch in by_length(batches, "embedding"):
            if length not in probes:
                continue
            rows, (p1, p2) = units(batch.column("embedding")), known[length]
            at, probe = np.nonzero(rows @ probes[length].T >= threshold)
            e1, e2 = excesses(rows, books[length])
            forth = e1[at, p1.argmin(1)[probe]] + e2[at, p2.argmin(1)[probe]]
            back = p1[probe, e1.argmin(1)[at]] + p2[probe, e2.argmin(1)[at]]
            bins = np.minimum(np.minimum(forth, back) / _MOST * _BINS, _BINS - 1).astype(int)
            counts += np.bincount(bins, minlength=_BINS)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(counts[some], pa.int64())], ["bin", "links"])

    rows = classes.select("embedding").mapInArrow(run, "bin long, links long").groupBy("bin").agg(F.sum("links").alias("links")).collect()  # at most _BINS rows
    total, seen = sum(row["links"] for row in rows), 0
    for row in sorted(rows):
        seen += row["links"]
        if seen >= RECALL * total:
            return MARGIN * (row["bin"] + 1) * _MOST / _BINS
    return 0.0


def linked_blocks(books: Books, cutoff: float, threshold: float):
    """The task of one block of a cell and one block of its visitors."""

    def run(table: pa.Table) -> pa.Table:
        base, query = table.filter(table["visits"].combine_chunks().is_null()), table.filter(table["visits"].combine_chunks().is_valid())
        if not base.num_rows or not query.num_rows:
            return pa.table({"node": pa.array([], pa.int64()), "links": pa.array([], pa.int64()), "head": pa.array([], pa.int64())})
        column = lambda t, name: t[name].combine_chunks()
        x, q = units(column(base, "embedding")), units(column(query, "embedding"))
        x_node, q_node = np.array(column(base, "node")), np.array(column(query, "node"))
        x_copies, q_copies = np.array(column(base, "copies")), np.array(column(query, "copies"))
        x_cell, q_cell = column(base, "home")[0].as_py(), np.array(column(query, "home"))
        linked = q @ x.T >= threshold
        linked &= (q_cell != x_cell)[:, None] | (q_node[:, None] < x_node[None, :])
        at, to = np.nonzero(linked)
        if len(at):
            # A pair that visits each other's cell counts in the lower cell's visit only.
            e1, e2 = excesses(x, books[x.shape[1]])
            width = e2.shape[1]
            mutual = e1[to, q_cell[at] // width] + e2[to, q_cell[at] % width] <= cutoff
            linked[at, to] = ~mutual | (q_cell[at] <= x_cell)
        # A forest: each round takes the smallest label of all that a row links with.
        nodes = np.concatenate([q_node, x_node])
        label = nodes.copy()
        n, most = len(q_node), np.iinfo(np.int64).max
        while linked.any():
            before = label.copy()
            label[:n] = np.minimum(label[:n], np.where(linked, label[None, n:], most).min(1))
            label[n:] = np.minimum(label[n:], np.where(linked, label[:n, None], most).min(0))
            # A node that is both vector and visitor has one label.
            unique, back = np.unique(nodes, return_inverse=True)
            least = np.full(len(unique), most)
            np.minimum.at(least, back, label)
            label = least[back]
            if (label == before).all():
                break
        links = np.concatenate([linked @ x_copies, q_copies @ linked])
        some = links > 0
        return pa.table({"node": pa.array(nodes[some]), "links": pa.array(links[some].astype(np.int64)), "head": pa.array(label[some])})

    return run


def near_duplicates(vectors: DataFrame, threshold: float = 0.9, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    source = vectors.select(vectors[id_col].cast("long").alias("vec_id"), vectors[vector_col].alias("embedding"))
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf)
    valid = F.col("vec_id").isNotNull() & F.coalesce(F.forall("embedding", finite) & F.exists("embedding", lambda x: x != 0), F.lit(False))
    kept = source.select("vec_id", F.when(valid, F.col("embedding")).alias("embedding"))
    # Two hashes by different starts: equal pairs of unequal vectors are beyond any table's size.
    rows = stored(kept.withColumn("h1", F.when(valid, F.xxhash64("embedding"))).withColumn("h2", F.when(valid, F.xxhash64(F.lit("second"), "embedding"))), "vectors")
    distinct = rows.where("h1 IS NOT NULL").distinct()
    classes = stored(distinct.groupBy("h1", "h2").agg(F.min("vec_id").alias("first"), F.count("*").alias("copies"), F.first("embedding").alias("embedding")).withColumn("node", F.monotonically_increasing_id()), "classes")

    count = classes.count()
    # Chosen by hash: about FITTED vectors in all, however many tasks there are.
    chosen = F.pmod("h1", F.lit(1 << 30)) < math.ceil(min(1.0, FITTED / max(1, count)) * (1 << 30))
    sample = classes.where(chosen).select("embedding").toArrow()
    size = max(1, min(CODEWORDS, math.ceil(math.sqrt(count / CELL))))
    books: Books = {}
    probes: dict[int, np.ndarray] = {}
    rows_of: dict[int, list[np.ndarray]] = {}
    for length, part in by_length(sample.to_batches(), "embedding"):
        rows_of.setdefault(length, []).append(units(part.column("embedding")))
    for length, parts_of in rows_of.items():
        all_rows = np.concatenate(parts_of)
        cut = length // 2
        books[length] = (fit_book(all_rows[:, :cut], min(size, len(all_rows))), fit_book(all_rows[:, cut:], min(size, len(all_rows))))
        probes[length] = all_rows[:PROBES]
    cutoff = set_cutoff(classes, probes, books, threshold) if books else 0.0

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for length, batch in by_length(batches, "embedding"):
            home, visits = np.zeros(batch.num_rows, np.int64), [[0]] * batch.num_rows
            if length in books:  # lengths that the sample missed are all in one cell
                e1, e2 = excesses(units(batch.column("embedding")), books[length])
                visits = [traverse(a, b, cutoff) for a, b in zip(e1, e2, strict=True)]
                home = e1.argmin(1) * e2.shape[1] + e2.argmin(1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([length] * batch.num_rows, pa.int32()), pa.array(home, pa.int64()), pa.array(visits, pa.list_(pa.int64()))], [*batch.schema.names, "length", "home", "cells"])

    placed = stored(classes.select("node", "copies", "embedding").mapInArrow(visit, "node long, copies long, embedding " + classes.schema["embedding"].dataType.simpleString() + ", length int, home long, cells array<long>"), "placed")
    visiting = placed.select("node", "copies", "embedding", "length", "home", F.explode("cells").alias("cell"))
    base_count = placed.groupBy("length", F.col("home").alias("cell")).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("base_blocks"))
    query_count = visiting.groupBy("length", "cell").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("query_blocks"))
    blocks = stored(base_count.join(query_count, ["length", "cell"]), "blocks")  # a row for each cell that is used
    share = lambda parts: F.pmod(F.xxhash64("node"), F.col(parts)).cast("int")
    every = lambda parts: F.explode(F.sequence(F.lit(0), F.col(parts) - 1))
    keep = ["length", "cell", "base_block", "query_block", "node", "copies", "embedding", "home", "visits"]
    base = placed.withColumn("cell", F.col("home")).join(blocks, ["length", "cell"]).withColumn("base_block", share("base_blocks")).withColumn("visits", F.lit(None).cast("boolean")).withColumn("query_block", every("query_blocks")).select(keep)
    query = visiting.join(blocks, ["length", "cell"]).withColumn("query_block", share("query_blocks")).withColumn("visits", F.lit(True)).withColumn("base_block", every("base_blocks")).select(keep)
    found = stored(base.union(query).groupBy("length", "cell", "base_block", "query_block").applyInArrow(linked_blocks_with_missing(books, cutoff, threshold), "node long, links long, head long"), "found")

    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    parts = connected_components(found, "node", "head")
    heads = classes.select("h1", "h2", "node", "first", "copies").join(parts, "node", "left").withColumn("part", F.coalesce("component", "node"))
    least = heads.groupBy("part").agg(F.min("first").alias("component_id"))
    known = heads.join(least, "part").join(links, "node", "left").select("h1", "h2", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    result = rows.select("vec_id", "h1", "h2").join(known, ["h1", "h2"], "left")
    component = F.coalesce("component_id", "vec_id")
    return result.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


def linked_blocks_with_missing(books: Books, cutoff: float, threshold: float):
    """``linked_blocks`` where vector lengths that the sample missed share one codeword."""
    known = linked_blocks(books, cutoff, threshold)

    def run(table: pa.Table) -> pa.Table:
        length = table["length"][0].as_py()
        if length in books:
            return known(table)
        one = (np.zeros((1, length // 2)), np.zeros((1, length - length // 2)))
        return linked_blocks({length: one}, cutoff, threshold)(table)

    return run
