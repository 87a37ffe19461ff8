"""Approximate nearest neighbours by a forest of random-projection trees.

Vectors are scaled to length one. Each tree splits a sample in halves by a random direction, of several the one along
which the node's vectors vary most, until a leaf stands for about LEAF vectors of the table; then every vector is put
in its leaf of every tree. A query searches all trees through one priority queue: a side of a split that the query isn't on
costs the square of its distance to the split, added up along the path, and nodes are taken by rising cost until a cutoff.
The cutoff is where sampled queries, answered by brute force over all vectors, find the target share of their
neighbours. Leaves and their visitors are dealt out in blocks of bounded size, where all cosines are computed
in double precision, so a score never depends on the trees.

Exact copies are one class; as they tie, a class answers with its smallest ids only, one more than there are
neighbours, which lose none. Of a block each query takes on as many classes as can hold its neighbours.

Results on unusual rows: a vector that is null, empty, zero or holds null or non-finite components takes no part, nor
does a null id; vectors of different lengths aren't compared; rows that repeat an id are rows of their own, each
with its answers, and a copy of a query's row is a candidate. A query without candidates has no rows. An empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkwell.llm.codes import finite
from inkwell.llm.vectors import by_length, units
from inkwell.session import stored

#: Trees, vectors of the table that a leaf stands for about, and the fewest sampled vectors in a leaf.
TREES, LEAF, LEAST = 3, 1_024, 8
#: Vectors that the trees are fitted on, about, and sampled queries that set the cutoff.
FITTED, PROBES = 40_000, 512
#: Directions of which a node takes the best.
DIRECTIONS = 16
#: Share of the sampled queries' neighbours that lie within the cutoff.
RECALL = 0.97
#: Vectors and visitors in a block.
BLOCK = 2_048
#: Queries that are compared with a block at once, and the rank of a query's own class, above any cosine.
SLICE, OWN = 64, 9.0
#: Scores this near may be equal but for rounding; they are then computed pair by pair, the same way everywhere.
CLOSE = 1e-9


class Tree:
    """Splits as arrays: of node k the direction, the threshold, and the children, negative for leaf -1 - child."""

    def __init__(self, rows: np.ndarray, leaf: int, seed: int):
        rng = np.random.default_rng(seed)
        directions, thresholds, children = [], [], []
        self.leaves = 0
        waiting = [(np.arange(len(rows)), -1, 0)]
        while waiting:
            held, parent, side = waiting.pop()
            split = self._split(rows[held], rng) if len(held) > leaf else None
            if split is None:
                node, self.leaves = -1 - self.leaves, self.leaves + 1
            else:
                node = len(directions)
                directions.append(split[0])
                thresholds.append(split[1])
                children.append([0, 0])
                right = rows[held] @ split[0] > split[1]
                waiting += [(held[right], node, 1), (held[~right], node, 0)]
            if parent >= 0:
                children[parent][side] = node
        self.directions = np.array(directions).reshape(len(directions), rows.shape[1])
        self.thresholds, self.children = np.array(thresholds), np.array(children, int).reshape(-1, 2)

    @staticmethod
    def _split(rows: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, float] | None:
        """The median along the best of some random directions; none if the rows are all alike there."""
        tried = rng.standard_normal((DIRECTIONS, rows.shape[1]))
        tried /= np.sqrt((tried * tried).sum(1, keepdims=True))
        along = rows @ tried.T
        best = int(along.var(0).argmax())
        threshold = float(np.median(along[:, best]))
        right = along[:, best] > threshold
        return (tried[best], threshold) if 0 < right.sum() < len(rows) else None

    def place(self, rows: np.ndarray) -> np.ndarray:
        """The leaf of each row."""
        at = np.zeros(len(rows), int) if len(self.thresholds) else np.full(len(rows), -1)
        while (inner := np.flatnonzero(at >= 0)).size:
            node = at[inner]
            right = np.einsum("ij,ij->i", rows[inner], self.directions[node]) > self.thresholds[node]
            at[inner] = self.children[node, right.astype(int)]
        return -1 - at

    def cost_of(self, margins: np.ndarray, leaves: np.ndarray) -> np.ndarray:
        """What one query pays for each of some leaves."""
        paid = np.zeros(self.leaves)
        waiting = [(0 if len(margins) else -1, 0.0)]
        while waiting:
            node, cost = waiting.pop()
            if node < 0:
                paid[-1 - node] = cost
                continue
            margin = margins[node]
            near = int(margin > 0)
            waiting += [(self.children[node, near], cost), (self.children[node, 1 - near], cost + margin * margin)]
        return paid[leaves]


class Forest:
    """Trees over vectors of one length."""

    def __init__(self, rows: np.ndarray, leaf: int):
        self.trees = [Tree(rows, leaf, seed) for seed in range(TREES)]

    def margins(self, rows: np.ndarray) -> list[np.ndarray]:
        """For each tree, how far each row is beyond each split."""
        return [rows @ tree.directions.T - tree.thresholds for tree in self.trees]

    def search(self, margins: list[np.ndarray], cutoff: float) -> list[tuple[int, int]]:
        """(tree, leaf) by rising cost up to the cutoff, all trees through one queue."""
        found, queue = [], [(0.0, t, 0 if len(of_tree) else -1) for t, of_tree in enumerate(margins)]
        while queue and queue[0][0] <= cutoff:
            cost, t, node = heapq.heappop(queue)
            while node >= 0:  # down the query's own side, whose cost is the same
                margin = float(margins[t][node])
                near = int(margin > 0)
                heapq.heappush(queue, (cost + margin * margin, t, int(self.trees[t].children[node, 1 - near])))
                node = int(self.trees[t].children[node, near])
            found.append((t, -1 - node))
        return found


def cosines(query: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The cosine of pairs of rows, equal for equal pairs wherever they stand."""
    # A sum over columns, one after another: its order depends on neither memory nor the number of rows.
    dot, left, right = np.zeros((3, len(query)))
    for k in range(query.shape[1]):
        dot += query[:, k] * rows[:, k]
        left += query[:, k] * query[:, k]
        right += rows[:, k] * rows[:, k]
    return dot / (np.sqrt(left) * np.sqrt(right))


def scaled(column: pa.Array) -> np.ndarray:
    """Rows as doubles, scaled by a power of two so that squares neither overflow nor vanish; cosines stay the same."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = flat.reshape(len(column), -1)
    return np.ldexp(rows, -np.frexp(np.abs(rows).max(axis=1, keepdims=True))[1])


def kept(at: np.ndarray, ranked: np.ndarray, firsts: np.ndarray, most: int) -> np.ndarray:
    """Where each query's ``most`` first pairs stand, by falling rank, then first id."""
    order = np.lexsort((firsts, -ranked, at))
    place = np.arange(len(at)) - np.searchsorted(at[order], at[order])
    return order[place < most]


def best(query: pa.Array, rows: pa.Array, nodes: np.ndarray, firsts: np.ndarray, own: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each query its ``most`` nearest rows by score and first id, with its own class always among them: query, row, score."""
    base, wide, found = units(rows), scaled(rows), []
    for begin in range(0, len(query), SLICE):
        part = query.slice(begin, SLICE)
        near = units(part) @ base.T
        near[own[begin : begin + SLICE, None] == nodes[None, :]] = OWN
        take = min(most, near.shape[1])
        least = np.partition(near, near.shape[1] - take, axis=1)[:, near.shape[1] - take]
        at, to = np.nonzero(near >= least[:, None] - CLOSE)
        score = cosines(scaled(part)[at], wide[to])
        some = kept(at, np.where(near[at, to] == OWN, OWN, score), firsts[to], most)
        found.append((at[some] + begin, to[some], score[some]))
    return tuple(np.concatenate(parts) for parts in zip(*found, strict=True))


def in_blocks(left: pa.Table, right: pa.Table, most: int) -> pa.Table:
    """One block of a leaf and one block of its visitors."""
    if not left.num_rows or not right.num_rows:
        return pa.table({"query": pa.array([], pa.int64()), "node": pa.array([], pa.int64()), "score": pa.array([], pa.float64()), "first": pa.array([], pa.int64())})
    column = lambda t, name: t[name].combine_chunks()
    nodes, firsts, queries = np.asarray(column(left, "node")), np.asarray(column(left, "first")), np.asarray(column(right, "node"))
    at, to, score = best(column(right, "embedding"), column(left, "embedding"), nodes, firsts, queries, most)
    return pa.table({"query": pa.array(queries[at]), "node": pa.array(nodes[to]), "score": pa.array(score), "first": pa.array(firsts[to])})


def leading(found: DataFrame, most: int, copies: int) -> DataFrame:
    """Each query's ``most`` nearest classes; a pair may have been found by ``copies`` trees."""
    order = [F.desc(F.when(F.col("query") == F.col("node"), OWN).otherwise(F.col("score"))), F.asc("first"), F.asc("node")]
    window = Window.partitionBy("query").orderBy(*order)
    some = found.withColumn("place", F.row_number().over(window)).where(F.col("place") <= most * copies).drop("place").distinct()
    return some.withColumn("place", F.row_number().over(window)).where(F.col("place") <= most).drop("place")


def neighbours(
    vectors: DataFrame, queries: str = "vec_id % 50 = 0", count: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """The ``count`` nearest rows of each row that ``queries`` selects by vec_id: query_id, rank, vec_id, score."""
    spark = vectors.sparkSession
    source = vectors.select(vectors[id_col].cast("long").alias("vec_id"), vectors[vector_col].alias("embedding"))
    valid = F.col("vec_id").isNotNull() & finite(F.col("embedding")) & F.exists("embedding", lambda x: x != 0)
    hashed = source.where(valid).withColumns({"h1": F.xxhash64("embedding"), "h2": F.xxhash64(F.lit("second"), "embedding"), "row": F.monotonically_increasing_id()})
    rows = stored(hashed.withColumn("asks", F.coalesce(F.expr(queries), F.lit(False))), "vectors")
    classes = rows.groupBy("h1", "h2").agg(F.min("vec_id").alias("first"), F.max("asks").alias("asks"), F.first("embedding").alias("embedding"))
    classes = stored(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    most = count + 1  # a query's own class may hold no other row

    size = classes.count()
    share = lambda of: math.ceil(min(1.0, of) * (1 << 30))
    chosen = F.pmod("h1", F.lit(1 << 30))
    sample = classes.where(chosen < share(FITTED / max(1, size))).select("embedding").toArrow()
    asking = classes.where("asks")
    probes = asking.where(chosen < share(PROBES / max(1, asking.count()))).select("node", "embedding").toArrow()
    forests = {length: Forest(np.concatenate(parts), max(LEAST, round(LEAF * min(1.0, FITTED / max(1, size))))) for length, parts in gathered(sample).items()}
    cutoff = set_cutoff(classes, probes, forests, most)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for length, batch in by_length(batches, "embedding"):
            trees = forests[length].trees if length in forests else []  # lengths that the sample missed are one leaf
            unit = units(batch["embedding"])
            each = np.repeat(np.arange(batch.num_rows), max(1, len(trees)))
            leaf = np.stack([tree.place(unit) for tree in trees], 1).ravel() if trees else np.zeros(len(each), int)
            tree = np.tile(np.arange(max(1, len(trees))), batch.num_rows)
            keys = [pa.array(np.full(len(each), length, np.int32)), pa.array(tree.astype(np.int32)), pa.array(leaf.astype(np.int32))]
            yield pa.RecordBatch.from_arrays([*(column.take(pa.array(each)) for column in batch.columns), *keys], [*batch.schema.names, "length", "tree", "leaf"])

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for length, batch in by_length(batches, "embedding"):
            visits = [[(0, 0)]] * batch.num_rows
            if length in forests:
                margins = forests[length].margins(units(batch["embedding"]))
                visits = [forests[length].search([of_tree[k] for of_tree in margins], cutoff) for k in range(batch.num_rows)]
            each = np.repeat(np.arange(batch.num_rows), [len(x) for x in visits])
            tree, leaf = (np.array([x[side] for found in visits for x in found], np.int32) for side in (0, 1))
            yield pa.RecordBatch.from_arrays([*(column.take(pa.array(each)) for column in batch.columns), pa.array(np.full(len(each), length, np.int32)), pa.array(tree), pa.array(leaf)], [*batch.schema.names, "length", "tree", "leaf"])

    kind = classes.schema["embedding"].dataType.simpleString()
    keys = ["length", "tree", "leaf"]
    ends = f"embedding {kind}, length int, tree int, leaf int"
    placed = classes.select("node", "first", "embedding").mapInArrow(place, f"node long, first long, {ends}")
    visiting = asking.select("node", "embedding").mapInArrow(visit, f"node long, {ends}")
    held = classes.select("node", "first", "embedding").mapInArrow(place, f"node long, first long, {ends}").groupBy(keys).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    visitors = asking.select("node", "embedding").mapInArrow(visit, f"node long, {ends}").groupBy(keys).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("visitors"))
    shape = stored(held.join(visitors, keys), "blocks")  # a row for each leaf that is visited
    own = lambda parts: F.pmod(F.xxhash64("node"), F.col(parts)).cast("int")
    every = lambda parts: F.explode(F.sequence(F.lit(0), F.col(parts) - 1))
    base = placed.join(shape, keys).withColumn("i", own("blocks")).withColumn("j", every("visitors")).select(*keys, "i", "j", "node", "first", "embedding")
    query = visiting.join(shape, keys).withColumn("j", own("visitors")).withColumn("i", every("blocks")).select(*keys, "i", "j", "node", "embedding")
    block = [*keys, "i", "j"]
    met = base.groupBy(block).cogroup(query.groupBy(block)).applyInArrow(lambda left, right: in_blocks(left, right, most), "query long, node long, score double, first long")
    answers = leading(stored(met, "met"), most, TREES)

    # Of each class the smallest ids, one more than there are neighbours.
    ranked = rows.select("h1", "h2", "vec_id", "row").withColumn("place", F.row_number().over(Window.partitionBy("h1", "h2").orderBy("vec_id", "row")))
    ids = ranked.where(F.col("place") <= most).join(classes.select("h1", "h2", "node"), ["h1", "h2"]).groupBy("node").agg(F.collect_list(F.struct("vec_id", "row")).alias("ids"))
    offered = answers.join(ids, "node").groupBy("query").agg(F.collect_list(F.struct("score", "ids")).alias("offers"))  # ``most`` lists of ``most`` ids
    asked = rows.where("asks").select("vec_id", "row", "h1", "h2").join(asking.select("h1", "h2", F.col("node").alias("query")), ["h1", "h2"])
    known = asked.select(F.col("vec_id").alias("query_id"), F.col("row").alias("own"), "query").join(offered, "query")
    flat = F.flatten(F.transform("offers", lambda offer: F.transform(offer["ids"], lambda x: F.struct((-offer["score"]).alias("far"), x["vec_id"].alias("vec_id"), x["row"].alias("row")))))
    first = F.slice(F.array_sort(F.filter(flat, lambda x: x["row"] != F.col("own"))), 1, count)
    out = known.select("query_id", F.posexplode(first).alias("at", "hit"))
    return out.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), (-F.col("hit.far")).alias("score"))


def gathered(table: pa.Table) -> dict[int, list[np.ndarray]]:
    """Unit vectors of a bounded table by length."""
    rows: dict[int, list[np.ndarray]] = {}
    for length, part in by_length(table.to_batches(), "embedding"):
        rows.setdefault(length, []).append(units(part["embedding"]))
    return rows


def set_cutoff(classes: DataFrame, probes: pa.Table, forests: dict[int, Forest], most: int) -> float:
    """The cost up to which the probes' true neighbours, by brute force over all classes, are reached to RECALL."""
    known = {}
    for length, part in by_length(probes.to_batches(), "embedding"):
        known.setdefault(length, []).append(part)
    tables = {length: pa.Table.from_batches(parts).combine_chunks() for length, parts in known.items() if length in forests}

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {}  # of a task ``most`` rows a probe: probe, node, score, first, leaves
        for length, batch in by_length(batches, "embedding"):
            if length not in tables:
                continue
            own, nodes, firsts = np.asarray(tables[length]["node"].combine_chunks()), np.asarray(batch["node"]), np.asarray(batch["first"])
            at, to, score = best(tables[length]["embedding"].combine_chunks(), batch["embedding"], nodes, firsts, own, most)
            unit = units(batch["embedding"])
            leaves = np.stack([tree.place(unit) for tree in forests[length].trees], 1)
            new = [own[at], nodes[to], score, firsts[to], leaves[to]]
            every = [np.concatenate(pair) for pair in zip(held[length], new, strict=True)] if length in held else new
            some = kept(every[0], np.where(every[0] == every[1], OWN, every[2]), every[3], most)
            held[length] = [column[some] for column in every]
        for columns in held.values():
            lists = pa.array(columns[4].tolist(), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns[:4]), lists], ["query", "node", "score", "first", "leaves"])

    found = classes.select("node", "first", "embedding").mapInArrow(nearest, "query long, node long, score double, first long, leaves array<int>")
    rows = leading(found, most, 1).where("query <> node").collect()  # ``most`` rows for each of the probes
    margins = {}
    for length, table in tables.items():
        of_forest = forests[length].margins(units(table["embedding"].combine_chunks()))
        for k, node in enumerate(table["node"].to_pylist()):
            margins[node] = (forests[length], [of_tree[k] for of_tree in of_forest])
    asked: dict[int, list[list[int]]] = {}
    for row in rows:
        asked.setdefault(row["query"], []).append(row["leaves"])
    costs = []
    for query, leaves in asked.items():
        forest, of_trees = margins[query]
        costs += np.min([tree.cost_of(m, np.array(leaves)[:, t]) for t, (tree, m) in enumerate(zip(forest.trees, of_trees, strict=True))], axis=0).tolist()
    return sorted(costs)[math.ceil(RECALL * len(costs)) - 1] if costs else 0.0
