"""Term sets compared in blocks: a task holds a block of left rows and one of right rows and counts what all their pairs share.

Each row is shuffled once for each block that it meets, so pairs are neither shuffled nor written, and no term's rows have to meet in one task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a left and a right block.
LEFT, RIGHT = 4_096, 8_192
#: Rows of a block where sets of one kind meet.
BLOCK = 32_768
#: Where sets of a block are packed: the weight of a block, in which a set counts 1 and 1 more for each HEAVY terms; the parts of
#: a key's sets that make a block if that is less, but not less than LEAST.
PACKED, HEAVY, SHARES, LEAST = 65_536, 64, 8, 1_024
#: Pairs that are counted at a time, and common terms that are listed for it.
CELLS, LISTED = 1 << 20, 1 << 21

#: Scores of pairs from left rows, right rows and the numbers of common terms (right by left), by column; -inf where a pair doesn't count.
Score = Callable[[pa.Table, pa.Table, dict[str, np.ndarray]], np.ndarray]


def sizes(rows: pa.Table, column: str) -> np.ndarray:
    """Lengths of arrays without nulls."""
    return rows[column].combine_chunks().value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)


class Postings:
    """The left rows of each term, with the terms of right rows in the same numbers."""

    def __init__(self, left: np.ndarray, left_sizes: np.ndarray, right: np.ndarray, right_sizes: np.ndarray, terms: int) -> None:
        self.n, self.codes = len(left_sizes), right
        self.rows = np.sort(left.astype(np.int64) * self.n + np.repeat(np.arange(self.n), left_sizes)) % max(1, self.n)
        self.held = np.bincount(left, minlength=terms)
        self.first = np.cumsum(self.held) - self.held
        self.ends = np.concatenate([[0], np.cumsum(right_sizes)])
        self.work = np.concatenate([[0], np.cumsum(self.held[right])])[self.ends]

    def common(self, begin: int, end: int) -> np.ndarray:
        """How many terms each right row from ``begin`` to ``end`` shares with each left row."""
        codes = self.codes[self.ends[begin] : self.ends[end]]
        strip = np.repeat(np.arange(end - begin) * self.n, np.diff(self.ends[begin : end + 1]))
        held = self.held[codes]
        inside = np.arange(held.sum()) - np.repeat(np.cumsum(held) - held, held)
        cells = np.repeat(strip, held) + self.rows[np.repeat(self.first[codes], held) + inside]
        return np.bincount(cells, minlength=(end - begin) * self.n).reshape(end - begin, self.n)


def numbered(left: pa.Table, right: pa.Table, column: str) -> tuple[np.ndarray, np.ndarray, int]:
    """The terms of left and right rows as numbers, and how many numbers there are."""
    a, b = (rows[column].combine_chunks().flatten() for rows in (left, right))
    codes = pa.concat_arrays([a, b]).dictionary_encode()
    number = codes.indices.to_numpy(zero_copy_only=False)
    return number[: len(a)], number[len(a) :], len(codes.dictionary)


def stretches(work: np.ndarray, left: int, cells: int = 0) -> Iterator[tuple[int, int]]:
    """Right rows in short stretches, so that memory doesn't grow with what rows share."""
    begin, n, most = 0, len(work) - 1, max(1, (cells or CELLS) // max(1, left))
    while begin < n:
        end = min(begin + most, n, max(begin + 1, int(np.searchsorted(work, work[begin] + LISTED, "right")) - 1))
        yield begin, end
        begin = end


def strips(left: pa.Table, right: pa.Table, terms: list[str]) -> Iterator[tuple[int, int, dict[str, np.ndarray]]]:
    """Stretches of right rows, each with the numbers of common terms."""
    postings = {}
    for name in terms:
        a, b, n = numbered(left, right, name)
        postings[name] = Postings(a, sizes(left, name), b, sizes(right, name), n)
    for begin, end in stretches(sum(p.work for p in postings.values()), left.num_rows):
        yield begin, end, {name: p.common(begin, end) for name, p in postings.items()}


def jaccards(common: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Jaccard of pairs from their common terms and the sizes of their sets, 0 for empty ones."""
    return common / np.maximum(left[None, :] + right[:, None] - common, 1)


def jaccard_score(left: pa.Table, right: pa.Table, common: dict[str, np.ndarray]) -> np.ndarray:
    """The Jaccard of ``terms``; pairs without a common term don't count."""
    n = common["terms"]
    return np.where(n > 0, jaccards(n, sizes(left, "terms"), sizes(right, "terms")), -np.inf)


def _best(left: pa.Table, right: pa.Table, terms: list[str], k: int, score: Score) -> pa.Table:
    """The ``k`` best right rows of each left row; ties go to the smaller id."""
    if not left.num_rows or not right.num_rows:
        return pa.table({"left": pa.array([], pa.int64()), "right": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
    ids, others = left["id"].to_numpy(), right["id"].to_numpy()
    least = np.full(len(ids), -np.inf)
    found = (np.array([], np.int64), np.array([], others.dtype), np.array([], np.float64))
    for begin, end, common in strips(left, right, terms):
        scores = score(left, right.slice(begin, end - begin), common)
        scores[others[begin:end, None] == ids[None, :]] = -np.inf
        b, a = np.nonzero((scores >= least[None, :]) & (scores > -np.inf))
        found = tuple(map(np.concatenate, zip(found, (a, others[begin:end][b], scores[b, a]), strict=True)))
        if begin == 0 or end == right.num_rows or len(found[0]) > 8 * k * len(ids):
            order = np.lexsort((found[1], -found[2], found[0]))
            found = tuple(x[order] for x in found)
            starts = np.searchsorted(found[0], np.arange(len(ids)))
            place = np.arange(len(found[0])) - starts[found[0]]
            found = tuple(x[place < k] for x in found)
            last = place[place < k] == k - 1
            least[found[0][last]] = found[2][last]
    return pa.table({"left": ids[found[0]], "right": found[1], "score": found[2]})


def _parts(frame: DataFrame) -> int:
    """Tasks: few rows can be much work, so their bytes don't decide."""
    return int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _dealt(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left rows (asks) and right rows of equal keys, for each two blocks l and r that meet."""
    count = lambda frame, size, name: frame.groupBy(*keys).agg(F.ceil(F.count("*") / size).alias(name))
    blocks = count(left, LEFT, "lefts").join(count(right, RIGHT, "rights"), keys)
    own = lambda name: F.pmod(F.xxhash64("id"), F.col(name))
    all_of = lambda name: F.explode(F.sequence(F.lit(0).cast("long"), F.col(name) - 1))
    a = left.join(blocks, keys).withColumn("l", own("lefts")).withColumn("r", all_of("rights")).drop("lefts", "rights")
    b = right.join(blocks, keys).withColumn("r", own("rights")).withColumn("l", all_of("lefts")).drop("lefts", "rights")
    return a.withColumn("asks", F.lit(True)).unionByName(b.withColumn("asks", F.lit(False)))


def best_pairs(left: DataFrame, right: DataFrame, keys: list[str], k: int, terms: list[str], score: Score = jaccard_score) -> DataFrame:
    """For each left row the ``k`` best other right rows with its keys in each block: left, right, score; the best of all are among them.

    Both frames have the same columns: the keys (null is like nothing), id (long), the arrays ``terms`` of distinct terms without nulls,
    and what ``score`` uses besides.
    """
    both = _dealt(left, right, keys)

    def run(rows: pa.Table) -> pa.Table:
        return _best(rows.filter(rows["asks"]), rows.filter(pc.invert(rows["asks"])), terms, k, score)

    group = [*keys, "l", "r"]
    return both.repartition(_parts(left), *group).groupBy(*group).applyInArrow(run, "left long, right long, score double")


def paired(sets: DataFrame, key: str, bands: float = 0.0, block: int = 0, pack: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Sets (id, key, terms) with i and j, the two blocks of a key that meet, and own, the block that a set is of.

    Blocks follow the sizes of sets; two meet where a set of one may have ``bands`` of the size of one of the other. Empty sets and
    null keys are left out. With ``pack``, which makes each block a row, blocks have ``block`` sets or fewer that are large, and a
    key with few sets has smaller blocks, so that its pairs are many tasks' work.
    """
    block = block or (PACKED if pack else BLOCK)
    known = sets.withColumn("size", F.size("terms")).where("size > 0")
    weight = 1 + F.col("size") / HEAVY if pack else F.lit(1.0)  # sums of 64ths are exact
    counted = known.groupBy(key, "size").agg(F.count("*").alias("n")).withColumn("weight", weight)
    weighed = F.col("n") * F.col("weight")
    before = F.sum(weighed).over(Window.partitionBy(key).orderBy("size").rowsBetween(Window.unboundedPreceding, -1))
    share = F.ceil(F.sum(weighed).over(Window.partitionBy(key)) / SHARES)
    most = F.least(F.lit(block), F.greatest(share, F.lit(LEAST))) if pack else F.lit(block)
    counted = counted.withColumn("before", F.coalesce(before, F.lit(0.0))).withColumn("block", most)
    # As many rows as there are sizes of sets, of a library each where they are packed.
    placed = known.join(F.broadcast(counted) if pack else counted, [key, "size"])
    at = lambda place: F.floor((F.col("before") + place * F.col("weight")) / F.col("block"))
    placed = placed.withColumn("own", at(F.pmod(F.xxhash64("id"), F.col("n")))).drop("before", "n", "weight", "block", "size")
    if pack:
        placed = pack(placed)
    # Of the histogram, so sets aren't read for it.
    ranges = counted.withColumn("own", F.explode(F.sequence(at(F.lit(0)), at(F.col("n") - 1))))
    ranges = ranges.groupBy(key, "own").agg(F.min("size").alias("low"), F.max("size").alias("high"))
    i, j = (ranges.select(key, *[F.col(c).alias(f"{c}_{side}") for c in ("own", "low", "high")]) for side in "ij")
    meet = i.join(j, key).where((F.col("own_i") <= F.col("own_j")) & (F.col("high_i") >= bands * F.col("low_j") - 1e-9)).select(key, F.col("own_i").alias("i"), F.col("own_j").alias("j"))
    meet = meet.withColumn("own", F.explode(F.array_distinct(F.array("i", "j"))))
    return placed.join(meet, [key, "own"])


def halves(rows: pa.Table) -> tuple[pa.Table, pa.Table, bool]:
    """The blocks i and j of a group of ``paired``, and whether they are one."""
    i, j = rows["i"][0].as_py(), rows["j"][0].as_py()
    left = rows.filter(pc.equal(rows["own"], i))
    return left, left if i == j else rows.filter(pc.equal(rows["own"], j)), i == j


def close_pairs(sets: DataFrame, key: str, limit: float) -> DataFrame:
    """How many pairs of a key's sets have a Jaccard of at least ``limit``: key, close. Keys without such pairs may be absent."""

    def run(rows: pa.Table) -> pa.Table:
        left, right, same = halves(rows)
        a, b = sizes(left, "terms"), sizes(right, "terms")
        close = 0
        for begin, end, common in strips(left, right, ["terms"]):
            near = jaccards(common["terms"], a, b[begin:end]) >= limit
            close += np.count_nonzero(np.tril(near, begin - 1) if same else near)
        return pa.table({key: rows[key].slice(0, 1), "close": pa.array([close], pa.int64())})

    dealt, kind = paired(sets.select("id", key, "terms"), key, limit), sets.schema[key].dataType.simpleString()
    met = dealt.repartition(_parts(sets), key, "i", "j").groupBy(key, "i", "j").applyInArrow(run, f"`{key}` {kind}, close long")
    return met.groupBy(key).agg(F.sum("close").alias("close"))


def _packed(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(block: pa.Scalar) -> pa.Table:
    return pa.ipc.open_stream(block.as_buffer()).read_all().combine_chunks()


def pack_block(rows: pa.Table) -> dict[str, bytes]:
    """Sets (id, terms and what else) in some bytes a term: heads without terms but with size, steps between a set's terms in the order of words, words."""
    size = sizes(rows, "terms")
    found = rows["terms"].combine_chunks().flatten().dictionary_encode()
    number = found.indices.to_numpy(zero_copy_only=False)
    order = np.argsort(-np.bincount(number, minlength=len(found.dictionary)), kind="stable")  # small numbers are common
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    steps = np.sort(np.repeat(np.arange(len(size)), size) * len(order) + place[number]) % max(1, len(order))
    inside = np.ones(len(steps), bool)
    inside[np.cumsum(size) - size] = False
    steps[1:] -= np.where(inside[1:], steps[:-1], 0)
    return {
        "heads": _packed(rows.drop_columns(["terms"]).append_column("size", pa.array(size.astype(np.int32)))),
        "steps": _packed(pa.table({"step": steps.astype(np.int32)})),
        "words": _packed(pa.table({"word": found.dictionary.take(pa.array(order))})),
    }


def unpack_block(row: pa.Table) -> tuple[pa.Table, np.ndarray, np.ndarray, pa.Array]:
    """Heads, sizes, numbers of terms and words of a packed block."""
    heads, steps, words = (_unpacked(row[name][0]) for name in ("heads", "steps", "words"))
    size = heads["size"].to_numpy().astype(np.int64)
    numbers = np.cumsum(steps["step"].to_numpy(), dtype=np.int64)
    first = np.cumsum(size) - size
    start = numbers[first] - steps["step"].to_numpy()[first]
    return heads, size, numbers - np.repeat(start, size), words["word"].combine_chunks()


def _prefixes(codes: np.ndarray, lengths: np.ndarray, rarity: np.ndarray, other: int, limit: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The rarest terms of sets, their number, how many terms are left, and how many of the rarest a near set of ``other`` terms or more has at least.

    Of common terms as many as are left may lie outside of the rarest ones. More of these than one are asked for, as sets that
    aren't near share one often and many hardly ever.
    """
    n = len(rarity)
    ordered = np.sort(np.repeat(np.arange(len(lengths)) * n, lengths) + rarity[codes]) % max(1, n)
    least = _overlap(lengths, np.maximum(other, np.ceil(limit * lengths - 1e-9)), limit)
    asked = np.minimum(1 + lengths // 8, least)
    most = np.clip(lengths - least + asked, 0, lengths)
    place = np.arange(len(ordered)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    return ordered[place < np.repeat(most, lengths)], most, lengths - most, asked


def _overlap(a: np.ndarray, b: np.ndarray, limit: float) -> np.ndarray:
    """Terms that near sets of these sizes share at least; sizes that can't be near count as if they were."""
    return np.maximum(np.ceil(limit / (1 + limit) * (a + b) - 1e-9).astype(np.int64), 1)


def _shared(a: np.ndarray, na: np.ndarray, b: np.ndarray, nb: np.ndarray, n: int, l: np.ndarray, r: np.ndarray) -> np.ndarray:
    """How many terms pairs share; r rises."""
    out, held = np.empty(len(l), np.int64), np.zeros(n, np.uint8)
    first_a, first_b = np.cumsum(na) - na, np.cumsum(nb) - nb
    heads = np.flatnonzero(np.diff(r, prepend=-1))
    for x, y in zip(heads, np.append(heads[1:], len(r)), strict=True):
        mine = b[first_b[r[x]] : first_b[r[x]] + nb[r[x]]]
        held[mine] = 1
        size = na[l[x:y]]
        listed = np.cumsum(size)
        cuts = np.unique(np.concatenate([[0], np.searchsorted(listed, np.arange(LISTED, listed[-1], LISTED)), [y - x]]))
        for u, v in zip(cuts, cuts[1:], strict=False):
            part = size[u:v]
            start = np.cumsum(part) - part
            at = np.repeat(first_a[l[x + u : x + v]] - start, part) + np.arange(part.sum())
            out[x + u : x + v] = np.add.reduceat(held[a[at]], start, dtype=np.int64)
        held[mine] = 0
    return out


def _near(a: np.ndarray, na: np.ndarray, b: np.ndarray, nb: np.ndarray, n: int, limit: float, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Left rows, right rows and Jaccards of near pairs, of sets as numbers of terms below ``n``; left before right where both sides are the same.

    Only pairs that share some of their rarest terms are looked at, whose number follows from the limit and the sizes.
    """
    if not len(na) or not len(nb):
        return
    held = np.bincount(a, minlength=n) + np.bincount(b, minlength=n)
    rarity = np.empty(n, np.int64)
    rarity[np.argsort(held, kind="stable")] = np.arange(n)
    few_a, most_a, left_a, asked_a = _prefixes(a, na, rarity, nb.min(), limit)
    few_b, most_b, left_b, asked_b = _prefixes(b, nb, rarity, na.min(), limit)
    rare, least = Postings(few_a, most_a, few_b, most_b, n), min(asked_a.min(), asked_b.min())
    for begin, end in stretches(rare.work, len(na), max(1, CELLS // 4)):
        common = rare.common(begin, end).ravel()
        at = np.flatnonzero(common >= least)
        if not len(at):
            continue
        r, l = np.divmod(at, len(na))
        r += begin
        fits = np.minimum(na[l], nb[r]) >= limit * np.maximum(na[l], nb[r]) - 1e-9
        fits &= common[at] >= _overlap(na[l], nb[r], limit) - np.maximum(left_a[l], left_b[r])
        if same:
            fits &= l < r
        r, l = r[fits], l[fits]
        if len(r):
            n_common = _shared(a, na, b, nb, n, l, r)
            jaccard = n_common / (na[l] + nb[r] - n_common)
            near = jaccard >= limit
            yield l[near], r[near], jaccard[near]


def _listed(left: pa.Table, right: pa.Table, found: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Iterator[pa.Table]:
    """Pairs of rows as a, b, jaccard: ids of rows."""
    for l, r, jaccard in found:
        yield pa.table({"a": left["id"].take(pa.array(l)), "b": right["id"].take(pa.array(r)), "jaccard": jaccard})


def near_rows(left: pa.Table, right: pa.Table, limit: float, same: bool) -> pa.Table:
    """Pairs of rows whose Jaccard of ``terms`` reaches ``limit``: a, b, jaccard; each once where both sides are the same."""
    a, b, n = numbered(left, right, "terms")
    found = list(_listed(left, right, _near(a, sizes(left, "terms"), b, sizes(right, "terms"), n, limit, same)))
    none = pa.table({"a": left["id"].slice(0, 0), "b": right["id"].slice(0, 0), "jaccard": pa.array([], pa.float64())})
    return pa.concat_tables([none, *found])


def _near_blocks(rows: pa.Table, limit: float) -> pa.Table:
    """``near_rows`` of the packed blocks i and j of a group; of sets with kinds only those with equal ones or an empty one are near."""
    left, right, same = halves(rows)
    if not left.num_rows or not right.num_rows:  # a block without sets meets none
        left = right = left if left.num_rows else right
        limit, same = 2.0, True
    first, na, a, words = unpack_block(left)
    second, nb, b, more = (first, na, a, words) if same else unpack_block(right)
    if same:
        n = len(words)
    else:
        both = pa.concat_arrays([words, more]).dictionary_encode()
        number, n = both.indices.to_numpy(zero_copy_only=False), len(both.dictionary)
        a, b = number[: len(words)][a], number[len(words) :][b]
    found = _near(a, na, b, nb, n, limit, same)
    if "kind" in first.column_names:
        kinds = pa.concat_arrays([t["kind"].combine_chunks() for t in (first, second)]).dictionary_encode()
        empty = np.array([not kind for kind in kinds.dictionary.to_pylist()], bool)
        number = kinds.indices.to_numpy(zero_copy_only=False)
        x, y = number[: len(na)], number[len(na) :]
        found = ((l[fit], r[fit], jaccard[fit]) for l, r, jaccard in found for fit in ((x[l] == y[r]) | empty[x[l]] | empty[y[r]],))
    none = first["id"].slice(0, 0)
    return pa.concat_tables([pa.table({"a": none, "b": none, "jaccard": pa.array([], pa.float64())}), *_listed(first, second, found)])


def near_sets(sets: DataFrame, limit: float) -> DataFrame:
    """Pairs left < right of a group's term sets with a Jaccard of at least ``limit``: left, right, jaccard.

    ``sets``: id, group, terms, distinct; of sets that have a kind as well, only those of one kind and those with an empty one are near.
    Empty sets are near to none. Sets are packed by blocks before these meet, so what is shuffled for each meeting is small.
    """
    kind, group = (sets.schema[name].dataType.simpleString() for name in ("id", "group"))

    def pack(placed: DataFrame) -> DataFrame:
        run = lambda rows: pa.table({"group": rows["group"].slice(0, 1), "own": rows["own"].slice(0, 1), **{k: pa.array([v], pa.binary()) for k, v in pack_block(rows.drop_columns(["group", "own"])).items()}})
        return placed.repartition(_parts(sets), "group", "own").groupBy("group", "own").applyInArrow(run, f"group {group}, own long, heads binary, steps binary, words binary")

    columns = ["id", "group", "terms", *[c for c in sets.columns if c == "kind"]]
    run = lambda rows: _near_blocks(rows, limit)
    met = paired(sets.select(*columns), "group", limit, pack=pack).repartition(_parts(sets), "group", "i", "j").groupBy("group", "i", "j").applyInArrow(run, f"a {kind}, b {kind}, jaccard double")
    return met.select(F.least("a", "b").alias("left"), F.greatest("a", "b").alias("right"), "jaccard")


def near_across(left: DataFrame, right: DataFrame, limit: float) -> DataFrame:
    """As ``near_sets`` for pairs of one left and one right set of a group: left, right, jaccard. Ids of both are of one type."""
    kind = left.schema["id"].dataType.simpleString()
    both = _dealt(*(frame.select("id", "group", "terms").where(F.size("terms") > 0) for frame in (left, right)), ["group"])

    def run(rows: pa.Table) -> pa.Table:
        return near_rows(rows.filter(rows["asks"]), rows.filter(pc.invert(rows["asks"])), limit, False)

    met = both.repartition(_parts(left), "group", "l", "r").groupBy("group", "l", "r").applyInArrow(run, f"a {kind}, b {kind}, jaccard double")
    return met.select(F.col("a").alias("left"), F.col("b").alias("right"), "jaccard")
