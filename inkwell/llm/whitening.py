"""Embedding whitening by a compensated covariance.

Components become whole numbers. Their sums are exact, so the mean is known as a whole part and a fraction in
double-double, and a centred component loses nothing. Outer products of centred vectors are formed in double-double by
error-free products and sums; a task keeps the upper triangle as high and low parts, and tasks' parts are merged, 64 at
a time, until few enough are left for the driver. The matrix has the square of the vectors' width, whatever the
number of rows. Its eigenvectors come from the tridiagonal divide and conquer solver that numpy's ``eigh`` calls;
eigenvalues are then formed anew from them in double-double, so that small ones keep their digits.

Results on unusual rows: a vector that is null or holds null or non-finite components is left out; what a vector
lacks to the longest one's length counts as zeros. Scaled components beyond 2 ** 61 count as that bound. A null id is kept.
Repeated rows count as often as they stand there. A component without variance has whitened null and explained 0, null
where nothing varies, and takes no part in identity_error, which is null without any component that varies. A deviation
beyond 63 bits is null. Vectors without components and empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.llm.codes import finite, matrix
from inkwell.session import drop_stored, stored

#: Rows whose outer products a worker holds at once, and partial results that one merge takes.
ROWS, MERGED = 32, 64
#: Scaled components are bounded so that differences and sums of two are still 64-bit integers.
BOUND = 2.0**61
#: A component has variance if its eigenvalue is above this share of the largest; exact zeros come out near 1e-31.
LEAST = 1e-26

Pair = tuple[np.ndarray, np.ndarray]


def two_sum(a: np.ndarray, b: np.ndarray) -> Pair:
    """The rounded sum and what rounding lost."""
    s = a + b
    t = s - a
    return s, (a - (s - t)) + (b - t)


def halves(a: np.ndarray) -> Pair:
    """A double as the sum of two that have half its bits."""
    c = 134217729.0 * a
    high = c - (c - a)
    return high, a - high


def add(a: Pair, b: Pair) -> Pair:
    """The sum of two double-doubles."""
    s, e = two_sum(a[0], b[0])
    e = e + (a[1] + b[1])
    high = s + e
    return high, e - (high - s)


def times(a: Pair, b: Pair) -> Pair:
    """The product of two double-doubles."""
    (a1, a2), (b1, b2) = halves(a[0]), halves(b[0])
    return product(a, b, a1, a2, b1, b2)


def product(a: Pair, b: Pair, a1, a2, b1, b2) -> Pair:
    """``times`` where the halves are known already."""
    p = a[0] * b[0]
    e = ((a1 * b1 - p) + a1 * b2 + a2 * b1) + a2 * b2
    e = e + (a[0] * b[1] + a[1] * b[0])
    high = p + e
    return high, e - (high - p)


def folded(pair: Pair) -> Pair:
    """The sum over rows, by halves."""
    high, low = pair
    while len(high) > 1:
        half = len(high) // 2
        rest = (high[2 * half :], low[2 * half :])
        high, low = add((high[:half], low[:half]), (high[half : 2 * half], low[half : 2 * half]))
        high, low = np.concatenate([high, rest[0]]), np.concatenate([low, rest[1]])
    return high[0], low[0]


def outer_sums(centred: Pair, i: np.ndarray, j: np.ndarray) -> Pair:
    """Sums of the products of columns i and j over all rows."""
    high, low = centred
    h1, h2 = halves(high)
    total = (np.zeros(len(i)), np.zeros(len(i)))
    for at in range(0, len(high), ROWS):
        rows = slice(at, at + ROWS)
        pick = lambda m, k: m[rows][:, k]  # noqa: E731, B023
        a, b = (pick(high, i), pick(low, i)), (pick(high, j), pick(low, j))
        total = add(total, folded(product(a, b, pick(h1, i), pick(h2, i), pick(h1, j), pick(h2, j))))
    return total


def covariance(rows: DataFrame, centred: Callable[[pa.RecordBatch], Pair], width: int) -> Pair:
    """The sum of the outer products of all rows, centred in a task, as high and low part."""
    i, j = np.triu_indices(width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, some = (np.zeros(len(i)), np.zeros(len(i))), False
        for batch in batches:
            if batch.num_rows:
                total, some = add(total, outer_sums(centred(batch), i, j)), True
        if some:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), *(pa.array([part.tolist()], pa.list_(pa.float64())) for part in total)], ["task", "high", "low"])

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        read = lambda name: np.stack([np.asarray(x.values) for x in table[name]])
        high, low = folded((read("high"), read("low")))
        return pa.table({"task": pa.array([key[0].as_py()], pa.int64()), "high": pa.array([high.tolist()], pa.list_(pa.float64())), "low": pa.array([low.tolist()], pa.list_(pa.float64()))})

    schema = "task long, high array<double>, low array<double>"
    parts = stored(rows.mapInArrow(run, schema), "products")
    most = parts.agg(F.max("task")).first()[0] or 0
    while most >= MERGED:
        after = stored(parts.groupBy(F.floor(F.col("task") / MERGED).alias("of")).applyInArrow(merge, schema), "products")
        drop_stored(parts)
        parts, most = after, most // MERGED
    found = parts.orderBy("task").toArrow()  # MERGED rows at most
    high, low = np.zeros((2, width, width))
    if found.num_rows:
        read = lambda name: np.stack([np.asarray(x.values) for x in found[name]])
        high[i, j], low[i, j] = folded((read("high"), read("low")))
        high[j, i], low[j, i] = high[i, j], low[i, j]
    drop_stored(parts)
    return high, low


def sums(rows: DataFrame, width: int, fill: int) -> tuple[int, list[int]]:
    """The number of rows and the exact sum of each component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = [0] * width, 0
        for batch in batches:
            x = matrix(batch["x"], width, fill)
            count += len(x)
            total = [t + (h << 32) + l for t, h, l in zip(total, (x >> 32).sum(0).tolist(), (x & 0xFFFFFFFF).sum(0).tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array([-1, *range(width)], pa.int32()), pa.array([Decimal(v) for v in (count, *total)], pa.decimal128(38, 0))], ["at", "value"])

    found = rows.select("x").mapInArrow(run, "at int, value decimal(38,0)").groupBy("at").agg(F.sum("value").alias("value"))
    value = {row["at"]: int(row["value"]) for row in found.collect()}  # a row for each component
    return value.get(-1, 0), [value.get(at, 0) for at in range(width)]


class Centre:
    """The mean of each component: a whole part, and a fraction in double-double."""

    def __init__(self, n: int, totals: list[int], fill: int):
        self.n, self.fill, self.width = n, fill, len(totals)
        whole, rest = zip(*(divmod(total, n) for total in totals), strict=True)
        self.whole, self.rest = np.array(whole, np.int64), np.array(rest, object)
        high = [r / n for r in rest]
        # What the rounded quotient lost, from whole numbers: r - high * n with high as a ratio of two.
        low = [(r * b - a * n) / (b * n) for r, (a, b) in zip(rest, (h.as_integer_ratio() for h in high), strict=True)]
        self.fraction = (np.array(high), np.array(low))

    def whole_steps(self, batch: pa.RecordBatch) -> np.ndarray:
        return matrix(batch["x"], self.width, self.fill) - self.whole

    def centred(self, batch: pa.RecordBatch) -> Pair:
        steps = self.whole_steps(batch)
        high = steps.astype(np.float64)
        s, e = two_sum(high, -self.fraction[0])
        e = e + ((steps - high.astype(np.int64)) - self.fraction[1])
        first = s + e
        return first, e - (first - s)

    def deviations(self, batch: pa.RecordBatch) -> list[int | None]:
        """The exact sum of the squares of n * x - sum."""
        steps = self.whole_steps(batch)
        most = self.n * (int(np.abs(steps).max(initial=0)) + 1)
        if self.width * most * most < 2**63:
            return ((steps * self.n - self.rest.astype(np.int64)) ** 2).sum(1).tolist()
        exact = ((steps.astype(object) * self.n - self.rest) ** 2).sum(1).tolist()
        return [value if value < 2**63 else None for value in exact]


def components(high: np.ndarray, low: np.ndarray, n: int, count: int) -> tuple[np.ndarray, list[float], float]:
    """The first eigenvectors as columns, by falling eigenvalue, their eigenvalues, and the trace, of the sums over n."""
    _, vectors = np.linalg.eigh(high / n)
    vectors = vectors[:, ::-1]
    values = []
    for v in vectors.T:
        square = times((v[:, None], np.zeros((len(v), 1))), (v[None, :], np.zeros((1, len(v)))))
        top, rest = times(square, (high, low))
        length = times((v, np.zeros(len(v))), (v, np.zeros(len(v))))
        values.append(math.fsum([*top.ravel(), *rest.ravel()]) / math.fsum([*length[0], *length[1]]) / n)
    order = np.argsort([-value for value in values], kind="stable")[:count]
    return vectors[:, order], [values[k] for k in order], math.fsum([*np.diag(high), *np.diag(low)]) / n


def whiten(vectors: DataFrame, most: int = 32, scale: int = 64, shift: int = 1_000_000, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per vector and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    spark = vectors.sparkSession
    kept = vectors.select(vectors[id_col].cast("long").alias("vec_id"), vectors[vector_col].cast("array<double>").alias("embedding")).where(finite(F.col("embedding")))
    scaled = F.transform("embedding", lambda c: F.floor(F.greatest(F.least(c * F.lit(float(scale)), F.lit(BOUND)), F.lit(-BOUND))) + F.lit(shift))
    rows = stored(kept.select("vec_id", scaled.alias("x")), "scaled")
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    width = rows.agg(F.max(F.size("x"))).first()[0]
    if not width:
        return spark.createDataFrame([], schema)
    n, totals = sums(rows, width, shift)
    centre = Centre(n, totals, shift)
    high, low = covariance(rows, centre.centred, width)
    axes, values, trace = components(high, low, n, min(most, width))
    varies = np.array([value > LEAST * max(values) and value > 0 for value in values])
    axes = axes[:, varies] / np.sqrt(np.array(values)[varies])

    def projected(batch: pa.RecordBatch) -> np.ndarray:
        return centre.centred(batch)[0] @ axes

    error = identity_error(rows, projected, n, int(varies.sum())) if varies.any() else None
    explained = [None if trace == 0 else value / trace if some else 0.0 for value, some in zip(values, varies.tolist(), strict=True)]
    count = len(values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1_024):
                batch = whole.slice(at, 1_024)
                size = batch.num_rows
                found, missing = np.zeros((size, count)), np.tile(~varies, size)
                found[:, varies] = projected(batch)
                each = np.repeat(np.arange(size), count)
                columns = [
                    batch["vec_id"].take(pa.array(each)), pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), size)), pa.array(np.full(len(each), n)),
                    pa.array(centre.deviations(batch), pa.int64()).take(pa.array(each)), pa.array(found.ravel(), mask=missing),
                    pa.array(explained, pa.float64()).take(pa.array(np.tile(np.arange(count), size))), pa.array([error] * len(each), pa.float64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, schema)


def identity_error(rows: DataFrame, projected: Callable[[pa.RecordBatch], np.ndarray], n: int, count: int) -> float:
    """The largest entry of the covariance of projected rows minus the identity, the mean taken off first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = (np.zeros(count), np.zeros(count))
        for batch in batches:
            found = projected(batch)
            if len(found):
                total = add(total, folded((found, np.zeros_like(found))))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(count, dtype=np.int32)), pa.array(total[0] + total[1])], ["at", "value"])

    mean = np.zeros(count)
    for row in rows.mapInArrow(run, "at int, value double").groupBy("at").agg(F.sum("value").alias("value")).collect():  # a row for each component
        mean[row["at"]] = row["value"] / n

    def centred(batch: pa.RecordBatch) -> Pair:
        return two_sum(projected(batch), -mean)

    high, low = covariance(rows, centred, count)
    return float(np.abs((high + low) / n - np.eye(count)).max())
