import hashlib
import math
from fractions import Fraction

import numpy as np
import pytest

INF, NAN = math.inf, math.nan
SCHEMA = "vec_id long, embedding array<double>, label int, code string, node long, x string, first int, query int, length int, row string, asks int, at int"
CLASH = ("c", 1, "x", 2, 3, 4, "row", 5, 6)
UNUSUAL = [(None, [0.5, -0.25, 0.125, 1.0], 1), (900, None, 1), (901, [0.1, None, 0.2, 0.3], 1), (902, [0.1, NAN, 0.2, 0.3], None), (903, [INF, 0.0, 0.0, 0.0], 2), (904, [0.0] * 4, None), (905, [], 3), (906, [0.3, -0.1], None)]


def table(spark, rows):
    return spark.createDataFrame([(*row, *CLASH) for row in rows], SCHEMA).repartition(3)


def drawn(n, width=4, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((5, width))
    return [(i, (centres[i % 5] * (0.3 if i % 7 else 1) + 0.2 * rng.standard_normal(width)).round(3).tolist(), i % 3 if i % 11 else None) for i in range(n)]


def usable(rows):
    return [(i, v, label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]


def plain_codes(rows, parts, entries, rounds=6, scale=4096):
    rows = sorted(usable(rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = -(-max(len(v) for _, v, _ in rows) // parts)
    whole = [[math.floor(scale * x) for x in v] + [0] * (width * parts - len(v)) for _, v, _ in rows]
    cut = [[w[p * width : (p + 1) * width] for p in range(parts)] for w in whole]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]

    def away(part, entry):
        return sum((a - b) ** 2 for a, b in zip(part, entry, strict=True))

    def assign():
        return [[min(range(len(books[p])), key=lambda e: (away(c[p], books[p][e]), e)) for p in range(parts)] for c in cut]

    for _ in range(rounds):
        codes = assign()
        for p in range(parts):
            for e in range(len(books[p])):
                own = [c[p] for c, code in zip(cut, codes, strict=True) if code[p] == e]
                if own:
                    books[p][e] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    codes = assign()
    errors = [sum(away(c[p], books[p][code[p]]) for p in range(parts)) for c, code in zip(cut, codes, strict=True)]
    sums = {}
    for (_, _, label), error in zip(rows, errors, strict=True):
        sums[label] = sums.get(label, 0) + error
    digest = hashlib.sha256(",".join(str(x) for p in books for e in p for x in e).encode()).hexdigest()
    return sorted(((i, bytes(code).hex(), error, sums[label], digest) for (i, _, label), code, error in zip(rows, codes, errors, strict=True)), key=str)


@pytest.mark.parametrize("rows", [drawn(700) + UNUSUAL + drawn(40), [(i, [float(i % 3), 1.0, 2.0, -1.0], 0) for i in range(60)], drawn(3)], ids=["unusual", "ties", "few"])
def test_codes_equal_plain_rounds(spark, rows):
    from inkwell.llm.codes import compress

    got = sorted((tuple(r) for r in compress(table(spark, rows), parts=2, entries=8).collect()), key=str)
    assert got == plain_codes(rows, 2, 8)


def test_codes_of_extremes(spark):
    from inkwell.llm.codes import compress

    got = compress(table(spark, [(1, [1e300, -1e300, 0.0, 0.5], 1), (2, [0.0] * 4, 1)]), parts=2).collect()
    assert len(got) == 2 and all(r.error == 0 for r in got)
    for rows in ([], UNUSUAL[1:5]):
        assert compress(table(spark, rows)).collect() == []


def test_heaps_leave_settled_parts_alone():
    from inkwell.llm.codes import Block, integers

    x = integers(np.random.default_rng(1).standard_normal((500, 16)), 4096)
    books = x[:4].reshape(4, 2, 8).transpose(1, 0, 2).copy()
    block = Block(x, 2, 4)
    for part in range(2):
        block.place(part, np.arange(500), books, np.zeros((2, 4)))
    before = block.codes()
    placed = []
    block.place = lambda part, rows, *_: placed.append(len(rows))
    block.settle(books, np.full((2, 4), 50.0))
    assert before.shape == (500, 2) and 0 < sum(placed) < 100


def plain_whitening(rows, most):
    rows = usable(rows)
    width = max(len(v) for _, v, _ in rows)
    x = [[math.floor(64 * c) + 1_000_000 for c in v] + [1_000_000] * (width - len(v)) for _, v, _ in rows]
    n, sums = len(x), [sum(column) for column in zip(*x, strict=True)]
    steps = [[n * a - s for a, s in zip(row, sums, strict=True)] for row in x]
    cov = np.array([[float(Fraction(sum(r[i] * r[j] for r in steps), n**3)) for j in range(width)] for i in range(width)])
    values, axes = np.linalg.eigh(cov)
    order = np.argsort(-values)[:most]
    return rows, n, steps, values[order], axes[:, order], np.trace(cov)


@pytest.mark.parametrize("rows", [drawn(150, 6) + UNUSUAL, drawn(40, 40)], ids=["unusual", "wide"])
def test_whitening_equals_exact_covariance(spark, rows):
    from inkwell.llm.whitening import whiten

    known, n, steps, values, axes, trace = plain_whitening(rows, 32)
    got = whiten(table(spark, rows)).toPandas()
    count = len(values)
    assert len(got) == len(known) * count and set(got.n) == {n} and set(got.component) == set(range(1, count + 1))
    want = {}
    for (i, _, _), step in zip(known, steps, strict=True):
        want.setdefault(None if i is None else i, []).append((sum(s * s for s in step), np.array(step) / n @ axes))
    varies = [c for c in range(count) if values[c] > 1e-9 * values[0]]
    for c in varies:
        part = got[got.component == c + 1]
        assert np.allclose(part.explained, values[c] / trace, rtol=1e-9)
        signs = []
        for _, row in part.iterrows():
            deviation, projected = want[None if row.vec_id != row.vec_id else int(row.vec_id)][0]
            assert int(row.deviation) == deviation
            w = projected[c] / math.sqrt(values[c])
            assert abs(abs(row.whitened) - abs(w)) < 1e-6
            signs.append(np.sign(row.whitened * w) if abs(w) > 1e-6 else 0)
        assert len({s for s in signs if s}) == 1
    assert got.identity_error.max() < 1e-9
    flat = [c for c in range(count) if c not in varies]
    assert got[got.component.isin([c + 1 for c in flat])].whitened.isna().all()


def test_whitening_of_unusual_tables(spark):
    from inkwell.llm.whitening import whiten

    for rows in ([], UNUSUAL[1:5], [(1, [], 1)]):
        assert whiten(table(spark, rows)).collect() == []
    one = whiten(table(spark, [(1, [0.5, 0.25, 0.0, 0.0], 1)])).collect()
    assert [(r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in sorted(one, key=lambda r: r.component)] == [(c, 1, 0, None, None, None) for c in (1, 2, 3, 4)]
    far = whiten(table(spark, [(1, [1e300, 1.0, 0.0, 0.0], 1), (2, [-1e300, 2.0, 0.0, 0.0], 1)])).collect()
    assert all(r.deviation is None for r in far) and {r.component for r in far} == {1, 2, 3, 4}


def test_compensated_sums_keep_what_doubles_lose():
    from inkwell.llm.whitening import outer_sums

    rng = np.random.default_rng(2)
    high = rng.standard_normal((333, 3)) * 10.0 ** rng.integers(-9, 9, (333, 3))
    i, j = np.triu_indices(3)
    a, b = outer_sums((high, np.zeros_like(high)), i, j)
    for k, (p, q) in enumerate(zip(i, j, strict=True)):
        exact = sum(Fraction(x) * Fraction(y) for x, y in zip(high[:, p], high[:, q], strict=True))
        size = sum(abs(x * y) for x, y in zip(high[:, p], high[:, q], strict=True))
        assert abs(Fraction(a[k]) + Fraction(b[k]) - exact) < Fraction(size) * Fraction(2) ** -98


def test_covariance_merges_many_tasks(spark):
    from inkwell.llm.whitening import Centre, covariance

    x = [[i * i % 17, i % 5, 3] for i in range(600)]
    rows = spark.createDataFrame([(v,) for v in x], "x array<long>").repartition(150)
    centre = Centre(len(x), [sum(c) for c in zip(*x, strict=True)], 0)
    high, low = covariance(rows, centre.centred, 3)
    steps = np.array(x) - np.mean(x, axis=0)
    assert np.allclose(high + low, steps.T @ steps)


def plain_neighbours(rows, count=5):
    rows = [(i, v) for i, v, _ in usable(rows) if i is not None and any(v)]
    unit = [np.array(v) / math.sqrt(sum(x * x for x in v)) for _, v in rows]
    found = []
    for k, (i, v) in enumerate(rows):
        if i % 50 == 0:
            ranked = sorted((round(-float(unit[k] @ unit[m]), 12), j) for m, (j, w) in enumerate(rows) if m != k and len(w) == len(v))
            found += [(i, rank + 1, j, -score) for rank, (score, j) in enumerate(ranked[:count])]
    return sorted(found)


@pytest.mark.parametrize("extra", [UNUSUAL, [(2_000 + i, [0.5, 0.25, -0.5, 0.25], 1) for i in range(400)] + [(50, [0.1, 0.2, 0.3, 0.4], 0)]], ids=["unusual", "copies"])
def test_neighbours_equal_brute_force(spark, extra):
    from inkwell.llm.forest import neighbours

    rows = drawn(300) + extra
    got = sorted((r.query_id, r.rank, r.vec_id, round(r.score, 12)) for r in neighbours(table(spark, rows)).collect())
    assert got == plain_neighbours(rows)


def test_neighbours_of_small_tables(spark):
    from inkwell.llm.forest import neighbours

    assert neighbours(table(spark, [])).collect() == []
    assert neighbours(table(spark, [(0, [1.0, 2.0], 1), (1, None, 1)])).collect() == []
    got = neighbours(table(spark, [(0, [1.0, 2.0], 1), (7, [2.0, 4.0], 1), (3, [1.0, 2.0], 1)])).collect()
    assert [(r.rank, r.vec_id) for r in sorted(got, key=lambda r: r.rank)] == [(1, 3), (2, 7)]


def test_neighbours_through_many_leaves(spark, monkeypatch):
    """Recall against brute force where each tree has dozens of leaves and each leaf several blocks."""
    from inkwell.llm import forest

    monkeypatch.setattr(forest, "LEAF", 40)
    monkeypatch.setattr(forest, "BLOCK", 16)
    frame = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = {(r.query_id, r.vec_id): r.score for r in forest.neighbours(frame).collect()}
    rows = [(r.vec_id, [float(x) for x in r.embedding], None) for r in frame.collect()]
    want = plain_neighbours(rows)
    hits = [score for i, _, j, score in want if (i, j) in got]
    assert len(got) == len(want) and len(hits) >= 0.9 * len(want)
    assert all(abs(got[i, j] - score) < 1e-9 for i, _, j, score in want if (i, j) in got)


def test_tree_costs_match_paths():
    from inkwell.llm.forest import Forest

    rng = np.random.default_rng(4)
    rows = rng.standard_normal((300, 8))
    rows /= np.sqrt((rows * rows).sum(1, keepdims=True))
    found = Forest(rows, 20)
    margins = [m[0] for m in found.margins(rows[:1])]
    for t, tree in enumerate(found.trees):
        assert sorted(set(tree.place(rows))) == list(range(tree.leaves))
        costs = tree.cost_of(margins[t], np.arange(tree.leaves))
        assert costs[tree.place(rows[:1])[0]] == 0
        seen = [leaf for of, leaf in found.search(margins, 0.05) if of == t]
        assert sorted(seen) == np.flatnonzero(costs <= 0.05).tolist()
