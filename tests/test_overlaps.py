import random
from functools import partial

import pytest
from pyspark.sql import functions as F


def made(seed, n, words=40, most=12):
    r = random.Random(seed)
    base = [sorted(r.sample(range(words), r.randint(0, most))) for _ in range(n)]
    near = [sorted(set(x) ^ {r.randrange(words)}) for x in base[: n // 2]]  # near copies
    sets = base[: n - n // 2] + near
    return [(i, "ab"[i % 3 % 2], [f"t{x}" for x in terms]) for i, terms in enumerate(sets)]


def jaccard(a, b):
    a, b = set(a), set(b)
    return len(a & b) / len(a | b) if a | b else 0.0


@pytest.fixture
def small(monkeypatch):
    """Many blocks and short stretches."""
    from inkwell.operators import overlaps as O

    monkeypatch.setattr(O, "paired", partial(O.paired, block=7))
    for name, value in {"LEFT": 3, "RIGHT": 5, "CELLS": 16, "LISTED": 8}.items():
        monkeypatch.setattr(O, name, value)
    return O


@pytest.mark.parametrize("limit", [0.08, 0.5, 0.72, 1.0])
def test_near_sets_equal_all_pairs(spark, small, limit):
    rows = made(1, 60)
    got = small.near_sets(spark.createDataFrame(rows, "id long, group string, terms array<string>"), limit).collect()
    want = {(a[0], b[0]): jaccard(a[2], b[2]) for a in rows for b in rows if a[0] < b[0] and a[1] == b[1] and a[2] and b[2]}
    assert len(got) == len({(r.left, r.right) for r in got})
    assert {(r.left, r.right): r.jaccard for r in got} == {k: j for k, j in want.items() if j >= limit}


@pytest.mark.parametrize("listed", [8, 1 << 21])
def test_rows_in_one_task_equal_all_pairs(monkeypatch, listed):
    import pyarrow as pa
    from inkwell.operators import overlaps as O

    monkeypatch.setattr(O, "LISTED", listed)
    rows = made(2, 80, 300, 60)
    table = pa.table({"id": [r[0] for r in rows if r[2]], "terms": [r[2] for r in rows if r[2]]})
    for limit in (0.3, 0.72):
        got = O.near_rows(table, table, limit, True).to_pylist()
        want = {(a[0], b[0]): jaccard(a[2], b[2]) for a in rows for b in rows if a[0] < b[0] and a[2] and b[2]}
        assert {(x["a"], x["b"]): x["jaccard"] for x in got} == {k: j for k, j in want.items() if j >= limit}


def test_close_pairs_are_counted_once(spark, small):
    rows = made(3, 60)
    got = small.close_pairs(spark.createDataFrame(rows, "id long, group string, terms array<string>"), "group", 0.2).collect()
    for kind in "ab":
        want = sum(jaccard(a[2], b[2]) >= 0.2 for a in rows for b in rows if a[0] < b[0] and a[1] == b[1] == kind)
        assert [r.close for r in got if r.group == kind] == [want]


def test_best_pairs_hold_the_best(spark, small):
    rows = made(4, 60)
    frame = spark.createDataFrame(rows, "id long, key string, terms array<string>")
    got = small.best_pairs(frame.where("id % 5 = 0"), frame, ["key"], 3, ["terms"]).orderBy("left", F.desc("score"), "right").collect()
    for left in rows[::5]:
        scores = sorted((-jaccard(left[2], b[2]), b[0]) for b in rows if b[0] != left[0] and b[1] == left[1] and jaccard(left[2], b[2]))
        assert [(-r.score, r.right) for r in got if r.left == left[0]][:3] == scores[:3]


def test_sets_across_meet_each_other_only(spark, small):
    """Candidates aren't compared with candidates, of which there may be far more than patterns."""
    rows = made(5, 60)
    frame = spark.createDataFrame(rows, "id long, group string, terms array<string>")
    got = small.near_across(frame.where("id < 20"), frame.where("id >= 20"), 0.5).collect()
    want = {(a[0], b[0]): jaccard(a[2], b[2]) for a in rows[:20] for b in rows[20:] if a[1] == b[1]}
    assert {(r.left, r.right): r.jaccard for r in got} == {k: j for k, j in want.items() if j >= 0.5}


def test_scores_are_rounded_as_sql_does(spark):
    """Halves of the fifth place by their decimal digits; fractions of such sizes are common."""
    import numpy as np
    from inkwell.operators.neighbours import _rounded

    values = [0.45 + 0.3 * n / m for m in (16, 32, 48, 80, 160) for n in range(m)] + [0.3 * n / m + 0.1 * k / 8 for m in (16, 80) for n in range(m) for k in range(8)]
    got = spark.createDataFrame([(v,) for v in values], "v double").select(F.round("v", 4)).collect()
    assert [r[0] for r in got] == _rounded(np.array(values)).tolist()


def test_sets_of_a_block_are_packed_whole():
    """Blocks are shuffled for each other block that they meet, so they are packed, in fewer bytes than the words have."""
    import pyarrow as pa
    from inkwell.operators import overlaps as O

    rows = [r for r in made(6, 900, 300, 60) if r[2]]
    packed = O.pack_block(pa.table({"id": [r[0] for r in rows], "terms": [r[2] for r in rows]}))
    assert sum(map(len, packed.values())) < sum(len(t) for r in rows for t in r[2])
    heads, size, numbers, words = O.unpack_block(pa.table({k: pa.array([v], pa.binary()) for k, v in packed.items()}))
    ends = size.cumsum()
    got = [(i, sorted(words.take(pa.array(numbers[end - n : end])).to_pylist())) for i, n, end in zip(heads["id"].to_pylist(), size, ends, strict=True)]
    assert got == [(r[0], sorted(r[2])) for r in rows]


def test_sets_that_share_a_few_rare_terms_are_not_compared(monkeypatch):
    import pyarrow as pa
    from inkwell.operators import overlaps as O

    looked, shared = [], O._shared
    monkeypatch.setattr(O, "_shared", lambda *a: looked.append(len(a[-1])) or shared(*a))
    r = random.Random(7)
    sets = [[f"r{i // 2}", *{f"w{int(3000 * r.random() ** 2)}" for _ in range(150)}] for i in range(200)]
    sets.append(sets[0][:-5])
    table = pa.table({"id": list(range(len(sets))), "terms": sets})
    got = [(x["a"], x["b"]) for x in O.near_rows(table, table, 0.72, True).to_pylist()]
    assert got == [(0, 200)]
    assert sum(looked) <= 3  # each of 100 rare terms is in two sets


def test_a_library_is_many_tasks(spark):
    """One block of a library's 9,000 sets would be one task's work."""
    from inkwell.operators import overlaps as O

    frame = spark.range(9000).selectExpr("id", "'a' AS group", "array(concat('t', id), concat('u', id)) AS terms")
    dealt = O.paired(frame, "group", 0.72, pack=lambda placed: placed.select("group", "own").distinct())
    assert dealt.select("i", "j").distinct().count() >= 28
    assert O.near_sets(frame, 0.72).count() == 0
