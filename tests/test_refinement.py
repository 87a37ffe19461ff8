from collections import defaultdict

import pytest


def starts_of(n, size=32, overlap=12, least=10):
    """Windows at each step until one reaches the end, the last one pulled back."""
    if n <= max(size, least):
        return [0]
    starts = list(range(0, n - size + 1, size - overlap))
    return starts if starts[-1] == n - size else [*starts, n - size]


def vote(lines):
    """The votes on a segment's boundaries; lines are (position, size, comma, early)."""
    votes = defaultdict(lambda: [0.0, 0, 0, 0])
    chances = defaultdict(int)
    for start in starts_of(len(lines)):
        window = lines[start : start + 32]
        for line in window[:-1]:
            chances[line[0]] += 1
        for position, size, comma, early in window:
            v = votes[position]
            if comma and size < 120 and position < window[-1][0]:
                v[0] += (0.5 if size < 60 else 0.75) * (0.65 if early else 1) * (0.5 if size > 100 else 1)
            if size < 100:
                name = "hard" if size < 13 else "strong" if size < 25 else "forbid" if size < 40 else "weak"
                v[0] += 0 if comma else {"hard": 1.5, "strong": 1.0, "weak": 0.5, "forbid": 0.0}[name]
                for at, strength in enumerate(("hard", "strong", "forbid"), 1):
                    v[at] += name == strength
            if size > 600:
                v[0] += 0.25
    return {place: (v[0], v[0] / chances[place], *v[1:]) for place, v in votes.items() if chances[place] and (v[0] or any(v[1:]))}


def chosen(votes, support, hard, strong, forbid):
    return not forbid > max(hard, strong) and ((hard > 0 and forbid == 0) or (votes >= 2 and support >= 0.55) or (support >= 0.8 and votes >= 1))


def forced(lines, votes, most=24):
    cuts, start, n = [], 0, len(lines)
    while n - start > most:
        target = min(n - 2, start + most - 1)
        places = [i for i in range(max(start + 2, target - 4), min(n - 2, target + 4) + 1) if i >= min(n - 2, start + max(5, most // 2) - 1)] or [target]

        def score(i):
            position, size, _, early = lines[i]
            _, support, hard, strong, forbid = votes.get(position, (0, 0.0, 0, 0, 0))
            return round(min(1.0, size / 400) + support + 1.2 * hard + 0.5 * strong - 0.9 * forbid + early - 0.03 * abs(i - target), 6)

        best = max(places, key=lambda i: (score(i), -i))
        cuts.append(lines[best][0])
        start = best + 1
    return cuts


def plain(lines, depth=1):
    """The plain recursion: segments as lists."""
    if len(lines) <= 24:
        return [lines]
    votes = vote(lines)
    cuts = [place for place, v in votes.items() if chosen(*v) and place != lines[-1][0]] if depth <= 2 else []
    cuts = set(cuts or forced(lines, votes))
    parts, now = [], []
    for line in lines:
        now.append(line)
        if line[0] in cuts:
            parts, now = [*parts, now], []
    return [done for part in [*parts, *([now] if now else [])] for done in plain(part, depth + 1)]


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_refined_segments_equal_plain_recursion(spark, sf):
    from inkwell.plans import QUERIES

    texts = defaultdict(list)
    for doc_id, text in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect():
        for position, line in enumerate((text or "").split("\n")):
            if line.strip(" "):
                texts[doc_id].append((position, len(line), "," in line, line[:1] in tuple("ABCDEFGHIJKLM")))
    want = {(doc, line[0]): part[0][0] for doc, lines in texts.items() for part in plain(lines) for line in part}
    rows = QUERIES["refined_segments"](spark, sf).collect()
    assert len(rows) == len(want) and {(r.doc_id, r.position): r["first"] for r in rows} == want
    sizes = defaultdict(int)
    for (doc, _), first in want.items():
        sizes[doc, first] += 1
    assert max(sizes.values()) <= 24


def test_forced_cuts(spark):
    from inkwell.operators.sequences import forced_cuts
    from pyspark.sql import functions as F

    peaks = [0.0] * 60
    peaks[20], peaks[45] = 5.0, 5.0
    rows = spark.createDataFrame([(peaks,), ([0.0] * 24,), ([0.0] * 25,), ([],), ([0.0] * 100,)], "s array<double>")
    got = [r[0] for r in rows.select(forced_cuts(F.col("s"))).collect()]
    assert got == [[20, 45], [], [23], [], [23, 47, 71, 95]]


def test_refinement_of_no_rows(spark):
    from inkwell.operators.sequences import refined
    from inkwell.plans.sequence_queries import _answers

    lines = spark.createDataFrame([], "doc_id long, position int, size int, comma boolean, early boolean")
    assess = spark.createDataFrame([], "doc_id long, boundary int, confidence double, split boolean")
    segments = spark.createDataFrame([], "doc_id long, position int, first int")
    assert refined(lines, segments, "doc_id", "position", _answers(lines), assess).collect() == []
