import random


def loop(rows, limit):
    """Greedy suppression as a plain loop: (library, name) to cluster."""
    out, accepted = {}, {}
    for library, name, _, terms in sorted(rows, key=lambda r: (-r[2], r[1])):
        own, kept = set(terms), accepted.setdefault(library, [])
        near = next((other for other, theirs in kept if own | theirs and len(own & theirs) / len(own | theirs) >= limit), None)
        if near is None:
            kept.append((name, own))
        out[library, name] = near or name
    return out


def test_suppression_equals_a_loop(spark):
    from inkwell.operators.patterns import suppressed

    rng = random.Random(3)
    rows = []
    for i in range(300):
        terms = [f"t{i // 15}_{n}" for n in range(8) if rng.random() < 0.8] + rng.sample("uvw", rng.randint(0, 1))
        rows.append((rng.choice(("en", "de")), f"n{i}", rng.randint(0, 20), terms if i % 40 else []))
    frame = spark.createDataFrame(rows, "lib string, name string, support long, terms array<string>")
    got = {(r.lib, r.name): r.cluster for r in suppressed(frame, "lib", "name", "support", "terms", 0.5).collect()}
    assert got == loop(rows, 0.5)


def test_suppressed_patterns_take_whole_texts(spark, tmp_path):
    from inkwell.plans import QUERIES

    word = lambda n: "".join(chr(97 + n // 26**k % 26) for k in range(9))
    opening = " ".join(map(word, range(40)))
    texts = [f"{opening} {' '.join(map(word, range(first, first + 200)))}" for first in (1000, 2000, 1001)]
    spark.createDataFrame([(i, t, "en", "s", len(t) - i) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.name: r.cluster for r in QUERIES["suppressed_patterns"](spark, str(tmp_path)).collect()}
    assert got == {"0": "0", "1": "1", "2": "0"}


def test_near_patterns_are_pairs_of_numbers(spark, monkeypatch):
    """Pairs may be many, so neither hashes nor orders are written for each."""
    from inkwell.operators import patterns as P

    kept, stored = {}, P.stored
    monkeypatch.setattr(P, "stored", lambda frame, name: kept.setdefault(name, stored(frame, name)))
    rows = [("en", f"n{i}", i, [f"t{k}" for k in range(i % 7, 12)]) for i in range(60)] + [(None, "x", 1, ["a"]), (None, "y", 2, ["a"]), ("en", "z", 1, [])]
    frame = spark.createDataFrame(rows, "lib string, name string, support long, terms array<string>")
    got = {(r.lib, r.name): r.cluster for r in P.suppressed(frame, "lib", "name", "support", "terms", 0.5).collect()}
    assert [c.dataType.simpleString() for c in kept["near"].schema] == ["bigint", "bigint"]
    assert got == loop(rows[:60], 0.5) | {(None, "x"): "y", (None, "y"): "y", ("en", "z"): "z"}
