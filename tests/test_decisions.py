import pytest

PATTERNS = "pattern_id string, library string, name string, terms array<string>, layer string, position long, made boolean, axes array<string>, risks array<string>, books long, instances long"
INSTANCES = "instance_id string, library string, pattern_id string, book string, candidate_id string, evidence array<string>, grounded int, completeness double"
SUPPORT = "pattern_id string, library string, book string"
ACCEPTED = "candidate_id string, library string, decision string, target_id string, position long, book string, name string, terms array<string>, axes array<string>, risks array<string>, evidence array<string>, grounded int, completeness double"
LIBRARY = "EventsLibrary"


def pattern(pattern_id, name, terms, layer="emerging", made=False, position=0, axes=()):
    return (pattern_id, LIBRARY, name, terms, layer, position, made, list(axes), [], 0, 0)


def accepted(candidate_id, decision, target=None, position=0, book="b1", name=None, terms=(), axes=(), evidence=("e1",), grounded=0, completeness=0.0):
    return (candidate_id, LIBRARY, decision, target, position, book, name, list(terms), list(axes), None, list(evidence), grounded, completeness)


@pytest.fixture
def store(spark, tmp_path):
    from inkwell.sources.snapshots import Snapshots

    made = Snapshots(spark, f"file://{tmp_path}/library")
    rows = [pattern("event_1", "Old Pattern", ["a", "b", "c", "d"], axes=["x"]), pattern("event_2", "Other", ["q"], position=1), pattern("event_7", "All", ["u", "v"], "universal"), pattern("event_3", "Lonely", ["z"], made=True, position=2)]
    made.commit({"patterns": spark.createDataFrame(rows, PATTERNS), "instances": spark.createDataFrame([], INSTANCES), "support": spark.createDataFrame([], SUPPORT)}, None)
    return made


def run(spark, store, *rows):
    from inkwell.operators.decisions import commit_to

    return commit_to(store, spark.createDataFrame(list(rows), ACCEPTED))


def state(store):
    patterns = {r.pattern_id: (r.layer, r.books, r.instances, tuple(r.axes or ())) for r in store.read("patterns").collect()}
    return patterns, {r.instance_id: (r.pattern_id, r.completeness) for r in store.read("instances").collect()}


def test_same_batch_changes_nothing(spark, store):
    batch = [
        accepted("c1", "merge_existing", "event_1"), accepted("c2", "create_new", None, 1, name="Brand New", terms=["k", "l", "m"]), accepted("c3", "create_new", None, 2, name="brandnew", terms=["other"]),
        accepted("c4", "create_new", None, 3, name="Similar", terms=["a", "b", "c", "d"]), accepted("c5", "enrich_existing", "event_1", 4, axes=["x", "y"]), accepted("c6", "enrich_existing", "event_7", 5, axes=["y"]),
        accepted("c7", "merge_existing", "nowhere", 6), accepted("c8", "reject", None, 7), accepted("c9", "create_new", None, 8, name="Third", terms=["k", "l", "m", "n"], evidence=["e9"]),
    ]
    version, counts = run(spark, store, *batch)
    patterns, instances = state(store)
    assert version == 2 and counts == {"merged": 5, "created": 1, "enriched": 1, "held": 2, "instances_added": 4, "instances_duplicate": 3, "patterns_pruned": 1}
    assert patterns == {"event_1": ("emerging", 1, 1, ("x", "y")), "event_2": ("emerging", 0, 0, ()), "event_7": ("universal", 1, 1, ()), "emerging_event_0008": ("emerging", 1, 2, ())}
    assert set(instances) == {f"{LIBRARY}:b1:{p}" for p in ("event_1:e1", "event_7:e1", "emerging_event_0008:e1", "emerging_event_0008:e9")}
    again, counts = run(spark, store, *batch)
    assert again == 2 and state(store) == (patterns, instances)
    assert "created" not in counts and "instances_added" not in counts


def test_candidate_moves_to_another_pattern(spark, store):
    run(spark, store, accepted("c1", "merge_existing", "event_1"))
    _, counts = run(spark, store, accepted("c1", "merge_existing", "event_2"))
    patterns, instances = state(store)
    assert counts == {"merged": 1, "instances_reassigned": 1} and instances == {f"{LIBRARY}:b1:event_2:e1": ("event_2", 0.0)}
    assert patterns["event_1"][1:3] == (1, 0) and patterns["event_2"][1:3] == (1, 1)


def test_better_card_replaces(spark, store):
    run(spark, store, accepted("c1", "merge_existing", "event_1", completeness=0.5))
    assert run(spark, store, accepted("c1", "merge_existing", "event_1", completeness=0.4))[1]["instances_duplicate"] == 1
    assert run(spark, store, accepted("c1", "merge_existing", "event_1", grounded=1))[1]["instances_enriched"] == 1
    assert state(store)[1] == {f"{LIBRARY}:b1:event_1:e1": ("event_1", 0.0)}
    # Without a candidate's id, and for another candidate with the same evidence, the instance's id counts.
    assert run(spark, store, accepted("", "merge_existing", "event_1", grounded=1, completeness=0.9), accepted("c5", "merge_existing", "event_1", 1, grounded=1, completeness=0.95))[1]["instances_enriched"] == 2
    assert state(store)[1] == {f"{LIBRARY}:b1:event_1:e1": ("event_1", 0.95)}


def test_killed_run_leaves_the_old_version(spark, store, monkeypatch):
    before = state(store)
    store._files.create(store._at("pointers/000000000002"), False).close()  # its writer died before the text
    assert store.version() == 1 and state(store) == before
    assert run(spark, store, accepted("c1", "merge_existing", "event_1"))[0] == 3
    with pytest.raises(RuntimeError, match="changed since"):
        store.commit({"patterns": store.read("patterns")}, 1)
    assert store.version() == 3
    store.keep(1)
    assert store.version() == 3 and store.read("patterns").count() == 3


def test_gate(spark):
    from inkwell.operators.decisions import gate
    from pyspark.sql import functions as F

    candidates = [(f"c{i}", "E", ["p1"], 0.5, None) for i in range(9)] + [("w1", "W", ["p1"], 0.5, "why"), ("n1", "Empty", None, None, None), ("n2", "Empty", ["p1"], None, None)]
    known = ["causal_order", "Core_Mechanism "]
    said = [
        ("c0", 1, "merge_existing", "e1", None, None, ["p1"], None, None), ("c0", 2, "reject", None, None, None, None, None, None), ("c1", 1, "create_new", None, ["core_mechanism", "genre"], ["d"], None, "n", "m"),
        ("c2", 1, "create_new", None, known, None, None, "n", "m"), ("c3", 1, "create_new", None, known, ["d"], ["p1", "p7"], "fresh", "story told anew"), ("c4", 1, "create_new", None, known, ["d"], None, " Known One", "m"),
        ("c5", 1, "create_new", None, known, ["d"], None, "x", "alpha beta gamma delta"), ("c6", 1, "enrich_existing", "gone", None, None, None, None, None), ("c7", 1, "maybe", None, None, None, None, None, None),
        ("w1", 1, "merge_existing", "e1", None, None, None, None, None), ("n1", 1, "create_new", None, known, None, None, "n", "m"), ("n2", 1, "create_new", None, known, None, None, " ", "m"), ("zz", 1, "reject", None, None, None, None, None, None),
    ]
    patterns = [("e1", "E", "known one", ["qq"], "emerging", 0), ("e2", "E", "b", ["alpha", "beta", "gamma", "delta"], "universal", 0), ("w0", "W", "w", ["ww"], "universal", 0)]
    frame = spark.createDataFrame(said, "candidate_id string, position int, decision string, target_id string, novelty array<string>, differences array<string>, evidence array<string>, name string, mechanism string")
    of = spark.createDataFrame(candidates, "candidate_id string, library string, evidence array<string>, confidence double, unfit string").withColumns({"name": F.lit("c"), "target": F.lit("c"), "layer": F.lit("c")})
    there = spark.createDataFrame(patterns, "pattern_id string, library string, name string, terms array<string>, layer string, position int")
    got = {r.candidate_id: (r.decision, list(r.reasons)) for r in gate(frame, of, there).collect()}
    more = "needs_more_evidence"
    assert got == {
        "c0": ("merge_existing", []), "c1": (more, ["fewer_than_two_structural_novelty_dimensions"]), "c2": (more, ["missing_nearest_pattern_differences"]), "c3": ("create_new", ["invalid_decision_evidence_trimmed"]),
        "c4": (more, ["local_near_duplicate:e1"]), "c5": (more, ["local_near_duplicate:e2"]), "c6": (more, ["target_pattern_not_found"]), "c7": ("reject", ["invalid_decision"]), "c8": (more, ["missing_llm_decision"]),
        "w1": (more, ["why"]), "n1": ("create_new", []), "n2": (more, ["incomplete_proposed_pattern"]),
    }
    assert gate(frame, of.limit(0), there).collect() == []


def test_pattern_terms(spark):
    from inkwell.operators.decisions import pattern_terms
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([("Ab a b_1 规则x制度",), (None,), ("",)], "text string")
    assert [r[0] for r in rows.select(pattern_terms(F.col("text"))).collect()] == [["ab", "b_1", "规则", "则制", "制度", "规则制", "则制度"], [], []]
