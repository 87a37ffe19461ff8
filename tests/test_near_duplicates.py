import random

from pyspark.sql import functions as F


def prose(rng, sentences):
    return [" ".join("".join(rng.choices("abcdefghijklmnop", k=7)) for _ in range(5)) for _ in range(sentences)]


def test_candidates_equal_brute_force(spark):
    from inkwell.operators.fingerprint import anchor_candidates

    rng = random.Random(1)
    common = [f"c{i}" for i in range(6)]
    sets = {i: set(rng.sample(common, rng.randint(3, 6))) | {f"r{rng.randint(0, 40)}" for _ in range(rng.randint(0, 6))} for i in range(150)}
    sets |= {1000 + i: {"u", "v", "w", "x", "y"} for i in range(80)}
    rows = spark.createDataFrame([(i, a) for i, s in sets.items() for a in s], "id long, anchor string")
    want = {(i, j, len(sets[i] & sets[j])) for i in sets for j in sets if i < j and len(sets[i] & sets[j]) >= 4}
    got = [tuple(r) for r in anchor_candidates(rows).select("left", "right", "shared").collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_large_groups_stay_together(spark, tmp_path):
    from inkwell.plans import QUERIES

    rng = random.Random(2)
    base, other = prose(rng, 60), prose(rng, 60)
    texts = [". ".join(base)] * 70 + [". ".join(base + prose(rng, 1)) for _ in range(70)] + [". ".join(other)]
    rows = [(i, t, "en", f"s{i % 3}", len(t)) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    found = {name: QUERIES[name](spark, str(tmp_path)) for name in ("near_dup_candidates", "near_dup_relations", "near_dup_components", "sketch_order")}
    assert {r.node: r.component for r in found["near_dup_components"].collect()} == dict.fromkeys(range(140), 0)
    # Copies are members of their head; pairs are of the 71 different texts.
    assert all(found[name].count() == 71 * 70 // 2 for name in ("near_dup_candidates", "near_dup_relations", "sketch_order"))
    kinds = {r.relation: r.n for r in found["near_dup_relations"].groupBy("relation").agg(F.count("*").alias("n")).collect()}
    assert kinds == {"same_edition": 71 * 70 // 2}
    members = {r.relation: r.n for r in QUERIES["near_dup_members"](spark, str(tmp_path)).groupBy("relation").agg(F.count("*").alias("n")).collect()}
    assert members == {"head": 72, "byte_exact": 69}
    works = {r.id: (r.work, r.edition, r.action, r.version) for r in QUERIES["works"](spark, str(tmp_path)).collect()}
    assert {w[:2] for i, w in works.items() if i < 140} == {(0, 0)} and works[140] == (140, 140, "canonical", 1)
    assert sum(w[2] == "canonical" for w in works.values()) == 2 and len(works) == 141


def test_short_copies_are_one_work(spark, tmp_path):
    from inkwell.plans import QUERIES

    texts = ["one line", "one line", "other line", "one  line\n", None, None, "", "other  line"]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.node: r.component for r in QUERIES["near_dup_components"](spark, str(tmp_path)).collect()}
    assert got == {0: 0, 1: 0, 3: 0, 2: 2, 7: 2}


def test_linked_components_equal_brute_force(spark):
    """Components by leaders first are those of all links, where links aren't transitive."""
    from inkwell.operators.fingerprint import linked_components

    rng = random.Random(4)
    pools = [[f"p{p}_{k}" for k in range(14)] for p in range(5)]
    sets = {i: set(rng.sample(pools[rng.randrange(5)], 9)) | set(rng.sample(pools[rng.randrange(5)], rng.randint(0, 5))) | {f"own{i}"} for i in range(120)}
    sets |= {500 + i: {"same", "thing", "again", "and", "more", "six", "seven"} for i in range(40)}
    asked = []

    def links(pairs):
        asked.append(pairs.count())
        frame = spark.createDataFrame([(i, sorted(s)) for i, s in sets.items()], "id long, a array<string>")
        both = pairs.join(frame.selectExpr("id AS left", "a AS x"), "left").join(frame.selectExpr("id AS right", "a AS y"), "right")
        return both.where("size(array_intersect(x, y)) >= 7").select("left", "right")

    rows = spark.createDataFrame([(i, a) for i, s in sets.items() for a in s], "id long, anchor string")
    group = {i: {i} for i in sets}
    for i in sets:
        for j in sets:
            if i < j and len(sets[i] & sets[j]) >= 7 and group[i] is not group[j]:
                group[i] |= group[j]
                for node in group[j]:
                    group[node] = group[i]
    want = {i: min(nodes) for i, nodes in group.items() if len(nodes) > 1}
    assert {r.node: r.component for r in linked_components(rows, links, 7).collect()} == want
    assert asked[1] < 160 * 159 // 4


def test_members_read_texts_once(spark, tmp_path):
    """What is known of the texts is written before their heads are looked for; white space of any script doesn't count."""
    from inkwell.plans.dedup_queries import _members

    texts = ["ab c\n\td", "a b c　d", "abcd", "ab cd ", "äb\u0085cd", "äbcd", "×y z÷", "", None]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(path)
    members = _members(spark.read.parquet(path))
    assert {r.id: (r.head, r.chars, r.copies) for r in members.collect()} == {0: (0, 4, 4), 1: (0, 4, 4), 2: (0, 4, 4), 3: (0, 4, 4), 4: (4, 4, 2), 5: (4, 4, 2), 6: (6, 4, 1), 7: (7, 0, 1)}
    assert not any(str(tmp_path) in file for file in members.inputFiles())
