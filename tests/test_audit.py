import random


def test_as_of_equals_plain_scan(spark):
    from inkwell.operators.audit import as_of

    rng = random.Random(6)
    left = [(rng.choice(["a", "b", "hot", "hot", "hot"]), rng.randrange(300), i) for i in range(400)] + [(None, 5, 1000), ("a", None, 1001), ("new", 3, 1002), ("hot", 7, 1003), ("hot", 7, 1003)]
    right = [(rng.choice(["a", "b", "hot", "hot"]), rng.randrange(300), f"r{i}") for i in range(150)] + [(None, 1, "rx"), ("a", None, "ry"), ("hot", 7, "ra"), ("hot", 7, "rz")]
    a = spark.createDataFrame(left, "k string, t int, id int").selectExpr("*", "'x' AS name", "1 AS found")
    b = spark.createDataFrame(right, "k string, t int, name string")
    for parts in (1, 5, 40):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        got = sorted(((r.id, r.hit and (r.hit.t, r.hit.name)) for r in as_of(a, b, "k", "t", "hit").collect()), key=str)
        want = [(i, max(((t, n) for k, t, n in right if k is not None and k == key and t is not None and time is not None and t <= time), default=None)) for key, time, i in left]
        assert got == sorted(want, key=str)
    spark.conf.set("spark.sql.shuffle.partitions", 4)
    assert as_of(a.limit(0), b, "k", "t", "hit").collect() == [] and all(r.hit is None for r in as_of(a, b.limit(0), "k", "t", "hit").collect())


def test_deletion_evidence(spark):
    from inkwell.operators.audit import deletion_evidence

    rows = lambda *x: spark.createDataFrame(list(x), "k string, t int, id string")
    deletions = rows(("a", 10, "d1"), ("b", 10, "d2"), ("c", 10, "d3"), ("d", 10, "d4"), ("e", 1, "d5"), ("f", 9, "d6"))
    journal = rows(("a", 5, "j1"), ("b", 5, "j2"), ("e", 2, "j5"), ("f", 9, "j6"), ("a", 2, "j0"))
    states = rows(("a", 4, "s1"), ("b", 4, "s2"), ("b", 7, "s3"), ("c", 3, "s4"))
    got = {r.id: (r.journal_id, r.state_id, r.evidence) for r in deletion_evidence(deletions, journal, states, "k", "t").collect()}
    assert got == {
        "d1": ("j1", "s1", "verified"), "d2": ("j2", "s3", "stale"), "d3": (None, "s4", "reconstructed"), "d4": (None, None, "none"), "d5": (None, None, "none"), "d6": ("j6", None, "verified"),
    }
