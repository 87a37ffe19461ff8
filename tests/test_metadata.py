def test_sums_that_differ_in_their_last_bits_tie(spark):
    """0.1 + 0.2 is no more than 0.3, so the smaller key comes first."""
    from inkwell.operators.metadata import ranked_candidates

    rows = spark.createDataFrame([(1, "b", "x", 0.1), (1, "b", "y", 0.2), (1, "a", "x", 0.3), (2, "b", "x", 0.31), (2, "a", "x", 0.3)], "item int, key string, source string, c double")
    got = ranked_candidates(rows, "item", "key", "source", "c", ("p", "q")).orderBy("item").collect()
    assert [(r.item, r.key) for r in got] == [(1, "a"), (2, "b")]
