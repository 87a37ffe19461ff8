def test_a_run_is_ranked_in_ranges(spark):
    """No window holds a whole run."""
    from inkwell.operators.review import index_order

    rows = [("r" if i % 3 else None, i, None if i % 5 == 0 else str(i % 4), f"t{i % 7}", None, i % 6, None, "keep" if i % 2 else "drop") for i in range(60)]
    plan = spark.createDataFrame(rows, "run string, file_id long, category string, title_key string, author_key string, library_id long, version int, action string")
    frames = index_order(plan), index_order(plan, "keep")
    keys = (lambda r: (r[2] or "99", r[3], r[5], r[1])), (lambda r: (r[7] == "keep", r[1]))
    for frame, key in zip(frames, keys, strict=True):
        assert "windowspecdefinition(run" not in frame._jdf.queryExecution().toString()
        for run in ("r", None):
            want = [r[1] for r in sorted((r for r in rows if r[0] == run), key=key)]
            assert [r.file_id for r in frame.where(frame.run.eqNullSafe(run)).orderBy("rank").collect()] == want
            assert [r["rank"] for r in frame.where(frame.run.eqNullSafe(run)).orderBy("rank").collect()] == list(range(1, len(want) + 1))
