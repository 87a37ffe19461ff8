import json

import pytest

CASES = [
    ('first {"a": 1} and {"b": 2}', '{"a": 1}', None), ('```json\n{"items": []}\n```', '{"items": []}', None), ('{"items": []} extra', '{"items": []}', None), (' {"items": []}\n', '{"items": []}', '{"items": []}'),
    ('{"a": "}{", "b": {"c": "\\"}"}} tail }', '{"a": "}{", "b": {"c": "\\"}"}}', None), ('{note} then {"a": [1, {"b": null}]}', '{"a": [1, {"b": null}]}', None), ('say "quoted { {"a": 1}', None, None), ('{"a": {"b": 1}', None, None),
    ("} {\"a\": 1}", '{"a": 1}', None), ("no object", None, None), ("", None, None), (None, None, None), ("[1, 2]", None, None), ('{"a": 1}{"b": 2}', '{"a": 1}', None), ('{"a": "x\\', None, None),
    ('{"t": "' + "line\\n" * 5_000 + '"} {}', '{"t": "' + "line\\n" * 5_000 + '"}', None),
]


def plain(text):
    """Brace by brace, sign by sign."""
    depth = start = 0
    quoted = escaped = False
    for at, sign in enumerate(text or ""):
        if escaped:
            escaped = False
        elif sign == "\\":
            escaped = True
        elif sign == '"' and depth:
            quoted = not quoted
        elif not quoted and sign == "{":
            depth, start = depth + 1, start if depth else at
        elif not quoted and sign == "}" and depth:
            depth -= 1
            if not depth:
                try:
                    json.loads(text[start : at + 1])
                    return text[start : at + 1]
                except ValueError:
                    pass


def test_first_object_and_strict(spark):
    from inkwell.operators.metadata import json_object, strict_json
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([(i, case[0]) for i, case in enumerate(CASES)], "i int, answer string")
    got = [(r.found, r.strict) for r in rows.select("i", json_object(F.col("answer")).alias("found"), strict_json(F.col("answer")).alias("strict")).orderBy("i").collect()]
    assert got == [case[1:] for case in CASES]
    assert [plain(case[0]) for case in CASES] == [case[1] for case in CASES]
    assert rows.limit(0).select(json_object(F.col("answer"))).collect() == []


@pytest.mark.parametrize("seed", range(3))
def test_objects_equal_plain_scan(spark, seed):
    import random

    from inkwell.operators.metadata import json_object
    from pyspark.sql import functions as F

    rng = random.Random(seed)
    texts = ["".join(rng.choices('{}"\\ab:1,', k=rng.randint(0, 30))) + rng.choice(["", '{"a": "}"}', "{}"]) for _ in range(300)]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, answer string")
    got = [r[1] for r in rows.select("i", json_object(F.col("answer"))).orderBy("i").collect()]
    assert got == [plain(text) for text in texts]
