import duckdb
import pytest

SF = "/root/testdata/sf0.001"


def value(x):
    if x is None or (isinstance(x, float) and x != x):
        return None
    return round(x, 9) if isinstance(x, float) else x


@pytest.fixture(scope="session")
def duck():
    connection = duckdb.connect()
    for name in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        connection.sql(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return connection


def names():
    from inkwell.plans import QUERIES

    return sorted(QUERIES)


@pytest.mark.parametrize("name", names())
def test_query(spark, duck, name):
    from inkwell.plans import ORACLE_SQL, QUERIES

    frame = QUERIES[name](spark, SF)
    columns = sorted(frame.columns)
    rows = [tuple(value(r[c]) for c in columns) for r in frame.collect()]
    if name in ORACLE_SQL:
        listed = ", ".join(f'"{c}"' for c in columns)
        want = [tuple(map(value, r)) for r in duck.sql(f"select {listed} from ({ORACLE_SQL[name]})").fetchall()]
        assert sorted(rows, key=str) == sorted(want, key=str)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).columns
