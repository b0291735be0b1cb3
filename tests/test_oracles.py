"""Every query against its SQL: same columns, types, rows and values."""

import pytest

import __spark_entry__ as entry_point
from compare import connect, duck_rows, duck_types, spark_rows
from sparkledger.oracles import ORACLES
from sparkledger.registry import QUERIES

SPARK_TYPE = {
    "BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DATE": "date", "DOUBLE": "double", "TIMESTAMP": "timestamp_ntz",
    "BOOLEAN": "boolean",
}


# Their windows go over a date range of a key.
WINDOWED = {"flow_address"}


@pytest.fixture(scope="module")
def duck(data):
    return connect(data)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert QUERIES.items() <= entry_point.queries().items() and ORACLES.items() <= entry_point.oracle_sql().items()


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, data, duck, name, capsys):
    df = entry_point.queries()[name](spark, data)
    df.explain()
    plan = capsys.readouterr().out
    # No comparison of all pairs, no window over a whole table, no Python per row.
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Window", "Python"):
        assert operator not in plan or operator == "Window" and name in WINDOWED
    sql = entry_point.oracle_sql()[name]
    got, expected = spark_rows(df), duck_rows(duck, sql)
    assert got[0] == expected[0]
    assert len(got[1]) == len(expected[1])
    assert got == expected
    types = {column: SPARK_TYPE.get(kind, kind.lower()) for column, kind in duck_types(duck, sql).items()}
    assert {f.name: f.dataType.simpleString() for f in df.schema.fields} == types
