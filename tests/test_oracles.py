"""Every query against its SQL on the test tables."""

import duckdb
import pytest

from checks import oracles, queries
from tests.conftest import DATA

QUERIES, ORACLES = queries.queries(), oracles.oracle_sql()
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    yield con
    con.close()


def values(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


KINDS = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_its_sql(name, spark, data, duck):
    result = QUERIES[name](spark, data)
    got = [tuple(row) for row in result.collect()]
    answer = duck.execute(ORACLES[name])
    names = [column[0] for column in answer.description]
    expected = answer.fetchall()
    assert sorted(result.columns) == sorted(names)
    types = {row[0]: row[1] for row in duck.execute(f"DESCRIBE {ORACLES[name]}").fetchall()}
    assert {column: KINDS[kind] for column, kind in result.dtypes} == types
    assert len(got) == len(expected) > 0
    assert values(result.columns, got) == values(names, expected)
