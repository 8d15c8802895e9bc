"""Every registered query against its SQL, on the smallest tables."""

import duckdb
import pytest
from conftest import TESTDATA

import __spark_entry__ as entry

FOLDER = TESTDATA / "sf0.001"
QUERIES = {**entry.batch.QUERIES, **entry.live.QUERIES}
SQL = entry.sql.ORACLES
TYPES = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in FOLDER.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    yield connection
    connection.close()


def comparable(rows, columns):
    order = [columns.index(c) for c in sorted(columns)]
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def test_every_query_has_sql():
    assert QUERIES.keys() == SQL.keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    found = QUERIES[name](spark, str(FOLDER))
    wanted = duck.execute(SQL[name])
    types = {c[0]: str(c[1]) for c in wanted.description}
    assert {c: TYPES[t] for c, t in found.dtypes} == types
    rows = [tuple(r) for r in found.collect()]
    assert comparable(rows, found.columns) == comparable(wanted.fetchall(), list(types))


def test_entry_registers_every_query():
    assert QUERIES.keys() <= entry.queries().keys()
    assert SQL.items() <= entry.oracle_sql().items()


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() == 12
