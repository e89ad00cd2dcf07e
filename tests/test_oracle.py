"""Every catalog query against its SQL on the small test tables."""

import os

import duckdb
import pytest

from reknit import catalog

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = catalog.load()
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    yield connection
    connection.close()


def _plain(table):
    columns = sorted(table.column_names)
    types = {c: str(table.schema.field(c).type).replace("large_", "") for c in columns}
    return types, sorted(map(repr, zip(*[table[c].to_pylist() for c in columns])))


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows_and_types(spark, duck, name):
    result = QUERIES[name](spark, FOLDER)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert not [word for word in ("NestedLoop", "CartesianProduct", "Python", "Pandas", "Arrow")
                if word in plan]
    found = _plain(result.toArrow())
    wanted = _plain(duck.sql(SQL[name]).to_arrow_table())
    assert found[0] == wanted[0]
    assert found[1] == wanted[1]
