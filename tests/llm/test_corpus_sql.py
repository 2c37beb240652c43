"""Corpus queries against their SQL, on small given tables."""

import os

import duckdb
import pytest

from kinmart.llm.oracle import ORACLES
from kinmart.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "pages", "benchmark", "labels", "conversations")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the given tables are not here")


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def test_all_sql_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_matches_sql(spark, sql, name):
    made = QUERIES[name](spark, SF)
    found = sql.execute(ORACLES[name])
    columns = [column[0] for column in found.description]
    assert sorted(columns) == sorted(made.columns)
    order = [columns.index(c) for c in made.columns]
    want = [tuple(row[k] for k in order) for row in found.fetchall()]
    assert sorted(map(tuple, made.collect()), key=repr) == sorted(want, key=repr)
