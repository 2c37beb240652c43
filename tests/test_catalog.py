"""Every registered query against its SQL, on the smallest given tables."""

import math
import os
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as entry
from catalog.oracle import ORACLES
from catalog.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the given tables are not here")


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def comparable(columns, rows):
    order = sorted(range(len(columns)), key=lambda place: columns[place])

    def value(v):
        if isinstance(v, (float, Decimal)):
            return float(v) if not math.isnan(float(v)) else "nan"
        return v

    return sorted(
        (tuple(value(row[place]) for place in order) for row in rows),
        key=lambda row: [(v is not None, str(v)) for v in row],
    )


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, sql, name):
    made = QUERIES[name](spark, SF)
    found = sql.execute(ORACLES[name])
    columns = [column[0] for column in found.description]
    assert sorted(columns) == sorted(made.columns)
    assert comparable(made.columns, [tuple(r) for r in made.collect()]) == comparable(
        columns, found.fetchall()
    )


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 1000


def test_no_query_plans_pairs_of_rows(spark):
    for name in ("top_matches", "score_table", "check_dim_has_no_unreferenced_molecule"):
        plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan
