"""Every registered query of the reference's operators against its SQL, on the smallest tables."""

import os

import duckdb
import pytest

from stepwise.plans.registry import collect

QUERIES, SQL = collect("QUERIES"), collect("SQL")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db(sf):
    connection = duckdb.connect()
    for t in TABLES:
        path = f"{sf}/{t}.parquet"
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return connection


def test_sql_belongs_to_queries():
    assert SQL.keys() <= QUERIES.keys()


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, sf, db, name):
    df = QUERIES[name](spark, sf)
    columns = sorted(df.columns)
    got = sorted(repr(tuple(r[c] for c in columns)) for r in df.collect())
    found = db.execute(SQL[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    want = sorted(repr(tuple(r[i] for i in at)) for r in found.fetchall())
    assert got == want
    assert want, "an empty result proves nothing"


@pytest.mark.parametrize("name", sorted(QUERIES.keys() - SQL.keys()))
def test_runs(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0


@pytest.mark.parametrize("name", ["c7_assign_by_overlap", "c9_overlap_filter", "c10_count_between", "d11_window_mode", "f2_asof_previous", "e1_offset_sweep", "f11_name_scan"])
def test_no_nested_loops(spark, sf, name):
    plan = QUERIES[name](spark, sf)._jdf.queryExecution().optimizedPlan()
    text = QUERIES[name](spark, sf)._jdf.queryExecution().sparkPlan().toString()
    assert "NestedLoop" not in text and "Cartesian" not in text, plan.toString()
