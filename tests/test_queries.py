"""Every registered query against its SQL, on the smallest tables."""

import glob
import os

import duckdb
import pytest

from __spark_entry__ import entry, queries
from subjectloom.plans import all_queries, all_sql
from tools.check_queries import _rows

# The optional subpackage has its own tests.
QUERIES, SQL = {name: queries()[name] for name in all_queries()}, all_sql()
# The fits are covered by test_models; the driver runs these queries too.
SLOW = {
    "mlp_fit_score", "staged_fit", "score_matrix", "tree_fit_score", "logreg_fit_score",
    "knn_fit_score", "kmeans_fit",
}


@pytest.fixture(scope="module")
def con(small):
    connection = duckdb.connect()
    for path in glob.glob(f"{small}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, small, con, name):
    df = QUERIES[name](spark, small)
    want = con.sql(SQL[name])
    columns = list(want.columns)
    assert sorted(df.columns) == sorted(columns)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    assert got == _rows(columns, want.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL) - SLOW))
def test_query_runs(spark, small, name):
    assert QUERIES[name](spark, small).count() > 0


def test_entry(spark):
    assert entry(spark).count() == 6


def test_names():
    assert set(SQL) <= set(QUERIES)
    assert not [n for n in QUERIES if "pipeline" in n or n.startswith("op")]
