"""Every registered query on the smallest data set: against its SQL, and its plan's shape."""

import contextlib
import io

import duckdb
import pytest

import __spark_entry__ as entry
from check import TABLES, normal
from facetry.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def database():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, database, name):
    df = entry.queries()[name](spark, SF)
    shown = io.StringIO()
    with contextlib.redirect_stdout(shown):
        df.explain()
    assert "CartesianProduct" not in shown.getvalue()
    assert "NestedLoopJoin" not in shown.getvalue()
    got = df.toPandas()
    assert len(got) > 0
    if name in SQL:
        want = database.execute(SQL[name]).df()
        assert normal(got).equals(normal(want))


def test_entry(spark):
    assert entry.entry(spark).columns == ["aspect_idx", "aspect", "precision", "recall", "f1"]


def test_only_queries_that_sql_cannot_express_lack_a_statement():
    assert set(QUERIES) - set(SQL) == {"aspect_epochs"}
    assert set(SQL) <= set(entry.queries())
