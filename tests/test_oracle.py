"""Every registered query against its DuckDB SQL on the smallest tables,
and the driver entry point."""

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from tools.oracle_check import TABLES, frame_digest

SQL = entry.oracle_sql()
Q = entry.queries()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    got = frame_digest(Q[name](spark, SF_SMALL).toArrow())
    want = frame_digest(con.execute(SQL[name]).to_arrow_table())
    assert got == want


def test_every_sql_has_a_query():
    assert set(SQL) <= set(Q)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == entry.entry(spark).columns
