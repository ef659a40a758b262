import duckdb
import pandas as pd
import pytest

from panelwise.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql_gives_the_same_rows(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want, got = con.execute(queries.SQL[name]).df(), queries.QUERIES[name](spark, SF).toPandas()
    cols = sorted(want.columns)
    assert sorted(got.columns) == cols
    order = lambda d: d[cols].sort_values(cols).reset_index(drop=True)
    pd.testing.assert_frame_equal(order(got), order(want), check_dtype=False, rtol=1e-12)


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def test_scratch_tables_are_cleared(spark, tmp_path):
    import os
    from panelwise import session
    from panelwise.llm import common
    made = common.written(spark.range(3), "to-clear")
    path = session._SCRATCH[-1]
    assert made.count() == 3 and "to-clear" in path
    local = path.split(":", 1)[-1]
    assert os.path.exists(local)
    session._SCRATCH[:], kept = [path], session._SCRATCH[:-1]  # tables of other tests stay
    assert session.clear_scratch(spark) == 1 and not os.path.exists(local)
    session._SCRATCH[:] = kept
