"""Every oracle SQL runs in DuckDB on the smallest tables (no Spark)."""

import duckdb
import pytest

import __spark_entry__ as E
from stridelake.sources.tables import TABLES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_oracle_runs(con, name):
    res = con.execute(E.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert len(cols) == len(set(cols))  # every column named, no duplicates
    assert res.fetchall() is not None
