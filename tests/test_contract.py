"""Driver contract: entry() runs and every query matches its DuckDB oracle at sf0.001."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from tools.oracle_check import TABLES, digest

SF = "/root/testdata/sf0.001"
ORACLES = E.oracle_sql()
QUERIES = E.queries()

pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == E.entry(spark).columns


def test_every_query_documented():
    for name, fn in QUERIES.items():
        assert fn.__doc__, name


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    scols, srows = df.columns, [tuple(r) for r in df.collect()]
    con.execute(f"CREATE OR REPLACE VIEW oracle_view AS {ORACLES[name]}")  # as the driver stores it
    res = con.execute("SELECT * FROM oracle_view")
    dcols, drows = [d[0] for d in res.description], res.fetchall()
    assert sorted(scols) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(scols, srows)[0] == digest(dcols, drows)[0]
