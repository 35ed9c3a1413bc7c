"""Every registered query with an oracle equals its DuckDB SQL on the sf0.001 tables."""

import duckdb
import pytest

import __spark_entry__ as E
from tools.check_oracle import TABLES, norm_rows

SF = "/root/testdata/sf0.001"
ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    got = E.queries()[name](spark, SF).toPandas()
    want = con.execute(ORACLES[name]).fetchdf()
    gc, gr = norm_rows(got)
    wc, wr = norm_rows(want)
    assert gc == wc
    assert len(gr) == len(wr)
    assert gr == wr


def test_every_query_has_entry_and_runs_rows_only(spark):
    qs = E.queries()
    assert set(ORACLES) <= set(qs)
    assert E.entry(spark).count() > 0
