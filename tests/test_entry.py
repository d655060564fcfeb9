"""Driver contract: entry() runs, every oracle has a query, and every query
matches its DuckDB oracle on the smallest driver tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "scripts"))

import __spark_entry__ as E  # noqa: E402
from check_oracle import TABLES, key, norm  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["station_name", "avg_peak_departures",
                          "days_observed"]
    assert df.count() > 0


def test_registry():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 30


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM "
                    f"read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    rows = df.collect()
    cols = sorted(df.columns)
    o = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in o.description]
    assert sorted(ocols) == cols
    s_idx = [df.columns.index(c) for c in cols]
    o_idx = [ocols.index(c) for c in cols]
    sv = sorted((tuple(norm(r[i]) for i in s_idx) for r in rows), key=key)
    ov = sorted((tuple(norm(r[i]) for i in o_idx) for r in o.fetchall()),
                key=key)
    assert sv == ov
