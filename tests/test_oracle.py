"""Every query with a SQL twin agrees with DuckDB on the smallest driver tables."""


import math

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tools.check_oracle import TABLES, rows_equal, sort_key

SF = "/root/testdata/sf0.001"
SQL = oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    yield c
    c.close()


def test_every_sql_key_is_registered():
    assert set(SQL) <= set(queries())


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() > 0 and "c_custkey" in df.columns


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, con, name):
    df = queries()[name](spark, SF)
    rows, cols = df.collect(), df.columns
    cur = con.execute(SQL[name])
    orows, ocols = cur.fetchall(), [d[0] for d in cur.description]
    assert sorted(cols) == sorted(ocols)
    assert len(rows) == len(orows)
    order = sorted(cols)
    a = sorted((tuple(r[cols.index(c)] for c in order) for r in rows), key=sort_key)
    b = sorted((tuple(r[ocols.index(c)] for c in order) for r in orows), key=sort_key)
    bad = [(x, y) for x, y in zip(a, b) if not rows_equal(x, y)]
    assert not bad, bad[:2]
    assert not any(isinstance(v, float) and math.isnan(v) for r in rows for v in r)
