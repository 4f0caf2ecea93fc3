"""Every registered query with an oracle must equal its DuckDB SQL on sf0.001."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from helpers import SF_SMALL

TABLES = "events documents embeddings pages benchmark labels conversations".split()
ORACLES = entry.oracle_sql()


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, (bytes, bytearray, memoryview)):
        return bytes(v)
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_oracle(spark, con, key):
    df = entry.queries()[key](spark, SF_SMALL)
    cols = df.columns
    got = sorted((tuple(_norm(r[c]) for c in sorted(cols)) for r in df.collect()), key=repr)
    cur = con.execute(ORACLES[key])
    dcols = [d[0] for d in cur.description]
    assert sorted(dcols) == sorted(cols)
    order = sorted(range(len(dcols)), key=lambda i: dcols[i])
    want = sorted((tuple(_norm(r[i]) for i in order) for r in cur.fetchall()), key=repr)
    assert got == want


def test_rows_only_queries_run(spark):
    for key in sorted(set(entry.queries()) - set(ORACLES)):
        assert entry.queries()[key](spark, SF_SMALL).count() >= 0, key


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "split" in df.columns
