"""Every registered query against its DuckDB oracle at sf0.001."""

import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from ledgerline.plans import oracle as _oracle
from ledgerline.plans import queries as _queries

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "orders"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.6g}")
    return v


def _multiset(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


KEYS = sorted(_queries.queries())


def test_registry_complete():
    assert set(KEYS) == set(_oracle.oracle_sql()) and len(KEYS) == 88
    assert set(KEYS) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    df = entry.queries()[key](spark, SF)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    res = con.execute(entry.oracle_sql()[key])
    o_cols = [d[0] for d in res.description]
    o_rows = res.fetchall()
    assert sorted(s_cols) == sorted(o_cols)
    assert len(s_rows) == len(o_rows)
    assert _multiset(s_cols, s_rows) == _multiset(o_cols, o_rows)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["member_id", "payment_history_pts", "defaulters_history_pts",
                          "financial_health_pts", "credit_score", "n_rows"]
    assert df.count() > 0
