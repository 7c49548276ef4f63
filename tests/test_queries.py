"""Every registered query against its DuckDB oracle on the small tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL
from tools.compare import TABLES, digest

QUERIES = {k: v for k, v in entry.queries().items() if k not in entry.LLM_QUERIES}
ORACLE = {k: v for k, v in entry.oracle_sql().items() if k not in entry.LLM_ORACLE}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    s_rows = [tuple(r) for r in df.collect()]
    res = con.execute(ORACLE[name])
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    assert sorted(df.columns) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert digest(df.columns, s_rows)[0] == digest(d_cols, d_rows)[0]


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["date_key", "order_priority", "order_count", "total_price", "max_total_price"]
    assert df.count() > 0
