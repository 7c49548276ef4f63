"""Every registered query of the subpackage against its SQL, and the guard around the subpackage."""

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL
from tools.compare import TABLES, digest


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_one_query_for_each_operator():
    assert sorted(int(k[2:].split("_")[0]) for k in entry.LLM_QUERIES if k != "pipeline") == list(range(1, 14))
    assert "pipeline" in entry.queries()


@pytest.mark.parametrize("name", sorted(entry.LLM_ORACLE))
def test_query_equals_sql(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in res.description]
    assert sorted(df.columns) == sorted(columns)
    assert digest(df.columns, rows)[0] == digest(columns, res.fetchall())[0]


@pytest.mark.parametrize("name", sorted(set(entry.LLM_QUERIES) - set(entry.LLM_ORACLE) - {"pipeline"}))
def test_query_runs(spark, name):
    assert entry.queries()[name](spark, SF_SMALL).count() > 0


NATIVE = ["op3_digest_index", "op4_external_shuffle", "op5_template_tree", "op7_source_mix"]


@pytest.mark.parametrize("name", NATIVE)
def test_native_plans_hold_no_python(spark, name):
    plan = entry.queries()[name](spark, SF_SMALL)._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow", "ExistingRDD"))
