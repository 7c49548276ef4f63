"""Ops tables on hand-written rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.operators import ops
from strata.spec import Settings

NOW = Settings(now="2024-01-15 10:00:00")


@pytest.fixture()
def bronze(spark):
    rows = [
        ("city", "r1", dt.datetime(2024, 1, 15, 8), "f1", 100, None, None),
        ("city", "r1", dt.datetime(2024, 1, 15, 9), "f1", 100, '{"region":"N"}', None),
        ("city", "r1", dt.datetime(2024, 1, 15, 9), "f2", 50, "{}", "C3"),
        ("trips", "r2", dt.datetime(2024, 1, 13, 9), "f3", 70, None, None),
    ]
    return spark.createDataFrame(rows, "_dataset string, _ingest_run_id string, _ingest_ts timestamp, "
                                       "_source_file string, _source_file_size bigint, _rescued_data string, "
                                       "_corrupt_record string")


def test_ingest_quality(bronze):
    got = {r["dataset"]: r for r in ops.ingest_quality(bronze).collect()}
    c = got["city"]
    assert (c["rows"], c["corrupt_rows"], c["rescued_rows"]) == (3, 1, 1)
    assert c["corrupt_rate"] == pytest.approx(0.333333) and c["rescued_rate"] == pytest.approx(0.333333)


def test_run_audit_counts_bytes_once_per_file(bronze):
    got = {r["dataset"]: r for r in ops.run_audit(bronze).collect()}
    assert (got["city"]["files"], got["city"]["bytes"], got["city"]["rows"]) == (2, 150, 3)
    assert got["city"]["first_ingest_ts"] == dt.datetime(2024, 1, 15, 8)


def test_freshness(bronze):
    got = {r["dataset"]: r for r in ops.freshness(
        [("city", bronze.filter(F.col("_dataset") == "city"), "_ingest_ts"),
         ("trips", bronze.filter(F.col("_dataset") == "trips"), "_ingest_ts")], NOW).collect()}
    assert got["city"]["lag_hours"] == 1.0 and got["city"]["within_sla"]
    assert got["trips"]["lag_hours"] == 49.0 and not got["trips"]["within_sla"]


def test_join_drop(spark):
    facts = spark.range(10)
    got = ops.join_drop("current", facts, facts.filter("id < 8")).first()
    assert (got["facts_in"], got["facts_matched"], got["drop_rate"]) == (10, 8, 0.2)


def test_data_quality(spark):
    df = spark.createDataFrame([(None,), (None,), (None,), ("negative_fare",)], "_reject_reason string")
    got = {r["reason"]: r for r in ops.data_quality(df, "trips").collect()}
    assert got["valid"]["share"] == 0.75 and got["negative_fare"]["quarantine_rate"] == 0.25


def test_guardrails_pass_fail_and_enforcement(spark):
    one = lambda v: spark.createDataFrame([(v,)], "observed double")
    g = ops.guardrails([("ok", one(0.01), 0.05), ("bad", one(0.5), 0.05), ("unknown", one(None), 1.0)])
    got = {r["check"]: r["passed"] for r in g.collect()}
    assert got == {"ok": True, "bad": False, "unknown": False}
    with pytest.raises(ops.GuardrailError, match="bad"):
        ops.enforce_guardrails(g, Settings())
    ops.enforce_guardrails(g, Settings(guardrails_enforced=False))
