"""The pipeline on streams gives the tables of the batch, run after run."""

from dataclasses import replace

import pytest

import fixtures as fx
from strata.plans import layers, stream_layers
from strata.spec import Settings
from strata.streaming.merge_table import MergeTable, read_merged

ON = Settings(now=fx.NOW, replay_enabled=True, replay_id="rp1", backfill_enabled=True, backfill_start="2023-01-01",
              backfill_end="2023-12-31", backfill_id="bf1", backfill_reason="missed drop")
OFF = Settings(now=fx.NOW)
WIDER = replace(ON, backfill_start="2022-01-01", backfill_id="bf2", replay_id="rp2")
#: Tables that hold the state of all runs, and columns that say when or in what run a row was written.
TABLES = ("silver_trips", "silver_city", "fact_trips_current", "fact_trips_asof", "fact_trips_daily", "silver_trips_unmatched_city",
          "type_drift_guardrails", "rescued_city_profile", "join_drop_summary", "data_quality_summary", "pipeline_guardrails",
          "dim_city_current", "bronze_ingest_quality")
TIMES = {"_load_ts", "_checked_at", "_logged_at"}


@pytest.fixture(scope="module")
def drops(spark):
    from strata.session import scratch_path
    root = fx.local(scratch_path(spark, "stream-layers"))
    fx.city_csvs(root + "/city")
    fx.trips_csv(root + "/trips")
    fx.write(root + "/backfill/b1.csv", fx.TRIPS_HEADER + "\nB1,C1,2023-06-01,3,new,9,5,5\nB2,C1,2022-06-02,3,new,9,5,5\n"
                                                          "B3,C1,2023-07-01,-3,new,9,5,5\n")
    return root


def rows_of(spark, out, name):
    plain = name not in ("silver_trips", "silver_city") or "/stream/" not in out[name]
    df = spark.read.parquet(out[name]) if plain else read_merged(spark, out[name])
    columns = sorted(c for c in df.columns if c not in TIMES)
    return columns, sorted(map(tuple, df.select(*columns).collect()), key=repr)


def test_streams_equal_batch_over_four_runs(spark, drops):
    for run, (settings, backfill) in enumerate([(ON, "/backfill"), (OFF, None), (WIDER, "/backfill"), (OFF, None)]):
        if run == 2:
            fx.write(drops + "/trips/trips_late.csv", fx.TRIPS_HEADER + "\nT50,C2,2024-01-13,4,new,3,5,5\nT51,C2,2023-12-01,4,new,3,5,5\n")
        outs = [f(spark, drops + "/city", drops + "/trips", drops + folder, settings, backfill_location=backfill and drops + backfill)
                for f, folder in ((layers.run_batch, "/batch"), (stream_layers.run_streams, "/stream"))]
        for name in TABLES:
            batch, stream = (rows_of(spark, out, name) for out in outs)
            assert batch == stream, (run, name)
    silver = {r["trip_id"]: (r["_replay_id"], r["_backfill_id"]) for r in read_merged(spark, outs[1]["silver_trips"]).collect()}
    assert silver["T9"] == ("rp1", None) and silver["T51"] == ("rp2", None)
    assert silver["B1"] == (None, "bf1") and silver["B2"] == (None, "bf2") and "B3" not in silver


def test_a_logged_run_is_merged_by_the_next(spark, scratch):
    root = fx.local(scratch)
    rows = spark.createDataFrame([("h1", "a", 1), ("h2", "b", 1)], "_record_hash string, k string, s int")
    table = MergeTable(spark, root + "/table", "scd1", ["k"], "s")
    real, stopped = table.merge, RuntimeError("stopped")

    def stop(*a):
        raise stopped

    table.merge = stop
    with pytest.raises(RuntimeError):
        stream_layers.admit(spark, table, rows.filter("k = 'a'"), rows, root + "/log", "replay", {"_replay_id": "r1"})
    table.merge = real
    stream_layers.admit(spark, table, rows.limit(0), rows, root + "/log", "replay", None)
    assert [(r["k"], r["_replay_id"]) for r in table.read().collect()] == [("a", "r1")]
    stream_layers.admit(spark, table, rows, rows, root + "/log", "replay", {"_replay_id": "r2"})
    assert sorted((r["k"], r["_replay_id"]) for r in table.read().collect()) == [("a", "r1"), ("b", "r2")]
