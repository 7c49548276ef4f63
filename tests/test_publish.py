"""Write, audit, publish, and retention through the pointer."""

import datetime as dt
import os
from dataclasses import replace

import pytest

import fixtures as fx
from strata.plans import layers
from strata.sources.publish import Run, published_run, read_published, retire
from strata.spec import Settings

OK, BAD = "check string, passed boolean", [("a", True), ("b", False)]
SETTINGS = Settings(now="2024-01-15 00:00:00")


def checks(spark, *passed):
    return spark.createDataFrame([("c", p) for p in passed], OK)


def publish(spark, root, value, passed=True, settings=SETTINGS):
    run = Run(spark, root)
    run.save("t", spark.createDataFrame([(value,)], "v int"))
    return run.publish(checks(spark, True, passed), settings)


def shown(spark, root, name="t"):
    return sorted(r["v"] for r in read_published(spark, root, name).collect())


def test_a_failed_check_leaves_readers_on_the_old_tables(spark, scratch):
    root = fx.local(scratch)
    with pytest.raises(ValueError):
        read_published(spark, root, "t")
    assert publish(spark, root, 1) and shown(spark, root) == [1]
    old = read_published(spark, root, "t")
    assert not publish(spark, root, 2, passed=False) and shown(spark, root) == [1]
    assert publish(spark, root, 3, passed=False, settings=replace(SETTINGS, guardrails_enforced=False))
    assert shown(spark, root) == [3] and [r["v"] for r in old.collect()] == [1]      # a running reader
    for v in range(4, 8):
        assert publish(spark, root, v)
    assert shown(spark, root) == [7] and len(os.listdir(root + "/runs")) == 2


def test_a_run_that_stops_shows_nothing(spark, scratch):
    root = fx.local(scratch)
    publish(spark, root, 1)
    Run(spark, root).save("t", spark.createDataFrame([(2,)], "v int"))
    assert shown(spark, root) == [1]
    pointer = f"{root}/published/run={published_run(spark, root)}"
    publish(spark, root, 3)
    os.remove(f"{root}/published/run={published_run(spark, root)}/_SUCCESS")       # its pointer wasn't finished
    assert os.path.exists(pointer) and shown(spark, root) == [1]
    assert publish(spark, root, 4) and shown(spark, root) == [4]


def test_retention_drops_partitions_and_a_repeat_changes_nothing(spark, scratch):
    root = fx.local(scratch)
    days = [dt.date(2023, 11, 1), dt.date(2023, 12, 15), dt.date(2023, 12, 16), dt.date(2024, 1, 14), None]
    rows = spark.createDataFrame([(i, d) for i, d in enumerate(days)] + [(9, days[0])], "v int, _ingest_date date")
    run = Run(spark, root)
    run.save("q", rows, ["_ingest_date"])
    run.save("t", spark.createDataFrame([(1,)], "v int"))
    run.publish(checks(spark, True), SETTINGS)
    kept = {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(root + "/runs") for f in names}
    assert retire(spark, root, "q", SETTINGS) == 2                                   # cut-off 2023-12-16
    assert shown(spark, root, "q") == [2, 3, 4] and shown(spark, root) == [1]
    after = {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(root + "/runs") for f in names}
    assert set(after.items()) <= set(kept.items())                                   # nothing was rewritten
    log = sorted((r["name"], r["ingest_date"], r["rows"]) for r in spark.read.parquet(root + "/retention_log").collect())
    assert log == [("q", days[0], 2), ("q", days[1], 1)]
    at = published_run(spark, root)
    assert retire(spark, root, "q", SETTINGS) == 0 and published_run(spark, root) == at
    late = replace(SETTINGS, now="2024-06-01 00:00:00")
    assert retire(spark, root, "q", late) == 2 and shown(spark, root, "q") == [4]    # undated rows stay
    assert retire(spark, root, "q", late) == 0
    assert not any("2023-11-01" in d for d, _, _ in os.walk(root + "/runs"))


def test_the_pipeline_publishes_when_its_guardrails_pass(spark, scratch):
    root = fx.local(scratch)
    city = fx.city_csvs(root + "/drops/city")
    fx.trips_csv(root + "/drops/trips")
    loose = Settings(now=fx.NOW, max_quarantine_rate=1.0, max_join_drop_rate_current=1.0, max_join_drop_rate_asof=1.0,
                     max_type_drift_rate=1.0, max_corrupt_rate=1.0, max_rescued_rate=1.0, freshness_sla_hours=10_000)
    layers.run_batch(spark, city, root + "/drops/trips", root + "/out", loose)
    first = published_run(spark, root + "/out")
    assert first is not None and read_published(spark, root + "/out", "silver_trips").count() == 4
    fx.write(root + "/drops/trips/more.csv", fx.TRIPS_HEADER + "\nT80,C1,2024-01-14,2,new,3,5,5\n")
    out = layers.run_batch(spark, city, root + "/drops/trips", root + "/out", Settings(now=fx.NOW))     # guardrails fail
    assert spark.read.parquet(out["silver_trips"]).count() == 5
    assert published_run(spark, root + "/out") == first and read_published(spark, root + "/out", "silver_trips").count() == 4
    month = replace(loose, now="2024-03-15 00:00:00")
    out = layers.run_batch(spark, city, root + "/drops/trips", root + "/out", month)
    assert read_published(spark, root + "/out", "silver_trips").count() == 5
    assert read_published(spark, root + "/out", "quarantine_trips").count() == 0
    assert spark.read.parquet(out["quarantine_retention_candidates"]).where("dataset = 'trips'").agg({"rows": "sum"}).first()[0] == 12
