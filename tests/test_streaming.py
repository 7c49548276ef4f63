"""Streaming ingest (S1-S3, S8, S9, S12, S14, W1): stream = batch, restart adds nothing."""

import os

import pytest

from pyspark.sql import functions as F

import fixtures as fx
from strata.plans import layers
from strata.spec import Settings
from strata.streaming.runner import run_stream

SETTINGS = Settings(now=fx.NOW, max_files_per_trigger=1)


def test_stream_equals_batch_and_restart_is_idempotent(spark, scratch):
    root = fx.local(scratch)
    drops = root + "/drops"
    fx.trips_csv(drops)
    # a re-delivery of the same content under another name
    fx.write(os.path.join(drops, "trips_2.csv"), open(os.path.join(drops, "trips_1.csv")).read())
    bronze = run_stream(spark, drops, layers.TRIPS, SETTINGS, root + "/out")
    streamed = spark.read.parquet(bronze)
    batch = layers.bronze(spark, drops, layers.TRIPS, SETTINGS)
    key = ["_record_hash"]
    assert streamed.count() == batch.count() == 16
    assert streamed.select(*key).exceptAll(batch.select(*key)).count() == 0

    # restart from the checkpoints: nothing new
    run_stream(spark, drops, layers.TRIPS, SETTINGS, root + "/out")
    assert spark.read.parquet(bronze).count() == 16

    # a new drop: only its new rows arrive
    fx.write(os.path.join(drops, "trips_3.csv"),
             fx.TRIPS_HEADER + "\nT99,C2,2024-01-14,2,new,3,5,5\nT1,c1,2024-01-14,5.5,NEW,120.0,5,4\n")
    run_stream(spark, drops, layers.TRIPS, SETTINGS, root + "/out")
    after = spark.read.parquet(bronze)
    assert after.count() == 17
    assert after.filter(F.col("trip_id") == "T99").count() == 1
    assert after.select("_ingest_yyyymmdd").distinct().collect()[0][0] == 20240115


def test_silver_stream_splits_like_batch(spark, scratch):
    from strata.streaming.runner import silver_stream
    root = fx.local(scratch)
    fx.trips_csv(root + "/drops")
    bronze = run_stream(spark, root + "/drops", layers.TRIPS, SETTINGS, root + "/out")
    silver_stream(spark, bronze, layers.TRIPS, SETTINGS, root + "/valid", root + "/quarantine",
                  root + "/_ck_silver")
    valid = spark.read.parquet(root + "/valid")
    quarantine = spark.read.parquet(root + "/quarantine")
    assert sorted(r["trip_id"] for r in valid.collect()) == ["T1", "T10", "T14", "T15"]
    assert quarantine.count() == 12


def test_empty_like_has_shape_and_no_rows(spark):
    from strata.sources.empty import empty_like
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    e = empty_like(df)
    assert e.schema == df.schema and e.count() == 0


def test_scale_conf_sizes_partitions():
    from strata.session import scale_conf
    c = scale_conf(100 << 40, executors=1000, cores_per_executor=8)
    assert int(c["spark.sql.shuffle.partitions"]) == 409600
    assert int(scale_conf(1 << 20, 2, 4)["spark.sql.shuffle.partitions"]) == 16


def test_command_line_batch(spark, scratch):
    import json
    import subprocess
    import sys
    root = fx.local(scratch)
    city = fx.city_csvs(root + "/drops/city")
    fx.trips_csv(root + "/drops/trips")
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    res = subprocess.run([sys.executable, "-m", "strata", "--city", city, "--trips", root + "/drops/trips",
                          "--out", root + "/out", "--now", fx.NOW, "--master", "local[2]",
                          "--shuffle-partitions", "4", "--no-enforce"],
                         cwd=repo, capture_output=True, text=True, timeout=600)
    assert res.returncode == 0, res.stderr[-2000:]
    out = json.loads(res.stdout.strip().splitlines()[-1])
    assert spark.read.parquet(out["fact_trips_current"]).count() == 2


def test_command_line_stream(spark, scratch):
    import json
    import subprocess
    import sys
    root = fx.local(scratch)
    city = fx.city_csvs(root + "/drops/city")
    fx.trips_csv(root + "/drops/trips")
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    cmd = [sys.executable, "-m", "strata", "--city", city, "--trips", root + "/drops/trips",
           "--out", root + "/out", "--now", fx.NOW, "--master", "local[2]", "--stream",
           "--shuffle-partitions", "4", "--no-enforce"]
    res = subprocess.run(cmd, cwd=repo, capture_output=True, text=True, timeout=900)
    assert res.returncode == 0, res.stderr[-2000:]
    out = json.loads(res.stdout.strip().splitlines()[-1])
    from strata.streaming.merge_table import read_merged
    trips = read_merged(spark, out["silver_trips"])
    assert sorted(r["trip_id"] for r in trips.collect()) == ["T1", "T10", "T14", "T15"]
    assert read_merged(spark, out["silver_city"]).filter(F.col("__END_AT").isNull()).count() == 3
    assert spark.read.parquet(out["quarantine_trips"]).count() == 12
    drift = {r["field"]: r["type_drift_rows"] for r in spark.read.parquet(out["type_drift_log"]).collect() if r["dataset"] == "trips"}
    assert (drift["date"], drift["distance_travelled_km"], drift["passenger_rating"]) == (1, 1, 1)
    assert [tuple(r) for r in spark.read.parquet(out["rescued_city_profile"]).collect()] == [("region", 1)]


def test_dedupe_scopes(spark, scratch):   # D1, W1, B5
    import datetime as dt

    from strata.operators.dedupe import dedupe_content
    rows = [("h1", "f1", dt.datetime(2024, 1, 1)), ("h1", "f1", dt.datetime(2024, 1, 1)),
            ("h1", "f2", dt.datetime(2024, 1, 2)), ("h2", "f2", dt.datetime(2024, 1, 2))]
    df = spark.createDataFrame(rows, "_record_hash string, _source_file string, _ingest_ts timestamp")
    assert dedupe_content(df, "all").count() == 2
    assert dedupe_content(df, "file").count() == 3          # A -> B -> A across files survives
    with pytest.raises(ValueError):
        dedupe_content(df, "bogus")
    root = fx.local(scratch)
    df.write.parquet(root + "/in")
    s = spark.readStream.schema(df.schema).parquet(root + "/in")
    out = dedupe_content(s, "watermark", "_ingest_ts", watermark_days=3)
    q = (out.writeStream.format("parquet").option("checkpointLocation", root + "/ck")
         .trigger(availableNow=True).start(root + "/out"))
    q.awaitTermination()
    assert spark.read.parquet(root + "/out").count() == 2


def test_all_scope_keeps_old_rows_on_a_stream(spark, scratch):   # W1
    import datetime as dt

    from strata.operators.dedupe import dedupe_content
    root = fx.local(scratch)
    schema = "_record_hash string, _source_file string, _ingest_ts timestamp"
    for i, (h, day) in enumerate((("new", 15), ("old", 1), ("old", 2))):
        spark.createDataFrame([(h, f"f{i}", dt.datetime(2024, 1 if h == "old" else 2, day))], schema).write.mode(
            "append").parquet(root + "/in")
        s = spark.readStream.schema(schema).parquet(root + "/in")
        q = (dedupe_content(s, "all", watermark_days=3).writeStream.format("parquet")
             .option("checkpointLocation", root + "/ck").trigger(availableNow=True).start(root + "/out"))
        q.awaitTermination()
    assert sorted(r[0] for r in spark.read.parquet(root + "/out").select("_record_hash").collect()) == ["new", "old"]


HASHED = "_record_hash string, _source_file string, _ingest_ts timestamp"


def test_hash_table_dedupes_over_batches_retries_and_streams(spark, scratch, monkeypatch):   # D1, W1
    import datetime as dt

    from strata.streaming import dedupe
    from strata.streaming.merge_table import MergeTable
    root = fx.local(scratch)

    def rows(*hashes):
        return spark.createDataFrame([(h, "f", dt.datetime(2024, 1, 1)) for h in hashes], HASHED)

    def got():
        return sorted((r["_record_hash"] or "", r["batch_id"]) for r in spark.read.parquet(root + "/out").collect())

    def append(df, n, source="s"):
        dedupe.append_new(spark, df, n, source, root + "/out", root + "/hashes")

    append(rows("a", "a", "b", None), 0)
    with monkeypatch.context() as m:                       # stops after the rows, before their hashes
        m.setattr(MergeTable, "merge", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(RuntimeError):
            append(rows("b", "c", None), 1)
    append(rows("b", "c", None), 1)
    append(rows("b", "c", None), 1)                        # stopped after the hashes: nothing left to do
    MergeTable(spark, root + "/hashes").compact()
    append(rows("b", "c", None), 1)                        # and so after a compaction
    append(rows("a", "c", "d"), 2)
    assert got() == [("", 0), ("a", 0), ("b", 0), ("c", 1), ("d", 2)]
    append(rows("a", "e"), 3, "another stream")
    assert got()[-1] == ("e", 3)


def test_watermark_scope_bounds_the_table_and_keeps_late_rows_apart(spark, scratch, monkeypatch):   # W1
    import datetime as dt

    from strata.streaming import dedupe, merge_table
    root = fx.local(scratch)
    monkeypatch.setattr(merge_table, "MOST_DELTAS", 1)
    days = [[1, 2, 2], [10, 2], [11, 10, 1], [30], [12, 30]]
    for n, batch in enumerate(days):
        df = spark.createDataFrame([(f"h{d}", "f", dt.datetime(2024, 1, d)) for d in batch], HASHED)
        dedupe.append_new(spark, df, n, "s", root + "/out", root + "/hashes", "watermark", watermark_days=3)
    kept = sorted((r["batch_id"], r["_record_hash"]) for r in spark.read.parquet(root + "/out").collect())
    assert kept == [(0, "h1"), (0, "h2"), (1, "h10"), (2, "h11"), (3, "h30")]
    late = sorted((r["batch_id"], r["_record_hash"]) for r in dedupe.late_rows(spark, root + "/out").collect())
    assert late == [(2, "h1"), (4, "h12")]
    assert [r[0] for r in merge_table.MergeTable(spark, root + "/hashes").rows().select("_record_hash").collect()] == ["h30"]
