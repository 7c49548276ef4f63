"""End to end on the hand-written drops of FIXTURES.md."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

import fixtures as fx
from strata.operators import quality
from strata.operators.conform import conform, promoted
from strata.plans import layers
from strata.sources.csv_drops import read_drops
from strata.spec import Settings

SETTINGS = Settings(now=fx.NOW)


@pytest.fixture(scope="module")
def built(spark):
    from strata.session import scratch_path
    root = fx.local(scratch_path(spark, "layers"))
    city = fx.city_csvs(root + "/drops/city")
    fx.trips_csv(root + "/drops/trips")
    out = layers.run_batch(spark, city, root + "/drops/trips", root + "/out", SETTINGS)
    return {k: spark.read.parquet(v) for k, v in out.items()}


def test_reject_reasons_first_match_wins(built):
    got = {r["trip_id"]: r["_reject_reason"] for r in built["silver_trips_staging"].collect()}
    for row in fx.TRIPS_ROWS:
        trip_id = row[0] or None
        assert got[trip_id] == row[8], trip_id


def test_valid_and_quarantine_are_exact_complements(built):   # B8
    staging = built["silver_trips_staging"].count()
    valid = built["silver_trips_staging"].filter(F.col("_reject_reason").isNull()).count()
    assert staging == 16
    assert valid + built["quarantine_trips"].count() == staging
    assert built["quarantine_trips"].filter(F.col("_reject_reason") == "unknown").count() == 0   # B9


def test_type_drift_totals(built):
    drift = {r["field"]: r["type_drift_rows"]
             for r in built["type_drift_log"].filter(F.col("dataset") == "trips").collect()}
    assert drift == {"trip_id": 0, "city_id": 0, "date": 1, "distance_travelled_km": 1,
                     "passenger_type": 0, "fare_amount": 0, "passenger_rating": 1, "driver_rating": 0}


def test_contract_transforms(built):
    t1 = built["silver_trips"].filter(F.col("trip_id") == "T1").first()
    assert (t1["city_id"], t1["passenger_type"]) == ("C1", "new")


def test_current_fact_drops_unmatched_and_out_of_calendar(built):
    assert sorted(r[0] for r in built["fact_trips_current"].select("trip_id").collect()) == ["T1", "T10"]
    assert [r[0] for r in built["silver_trips_unmatched_city"].select("trip_id").collect()] == ["T14"]


def test_asof_fact_with_open_first_version(built):   # B13
    rows = {r["trip_id"]: r["city_name_asof"] for r in built["fact_trips_asof"].collect()}
    assert rows == {"T1": "Delhi", "T10": "Delhi"}


def test_mixed_headers_rescue_and_corrupt(built):   # S4, S5, S6
    rows = {r["city_id"]: r for r in built["bronze_city"].collect()}
    assert rows["C4"]["city_name"] == "Agra"
    assert rows["C4"]["_rescued_data"] == '{"region":"North"}'
    assert rows["C2"]["city_name"] == "Ja\nipur"
    assert rows["C3"]["_corrupt_record"] is not None
    assert rows["C1"]["_rescued_data"] is None
    assert built["quarantine_city"].first()["_reject_reason"] == "corrupt_record"   # B20


def test_rescued_profile_and_schema_drift(built):
    assert [tuple(r) for r in built["rescued_city_profile"].collect()] == [("region", 1)]
    unexpected = {tuple(r["unexpected_cols"]) for r in built["schema_drift_log"].collect()}
    assert ("region",) in unexpected   # X9


def test_promotion_from_rescued(spark, built):   # P9-P11, B19
    b = built["bronze_city"].filter(F.col("city_id") == "C4")
    spec = layers.with_promotions(layers.CITY, {"region": "string"})
    row = conform(b, spec).first()
    assert (row["region"], row["_region_from_rescued"]) == ("North", True)
    other = built["bronze_city"].filter(F.col("city_id") == "C1")
    empty = other.select(*promoted(other.schema, {"region": "string"}).values()).first()
    assert (empty["region"], empty["_region_from_rescued"]) == (None, False)


def test_guardrails_table_and_enforcement(built):
    from strata.operators.ops import GuardrailError, enforce_guardrails
    g = built["pipeline_guardrails"]
    assert g.count() == 7
    with pytest.raises(GuardrailError):
        enforce_guardrails(g, SETTINGS)


def test_uniform_header_switch(spark, built):
    from strata.session import scratch_path
    root = fx.local(scratch_path(spark, "uniform"))
    fx.trips_csv(root)
    df = read_drops(spark, root, declared=layers.TRIPS.required_columns, headers="uniform")
    assert df.count() == 16
    fx.write(root + "/other.csv", "City Name,City ID\nAgra,C2\n")
    with pytest.raises(ValueError, match="headers differ"):
        read_drops(spark, root, declared=["city_id"], headers="uniform")


def test_replay_and_backfill_policies(spark, built):   # F8, F9, B10
    staging = built["silver_trips_staging"]
    q = quality.quarantined_rows(staging)
    assert quality.replay_late(q, Settings()) is None
    r = quality.replay_late(q, Settings(replay_enabled=True, replay_id="r9"))
    assert [(x["trip_id"], x["_replay_id"]) for x in r.collect()] == [("T9", "r9")]
    with pytest.raises(ValueError):
        Settings(backfill_enabled=True)
    s = Settings(backfill_enabled=True, backfill_start="2024-01-07", backfill_end="2024-01-14",
                 backfill_id="b1", backfill_reason="fix")
    b = quality.backfill_window(staging.drop("_reject_reason"), s)
    kept = quality.valid_rows(quality.classify(b, layers.TRIPS, waive_late=True))
    ids = sorted(x["trip_id"] for x in kept.collect())
    assert ids == ["T1", "T10", "T14", "T9"]   # T9 is late but lateness is waived; T15 out of window


def test_retention_rewrites_only_old_partitions(spark, scratch):   # X7, X12
    import datetime as dt

    from strata.operators.ops import enforce_retention, retention_candidates
    from strata.sources.sinks import overwrite_partitions
    rows = [("a", "late_arrival", dt.date(2023, 11, 1)), ("b", "late_arrival", dt.date(2023, 12, 1)),
            ("c", "negative_fare", dt.date(2024, 1, 14))]
    q = spark.createDataFrame(rows, "trip_id string, _reject_reason string, _ingest_date date")
    cand = retention_candidates(q, "trips", SETTINGS)   # cut-off 2023-12-16
    assert sorted((r["reason"], r["ingest_date"], r["rows"]) for r in cand.collect()) == [
        ("late_arrival", dt.date(2023, 11, 1), 1), ("late_arrival", dt.date(2023, 12, 1), 1)]
    path = fx.local(scratch) + "/quarantine"
    q.write.partitionBy("_ingest_date").parquet(path)
    kept = enforce_retention(spark.read.parquet(path), SETTINGS)
    staged = fx.local(scratch) + "/quarantine_next"
    overwrite_partitions(kept, staged, ["_ingest_date"])
    assert [r["trip_id"] for r in spark.read.parquet(staged).collect()] == ["c"]


def test_change_feed_on_streams(spark, scratch):   # W4
    from strata.operators import quality
    root = fx.local(scratch)
    staging = fx.local(scratch) + "/staging"
    built_rows = spark.createDataFrame([("T1", "2024-01-14")], "trip_id string, date string")
    built_rows.write.parquet(staging)
    s = spark.readStream.schema("trip_id string, date string").parquet(staging)
    valid = s.select("trip_id")
    replay = quality.with_tags(s.select("trip_id"), _replay_id="r1")
    feed = quality.change_feed(valid, replay, None)
    assert feed.isStreaming
    q = (feed.writeStream.format("parquet").option("checkpointLocation", root + "/ck")
         .trigger(availableNow=True).start(root + "/feed"))
    q.awaitTermination()
    got = sorted(((r["trip_id"], r["_replay_id"]) for r in spark.read.parquet(root + "/feed").collect()),
                 key=lambda t: (t[0], t[1] or ""))
    assert got == [("T1", None), ("T1", "r1")]


def test_pipeline_with_backfill_and_replay(spark):   # S3, F8, F9, X11, B10, B11
    from strata.session import scratch_path
    root = fx.local(scratch_path(spark, "layers-bf"))
    city = fx.city_csvs(root + "/drops/city")
    fx.trips_csv(root + "/drops/trips")
    fx.write(root + "/drops/backfill/b1.csv",
             fx.TRIPS_HEADER + "\nB1,C1,2023-06-01,3,new,9,5,5\nB2,C1,2023-06-02,-3,new,9,5,5\n"
                               "B3,C1,2019-01-01,3,new,9,5,5\n")
    s = Settings(now=fx.NOW, replay_enabled=True, replay_id="rp1", backfill_enabled=True,
                 backfill_start="2023-01-01", backfill_end="2023-12-31", backfill_id="bf1",
                 backfill_reason="missed drop")
    out = layers.run_batch(spark, city, root + "/drops/trips", root + "/out", s,
                           backfill_location=root + "/drops/backfill")
    trips = {r["trip_id"]: r for r in spark.read.parquet(out["silver_trips"]).collect()}
    # T9 (late) comes back through replay; B1 through backfill; B2 breaks a rule; B3 is outside the window
    assert trips["T9"]["_replay_id"] == "rp1"
    assert trips["B1"]["_backfill_id"] == "bf1" and "B2" not in trips and "B3" not in trips
    assert sorted(trips) == ["B1", "T1", "T10", "T14", "T15", "T9"]
    log = spark.read.parquet(out["replay_log"]).collect()
    assert [(r["_replay_id"], r["rows"]) for r in log] == [("rp1", 1)]
    refused = {r["trip_id"]: r["_reject_reason"] for r in spark.read.parquet(out["quarantine_trips_backfill"]).collect()}
    assert refused == {"B2": "negative_distance", "B3": "outside_backfill_window"}
    assert {r["dataset"] for r in spark.read.parquet(out["bronze_ingest_quality"]).collect()} == {
        "city", "trips", "trips_backfill"}
    assert "_load_ts" in spark.read.parquet(out["fact_trips_asof"]).columns
    assert "_logged_at" in spark.read.parquet(out["type_drift_log"]).columns
    assert "_checked_at" in spark.read.parquet(out["type_drift_guardrails"]).columns
    assert spark.read.parquet(out["dim_date"]).count() == 4018

    # the same command a month later, and one without replay, leave silver as it is
    first = sorted(map(tuple, spark.read.parquet(out["silver_trips"]).collect()))
    for settings in (replace(s, now="2024-02-15 00:00:00"), replace(s, now="2024-03-15 00:00:00", replay_enabled=False)):
        again = layers.run_batch(spark, city, root + "/drops/trips", root + "/out", settings,
                                 backfill_location=root + "/drops/backfill")
        assert sorted(map(tuple, spark.read.parquet(again["silver_trips"]).collect())) == first
        assert spark.read.parquet(again["replay_log"]).count() == 1

    # a new drop keeps its own ingest time, the others theirs
    fx.write(root + "/drops/trips/late.csv", fx.TRIPS_HEADER + "\nT77,C1,2024-02-14,2,new,3,5,5\n")
    again = layers.run_batch(spark, city, root + "/drops/trips", root + "/out", replace(s, now="2024-02-15 00:00:00"),
                             backfill_location=root + "/drops/backfill")
    rows = spark.read.parquet(again["silver_trips"]).collect()
    assert sorted(map(tuple, (r for r in rows if r["trip_id"] != "T77"))) == first
    assert {str(r["_ingest_ts"])[:10] for r in rows} == {fx.NOW[:10], "2024-02-15"}


def test_promotion_reaches_silver(spark, scratch):   # P12
    root = fx.local(scratch)
    city = fx.city_csvs(root + "/drops/city")
    fx.trips_csv(root + "/drops/trips")
    out = layers.run_batch(spark, city, root + "/drops/trips", root + "/out", SETTINGS,
                           promote={"city": {"region": "string"}})
    regions = {r["city_id"]: r["region"] for r in spark.read.parquet(out["silver_city"]).collect()}
    assert regions["C4"] == "North" and regions["C1"] is None


def test_backfill_stays_without_and_with_another_backfill(spark):   # S3, F9, U1
    from strata.session import scratch_path
    root = fx.local(scratch_path(spark, "layers-stay"))
    city = fx.city_csvs(root + "/drops/city")
    fx.trips_csv(root + "/drops/trips")
    fx.write(root + "/drops/backfill/b1.csv",
             fx.TRIPS_HEADER + "\nB1,C1,2023-06-01,3,new,9,5,5\nB2,C1,2022-06-02,3,new,9,5,5\nB3,C1,2023-07-01,-3,new,9,5,5\n")
    first = Settings(now=fx.NOW, backfill_enabled=True, backfill_start="2023-01-01", backfill_end="2023-12-31",
                     backfill_id="bf1", backfill_reason="missed drop")

    def run(settings, backfill=root + "/drops/backfill"):
        out = layers.run_batch(spark, city, root + "/drops/trips", root + "/out", settings, backfill_location=backfill)
        silver = {r["trip_id"]: (r["_backfill_id"], r["_backfill_reason"]) for r in spark.read.parquet(out["silver_trips"]).collect()}
        refused = {r["trip_id"]: r["_reject_reason"] for r in spark.read.parquet(out["quarantine_trips_backfill"]).collect()}
        return {k: v for k, v in silver.items() if k.startswith("B")}, refused

    assert run(first) == ({"B1": ("bf1", "missed drop")}, {"B2": "outside_backfill_window", "B3": "negative_distance"})
    assert run(Settings(now=fx.NOW), None)[0] == {"B1": ("bf1", "missed drop")}
    wider = replace(first, backfill_start="2022-01-01", backfill_id="bf2", backfill_reason="older")
    both = ({"B1": ("bf1", "missed drop"), "B2": ("bf2", "older")}, {"B3": "negative_distance"})
    assert run(wider) == both
    assert run(wider) == both                              # the same window again logs nothing
    assert spark.read.parquet(root + "/out/backfill_log").count() == 2
    assert run(Settings(now=fx.NOW), None) == both


def test_file_list_then_folder(spark, scratch):   # S1, S12
    from strata.plans import specs
    root = fx.local(scratch)
    fx.write(root + "/drops/a.csv", "c_custkey,c_name\n1,x\n")
    table = root + "/bronze"
    assert layers.ingest(spark, [root + "/drops/a.csv"], specs.CUSTOMER, SETTINGS, table).count() == 1
    fx.write(root + "/drops/b.csv", "c_custkey,c_name\n2,y\n")
    assert layers.ingest(spark, root + "/drops", specs.CUSTOMER, SETTINGS, table).count() == 2
    assert spark.read.parquet(table + "_files").where("length > 0 AND modificationTime IS NOT NULL").count() == 2
