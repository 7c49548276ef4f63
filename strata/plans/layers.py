"""The layered pipeline for the original two datasets: city (dimension) and trips (fact).

``run_batch`` builds every table from CSV drops: bronze (append-only: new files,
hash, de-duplicate), silver (contract, rules, quarantine, late policy, replay,
backfill, type 1 / type 2), gold (current and as-of facts, daily roll-up) and
the drift / ops tables. Each table is written once and read back, so later
stages start from storage (lineage cut, restartable), never from a cache.
"""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import calendar as cal
from strata.operators import drift, joins, ops, quality, scd
from strata.operators.conform import conform, contract_fields
from strata.operators.dedupe import dedupe_content
from strata.operators.metadata import add_ingest_metadata
from strata.sources.csv_drops import list_drop_files, observed_headers, read_drops
from strata.sources.empty import literal_rows
from strata.sources.publish import Run
from strata.sources.sinks import write_table
from strata.sources.tables import table_exists
from strata.spec import DatasetSpec, FieldMap, HashPart, Rule, Settings

# Names and types of the lineage columns.
LINEAGE_FIELDS = (
    FieldMap("_ingest_ts", "timestamp"),
    FieldMap("_ingest_date", "date"),
    FieldMap("_ingest_yyyymmdd", "int"),
    FieldMap("_source_file", "string"),
    FieldMap("_source_file_mod_ts", "timestamp"),
    FieldMap("_source_file_size", "bigint"),
    FieldMap("_ingest_run_id", "string"),
    FieldMap("_record_hash", "string"),
)
SEQUENCE = ("_ingest_ts", "_source_file_mod_ts", "_record_hash")

# Fixed values of the original datasets: column names, rule thresholds and
# reason texts (ratings 1..5; distance and fare not negative).
CITY = DatasetSpec(
    name="city",
    fields=(
        FieldMap("city_id", "string", transforms=("trim", "upper"), nullable=False),
        FieldMap("city_name", "string", transforms=("trim", "initcap"), nullable=False),
    ) + LINEAGE_FIELDS,
    rules=(Rule.required("city_id"), Rule.required("city_name")),
    keys=("city_id",),
    sequence=SEQUENCE,
    hash_parts=(HashPart("city_id", "key"), HashPart("city_name")),
    required_columns=("city_id", "city_name"),
    drift_fields=(("city_id", "string"), ("city_name", "string")),
    track=("city_name",),
)

TRIPS = DatasetSpec(
    name="trips",
    fields=(
        FieldMap("trip_id", "string", transforms=("trim",), nullable=False),
        FieldMap("city_id", "string", transforms=("trim", "upper"), nullable=False),
        FieldMap("business_date", "date", src="date", nullable=False),
        FieldMap("distance_travelled", "double", src="distance_travelled_km", nullable=False),
        FieldMap("passenger_type", "string", transforms=("trim", "lower"), nullable=False),
        FieldMap("fare_amount", "double", nullable=False),
        FieldMap("passenger_rating", "int", nullable=False),
        FieldMap("driver_rating", "int", nullable=False),
    ) + LINEAGE_FIELDS + (
        FieldMap("_replay_id", "string"),
        FieldMap("_backfill_id", "string"),
        FieldMap("_backfill_reason", "string"),
    ),
    rules=(
        Rule.required("trip_id"),
        Rule.required("city_id"),
        Rule.required("business_date"),
        Rule("distance_ok", "distance_travelled >= 0", "negative_distance", ("distance_travelled",)),
        Rule("fare_ok", "fare_amount >= 0", "negative_fare", ("fare_amount",)),
        Rule("passenger_rating_ok", "passenger_rating BETWEEN 1 AND 5", "passenger_rating_out_of_range",
             ("passenger_rating",)),
        Rule("driver_rating_ok", "driver_rating BETWEEN 1 AND 5", "driver_rating_out_of_range",
             ("driver_rating",)),
    ),
    keys=("trip_id",),
    sequence=SEQUENCE,
    hash_parts=(HashPart("trip_id"), HashPart("city_id", "key"), HashPart("date", "date"),
                HashPart("distance_travelled_km", "number"), HashPart("passenger_type"),
                HashPart("fare_amount", "number"), HashPart("passenger_rating"), HashPart("driver_rating")),
    required_columns=("trip_id", "city_id", "date", "distance_travelled_km", "passenger_type",
                      "fare_amount", "passenger_rating", "driver_rating"),
    drift_fields=(("trip_id", "string"), ("city_id", "string"), ("date", "date"),
                  ("distance_travelled_km", "double"), ("passenger_type", "string"),
                  ("fare_amount", "double"), ("passenger_rating", "int"), ("driver_rating", "int")),
    business_date="business_date",
)


BACKFILL = replace(TRIPS, name="trips_backfill")


def with_promotions(spec: DatasetSpec, promote) -> DatasetSpec:
    """The spec with registered rescued fields promoted into silver."""
    return replace(spec, promote=tuple(dict(promote or {}).items()))


def bronze(spark: SparkSession, location, spec: DatasetSpec, settings: Settings,
           scope: str = "all", headers: str = "scan") -> DataFrame:
    """CSV drops -> bronze rows: all text, rescued/corrupt kept, lineage, hash, de-duplicated."""
    declared = list(spec.required_columns) + list(spec.known_columns)
    raw = read_drops(spark, location, declared=declared, headers=headers)
    meta = add_ingest_metadata(raw, spec, settings, file_lineage=False)
    return dedupe_content(meta, scope)


def ingest(spark: SparkSession, location, spec: DatasetSpec, settings: Settings, path: str,
           scope: str = "all") -> DataFrame:
    """Append the rows of drop files not ingested before to the bronze table at ``path``.

    A row keeps the ingest time of the run that first saw it, so later rebuilds
    judge lateness and date versions as the first did. Rows are compared by hash
    with the whole table, so a run that stopped before it logged its files adds
    nothing twice when it is repeated. ``<path>_files`` lists what was read."""
    files = (list_drop_files(spark, location) if isinstance(location, str)
             else list_drop_files(spark, list(location), "*"))
    log, known = f"{path}_files", table_exists(spark, path)
    if known and table_exists(spark, log):
        read = spark.read.parquet(log)
        told = [c for c in files.columns if c in read.columns]      # a log of paths alone is a log too
        files = files.join(read.select(*told).distinct(), told, "left_anti")
    # one path for each new file: what the reader below and Spark's file index hold anyway
    paths = [r["path"] for r in files.select("path").collect()]
    if paths:
        new = bronze(spark, paths, spec, settings, scope)
        if known:
            keys = ["_record_hash", "_source_file"] if scope == "file" else ["_record_hash"]
            new = new.join(spark.read.parquet(path).select(*keys).distinct(), keys, "left_anti")
        write_table(new, path, mode="append", partition_by=["_ingest_yyyymmdd"])
        listed = literal_rows(spark, [(p,) for p in paths], "path string")
        write_table(files.join(listed, "path", "left_semi"), log, mode="append")
    elif not known:
        raise ValueError(f"no drop files under {location}")
    return spark.read.parquet(path)


def backfilled(spark: SparkSession, classified: DataFrame, settings: Settings, log_path: str) -> DataFrame | None:
    """The backfill log after this run, None if nothing was ever backfilled.

    The log is written before the rows are merged, and the rows are merged by the
    log: a backfill that was let in once is in every rebuild, with the id and
    reason of the run that let it in, whether that run was finished or not."""
    log = spark.read.parquet(log_path) if table_exists(spark, log_path) else None
    if settings.backfill_enabled:
        quality.backfill_registry(classified, settings, log).write.mode("append").parquet(log_path)
        log = spark.read.parquet(log_path)
    return log


def run_batch(spark: SparkSession, city_location, trips_location, out_root: str,
              settings: Settings | None = None, backfill_location=None, dedupe_scope: str = "all",
              asof_strategy: str = "sweep", open_first_version: bool = True,
              promote: dict[str, dict] | None = None) -> dict[str, str]:
    """Ingest new drops into bronze, rebuild every other table; returns table name -> path.

    Bronze and the logs are added to; the other tables are written aside and
    shown to readers (``sources.publish.read_published``) when the guardrails
    pass or aren't enforced. The quarantine keeps no row past its retention;
    ``quarantine_retention_candidates`` lists what went.

    ``open_first_version=False`` keeps the original behaviour where a city's
    first version starts at its first ingest, so older trips find no version.
    ``promote``: rescued fields to promote, e.g. ``{"trips": {"tip": "double"}}``.
    """
    promote = promote or {}
    if set(promote) - {"city", "trips"}:
        raise ValueError(f"unknown dataset in promote: {sorted(set(promote) - {'city', 'trips'})}")
    city_spec, trips_spec = (with_promotions(x, promote.get(x.name)) for x in (CITY, TRIPS))
    backfill_spec = replace(trips_spec, name=BACKFILL.name)
    trips_columns = [f.name for f in contract_fields(trips_spec)]
    settings = settings or Settings()
    run = Run(spark, out_root)
    path, save, state = run.state, run.save, {}

    def land(spec: DatasetSpec, location) -> DataFrame:
        name = f"bronze_{spec.name}"
        state[name] = path(name)
        return ingest(spark, location, spec, settings, path(name), dedupe_scope)

    # Bronze: append-only
    b_city, b_trips = land(city_spec, city_location), land(trips_spec, trips_location)
    b_backfill = None
    if settings.backfill_enabled and backfill_location is not None:
        b_backfill = land(backfill_spec, backfill_location)
    elif table_exists(spark, path(f"bronze_{BACKFILL.name}")):
        state[f"bronze_{BACKFILL.name}"] = path(f"bronze_{BACKFILL.name}")
        b_backfill = spark.read.parquet(path(f"bronze_{BACKFILL.name}"))

    # Silver: one classification per dataset, written once; valid and quarantine read it.
    city_c = save("silver_city_staging", quality.classify(conform(b_city, city_spec, settings), city_spec))
    trips_c = save("silver_trips_staging", quality.classify(conform(b_trips, trips_spec, settings), trips_spec))
    q_city, q_trips = quality.quarantined_rows(city_c), quality.quarantined_rows(trips_c)
    kept_trips = save("quarantine_trips", ops.enforce_retention(q_trips, settings), ["_ingest_date"])
    save("quarantine_city", ops.enforce_retention(q_city, settings), ["_ingest_date"])

    city_hist = save("silver_city", scd.scd2(
        quality.valid_rows(city_c), list(CITY.keys), "_ingest_ts", CITY.tracked,
        tiebreak=["_source_file_mod_ts", "_record_hash"], bucket="auto",
        open_first_version=open_first_version))

    log_path = path("replay_log")
    previous = spark.read.parquet(log_path) if table_exists(spark, log_path) else None
    carried = quality.carry_replayed(q_trips, previous) if previous is not None else None
    replay = quality.replay_late(kept_trips.select(*q_trips.columns), settings, previous)
    backfill = None
    if b_backfill is not None:
        b_c = save("silver_trips_backfill_staging", quality.classify(
            conform(b_backfill, backfill_spec, settings), backfill_spec, waive_late=True))
        log = backfilled(spark, b_c, settings, path("backfill_log"))
        if log is not None:
            state["backfill_log"] = path("backfill_log")
            backfill = quality.logged_backfill(b_c, log)
            save("quarantine_trips_backfill", quality.refused_backfill(b_c, log))
    feed = quality.change_feed(quality.valid_rows(trips_c), carried, replay, backfill)
    trips = save("silver_trips", scd.scd1(feed.select(*trips_columns), list(TRIPS.keys), list(SEQUENCE)))
    if replay is not None:
        # logged once the rows are in: a run that stops before this replays them again
        quality.replay_registry(replay).write.mode("append").parquet(log_path)
    if replay is not None or previous is not None:
        state["replay_log"] = log_path
    landed = [("city", b_city, CITY, city_location), ("trips", b_trips, TRIPS, trips_location)]
    if b_backfill is not None:
        landed.append((BACKFILL.name, b_backfill, BACKFILL, backfill_location))
    checks = gold_and_ops(spark, save, settings, trips, city_hist, trips_c, city_c, q_trips, q_city, landed, asof_strategy)
    run.publish(checks, settings)
    return {**run.tables, **state}


def gold_and_ops(spark: SparkSession, save, settings: Settings, trips: DataFrame, city_hist: DataFrame, trips_c: DataFrame,
                 city_c: DataFrame, q_trips: DataFrame, q_city: DataFrame, landed, asof_strategy: str = "sweep") -> DataFrame:
    """Facts, roll-up, drift and ops tables from the silver tables, each handed to ``save(name, rows)``; returns the checks.

    ``trips_c`` and ``city_c`` are classified rows, valid and quarantined;
    ``landed``: (dataset, bronze rows, spec, drop location or None)."""
    calendar = save("silver_calendar", cal.calendar(spark, settings.calendar_start, settings.calendar_end))
    save("dim_date", calendar)
    n_days = cal.calendar_rows(settings.calendar_start, settings.calendar_end)
    dim_current = save("dim_city_current",
                       scd.current_rows(city_hist).select("city_id", "city_name"))
    save("silver_trips_unmatched_city", joins.unmatched(trips, dim_current, ["city_id"]))
    save("silver_trips_unmatched_date", joins.unmatched(
        trips, calendar.select(F.col("date").alias("business_date")), ["business_date"]))

    # Gold
    measures = ["distance_travelled", "fare_amount", "passenger_rating", "driver_rating", "passenger_type"]
    tags = ["_ingest_run_id", "_replay_id", "_backfill_id"]
    load_ts = ops.now(settings).alias("_load_ts")
    cur = joins.join_calendar(joins.join_current(trips, dim_current, ["city_id"]), calendar,
                              "business_date", n_days)
    fact_current = save("fact_trips_current", cur.select(
        "trip_id", "city_id", "date_key", "year", "month", F.lit(1).cast("int").alias("trip_count"),
        *measures, load_ts, *tags))
    versions = city_hist.select("city_id", F.col("city_name").alias("city_name_asof"),
                                scd.START_COL, scd.END_COL)
    probes = trips.withColumn("_probe_ts", F.to_timestamp(F.col("business_date")))
    asof_fn = {"sweep": joins.asof_sweep_join, "interval": joins.asof_interval_join,
               "bucketed": joins.asof_bucketed_join}[asof_strategy]
    asof = joins.join_calendar(asof_fn(probes, versions, ["city_id"], "_probe_ts", ["city_name_asof"]),
                               calendar, "business_date", n_days)
    fact_asof = save("fact_trips_asof", asof.select(
        "trip_id", "city_id", "city_name_asof", "date_key", "year", "month",
        F.lit(1).cast("int").alias("trip_count"), *measures, load_ts, *tags))
    save("fact_trips_daily", fact_current.groupBy("date_key", "city_id", "passenger_type").agg(
        F.sum("trip_count").cast("bigint").alias("trip_count"),
        F.sum("distance_travelled").alias("distance_travelled"),
        F.sum("fare_amount").alias("fare_amount"),
        F.round(F.avg("passenger_rating"), 4).alias("avg_passenger_rating"),
        F.round(F.avg("driver_rating"), 4).alias("avg_driver_rating")))

    # Drift and ops
    td = save("type_drift_log", drift.stamped(reduce(DataFrame.unionByName, [
        drift.type_drift(b, name, x.drift_fields) for name, b, x, _ in landed]), "_logged_at", settings))
    save("type_drift_guardrails", drift.stamped(drift.type_drift_rollup(td), "_checked_at", settings))
    for name, b, _, _ in landed[:2]:
        save(f"rescued_{name}_profile", drift.rescued_profile(b))
    obs = []
    for name, _, spec, loc in landed:
        if isinstance(loc, str):
            h = observed_headers(spark, loc).select(
                F.lit(name).alias("dataset"), F.lit("bronze").alias("layer"),
                F.lit(settings.run_id).alias("ingest_run_id"), F.col("path").alias("source_file"),
                F.col("cols").alias("actual_cols"),
                F.array(*[F.lit(c) for c in spec.required_columns]).alias("required_cols"),
                F.array(*[F.lit(c) for c in spec.known_columns]).cast("array<string>").alias("known_cols"))
            obs.append(h)
    if obs:
        save("schema_drift_log", drift.schema_drift(reduce(DataFrame.unionByName, obs)))
    bronze_all = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [b for _, b, _, _ in landed])
    save("bronze_ingest_quality", ops.ingest_quality(bronze_all))
    save("ops_run_audit", ops.run_audit(bronze_all))
    jd = save("join_drop_summary", ops.join_drop("current", trips, fact_current).unionByName(
        ops.join_drop("asof", trips, fact_asof)))
    dq = save("data_quality_summary", ops.data_quality(trips_c, "trips").unionByName(
        ops.data_quality(city_c, "city")))
    fr = save("freshness_summary", ops.freshness([(name, b, "_ingest_ts") for name, b, _, _ in landed], settings))
    save("quarantine_retention_candidates", ops.retention_candidates(q_trips, "trips", settings).unionByName(
        ops.retention_candidates(q_city, "city", settings)))
    iq = ops.ingest_quality(bronze_all).agg(
        (F.sum("corrupt_rows") / F.sum("rows")).alias("corrupt"), (F.sum("rescued_rows") / F.sum("rows")).alias("rescued"))
    checks = [
        ("max_quarantine_rate", dq.agg(F.max("quarantine_rate").alias("observed")), settings.max_quarantine_rate),
        ("max_join_drop_rate_current", jd.filter(F.col("model") == "current").select(
            F.col("drop_rate").alias("observed")), settings.max_join_drop_rate_current),
        ("max_join_drop_rate_asof", jd.filter(F.col("model") == "asof").select(
            F.col("drop_rate").alias("observed")), settings.max_join_drop_rate_asof),
        ("max_type_drift_rate", td.agg((F.sum("type_drift_rows") / F.sum("rows_checked")).alias("observed")),
         settings.max_type_drift_rate),
        ("max_corrupt_rate", iq.select(F.col("corrupt").alias("observed")), settings.max_corrupt_rate),
        ("max_rescued_rate", iq.select(F.col("rescued").alias("observed")), settings.max_rescued_rate),
        ("freshness_lag_hours", fr.agg(F.max("lag_hours").alias("observed")), settings.freshness_sla_hours),
    ]
    return save("pipeline_guardrails", ops.guardrails(checks))
