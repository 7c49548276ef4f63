"""One builder per operator over the benchmark tables: ``(spark, root) -> DataFrame``.

Every builder reads whole tables (or frames Spark derives from them); none
filters rows to make a check cheaper. Keys quote the operator IDs they cover.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.normalize import record_hash
from strata.functions.transforms import apply_transforms
from strata.operators import calendar as cal
from strata.operators import drift, joins, ops, quality, scd
from strata.operators.conform import apply_contract, conform, promoted
from strata.operators.dedupe import dedupe_content
from strata.plans import specs
from strata.plans.bronze import events_bronze, orders_text
from strata.sources.tables import read_table
from strata.session import scratch_path
from strata.spec import HashPart, Settings

# ---------------------------------------------------------------- shared stages


def orders_staged(spark, root) -> DataFrame:
    return conform(read_table(spark, root, "orders"), specs.ORDERS)


def orders_classified(spark, root) -> DataFrame:
    return quality.classify(orders_staged(spark, root), specs.ORDERS)


def orders_valid(spark, root) -> DataFrame:
    return quality.valid_rows(orders_classified(spark, root))


def customer_classified(spark, root) -> DataFrame:
    return quality.classify(conform(read_table(spark, root, "customer"), specs.CUSTOMER), specs.CUSTOMER)


def customer_dim(spark, root) -> DataFrame:
    """Current customer dimension: one valid row per key."""
    valid = quality.valid_rows(customer_classified(spark, root))
    return scd.scd1(valid, ["customer_id"], ["customer_name"])


def lines_staged(spark, root) -> DataFrame:
    """Line items with their order date as business date and ship date as ingest date;
    a line without an order has no business date and is rejected for that."""
    li = read_table(spark, root, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                              "l_quantity", "l_discount", "l_extendedprice", "l_shipdate"])
    o = read_table(spark, root, "orders", ["o_orderkey", "o_orderdate"])
    joined = li.join(o, li["l_orderkey"] == o["o_orderkey"], "left")
    return conform(joined, specs.LINES)


def lines_classified(spark, root) -> DataFrame:
    return quality.classify(lines_staged(spark, root), specs.LINES)


def events_history(spark, root) -> DataFrame:
    ev = read_table(spark, root, "events", ["event_id", "user_id", "ts", "event_type"])
    return scd.scd2(ev, ["user_id"], "ts", ["event_type"], tiebreak=["event_id"], bucket="auto")


def events_probes(spark, root) -> DataFrame:
    ev = read_table(spark, root, "events", ["event_id", "user_id", "ts"])
    return ev.select("event_id", "user_id",
                     F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("probe_ts"))


def _versions(spark, root) -> DataFrame:
    """The version table, written once to the shared checkpoint folder and read
    back, as the pipeline stores it (the as-of joins read it several times)."""
    path = scratch_path(spark, "events-versions")
    (events_history(spark, root)
        .select("user_id", F.col("event_type").alias("event_type_asof"), scd.START_COL, scd.END_COL)
        .write.parquet(path))
    return spark.read.parquet(path)


def _calendar(spark, root) -> tuple[DataFrame, int]:
    """The calendar over all order dates, so no fact falls off its ends, and its number of days."""
    day = F.to_date("o_orderdate")
    first, last = read_table(spark, root, "orders", ["o_orderdate"]).agg(F.min(day), F.max(day)).first()
    start, end = str(first or specs.CALENDAR_START), str(last or specs.CALENDAR_START)
    return cal.calendar(spark, start, end), cal.calendar_rows(start, end)


# ---------------------------------------------------------------- projections


def q_contract_projection(spark, root):
    """Mapping-driven projection onto the orders contract."""
    return orders_staged(spark, root).select(*specs.ORDERS.field_names)


def q_initcap_transform(spark, root):
    """Initcap transform (blank-separated words)."""
    p = read_table(spark, root, "part", ["p_partkey", "p_name", "p_type"])
    return p.select("p_partkey", apply_transforms(F.col("p_name"), ("initcap",)).alias("part_name"),
                    apply_transforms(F.col("p_type"), ("initcap",)).alias("part_type"))


def q_record_hash(spark, root):
    """P3, P3a-d: normalised SHA-256 content hash of customer rows."""
    c = read_table(spark, root, "customer")
    return c.select("c_custkey", record_hash(specs.CUSTOMER.hash_parts, c.schema).alias("_record_hash"))


def q_content_dedupe(spark, root):
    """Line items delivered twice; one survivor per hash of the whole content."""
    li = read_table(spark, root, "lineitem")
    redelivered = li.unionByName(li).withColumn("_record_hash", record_hash(specs.LINE_CONTENT, li.schema))
    return dedupe_content(redelivered).select("l_orderkey", "l_linenumber", "_record_hash")


def q_record_hash_dates(spark, root):
    """Content hash with a date part."""
    o = read_table(spark, root, "orders")
    return o.select("o_orderkey", record_hash(specs.ORDERS.hash_parts, o.schema).alias("_record_hash"))


# ---------------------------------------------------------------- rules


def q_rules_valid(spark, root):
    """rows that pass every customer rule."""
    return quality.valid_rows(customer_classified(spark, root), specs.CUSTOMER.field_names)


def q_quarantine_reason(spark, root):
    """The exact complement, with the first failing rule as reason."""
    q = quality.quarantined_rows(customer_classified(spark, root))
    return q.select(*specs.CUSTOMER.field_names, quality.REASON_COL)


def q_quarantine_null_safe(spark, root):
    """F4-F7 with B8: NULL inputs (documents without labels) are quarantined, never lost."""
    d = read_table(spark, root, "documents", ["doc_id", "lang", "source", "n_chars"])
    lab = read_table(spark, root, "labels", ["doc_id", "quality", "toxic"])
    staged = conform(d.join(lab, "doc_id", "left"), specs.DOCS)
    q = quality.quarantined_rows(quality.classify(staged, specs.DOCS))
    return q.select("doc_id", "lang", "quality", "toxic", quality.REASON_COL)


def q_late_flag(spark, root):
    """Business date more than 7 days before the ingest date."""
    return lines_staged(spark, root).select("order_id", "line_number", "part_id", "supplier_id",
                                            "business_date", "_ingest_date", quality.LATE_COL)


def q_late_replay(spark, root):
    """Quarantined late rows, tagged with the replay id."""
    q = quality.quarantined_rows(lines_classified(spark, root))
    r = quality.replay_late(q, specs.REPLAY)
    return r.select("order_id", "line_number", "part_id", "supplier_id", "business_date", "_ingest_date",
                    "_replay_id")


def q_backfill_window(spark, root):
    """Backfill rows inside the inclusive window, tagged, rules applied."""
    b = quality.backfill_window(orders_staged(spark, root), specs.BACKFILL)
    v = quality.valid_rows(quality.classify(b, specs.ORDERS, waive_late=True))
    return v.select(*specs.ORDERS.field_names, "_backfill_id", "_backfill_reason")


def q_backfill_quarantine(spark, root):
    """Backfill rows refused by a rule or by the window, with the reason."""
    c = quality.classify(orders_staged(spark, root), specs.ORDERS, waive_late=True)
    _, refused = quality.split_backfill(c, specs.BACKFILL)
    return refused.select("order_id", "business_date", quality.REASON_COL, "_backfill_id")


def _hashed(lines):
    key = F.sha2(F.concat_ws("|", "order_id", F.col("line_number").cast("string")), 256)
    return lines.withColumn("_record_hash", key)


def _lines_hashed(spark, root):
    return _hashed(lines_classified(spark, root))


def q_replay_registry(spark, root):
    """X11: what a replay writes to its log."""
    late = quality.replay_late(quality.quarantined_rows(_lines_hashed(spark, root)), specs.REPLAY)
    return quality.replay_registry(late)


def q_replay_rerun(spark, root):
    """A later run under another replay id keeps what the first replay let in, once."""
    held = scratch_path(spark, "replay-lines")      # read by three branches: joined once, hashed where it is needed
    lines_classified(spark, root).select("order_id", "line_number", "business_date", "_ingest_date",
                                         quality.REASON_COL).write.parquet(held)
    c = _hashed(spark.read.parquet(held))
    q = quality.quarantined_rows(c)
    path = scratch_path(spark, "replay-log")
    quality.replay_registry(quality.replay_late(q, specs.REPLAY)).write.parquet(path)
    log = spark.read.parquet(path)
    feed = quality.change_feed(quality.valid_rows(c), quality.replay_again(q, specs.LATER_REPLAY, log))
    return feed.select("order_id", "line_number", "business_date", "_ingest_date", "_replay_id", "_backfill_id")


def q_backfill_rerun(spark, root):
    """Three runs of one backfill (a window, switched off, a later window that overlaps); every row
    let in by any of them is in the last, with the id and reason of the run that let it in."""
    from strata.plans.layers import backfilled
    staged = orders_staged(spark, root).withColumn("_record_hash", F.sha2(F.col("order_id"), 256))
    path = scratch_path(spark, "backfill-staging")
    quality.classify(staged, specs.ORDERS, waive_late=True).write.parquet(path)
    classified, log_path = spark.read.parquet(path), scratch_path(spark, "backfill-log")
    for settings in (specs.BACKFILL, Settings(), specs.LATER_BACKFILL):
        log = backfilled(spark, classified, settings, log_path)
    kept, refused = quality.logged_backfill(classified, log), quality.refused_backfill(classified, log)
    columns = ["order_id", "business_date", "_backfill_id", "_backfill_reason"]
    kept = kept.select(*columns, F.lit(None).cast("string").alias(quality.REASON_COL))
    return kept.unionByName(quality.with_tags(refused).select(*columns, quality.REASON_COL))


def q_retention_kept(spark, root):
    """The quarantine after retention; rows without a date stay."""
    q = quality.quarantined_rows(lines_classified(spark, root))
    dated = q.withColumn("_ingest_date", F.when(F.col("line_number") != 7, F.col("_ingest_date")))
    return ops.enforce_retention(dated, specs.LINES_NOW).select(
        "order_id", "line_number", quality.REASON_COL, "_ingest_date")


def q_change_feed_union(spark, root):
    """Valid rows + replayed late rows; the backfill feed is switched off."""
    # Valid + replayed rows are disjoint filters of one classification: one pass.
    # The backfill feed is switched off (Settings() default) and left out.
    feed = quality.feed_from_classified(lines_classified(spark, root), specs.REPLAY)
    return feed.select("order_id", "line_number", "business_date", "_ingest_date", "_replay_id",
                       "_backfill_id")


# ---------------------------------------------------------------- change application


def q_scd1_latest(spark, root):
    """Latest line item per (order, line number) by ship date."""
    li = read_table(spark, root, "lineitem")
    return scd.scd1(li, ["l_orderkey", "l_linenumber"], "l_shipdate", tiebreak=["l_partkey", "l_suppkey"])


def q_scd2_history(spark, root):
    """Event-type versions per user with [start, end) validity."""
    return events_history(spark, root).select("user_id", "event_type", scd.START_COL, scd.END_COL)


def q_scd2_effective(spark, root):
    """Event types by the day from which they hold, which lies up to a month before the event came in;
    with the versions as they were known in the middle of the events' time."""
    e = read_table(spark, root, "events", ["event_id", "user_id", "ts", "event_type"])
    days = F.expr("make_dt_interval(CAST(event_id * 7 % 31 AS INT))")
    e = e.withColumn("effective", F.date_trunc("day", F.col("ts") - days).cast("timestamp_ntz"))
    middle = e.select(F.timestamp_seconds(F.expr("CAST((unix_seconds(CAST(min(ts) AS timestamp)) "
                                                 "+ unix_seconds(CAST(max(ts) AS timestamp))) DIV 2 AS BIGINT)"))).first()[0]
    columns = ["user_id", "event_type", scd.START_COL, scd.END_COL, scd.KNOWN_COL]

    def versions(known_at):
        return scd.scd2_effective(e, ["user_id"], "effective", "ts", ["event_type"], tiebreak=["event_id"], known_at=known_at)

    return (versions(None).select(*columns, F.lit(True).alias("known_now"))
            .unionByName(versions(middle).select(*columns, F.lit(False).alias("known_now"))))


def q_dim_current(spark, root):
    """open version per user."""
    return scd.current_rows(events_history(spark, root)).select("user_id", "event_type")


# ---------------------------------------------------------------- model


def q_calendar(spark, root):
    """G1: date spine over the order dates."""
    return cal.calendar_spanning(read_table(spark, root, "orders", ["o_orderdate"]), "o_orderdate")


def fact_current(spark, root) -> DataFrame:
    facts = orders_valid(spark, root)
    dim = customer_dim(spark, root).select("customer_id")
    c, n = _calendar(spark, root)
    j = joins.join_calendar(joins.join_current(facts, dim, ["customer_id"]), c, "business_date", n)
    return j.select("order_id", "customer_id", "date_key", "year", "month",
                    F.lit(1).cast("int").alias("order_count"), "total_price", "order_priority",
                    "order_status")


def q_fact_current(spark, root):
    """Orders joined to the current customer and the calendar."""
    return fact_current(spark, root)


def q_fact_asof(spark, root):
    """Each event hour joined to the user's version valid then."""
    return joins.asof_interval_join(events_probes(spark, root), _versions(spark, root), ["user_id"],
                                    "probe_ts", ["event_type_asof"])


def q_fact_asof_bucketed(spark, root):
    """Same as-of join, candidates cut by month bucket."""
    return joins.asof_bucketed_join(events_probes(spark, root), _versions(spark, root), ["user_id"],
                                    "probe_ts", ["event_type_asof"], bucket="month")


def q_fact_asof_sweep(spark, root):
    """J3 at scale: the as-of join as a sorted sweep, no candidate pairs."""
    return joins.asof_sweep_join(events_probes(spark, root), _versions(spark, root), ["user_id"],
                                 "probe_ts", ["event_type_asof"], bucket="auto")


def q_unmatched(spark, root):
    """Orders whose customer is not in the dimension (rejected customers aren't)."""
    return joins.unmatched(orders_valid(spark, root), customer_dim(spark, root), ["customer_id"]).select("order_id", "customer_id")


def q_fact_daily(spark, root):
    """Daily roll-up per priority; money summed exactly as decimal."""
    f = fact_current(spark, root)
    return f.groupBy("date_key", "order_priority").agg(
        F.sum("order_count").cast("bigint").alias("order_count"),
        F.sum(F.col("total_price").cast("decimal(18,2)")).cast("double").alias("total_price"),
        F.max("total_price").alias("max_total_price"))


# ---------------------------------------------------------------- drift


def order_type_drift(spark, root) -> DataFrame:
    return drift.type_drift(orders_text(spark, root), "orders", specs.ORDERS.drift_fields)


def q_type_drift(spark, root):
    """A2/M2: values present but not castable, per field and run."""
    return order_type_drift(spark, root).select("dataset", "field", "expected_type", "ingest_run_id",
                                                "type_drift_rows")


def q_type_drift_rollup(spark, root):
    """A3: drift rows per dataset and run."""
    return drift.type_drift_rollup(order_type_drift(spark, root)).select(
        "dataset", "ingest_run_id", "type_drift_rows")


def q_rescued_profile(spark, root):
    """Rescued JSON keys by frequency."""
    ev = read_table(spark, root, "events", ["props"]).select(F.col("props").alias("_rescued_data"))
    return drift.rescued_profile(ev)


def q_rescued_promote(spark, root):
    """Rescued key ``k`` promoted to an int column with its flag."""
    ev = read_table(spark, root, "events", ["event_id", "props"]).withColumnRenamed("props", "_rescued_data")
    return ev.select("event_id", *promoted(ev.schema, specs.EVENTS.promote).values())


def q_rescued_keys(spark, root):
    """Several rescued keys, some on a part of the rows only."""
    c = read_table(spark, root, "customer")
    values = F.create_map(F.lit("segment"), F.col("c_mktsegment"),
                          F.lit("debt"), F.when(F.col("c_acctbal") < 0, F.col("c_acctbal").cast("string")),
                          F.lit("nation"), F.when(F.col("c_nationkey") > 9, F.col("c_nationkey").cast("string")))
    rescued = F.to_json(F.map_filter(values, lambda k, v: v.isNotNull()))
    return drift.rescued_profile(c.select(rescued.alias("_rescued_data")))


# ---------------------------------------------------------------- ops tables


def q_ingest_quality(spark, root):
    """Rows, corrupt and rescued rows and rates per run."""
    return ops.ingest_quality(events_bronze(spark, root))


def _join_drop_current(spark, root):
    """One pass over the facts: left joins to the (key-unique) dimension keys
    and calendar dates flag the facts the inner joins would keep."""
    facts = orders_valid(spark, root)
    c, n = _calendar(spark, root)
    dim = customer_dim(spark, root).select("customer_id").dropDuplicates(["customer_id"]) \
        .withColumn("_in_dim", F.lit(True))
    dates = c.select(F.col("date").alias("_date"), F.lit(True).alias("_in_cal"))
    dates = F.broadcast(dates) if n <= joins.MAX_BROADCAST_CALENDAR_ROWS else dates
    flagged = (facts.join(dim, "customer_id", "left")
                    .join(dates, F.col("business_date") == F.col("_date"), "left")
                    .select((F.col("_in_dim").isNotNull() & F.col("_in_cal").isNotNull()).alias("_matched")))
    return ops.join_drop_flagged("current", flagged)


def _join_drop_asof(spark, root):
    """One pass: a left as-of sweep flags the probes that find a version."""
    flagged = joins.asof_sweep_join(events_probes(spark, root), _versions(spark, root), ["user_id"],
                                    "probe_ts", ["event_type_asof"], bucket="auto", how="left",
                                    matched_col="_matched")
    return ops.join_drop_flagged("asof", flagged)


def q_join_drop(spark, root):
    """Facts in, facts kept and drop rate for the current and as-of joins."""
    return _join_drop_current(spark, root).unionByName(_join_drop_asof(spark, root))


def q_data_quality(spark, root):
    """Rows per reason and quarantine rate."""
    return ops.data_quality(customer_classified(spark, root), "customer")


def _freshness(spark, root):
    lines = read_table(spark, root, "lineitem", ["l_shipdate"])
    return ops.freshness([("events", events_bronze(spark, root), "_ingest_ts"),
                          ("lines", lines, "l_shipdate")], specs.EVENTS_NOW)


def _wall_clock(df: DataFrame, *cols: str) -> DataFrame:
    """Session-zone timestamps as wall-clock values, so a client in any time zone
    reads the same digits."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


def q_freshness(spark, root):
    """Latest ingest, lag in hours and SLA flag per dataset."""
    return _wall_clock(_freshness(spark, root), "last_ingest_ts")


def q_run_audit(spark, root):
    """Rows, files, bytes and first/last ingest per run."""
    return _wall_clock(ops.run_audit(events_bronze(spark, root)), "first_ingest_ts", "last_ingest_ts")


def q_retention(spark, root):
    """Quarantined line items past the retention limit."""
    q = quality.quarantined_rows(lines_classified(spark, root))
    return ops.retention_candidates(q, "lines", specs.LINES_NOW)


def q_guardrails(spark, root):
    """One row per check with observed value, threshold and verdict."""
    s = Settings()
    dq = q_data_quality(spark, root).agg(F.max("quarantine_rate").alias("observed"))
    jd = q_join_drop(spark, root)
    cur = jd.filter(F.col("model") == "current").select(F.col("drop_rate").alias("observed"))
    aso = jd.filter(F.col("model") == "asof").select(F.col("drop_rate").alias("observed"))
    td = drift.type_drift_rollup(order_type_drift(spark, root)).agg(
        F.round(F.sum("type_drift_rows") / F.sum("values_checked"), 6).alias("observed"))
    iq = events_bronze(spark, root).agg(
        F.round(F.avg(F.col("_corrupt_record").isNotNull().cast("double")), 6).alias("corrupt"),
        F.round(F.avg((F.col("_rescued_data").isNotNull()
                       & (F.regexp_replace("_rescued_data", r"\s", "") != "{}")).cast("double")), 6)
         .alias("rescued"))
    fr = _freshness(spark, root).filter(F.col("dataset") == "events").select(
        F.col("lag_hours").alias("observed"))
    checks = [
        ("max_quarantine_rate", dq, s.max_quarantine_rate),
        ("max_join_drop_rate_current", cur, s.max_join_drop_rate_current),
        ("max_join_drop_rate_asof", aso, s.max_join_drop_rate_asof),
        ("max_type_drift_rate", td, s.max_type_drift_rate),
        ("max_corrupt_rate", iq.select(F.col("corrupt").alias("observed")), s.max_corrupt_rate),
        ("max_rescued_rate", iq.select(F.col("rescued").alias("observed")), s.max_rescued_rate),
        ("freshness_lag_hours", fr, s.freshness_sla_hours),
    ]
    return ops.guardrails(checks)


QUERIES = {
    "contract_projection": q_contract_projection,
    "initcap_transform": q_initcap_transform,
    "record_hash": q_record_hash,
    "content_dedupe": q_content_dedupe,
    "record_hash_dates": q_record_hash_dates,
    "rules_valid": q_rules_valid,
    "quarantine_reason": q_quarantine_reason,
    "quarantine_null_safe": q_quarantine_null_safe,
    "late_flag": q_late_flag,
    "late_replay": q_late_replay,
    "backfill_window": q_backfill_window,
    "backfill_quarantine": q_backfill_quarantine,
    "replay_registry": q_replay_registry,
    "replay_rerun": q_replay_rerun,
    "backfill_rerun": q_backfill_rerun,
    "retention_kept": q_retention_kept,
    "change_feed_union": q_change_feed_union,
    "scd1_latest": q_scd1_latest,
    "scd2_history": q_scd2_history,
    "scd2_effective": q_scd2_effective,
    "dim_current": q_dim_current,
    "calendar": q_calendar,
    "fact_current": q_fact_current,
    "fact_asof": q_fact_asof,
    "fact_asof_bucketed": q_fact_asof_bucketed,
    "fact_asof_sweep": q_fact_asof_sweep,
    "unmatched": q_unmatched,
    "fact_daily": q_fact_daily,
    "type_drift": q_type_drift,
    "type_drift_rollup": q_type_drift_rollup,
    "rescued_profile": q_rescued_profile,
    "rescued_promote": q_rescued_promote,
    "rescued_keys": q_rescued_keys,
    "ingest_quality": q_ingest_quality,
    "join_drop": q_join_drop,
    "data_quality": q_data_quality,
    "freshness": q_freshness,
    "run_audit": q_run_audit,
    "retention": q_retention,
    "guardrails": q_guardrails,
}
