"""Operational tables: ingest quality, join drop, data quality, freshness,
run audit, quarantine retention and guardrails.

All are aggregates over pipeline tables; none collects rows to the driver
except ``enforce_guardrails``, which reads the guardrail table (a handful of
rows, one per check).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.spec import Settings

RATE_DIGITS = 6


def _rate(num: Column, den: Column) -> Column:
    return F.round(F.when(den > 0, num / den).otherwise(F.lit(0.0)), RATE_DIGITS)


def now(settings: Settings) -> Column:
    return F.lit(settings.now).cast("timestamp") if settings.now else F.current_timestamp()


def ingest_quality(bronze: DataFrame, dataset_col: str = "_dataset",
                   run_col: str = "_ingest_run_id") -> DataFrame:
    """Rows, corrupt rows and rows with rescued data per dataset and run."""
    corrupt = (F.col("_corrupt_record").isNotNull() if "_corrupt_record" in bronze.columns
               else F.lit(False))
    if "_rescued_data" in bronze.columns:
        r = F.col("_rescued_data")
        rescued = r.isNotNull() & (F.regexp_replace(r, r"\s", "") != F.lit("{}"))
    else:
        rescued = F.lit(False)
    agg = bronze.groupBy(F.col(dataset_col).alias("dataset"), F.col(run_col).alias("ingest_run_id")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(corrupt.cast("int")).cast("bigint").alias("corrupt_rows"),
        F.sum(rescued.cast("int")).cast("bigint").alias("rescued_rows"))
    return agg.withColumns({
        "corrupt_rate": _rate(F.col("corrupt_rows"), F.col("rows")),
        "rescued_rate": _rate(F.col("rescued_rows"), F.col("rows")),
    })


def join_drop(model: str, facts: DataFrame, matched: DataFrame) -> DataFrame:
    """Facts in, facts kept by the join, drop rate; ``matched`` is a subset of ``facts``."""
    tagged = (facts.select(F.lit(1).alias("i"), F.lit(0).alias("m"))
                   .unionByName(matched.select(F.lit(0).alias("i"), F.lit(1).alias("m"))))
    agg = tagged.agg(F.sum("i").cast("bigint").alias("facts_in"),
                     F.sum("m").cast("bigint").alias("facts_matched"))
    return agg.select(F.lit(model).alias("model"), "facts_in", "facts_matched",
                      _rate(F.col("facts_in") - F.col("facts_matched"), F.col("facts_in")).alias("drop_rate"))


def join_drop_flagged(model: str, flagged: DataFrame, matched_col: str = "_matched") -> DataFrame:
    """``join_drop`` from one pass over facts carrying a boolean matched flag."""
    agg = flagged.agg(F.count(F.lit(1)).cast("bigint").alias("facts_in"),
                      F.sum(F.col(matched_col).cast("int")).cast("bigint").alias("facts_matched"))
    return agg.select(F.lit(model).alias("model"), "facts_in",
                      F.coalesce(F.col("facts_matched"), F.lit(0).cast("bigint")).alias("facts_matched"),
                      _rate(F.col("facts_in") - F.coalesce(F.col("facts_matched"), F.lit(0)),
                            F.col("facts_in")).alias("drop_rate"))


def data_quality(classified: DataFrame, dataset: str, reason_col: str = "_reject_reason") -> DataFrame:
    """Rows per reject reason (``valid`` for kept rows), share, quarantine rate."""
    per = classified.groupBy(F.lit(dataset).alias("dataset"),
                             F.coalesce(F.col(reason_col), F.lit("valid")).alias("reason")).agg(
        F.count(F.lit(1)).alias("rows"))
    # Totals per dataset over the per-reason rows (a handful per dataset).
    w = Window.partitionBy("dataset")
    total = F.sum("rows").over(w)
    quarantined = F.sum(F.when(F.col("reason") != "valid", F.col("rows")).otherwise(0)).over(w)
    return per.select("dataset", "reason", "rows", _rate(F.col("rows"), total).alias("share"),
                      _rate(quarantined, total).alias("quarantine_rate"))


def freshness(tables, settings: Settings) -> DataFrame:
    """Latest ingest per dataset, its age in hours against ``now``, within the limit."""
    parts = [df.select(F.lit(name).alias("dataset"), F.col(ts_col).cast("timestamp").alias("_ts"))
             for name, df, ts_col in tables]
    u = reduce(lambda a, b: a.unionByName(b), parts)
    agg = u.groupBy("dataset").agg(F.max("_ts").alias("last_ingest_ts"))
    lag = (F.unix_micros(now(settings)) - F.unix_micros(F.col("last_ingest_ts"))) / F.lit(3.6e9)
    return agg.select("dataset", "last_ingest_ts", F.round(lag, 3).alias("lag_hours"),
                      (lag <= F.lit(settings.freshness_sla_hours)).alias("within_sla"))


def run_audit(bronze: DataFrame, dataset_col: str = "_dataset", run_col: str = "_ingest_run_id") -> DataFrame:
    """Rows, distinct files, bytes over distinct files, first/last ingest per run.

    Two aggregation levels (per file, then per run) instead of a distinct
    count, so a run with millions of files never meets in one hash set.
    """
    per_file = bronze.groupBy(F.col(dataset_col).alias("dataset"), F.col(run_col).alias("ingest_run_id"),
                              F.col("_source_file").alias("f")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.max("_source_file_size").alias("size"),
        F.min("_ingest_ts").alias("first_ts"),
        F.max("_ingest_ts").alias("last_ts"))
    return per_file.groupBy("dataset", "ingest_run_id").agg(
        F.sum("rows").cast("bigint").alias("rows"),
        F.count("f").cast("bigint").alias("files"),
        F.sum("size").cast("bigint").alias("bytes"),
        F.min("first_ts").alias("first_ingest_ts"),
        F.max("last_ts").alias("last_ingest_ts"))


def retention_candidates(quarantine: DataFrame, dataset: str, settings: Settings,
                         reason_col: str = "_reject_reason", date_col: str = "_ingest_date") -> DataFrame:
    """Quarantined rows older than the retention limit, per reason and day."""
    cutoff = F.date_sub(F.to_date(now(settings)), settings.quarantine_retention_days)
    old = quarantine.filter(F.col(date_col) < cutoff)
    return old.groupBy(F.col(reason_col).alias("reason"), F.col(date_col).alias("ingest_date")).agg(
        F.count(F.lit(1)).alias("rows")).select(F.lit(dataset).alias("dataset"), "reason",
                                               "ingest_date", "rows")


def enforce_retention(quarantine: DataFrame, settings: Settings, date_col: str = "_ingest_date") -> DataFrame:
    """The quarantine without rows past the retention limit; rows without a date,
    which are never candidates either, stay.

    Write it as the next version of the table (a new location, then point
    readers at it): with the table partitioned by ingest date, expired dates
    simply have no partition there. A dynamic partition overwrite in place
    would only replace partitions present in the kept rows and leave expired
    ones behind.
    """
    cutoff = F.date_sub(F.to_date(now(settings)), settings.quarantine_retention_days)
    return quarantine.filter(F.col(date_col).isNull() | (F.col(date_col) >= cutoff))


def guardrails(checks) -> DataFrame:
    """One row per check: (name, observed, threshold, passed).

    ``checks``: iterable of (name, one-row DataFrame with column ``observed``,
    threshold). ``passed`` is ``observed <= threshold``; a NULL observation fails.
    """
    parts = [df.select(F.lit(name).alias("check"),
                       F.col("observed").cast("double").alias("observed"),
                       F.lit(float(threshold)).alias("threshold"))
             for name, df, threshold in checks]
    u = reduce(lambda a, b: a.unionByName(b), parts)
    return u.withColumn("passed", F.coalesce(F.col("observed") <= F.col("threshold"), F.lit(False)))


class GuardrailError(RuntimeError):
    pass


def enforce_guardrails(table: DataFrame, settings: Settings) -> None:
    """Raise when enforcement is on and any check failed."""
    if not settings.guardrails_enforced:
        return
    failed = table.filter(~F.col("passed")).select("check", "observed", "threshold").collect()
    if failed:
        desc = ", ".join(f"{r['check']}={r['observed']} > {r['threshold']}" for r in failed)
        raise GuardrailError(f"guardrails failed: {desc}")
