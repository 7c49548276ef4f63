"""Schema drift, type drift and rescued-field profiling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.casts import safe_cast
from strata.operators.conform import rescued_values
from strata.spec import Settings

def schema_drift(observed: DataFrame) -> DataFrame:
    """Missing required and unexpected columns per observation.

    ``observed`` has ``actual_cols``, ``required_cols`` and ``known_cols``
    arrays, one row per source file (from the CSV header scan), so it scales
    with the number of files.
    """
    missing = F.array_except("required_cols", "actual_cols")
    unexpected = F.array_except("actual_cols", F.array_union("required_cols", "known_cols"))
    return observed.select(
        *[c for c in observed.columns if c not in ("actual_cols", "required_cols", "known_cols")],
        "actual_cols", "required_cols",
        missing.alias("missing_required_cols"),
        unexpected.alias("unexpected_cols"),
        (F.size(missing) > 0).alias("is_breaking_drift"))


def present_fields(df: DataFrame, fields) -> list[tuple[str, str]]:
    return [(f, t) for f, t in fields if f in df.columns]


def type_drift_counts(df: DataFrame, fields, run_col: str = "_ingest_run_id") -> DataFrame:
    """One row per run: rows checked and one drift counter per field (``d0``, ``d1`` ...).

    A plain aggregate, so it also runs on a stream (complete or update mode).
    """
    sums = [F.sum(F.when(F.col(f).isNotNull() & safe_cast(F.col(f), t, df.schema[f].dataType).isNull(), 1)
                  .otherwise(0)).cast("bigint").alias(f"d{i}") for i, (f, t) in enumerate(fields)]
    return df.groupBy(F.col(run_col).alias("ingest_run_id")).agg(
        F.count(F.lit(1)).alias("rows_checked"), *sums)


def type_drift_rows(wide: DataFrame, dataset: str, fields) -> DataFrame:
    """The per-run counters unpivoted to one row per (run, field)."""
    long = wide.unpivot(["ingest_run_id", "rows_checked"], [f"d{i}" for i in range(len(fields))],
                        "_slot", "type_drift_rows")
    names = F.create_map(*[x for i, (f, _) in enumerate(fields) for x in (F.lit(f"d{i}"), F.lit(f))])
    types = F.create_map(*[x for i, (_, t) in enumerate(fields) for x in (F.lit(f"d{i}"), F.lit(t))])
    return long.select(
        F.lit(dataset).alias("dataset"),
        names[F.col("_slot")].alias("field"),
        types[F.col("_slot")].alias("expected_type"),
        "ingest_run_id",
        F.col("type_drift_rows").cast("bigint").alias("type_drift_rows"),
        F.col("rows_checked").cast("bigint").alias("rows_checked"))


def stamped(df: DataFrame, column: str, settings: Settings) -> DataFrame:
    """``df`` with the run's time in ``column``."""
    now = F.lit(settings.now).cast("timestamp") if settings.now else F.current_timestamp()
    return df.withColumn(column, now)


def type_drift(df: DataFrame, dataset: str, fields, run_col: str = "_ingest_run_id") -> DataFrame:
    """Rows whose raw value is present but does not cast, per field and run.

    One scan and one aggregate: every field's counter is a column of the same
    ``groupBy(run)``, and the wide result (a row per run) is unpivoted to one
    row per (run, field). Fields missing from ``df`` are skipped.
    """
    fields = present_fields(df, fields)
    if not fields:
        raise ValueError(f"{dataset}: none of the drift fields is present")
    return type_drift_rows(type_drift_counts(df, fields, run_col), dataset, fields)


def type_drift_rollup(drift: DataFrame) -> DataFrame:
    """Drift rows per dataset and run (all fields)."""
    return drift.groupBy("dataset", "ingest_run_id").agg(
        F.sum("type_drift_rows").cast("bigint").alias("type_drift_rows"),
        (F.max("rows_checked") * F.count(F.lit(1))).cast("bigint").alias("values_checked"))


def rescued_counts(df: DataFrame) -> DataFrame:
    """How often each rescued key occurs; also runs on a stream in complete mode."""
    keys = F.map_keys(rescued_values(df.schema))
    return df.select(F.explode(keys).alias("rescued_key")).groupBy("rescued_key").count()


def rescued_profile(df: DataFrame) -> DataFrame:
    """``rescued_counts``, most frequent first."""
    return rescued_counts(df).orderBy(F.desc("count"), F.asc("rescued_key"))
