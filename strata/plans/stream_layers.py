"""The layered pipeline on streams: the same tables as ``layers.run_batch``, fed by new drops only.

Bronze, the valid/quarantine split and the silver merges are streams. Replayed
and backfilled rows enter the same merge as sources of their own: each run logs
the records it lets in as one numbered run of its log, and every logged run that
the merged table doesn't hold yet is merged under that number. So a run that
stops anywhere is made good by the next, and what was let in once stays, with
replay and backfill switched on or off. Gold and ops tables are then built from
the merged tables by the same code as the batch.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import quality
from strata.operators.conform import contract_fields
from strata.plans import layers
from strata.sources.publish import Run
from strata.sources.sinks import subfolders, write_table
from strata.sources.tables import table_exists
from strata.spec import DatasetSpec, Settings
from strata.streaming import runner
from strata.streaming.merge_table import MergeTable, read_merged

RUN = "_run"


def logged_runs(spark: SparkSession, log_path: str) -> dict[int, str]:
    return {int(at.rsplit("=", 1)[-1]): at for at in subfolders(spark, log_path, finished=True)}


def admit(spark: SparkSession, table: MergeTable, admissible: DataFrame, rows: DataFrame, log_path: str, source: str,
          tags: dict[str, str] | None) -> None:
    """Let records into ``table``: log those of ``admissible`` that no run has, then merge what the table lacks.

    ``rows``: everything that may be merged, found again by record hash. ``tags``:
    the tag columns of this run; None logs nothing and only makes earlier runs good."""
    runs = logged_runs(spark, log_path)
    if tags is not None:
        fresh = admissible.groupBy("_record_hash").agg(F.count(F.lit(1)).alias("rows"))
        if runs:
            fresh = fresh.join(spark.read.parquet(*runs.values()).select("_record_hash"), "_record_hash", "left_anti")
        number = max(runs, default=-1) + 1
        write_table(fresh.select("_record_hash", *[F.lit(v).cast("string").alias(t) for t, v in tags.items()], "rows"),
                    f"{log_path}/{RUN}={number}")
    for number, at in sorted(logged_runs(spark, log_path).items()):
        if not table.holds(number, source):
            log = spark.read.parquet(at)
            mine = [c for c in quality.TAG_COLUMNS if c in log.columns]
            let_in = quality.with_tags(rows).drop(*mine).join(log.select("_record_hash", *mine), "_record_hash")
            table.merge(let_in.select(*quality.with_tags(rows).columns), number, source)


def _late(quarantine: DataFrame) -> DataFrame:
    rows = quarantine.filter(F.col(quality.REASON_COL) == quality.LATE_REASON)
    return rows.drop(*[c for c in (quality.REASON_COL, quality.LATE_COL, quality.CORRUPT_COL) if c in rows.columns])


def run_streams(spark: SparkSession, city_location: str, trips_location: str, out_root: str, settings: Settings | None = None,
                backfill_location: str | None = None, asof_strategy: str = "sweep", open_first_version: bool = True,
                promote: dict[str, dict] | None = None) -> dict[str, str]:
    """New drops through every table; returns table name -> path.

    ``silver_city`` and ``silver_trips`` are merge tables (``read_merged``), the
    others plain parquet; gold and ops tables are published like those of the
    batch (``sources.publish``)."""
    settings, promote, root = settings or Settings(), promote or {}, out_root.rstrip("/")
    run = Run(spark, root)
    path, save, out = run.state, run.save, {}

    def split(spec: DatasetSpec, location: str, waive_late: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
        """(bronze, valid, quarantine) of a dataset after its new drops."""
        out[f"bronze_{spec.name}"] = runner.run_stream(spark, location, spec, settings, root)
        return split_so_far(spec, waive_late)

    def split_so_far(spec: DatasetSpec, waive_late: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
        valid, refused = path(f"silver_{spec.name}_valid"), path(f"quarantine_{spec.name}")
        runner.silver_stream(spark, path(f"bronze_{spec.name}"), spec, settings, valid, refused,
                             path(f"_checkpoints/silver_{spec.name}"), waive_late)
        out[f"quarantine_{spec.name}"] = refused
        widest = spark.read.option("mergeSchema", "true")
        return (widest.parquet(path(f"bronze_{spec.name}")).drop("batch_id"), widest.parquet(valid).drop("batch_id"),
                widest.parquet(refused).drop("batch_id"))

    def merged(spec: DatasetSpec, valid: DataFrame, columns, **how) -> MergeTable:
        out[f"silver_{spec.name}"] = path(f"silver_{spec.name}")
        stream = spark.readStream.schema(valid.schema).parquet(path(f"silver_{spec.name}_valid"))
        runner.merge_stream(spark, quality.with_tags(stream).select(*columns), out[f"silver_{spec.name}"],
                            path(f"_checkpoints/merge_{spec.name}"), list(spec.keys), sequence=list(layers.SEQUENCE), **how)
        return MergeTable(spark, out[f"silver_{spec.name}"])

    city, trips = (layers.with_promotions(x, promote.get(x.name)) for x in (layers.CITY, layers.TRIPS))
    backfill = replace(trips, name=layers.BACKFILL.name)
    b_city, v_city, q_city = split(city, city_location)
    b_trips, v_trips, q_trips = split(trips, trips_location)
    columns = [f.name for f in contract_fields(trips)]
    merged(city, v_city, v_city.columns, kind="scd2", track=layers.CITY.tracked, open_first_version=open_first_version)
    table = merged(trips, v_trips, columns, kind="scd1")

    if settings.replay_enabled or logged_runs(spark, path("replay_log")):
        late = _late(q_trips)
        tags = {"_replay_id": settings.replay_id} if settings.replay_enabled else None
        admit(spark, table, late, quality.with_tags(late).select(*columns), path("replay_log"), "replay", tags)
        out["replay_log"] = path("replay_log")

    landed = [("city", b_city, layers.CITY, city_location), ("trips", b_trips, layers.TRIPS, trips_location)]
    if settings.backfill_enabled and backfill_location is not None:
        parts = split(backfill, backfill_location, waive_late=True)
    else:
        known = table_exists(spark, path(f"bronze_{backfill.name}"))
        parts = split_so_far(backfill, waive_late=True) if known else None
    if parts is not None:
        b_backfill, valid, broken = parts
        inside = valid.filter(F.col("business_date").between(F.lit(settings.backfill_start).cast("date"),
                                                             F.lit(settings.backfill_end).cast("date")))
        tags = ({"_backfill_id": settings.backfill_id, "_backfill_reason": settings.backfill_reason}
                if settings.backfill_enabled else None)
        admit(spark, table, inside, quality.with_tags(valid).select(*columns), path("backfill_log"), "backfill", tags)
        out["backfill_log"] = path("backfill_log")
        runs = logged_runs(spark, path("backfill_log"))
        if runs:
            log = spark.read.parquet(*runs.values())
            both = valid.withColumn(quality.REASON_COL, F.lit(None).cast("string")).unionByName(broken, allowMissingColumns=True)
            save("quarantine_trips_backfill_open", quality.refused_backfill(both, log))
        landed.append((backfill.name, b_backfill, layers.BACKFILL, backfill_location))

    def classified(valid: DataFrame, quarantine: DataFrame) -> DataFrame:
        return valid.withColumn(quality.REASON_COL, F.lit(None).cast("string")).unionByName(quarantine, allowMissingColumns=True)

    checks = layers.gold_and_ops(spark, save, settings, read_merged(spark, out["silver_trips"]), read_merged(spark, out["silver_city"]),
                        classified(v_trips, q_trips), classified(v_city, q_city), q_trips, q_city, landed, asof_strategy)
    run.publish(checks, settings)
    return {**out, **run.tables}
