"""Structured Streaming drivers for the pipeline.

* ``drops_to_landing``: stream of new drop files -> ``foreachBatch`` that runs
  the header-aware CSV reader on that batch's files (at most
  ``maxFilesPerTrigger`` paths) and writes them, with ingest metadata, to
  ``landing/batch_id=N`` (overwrite: a retried batch rewrites the same folder).
* ``landing_to_bronze``: parquet stream of the landing folder ->
  de-duplication by content hash against a hash table on storage -> one bronze
  folder per micro-batch, partitioned by ingest day.
* ``merge_stream``: ``foreachBatch`` that adds each micro-batch to a ``MergeTable``:
  a batch writes its own rows, readers merge them with the base, and deltas that
  outgrow a share of the base are compacted into a new one.
* ``profile_stream``: complete-mode aggregate written whole on every batch.

All state (checkpoints, staging) lives under ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.dedupe import dedupe_content
from strata.operators.metadata import add_ingest_metadata
from strata.session import ensure_checkpoint_dir
from strata.sources.csv_drops import read_drops
from strata.streaming.dedupe import BATCH_ID, append_new
from strata.streaming.merge_table import MergeTable
from strata.spec import DatasetSpec, Settings

BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def _await(query, timeout_s: int | None = None) -> None:
    query.awaitTermination(timeout_s)
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def drops_to_landing(spark: SparkSession, location: str, spec: DatasetSpec, settings: Settings,
                     landing: str, checkpoint: str, glob: str = "*.csv", scope: str = "all"):
    """Hop 1: drop files -> landing parquet (one folder per micro-batch)."""
    declared = list(spec.required_columns) + list(spec.known_columns)
    files = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
             .option("pathGlobFilter", glob)
             .option("maxFilesPerTrigger", str(settings.max_files_per_trigger))
             .load(location).select("path"))

    def land(batch: DataFrame, batch_id: int) -> None:
        paths = [r["path"] for r in batch.collect()]   # bounded by maxFilesPerTrigger
        if not paths:
            return
        rows = add_ingest_metadata(read_drops(spark, paths, declared=declared), spec, settings,
                                   file_lineage=False)
        # Copies within the batch collapse map-side here; the stateful hop sees one of each.
        rows = dedupe_content(rows, "file" if scope == "file" else "all")
        rows.write.mode("overwrite").parquet(f"{landing}/batch_id={batch_id}")

    q = (files.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    _await(q)


def dedupe_stream(spark: SparkSession, stream: DataFrame, out: str, checkpoint: str, scope: str = "all",
                  time_col: str = "_ingest_ts", watermark_days: int | None = None, partition_by=()) -> None:
    """Append what is new of a stream to ``out/batch_id=N``, by a hash table at ``<out>_hashes`` (see ``append_new``)."""
    source: list[str] = []

    def apply(batch: DataFrame, batch_id: int) -> None:
        if not source:
            source.append(stream_name(spark, checkpoint))
        append_new(spark, batch, batch_id, source[0], out, f"{out}_hashes", scope, time_col, watermark_days, partition_by)

    q = (stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    _await(q)


def landing_to_bronze(spark: SparkSession, landing: str, bronze: str, checkpoint: str,
                      settings: Settings, scope: str = "all",
                      partition_by=("_ingest_yyyymmdd",)):
    """Hop 2: landing parquet -> content de-duplication -> bronze append."""
    schema = spark.read.parquet(landing).drop(BATCH_ID).schema
    stream = spark.readStream.schema(schema).parquet(landing).select(*schema.names)
    dedupe_stream(spark, stream, bronze, checkpoint, scope, "_ingest_ts", settings.watermark_days, partition_by)


def stream_name(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gave the stream when its checkpoint was made: a new checkpoint is a new source."""
    return spark.read.json(f"{checkpoint}/metadata").first()["id"]


def merge_batch(spark: SparkSession, batch: DataFrame, table: str, keys, kind: str, sequence, batch_id: int, source: str,
                track=None, tiebreak=None, bucket: str | None = "auto", open_first_version: bool = False) -> None:
    """Merge one batch of change rows into the table at ``table`` (see ``MergeTable``).

    ``source`` and ``batch_id`` name the batch; the same name again is a retry."""
    MergeTable(spark, table, kind, keys, sequence, track, tiebreak, bucket, open_first_version).merge(batch, batch_id, source)


def merge_stream(spark: SparkSession, stream: DataFrame, table: str, checkpoint: str, keys, kind: str,
                 sequence, track=None, tiebreak=None, bucket: str | None = "auto", open_first_version: bool = False):
    """Run ``stream`` to completion, merging every micro-batch into ``table``; ``read_merged`` reads it."""
    merged = MergeTable(spark, table, kind, keys, sequence, track, tiebreak, bucket, open_first_version)

    source: list[str] = []

    def apply(batch: DataFrame, batch_id: int) -> None:
        if not source:
            source.append(stream_name(spark, checkpoint))
        merged.merge(batch, batch_id, source[0])

    q = (stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    _await(q)


def profile_stream(spark: SparkSession, stream: DataFrame, table: str, checkpoint: str):
    """Rescued-key counts over the whole stream, complete mode, rewritten each batch."""
    from strata.operators.drift import rescued_counts
    counts = rescued_counts(stream)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(table)

    q = (counts.writeStream.outputMode("complete").foreachBatch(write)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    _await(q)


def run_stream(spark: SparkSession, location: str, spec: DatasetSpec, settings: Settings, out_root: str,
               scope: str = "all") -> str:
    """Drops -> landing -> bronze for one dataset; returns the bronze path."""
    ensure_checkpoint_dir(spark)
    root = out_root.rstrip("/")
    drops_to_landing(spark, location, spec, settings, f"{root}/landing_{spec.name}",
                     f"{root}/_checkpoints/landing_{spec.name}", scope=scope)
    bronze = f"{root}/bronze_{spec.name}"
    landing_to_bronze(spark, f"{root}/landing_{spec.name}", bronze,
                      f"{root}/_checkpoints/bronze_{spec.name}", settings, scope)
    return bronze


def table_files_stream(spark: SparkSession, folder: str, max_files_per_trigger: int = 1) -> DataFrame:
    """Parquet files of ``folder`` (recursively) as a stream, a few files per batch."""
    schema = spark.read.option("recursiveFileLookup", "true").parquet(folder).schema
    return (spark.readStream.schema(schema).option("recursiveFileLookup", "true")
            .option("maxFilesPerTrigger", str(max_files_per_trigger)).parquet(folder))


def silver_stream(spark: SparkSession, bronze: str, spec: DatasetSpec, settings: Settings, valid: str,
                  quarantine: str, checkpoint: str, waive_late: bool = False) -> None:
    """Bronze parquet folder as a stream -> ``silver_split``."""
    schema = spark.read.option("mergeSchema", "true").parquet(bronze).drop(BATCH_ID).schema
    silver_split(spark.readStream.schema(schema).parquet(bronze).select(*schema.names), spec, settings, valid, quarantine,
                 checkpoint, waive_late)


def silver_split(stream: DataFrame, spec: DatasetSpec, settings: Settings, valid: str, quarantine: str,
                 checkpoint: str, waive_late: bool = False) -> None:
    """Stream -> contract + rules, valid rows and quarantine from one pass.

    Each micro-batch is classified once (kept in memory for the two writes; if
    an executor is lost Spark recomputes it from that batch's files) and
    written to ``valid/batch_id=N`` and ``quarantine/batch_id=N`` with
    overwrite, so a retried batch replaces its own output and nothing else.
    """
    from strata.operators import quality
    from strata.operators.conform import conform

    def split(batch: DataFrame, batch_id: int) -> None:
        c = quality.classify(conform(batch, spec, settings), spec, waive_late).persist()
        try:
            quality.valid_rows(c).write.mode("overwrite").parquet(f"{valid}/batch_id={batch_id}")
            quality.quarantined_rows(c).write.mode("overwrite").parquet(f"{quarantine}/batch_id={batch_id}")
        finally:
            c.unpersist()

    q = (stream.writeStream.foreachBatch(split).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    _await(q)


def type_drift_stream(spark: SparkSession, stream: DataFrame, dataset: str, fields, table: str,
                      checkpoint: str, run_col: str = "_ingest_run_id") -> None:
    """Type drift over a whole stream: the per-run counters are a complete-mode
    aggregate; each micro-batch writes them, unpivoted, over the table."""
    from strata.operators import drift
    fields = drift.present_fields(stream, fields)
    counts = drift.type_drift_counts(stream, fields, run_col)

    def write(batch: DataFrame, batch_id: int) -> None:
        drift.type_drift_rows(batch, dataset, fields).write.mode("overwrite").parquet(table)

    q = (counts.writeStream.outputMode("complete").foreachBatch(write)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    _await(q)
