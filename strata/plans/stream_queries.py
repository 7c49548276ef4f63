"""Streaming twins of batch operators (W1, W5, S12-S14, C1, C2 incremental).

Each builder writes the table as several drop files under the shared
checkpoint folder (Spark derives them from the table; a second delivery of
the same rows where re-delivery is the point), streams them a few files per
micro-batch with ``availableNow``, and returns the sink table read back. The
result must equal the batch twin's, whatever the batch split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.normalize import record_hash
from strata.operators import scd
from strata.session import scratch_path
from strata.sources.tables import read_table
from strata.plans import specs
from strata.streaming.merge_table import read_merged
from strata.streaming.runner import dedupe_stream, merge_stream, profile_stream, table_files_stream

# A drop file for so many rows (a task aggregates them in memory), the least of them, and the most micro-batches that
# many files come in: what a batch does to the table before it is done that often, whatever the table's size.
ROWS_PER_FILE, DROP_FILES, MOST_BATCHES = 2_000_000, 4, 8


def _parts(df: DataFrame, least: int) -> int:
    return max(least, -(-df.count() // ROWS_PER_FILE))


def _drops(spark: SparkSession, root: str, table: str, cols, copies: int = 1, trigger: int = 1) -> tuple[str, str, int]:
    """(folder, its drop files, how many of them a micro-batch takes: ``trigger`` or more).

    A large table is written as it is read, without a shuffle."""
    base = scratch_path(spark, f"stream-{table}")
    df = read_table(spark, root, table, cols)
    files = _parts(df, DROP_FILES)
    whole = files > DROP_FILES and df.rdd.getNumPartitions() >= DROP_FILES
    dealt = df.coalesce(files) if whole else df.repartition(files)
    how = {"compression": "zstd", **({"maxRecordsPerFile": ROWS_PER_FILE} if whole else {})}
    for c in range(copies):
        dealt.write.mode("overwrite").options(**how).parquet(f"{base}/drops/delivery_{c}")
    written = len(spark.read.option("recursiveFileLookup", "true").parquet(f"{base}/drops").inputFiles())
    return base, f"{base}/drops", max(trigger, -(-written // MOST_BATCHES))


def q_stream_dedupe(spark: SparkSession, root: str) -> DataFrame:
    """W1/D1 streaming: two deliveries of line items, one survivor per hash of the whole content."""
    base, drops, trigger = _drops(spark, root, "lineitem", None, copies=2, trigger=2)
    files = table_files_stream(spark, drops, trigger)
    stream = files.select("l_orderkey", "l_linenumber", record_hash(specs.LINE_CONTENT, files.schema).alias("_record_hash"))
    dedupe_stream(spark, stream, f"{base}/bronze", f"{base}/_checkpoint", time_col="_record_hash")
    return spark.read.parquet(f"{base}/bronze").select("l_orderkey", "l_linenumber", "_record_hash")


def q_stream_scd1(spark: SparkSession, root: str) -> DataFrame:
    """C1 incremental: line items merged batch by batch into a type-1 table."""
    li = read_table(spark, root, "lineitem")
    base, drops, trigger = _drops(spark, root, "lineitem", None)
    merge_stream(spark, table_files_stream(spark, drops, trigger), f"{base}/table", f"{base}/_checkpoint",
                 ["l_orderkey", "l_linenumber"], "scd1", ["l_shipdate", "l_partkey", "l_suppkey"])
    return read_merged(spark, f"{base}/table").select(*li.columns)


def q_stream_scd2(spark: SparkSession, root: str) -> DataFrame:
    """C2 incremental: event versions merged batch by batch, out-of-order arrival."""
    base, drops, trigger = _drops(spark, root, "events", ["event_id", "user_id", "ts", "event_type"])
    merge_stream(spark, table_files_stream(spark, drops, trigger), f"{base}/table", f"{base}/_checkpoint",
                 ["user_id"], "scd2", ["ts", "event_id"], track=["event_type"])
    t = read_merged(spark, f"{base}/table")
    return t.select("user_id", "event_type", scd.START_COL, scd.END_COL)


def q_stream_profile(spark: SparkSession, root: str) -> DataFrame:
    """A1/W5 streaming: rescued-key counts in complete mode."""
    base, drops, trigger = _drops(spark, root, "events", ["props"])
    stream = table_files_stream(spark, drops, trigger).select(F.col("props").alias("_rescued_data"))
    profile_stream(spark, stream, f"{base}/profile", f"{base}/_checkpoint")
    return spark.read.parquet(f"{base}/profile").select("rescued_key", "count")


def q_stream_quarantine(spark: SparkSession, root: str) -> DataFrame:
    """S16/F4-F7 streaming: customer drops classified per micro-batch; the
    quarantine sink (written with the valid rows from one pass) read back."""
    from strata.spec import Settings
    from strata.streaming.runner import silver_split
    base, drops, trigger = _drops(spark, root, "customer", None)
    silver_split(table_files_stream(spark, drops, trigger), specs.CUSTOMER, Settings(), f"{base}/valid",
                 f"{base}/quarantine", f"{base}/_checkpoint")
    q = spark.read.parquet(f"{base}/quarantine")
    return q.select(*specs.CUSTOMER.field_names, "_reject_reason")


def q_stream_type_drift(spark: SparkSession, root: str) -> DataFrame:
    """A2/W5 streaming: orders as all-text drops, drift counted by a complete-mode aggregate."""
    from strata.plans.bronze import orders_text
    from strata.streaming.runner import type_drift_stream
    base = scratch_path(spark, "stream-orders-text")
    orders_text(spark, root).repartition(DROP_FILES).write.parquet(f"{base}/drops")
    type_drift_stream(spark, table_files_stream(spark, f"{base}/drops"), "orders", specs.ORDERS.drift_fields,
                      f"{base}/drift", f"{base}/_checkpoint")
    return spark.read.parquet(f"{base}/drift").select("dataset", "field", "expected_type", "ingest_run_id",
                                                      "type_drift_rows")


STREAM_QUERIES = {
    "stream_type_drift": q_stream_type_drift,
    "stream_quarantine": q_stream_quarantine,
    "stream_dedupe": q_stream_dedupe,
    "stream_scd1": q_stream_scd1,
    "stream_scd2": q_stream_scd2,
    "stream_profile": q_stream_profile,
}
