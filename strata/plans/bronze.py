"""Bronze-shaped frames derived from the benchmark tables.

They stand in for CSV drops already landed: business columns as text, the
rescued JSON, ingest time, run and file lineage, all computed by Spark from
the table rows, so their size follows the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.metadata import add_ingest_metadata
from strata.plans import specs
from strata.sources.tables import as_strings, read_table
from strata.spec import Settings


def events_bronze(spark: SparkSession, root: str) -> DataFrame:
    """Events as landed drops: one file per (day, event type), one run per day."""
    ev = read_table(spark, root, "events")
    b = ev.select(
        *[F.col(c).cast("string").alias(c) for c in ("event_id", "ts", "user_id", "event_type", "value")],
        F.col("props").alias("_rescued_data"),
        F.lit(None).cast("string").alias("_corrupt_record"),
        F.col("ts").alias("_ts_raw"))
    src = F.concat(F.lit("events/"), F.date_format("_ts_raw", "yyyyMMdd"), F.lit("/"), F.col("event_type"),
                   F.lit(".csv"))
    b = b.withColumns({
        "_source_file": src,
        "_source_file_mod_ts": F.date_trunc("day", F.col("_ts_raw").cast("timestamp")),
        "_source_file_size": (F.length(src) * 100).cast("bigint"),
    })
    out = add_ingest_metadata(
        b, specs.EVENTS, Settings(), ingest_ts=F.col("_ts_raw").cast("timestamp"), file_lineage=False,
        run_id=F.concat(F.lit("r"), F.date_format("_ts_raw", "yyyyMMdd")))
    return out.drop("_ts_raw")


def orders_text(spark: SparkSession, root: str) -> DataFrame:
    """Orders as all-text drops (dates as ``yyyy-MM-dd``), one run per order year."""
    o = read_table(spark, root, "orders")
    run = F.concat(F.lit("r"), F.year("o_orderdate").cast("string"))
    return as_strings(o, date_columns=("o_orderdate",)).withColumn("_ingest_run_id", run)
