"""De-duplication on a stream against a hash table on storage.

The hashes of everything appended so far lie in a merge table of their own, not
in streaming state: an executor holds a micro-batch and nothing else, and a new
checkpoint or another stream can use the same table. A micro-batch is compared
with the table by an anti-join on the hashes it was de-duplicated by. The table
is bucketed by them, so a batch's rows are shuffled once and the table never; new
hashes are stored as they lie in the files of their rows. Hashes are shuffled and
stored as bytes, at half the length of their hex.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.normalize import packed, unpacked
from strata.operators.dedupe import HASH_COL, SCOPES, dedupe_content
from strata.sources.tables import table_exists
from strata.streaming.merge_table import MergeTable, by_keys

BATCH_ID = "batch_id"


def hash_keys(scope: str) -> list[str]:
    if scope not in SCOPES:
        raise ValueError(f"scope must be one of {SCOPES}")
    return [HASH_COL, "_source_file"] if scope == "file" else [HASH_COL]


def unknown(rows: DataFrame, held: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys ``held`` lacks, NULL matching NULL.

    Rows with all keys are joined by plain equality, for which the shuffle that
    de-duplicated them serves; a null-safe join would shuffle them again."""
    whole = reduce(and_, [F.col(k).isNotNull() for k in keys])
    held = held.select(*keys)
    new = rows.filter(whole).join(held.filter(whole), keys, "left_anti").select(*rows.columns)
    return new.union(by_keys(rows.filter(~whole), held.filter(~whole), keys, "left_anti"))


def _changed(rows: DataFrame, columns: list[str], change) -> DataFrame:
    return rows.withColumns({c: change(F.col(c)) for c in columns})


def append_new(spark: SparkSession, batch: DataFrame, batch_id: int, source: str, out: str, hashes: str, scope: str = "all",
               time_col: str = "_ingest_ts", watermark_days: int | None = None, partition_by=()) -> None:
    """Append the rows of a micro-batch that nothing before it had to ``out/batch_id=N``.

    The rows are written before their hashes: a retry finds the hashes missing
    and writes the folder again, or finds them and has nothing left to do.
    Under scope ``watermark`` a row older than the newest one so far less
    ``watermark_days`` is neither compared nor lost: it goes to ``<out>_late``,
    and hashes as old as that leave the table when it is compacted."""
    keys = hash_keys(scope)
    known = MergeTable(spark, hashes, "scd1", keys, time_col, buckets=int(spark.conf.get("spark.sql.shuffle.partitions")))
    if known.holds(batch_id, source):
        return
    if scope == "watermark" and watermark_days is None:
        raise ValueError("scope 'watermark' needs watermark_days")
    folder, oldest = f"{out}/{BATCH_ID}={batch_id}", None
    with known.held() as held:
        rows = dedupe_content(_changed(batch, keys, packed), scope)
        if scope == "watermark":
            newest = held.agg(F.max(time_col)).first()[0] if held is not None else None
            if newest is not None:
                oldest = F.lit(newest) - F.expr(f"INTERVAL {int(watermark_days)} DAYS")
                late = rows.filter(F.col(time_col) < oldest)
                _changed(late, keys, unpacked).write.mode("overwrite").parquet(f"{out}_late/{BATCH_ID}={batch_id}")
                rows = rows.filter(F.col(time_col).isNull() | (F.col(time_col) >= oldest))
                held = held.filter(F.col(time_col) >= oldest)
        if held is not None:
            rows = unknown(rows, held, keys)
        rows = _changed(rows, keys, unpacked)
        writer = rows.write.mode("overwrite").option("compression", "zstd")     # hex digits at half their length
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(folder)
    added = spark.read.schema(rows.schema).parquet(folder).select(*dict.fromkeys([*keys, time_col]))
    dealt = not partition_by and int(batch.sparkSession.conf.get("spark.sql.shuffle.partitions")) == known.buckets
    known.merge(added, batch_id, source, keep=None if oldest is None else F.col(time_col) >= oldest, dealt=dealt)


def late_rows(spark: SparkSession, out: str) -> DataFrame | None:
    """What scope ``watermark`` set aside, with the batch it came in; None if nothing was."""
    at = f"{out}_late"
    return spark.read.parquet(at) if table_exists(spark, at) else None
