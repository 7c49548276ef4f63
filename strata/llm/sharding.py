"""Sharding by a two-pass external shuffle.

Pass one scatters whole records uniformly into memory-sized buckets by a seeded
hash. Pass two shuffles each bucket by Fisher-Yates (Spark's ``shuffle`` of an
array) and deals the joined order into shards, counts at most one apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import clean_text, scalar, table

BUCKET_BYTES = 16 << 20
#: Bound of the bucket table, which is broadcast: one (bucket, offset) row each, 24 MB at most.
MOST_BUCKETS = 1 << 20


def external_shuffle(df: DataFrame, key: list, size, shards: int, seed: int = 7,
                     bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """All rows of ``df`` with ``shard`` and ``slot``: a seeded random order dealt into ``shards``.

    ``key``: columns that name a record, nulls allowed; ``size``: its bytes.
    Records are scattered by a hash of the key, so rows that share the whole key
    share a bucket. ``slot`` counts from 0 without gaps in each shard, and shard
    sizes differ by one row at most. Input columns called ``shard`` or ``slot``
    are replaced. An empty table gives an empty result. The same rows, seed and
    bucket size give the same order.
    """
    total, n = scalar(df, F.sum(size), F.count("*"))
    buckets = max(1, min(MOST_BUCKETS, -(-(total or 0) // bucket_bytes)))
    h = F.xxhash64(F.lit(seed), *key)
    keep = [F.col(f"`{c}`") for c in df.columns if c.lower() not in ("shard", "slot")]
    rows = df.select(F.pmod(h, F.lit(buckets)).alias("_bucket"), h.alias("_h"), F.struct(*keep).alias("_row"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = df.select(F.pmod(h, F.lit(buckets)).alias("_bucket")).groupBy("_bucket").count()
    offsets = counts.select("_bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_offset"))
    shuffled = (rows.repartition(buckets, "_bucket").sortWithinPartitions("_bucket", "_h")
                .groupBy("_bucket").agg(F.shuffle(F.collect_list("_row"), seed).alias("_rows")))
    n = max(1, n)
    at = shuffled.join(F.broadcast(offsets), "_bucket").select("_offset", F.posexplode("_rows").alias("_i", "_row"))
    at = at.select("_row", (F.col("_offset") + F.col("_i")).alias("_at"))
    shard = F.expr(f"_at * {shards} div {n}")
    first = F.expr(f"((_at * {shards} div {n}) * {n} + {shards - 1}) div {shards}")
    return at.select("_row.*", shard.cast("int").alias("shard"), (F.col("_at") - first).alias("slot"))


def write_shards(shuffled: DataFrame, path: str) -> None:
    """One folder per shard; rows of a bucket stay in slot order within a file."""
    shuffled.write.partitionBy("shard").parquet(path)


def op4_external_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 8 shards, law ``rows``. A null text has no bytes and the CRC of the empty text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    size = F.octet_length(clean_text()).cast("long") + 1
    out = external_shuffle(docs, ["doc_id", F.xxhash64("text")], size, shards=8)
    return out.select("doc_id", size.alias("size"), F.crc32(clean_text().cast("binary")).alias("text_crc32"),
                      F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
