import collections

from pyspark.sql import functions as F

from strata.llm.sharding import external_shuffle, write_shards
from tests.llm.data import awkward, frame


def size():
    return F.octet_length(F.coalesce("text", F.lit(""))) + 1


def test_every_row_once_and_shards_even(spark):
    rows = awkward()
    out = external_shuffle(frame(spark, rows), ["doc_id", "text"], size(), 8, bucket_bytes=5000)
    got = out.collect()
    assert sorted((repr((r["doc_id"], r["text"], r["lang"], r["_key"])) for r in got)) == sorted(
        repr((r[0], r[1], r[2], r[9])) for r in rows)
    by = collections.defaultdict(list)
    for r in got:
        by[r["shard"]].append(r["slot"])
    sizes = [len(by[s]) for s in range(8)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    assert "size" in out.columns and out.columns.count("shard") == 1


def test_same_seed_same_order_and_other_seed_other_order(spark):
    ids = spark.range(500).select(F.col("id").alias("doc_id"))

    def order(seed):
        out = external_shuffle(ids, ["doc_id"], F.lit(100), 4, seed=seed, bucket_bytes=5000)
        return [r["doc_id"] for r in out.orderBy("shard", "slot").collect()]

    assert order(1) == order(1) != order(2)
    assert sorted(order(1)) == list(range(500)) != order(1)


def test_positions_are_uniform(spark):
    ids = spark.range(4000).select(F.col("id").alias("doc_id"))
    out = external_shuffle(ids, ["doc_id"], F.lit(100), 4, bucket_bytes=20_000)
    counts = {(r["q"], r["shard"]): r["n"] for r in out.groupBy(F.expr("doc_id div 1000").alias("q"), "shard")
              .agg(F.count("*").alias("n")).collect()}
    chi = sum((counts.get((q, s), 0) - 250) ** 2 / 250 for q in range(4) for s in range(4))
    assert chi < 30    # 9 degrees of freedom


def test_written_shards_and_empty_table(spark, scratch):
    out = external_shuffle(frame(spark, awkward()), ["doc_id", "text"], size(), 3)
    write_shards(out, scratch)
    assert spark.read.parquet(scratch).groupBy("shard").count().count() == 3
    assert external_shuffle(frame(spark, []), ["doc_id"], size(), 3).count() == 0
