"""What streams and replays move: as many micro-batches for any size, no shuffle that another already did."""

from functools import reduce

import pytest
from pyspark.sql import functions as F

from strata.functions.normalize import packed, unpacked
from strata.operators import quality
from strata.operators.dedupe import dedupe_content
from strata.plans import specs, stream_queries
from strata.streaming import dedupe
from strata.streaming.dedupe import unknown
from strata.streaming.merge_table import MergeTable

SF_SMALL = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_new_rows_of_a_batch_are_shuffled_once(spark):
    batch = spark.createDataFrame([("a", 1), ("b", 2), ("b", 2), (None, 3), (None, 4)], "_record_hash string, v long")
    for held, want in (([("a",), ("x",)], {"b", None}), ([("b",), (None,)], {"a"}), ([(None,), (None,)], {"a", "b"})):
        rows = dedupe_content(batch, "all")
        new = unknown(rows, spark.createDataFrame(held, "_record_hash string"), ["_record_hash"])
        assert new.columns == batch.columns
        got = [r["_record_hash"] for r in new.collect()]
        assert set(got) == want and len(got) == len(want)
    held = spark.createDataFrame([("a", "f")], "_record_hash string, _source_file string")
    two = spark.createDataFrame([("a", "f"), ("a", None), (None, "f")], "_record_hash string, _source_file string")
    assert unknown(two, held, ["_record_hash", "_source_file"]).count() == 2


def test_a_delta_is_written_without_a_shuffle(spark, scratch, monkeypatch):
    plans = []
    write = MergeTable._write
    monkeypatch.setattr(MergeTable, "_write", staticmethod(lambda rows, path: (plans.append((path, plan(rows))), write(rows, path))))
    rows = spark.createDataFrame([(1, 1), (1, 2), (2, 5)], "k long, s long")
    t = MergeTable(spark, f"{scratch}/t", "scd1", ["k"], "s")
    t.merge(rows, 0, "x")
    assert not any("Exchange" in p for at, p in plans if "/deltas/" in at) and plans
    assert sorted(map(tuple, t.read().collect())) == [(1, 2), (2, 5)]
    t.compact()
    assert sorted(map(tuple, t.read().collect())) == [(1, 2), (2, 5)]


def test_micro_batches_do_not_grow_with_the_table(spark, monkeypatch):
    for rows in (20, 100, 500):
        monkeypatch.setattr(stream_queries, "ROWS_PER_FILE", rows)
        _, drops, trigger = stream_queries._drops(spark, SF_SMALL, "lineitem", ["l_orderkey"], copies=2, trigger=2)
        files = len(spark.read.option("recursiveFileLookup", "true").parquet(drops).inputFiles())
        assert files / trigger <= stream_queries.MOST_BATCHES and trigger >= 2
        want = 2 * spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()
        assert spark.read.option("recursiveFileLookup", "true").parquet(drops).count() == want


def test_a_later_replay_is_one_pass(spark):
    rows = [(f"h{i}", quality.LATE_REASON if i % 3 else "other", i) for i in range(12)] + [(None, quality.LATE_REASON, 99)]
    q = spark.createDataFrame(rows, f"_record_hash string, {quality.REASON_COL} string, v long")
    log = spark.createDataFrame([("h1", "r1"), ("h1", "r0"), ("h2", None), ("h3", "r1"), ("h4", "r1")], "_record_hash string, _replay_id string")
    both = quality.carry_replayed(q, log).unionByName(quality.replay_late(q, specs.LATER_REPLAY, log))
    got = quality.replay_again(q, specs.LATER_REPLAY, log)
    assert set(got.columns) == set(both.columns)
    assert sorted(map(str, got.select(*both.columns).collect())) == sorted(map(str, both.collect()))


def test_packed_text_is_one_to_one(spark):
    digest = "0123456789abcdef" * 4
    texts = [None, "", "a", "\0", digest, digest.upper(), digest + "\n", digest[:63], "0" * 32, "x" * 64, "é" * 16]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", packed(F.col("t")).alias("p"))
    got = df.select("t", "p", unpacked(F.col("p")).alias("u")).collect()
    assert [r["u"] for r in got] == texts and len({bytes(r["p"]) for r in got}) == len(texts)
    assert not df.schema["p"].nullable and {len(r["p"]) for r in got if r["t"] == digest} == {32}


def hashed(spark, *ranges):
    text = F.when(F.col("id") % 50 != 0, F.sha2(F.col("id").cast("string"), 256)).when(F.col("id") % 100 == 0, F.concat(F.lit("h"), "id"))
    rows = [spark.range(a, b).select(text.alias("_record_hash"), F.col("id").alias("v")) for a, b in ranges]
    return reduce(lambda x, y: x.union(y), rows)


@pytest.mark.parametrize("name", ["plain", "quo'te"])
def test_the_hash_table_is_not_shuffled(spark, scratch, monkeypatch, name):
    plans, root = [], f"{scratch}/{name}"
    monkeypatch.setattr(dedupe, "unknown", lambda r, h, k: (new := unknown(r, h, k), plans.append(plan(new)))[0])
    for n, ranges in enumerate([[(0, 600), (300, 700)], [(500, 1200)], [(0, 1500)], [(0, 1500)]]):
        dedupe.append_new(spark, hashed(spark, *ranges), n, "s", f"{root}/out", f"{root}/hashes", time_col="_record_hash")
    got = spark.read.parquet(f"{root}/out")
    want = {r[0] for r in hashed(spark, (0, 1500)).select("_record_hash").collect()}
    assert sorted(map(str, (r["_record_hash"] for r in got.collect()))) == sorted(map(str, want)) and None in want
    assert len(plans) == 3 and all(p.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in p for p in plans)
    held = MergeTable(spark, f"{root}/hashes")
    assert {r[0] for r in held.rows().collect()} == want and held.rows().count() == len(want)
    files = spark.read.parquet(f"{root}/hashes/deltas").inputFiles()
    assert len(files) <= 3 * held.buckets      # stored as they lay, a file a bucket
    held.compact()
    assert {r[0] for r in held.rows().collect()} == want
    dedupe.append_new(spark, hashed(spark, (0, 1502)), 4, "s", f"{root}/out", f"{root}/hashes", time_col="_record_hash")
    assert [r["v"] for r in spark.read.parquet(f"{root}/out").where("batch_id = 4").orderBy("v").collect()] == [1500, 1501]
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("strata_merge_")]


def test_scope_file_and_other_partition_counts(spark, scratch):
    rows = [("a" * 64, "f1", 1), ("a" * 64, "f1", 2), ("a" * 64, "f2", 3), ("a" * 64, None, 4), (None, "f1", 5), ("b", "f1", 6)]
    df = spark.createDataFrame(rows, "_record_hash string, _source_file string, v long").withColumn("_ingest_ts", F.timestamp_seconds("v"))
    now, want = spark.conf.get("spark.sql.shuffle.partitions"), {r[:2] for r in rows}
    for n, parts in enumerate((now, "3", "13")):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            dedupe.append_new(spark, df, n, "s", f"{scratch}/out", f"{scratch}/hashes", "file", partition_by=["_ingest_ts"] if n else ())
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", now)
    got = [tuple(r) for r in spark.read.parquet(f"{scratch}/out/batch_id=0").select("_record_hash", "_source_file").collect()]
    assert set(got) == want and len(got) == len(want)
    assert MergeTable(spark, f"{scratch}/hashes").rows().count() == len(want)


def test_a_hash_table_without_rows(spark, scratch):
    def append(n, rows):
        dedupe.append_new(spark, rows, n, "s", f"{scratch}/out", f"{scratch}/hashes", time_col="v")
    held = lambda: MergeTable(spark, f"{scratch}/hashes")
    for n in range(2):
        append(n, hashed(spark, (5, 5)))
    assert held().rows() is None
    held().compact()
    assert held().rows() is None and held().holds(1, "s")
    append(2, hashed(spark, (5, 9)))
    append(3, hashed(spark, (5, 9)))
    held().compact()
    append(4, hashed(spark, (5, 10)))
    assert held().rows().count() == 5 == held().read().count() == spark.read.parquet(f"{scratch}/out").count()


def test_a_table_made_without_buckets_is_used_as_it_is(spark, scratch):
    old = MergeTable(spark, f"{scratch}/hashes", "scd1", ["_record_hash"], "v")
    old.merge(hashed(spark, (0, 100)), 0, "s")
    dedupe.append_new(spark, hashed(spark, (50, 201)), 1, "s", f"{scratch}/out", f"{scratch}/hashes", time_col="v")
    want = {r[0] for r in hashed(spark, (100, 201)).collect()} - {r[0] for r in hashed(spark, (0, 100)).collect()}
    assert {r["_record_hash"] for r in spark.read.parquet(f"{scratch}/out").collect()} == want
    assert not MergeTable(spark, f"{scratch}/hashes").buckets
