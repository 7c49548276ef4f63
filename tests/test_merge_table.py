"""Merge tables (C1, C2): batches in any order, retries, failures at every step, several sources, new columns."""

import os

import pytest
from pyspark.sql import functions as F

import fixtures as fx
from strata.operators import scd
from strata.streaming import merge_table as mt
from strata.streaming.merge_table import MergeTable, read_merged


def rows_of(spark):
    return spark.range(200).select((F.col("id") % 40).alias("k"), F.col("id").alias("s"), (F.col("id") * 7 % 11).alias("v"))


def batches_of(rows):
    """Out of order: the last batch is the oldest."""
    return [rows.filter("s >= 120"), rows.filter("s BETWEEN 60 AND 119 AND k < 30"), rows.filter("s BETWEEN 60 AND 119 AND k >= 30"),
            rows.filter("s < 60")]


def wanted(rows, kind):
    return scd.scd1(rows, ["k"], "s") if kind == "scd1" else scd.scd2(rows, ["k"], "s", ["v"])


def made(spark, path, kind):
    return MergeTable(spark, path, kind, ["k"], "s", track=["v"])


def same(got, want):
    return sorted(map(tuple, got.select(*want.columns).collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def files(path):
    return sorted(os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.startswith("part-"))


@pytest.mark.parametrize("kind", ["scd1", "scd2"])
def test_batches_equal_one_load_whenever_compacted(spark, scratch, kind):
    path, rows = fx.local(scratch), rows_of(spark)
    table, so_far = made(spark, path, kind), None
    for i, batch in enumerate(batches_of(rows)):
        table.merge(batch, i, "a")
        so_far = batch if so_far is None else so_far.unionByName(batch)
        assert same(read_merged(spark, path), wanted(so_far, kind))
        if i in (1, 2):
            table.compact()
            assert same(read_merged(spark, path), wanted(so_far, kind))
    table.merge(batches_of(rows)[0], 0, "a")       # a batch that the base holds
    table.merge(batches_of(rows)[3], 3, "a")       # and one that is a delta still
    assert same(read_merged(spark, path), wanted(rows, kind))


@pytest.mark.parametrize("step", ["_write", "_commit", "_clear"])
@pytest.mark.parametrize("kind", ["scd1", "scd2"])
def test_a_stop_at_any_step_loses_nothing(spark, scratch, monkeypatch, kind, step):
    path, rows = fx.local(scratch), rows_of(spark)
    table = made(spark, path, kind)
    monkeypatch.setattr(mt, "MOST_DELTAS", 1)       # every batch is compacted
    for i, batch in enumerate(batches_of(rows)):
        if i:
            with monkeypatch.context() as m:
                m.setattr(MergeTable, step, lambda *a: (_ for _ in ()).throw(RuntimeError("stopped")))
                with pytest.raises(RuntimeError):
                    table.merge(batch, i, "a")
        again = MergeTable(spark, path)             # another session
        again.merge(batch, i, "a")
        if step == "_clear" and i:
            again.compact()
    assert same(read_merged(spark, path), wanted(rows, kind))


def test_an_unfinished_batch_is_not_read(spark, scratch):
    path, rows = fx.local(scratch), rows_of(spark)
    table = made(spark, path, "scd1")
    table.merge(rows.filter("s < 100"), 0, "a")
    table.merge(rows.filter("s >= 100"), 1, "a")
    (folder,) = [at for _, batch, at in table._delta_folders() if batch == 1]
    os.remove(fx.local(folder) + "/_SUCCESS")
    assert same(read_merged(spark, path), wanted(rows.filter("s < 100"), "scd1"))
    table.merge(rows.filter("s >= 100"), 1, "a")
    assert same(read_merged(spark, path), wanted(rows, "scd1"))


def test_two_sources_keep_both_and_ids_are_required(spark, scratch):
    from strata.streaming.runner import merge_batch
    path, rows = fx.local(scratch), rows_of(spark)
    merge_batch(spark, rows.filter("k < 20"), path, ["k"], "scd1", "s", batch_id=0, source="one")
    merge_batch(spark, rows.filter("k >= 20"), path, ["k"], "scd1", "s", batch_id=0, source="two")
    assert same(read_merged(spark, path), wanted(rows, "scd1"))
    with pytest.raises(TypeError):
        merge_batch(spark, rows, path, ["k"], "scd1", "s")
    with pytest.raises(ValueError):
        MergeTable(spark, path, "scd1", ["v"], "s")     # not the table that is there
    with pytest.raises(ValueError):
        MergeTable(spark, path + "/none")


def test_a_batch_writes_itself_and_folders_stay_few(spark, scratch, monkeypatch):
    path, rows = fx.local(scratch), rows_of(spark)
    table = made(spark, path, "scd2")
    table.merge(rows.filter("s < 150"), 0, "a")
    table.compact()
    before = files(path)
    table.merge(rows.filter("s = 150"), 1, "a")
    new = set(files(path)) - set(before)
    assert set(before) <= set(files(path)) and new and all("_batch=1" in f for f in new)
    monkeypatch.setattr(mt, "MOST_DELTAS", 3)
    for i in range(2, 9):
        table.merge(rows.filter(f"s = {149 + i}"), i, "a")
        assert len(table._delta_folders()) <= 6 and len(table._versions_of("base")) <= 2
    assert same(read_merged(spark, path), wanted(rows.filter("s < 158"), "scd2"))


@pytest.mark.parametrize("kind", ["scd1", "scd2"])
def test_a_column_that_comes_later(spark, scratch, kind):   # P12, M1
    path, rows = fx.local(scratch), rows_of(spark)
    table = made(spark, path, kind)
    table.merge(rows.filter("s < 100"), 0, "a")
    table.compact()
    table.merge(rows.filter("s >= 100 AND k < 20").withColumn("tip", F.col("s") * 2), 1, "a")
    got = {(r["k"], r["s"]): r["tip"] for r in read_merged(spark, path).collect()}
    assert {t for (k, s), t in got.items() if s >= 100} == {2 * s for k, s in got if s >= 100}
    assert all(t is None for (k, s), t in got.items() if s < 100)


def test_null_keys_and_empty_batches(spark, scratch):
    path = fx.local(scratch)
    table = MergeTable(spark, path, "scd2", ["k"], "s", track=["v"])
    rows = spark.createDataFrame([(None, 1, "a"), (None, 2, "b"), (1, 1, "a"), (1, 2, "a")], "k long, s long, v string")
    with pytest.raises(ValueError):
        table.read()
    table.merge(rows.filter("s > 5"), 0, "a")
    table.merge(rows.filter("s = 2"), 1, "a")
    table.compact()
    table.merge(rows.filter("s = 1"), 2, "a")
    assert same(read_merged(spark, path), scd.scd2(rows, ["k"], "s", ["v"]))
