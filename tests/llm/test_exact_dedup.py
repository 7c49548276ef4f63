import hashlib

import pytest
from pyspark.sql import functions as F

from strata.llm.exact_dedup import DigestIndex, digests, exact_dedup
from tests.llm.data import awkward, frame


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[1] or "", []).append(r[0])
    out = []
    for r in rows:
        ids = groups[r[1] or ""]
        keep = max((i for i in ids if i is not None), default=None)
        out.append((r[0], keep, len(ids), r[0] == keep, hashlib.sha256((r[1] or "").encode()).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=repr)


def test_one_load_equals_brute_force(spark, scratch):
    rows = awkward()
    index = DigestIndex(spark, scratch, 4)
    assert got(exact_dedup([digests(frame(spark, rows))], index)) == brute(rows)


def test_later_loads_lose_to_earlier_and_reloading_admits_nothing(spark, scratch):
    df = digests(frame(spark, awkward()))
    index = DigestIndex(spark, scratch, 4)
    first = index.admit(df.where("doc_id <= 5")).count()
    assert index.admit(df.where("doc_id <= 5")).count() == 0
    rest = index.admit(df)
    assert first + rest.count() == index.rows().count() == df.select("digest").distinct().count()
    # another session opens the folder and finds the same rows
    again = DigestIndex(spark, scratch, 4)
    assert again.rows().where(F.col("keep_id") == 2).count() == 1    # the larger of 1 and 2, not the later null


def test_index_join_moves_only_the_new_side(spark, scratch):
    index = DigestIndex(spark, scratch, 4)
    index.admit(digests(frame(spark, awkward())))
    new = digests(frame(spark, awkward())).groupBy("digest").agg(F.max("doc_id"))
    plan = new.hint("merge").join(index.rows(), "digest", "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" in plan


def test_empty_table(spark, scratch):
    assert exact_dedup([digests(frame(spark, []))], DigestIndex(spark, scratch, 4)).count() == 0


def test_an_index_is_opened_by_what_it_is(spark, scratch):
    ids = spark.range(100).select(F.col("id").alias("doc_id"), F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("digest"))
    index = DigestIndex(spark, scratch, 4)
    assert index.admit(ids).count() == 100
    index.close()                                         # a later session knows nothing of the table
    again = DigestIndex(spark, scratch, 8)
    assert again.buckets == 4 and again.admit(ids).count() == 0 and again.rows().count() == 100
    more = again.rebucketed(scratch + "_more", 8)
    assert more.buckets == 8 and more.admit(ids).count() == 0 and more.rows().count() == 100
    spark.createDataFrame([(9, 4)], "format int, buckets int").write.mode("overwrite").parquet(scratch + "_meta")
    with pytest.raises(ValueError):
        DigestIndex(spark, scratch, 4)
    ids.write.parquet(scratch + "_files")
    with pytest.raises(ValueError):
        DigestIndex(spark, scratch + "_files", 4)


def test_the_query_leaves_no_table_behind(spark):
    from strata.llm.exact_dedup import op3_exact_dedup
    before = {t.name for t in spark.catalog.listTables()}
    assert op3_exact_dedup(spark, "/root/testdata/sf0.001").count() == 200
    assert {t.name for t in spark.catalog.listTables()} <= before
