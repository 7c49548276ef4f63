"""Physical-plan properties: one scan, broadcast only where bounded,
no Python on query paths, pruned reads, map-side partial aggregation."""

import contextlib
import io
import re

import pytest

from strata.plans.queries import QUERIES
from tests.conftest import SF_SMALL


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def test_type_drift_scans_orders_once(spark):
    p = plan(QUERIES["type_drift"](spark, SF_SMALL))
    assert p.split("\n\n")[0].count("Scan parquet") == 1


def test_calendar_join_is_broadcast(spark):
    p = plan(QUERIES["fact_current"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in p and "BroadcastExchange" in p


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_in_query_plans(spark, name):
    p = plan(QUERIES[name](spark, SF_SMALL))
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas"):
        assert node not in p, node


def test_late_flag_reads_only_needed_columns(spark):
    p = plan(QUERIES["late_flag"](spark, SF_SMALL))
    schemas = re.findall(r"ReadSchema: (struct<[^\n]*>)", p)
    lineitem = [s for s in schemas if "l_orderkey" in s][0]
    assert "l_tax" not in lineitem and "l_returnflag" not in lineitem


def test_type1_and_dedupe_aggregate_map_side(spark):
    assert "partial_max(" in plan(QUERIES["scd1_latest"](spark, SF_SMALL))
    p = plan(QUERIES["content_dedupe"](spark, SF_SMALL))
    assert p.count("HashAggregate") >= 2   # partial + final around one exchange


def test_backfill_window_pushed_to_scan(spark):
    p = plan(QUERIES["backfill_window"](spark, SF_SMALL))
    assert "PushedFilters" in p and "o_orderdate" in p.split("PushedFilters")[1].split("\n")[0]


def test_partition_pruning_on_bronze_day(spark, scratch):
    from pyspark.sql import functions as F

    from strata.sources.tables import read_partitions
    df = spark.range(100).withColumn("_ingest_yyyymmdd", (F.col("id") % 3 + 20240101).cast("int"))
    df.write.partitionBy("_ingest_yyyymmdd").parquet(scratch)
    part = read_partitions(spark, scratch, "_ingest_yyyymmdd", [20240102])
    p = plan(part)
    assert "PartitionFilters: [isnotnull(_ingest_yyyymmdd" in p and "20240102" in p
    assert part.count() == 33
