"""Queries over CSV drops that Spark writes from the benchmark tables.

``customer`` is landed as CSV files in two header layouts: most segments with
four columns, two segments with the columns reordered and one more column.
Each query writes its own drops under the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import drift
from strata.plans import specs
from strata.session import scratch_path
from strata.sources.csv_drops import observed_headers, read_drops
from strata.sources.tables import read_table

# Fixed layout of the two drop kinds.
WIDE_SEGMENTS = ("BUILDING", "MACHINERY")
NARROW_COLUMNS = ("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
WIDE_COLUMNS = ("c_acctbal", "c_nationkey", "c_name", "c_custkey", "c_mktsegment")


# Fixed layouts of the order drops: dirty headers, each without some required column and with one of its own.
ORDER_LAYOUTS = (
    ("F", {"o_orderkey": " O OrderKey", "o_custkey": "O-CustKey", "o_totalprice": "O TotalPrice(EUR)",
           "o_orderstatus": "O OrderStatus"}),
    ("", {"o_orderkey": "o_orderkey", "o_custkey": "O_CUSTKEY", "o_orderdate": "O  OrderDate",
          "o_totalprice": "o_totalprice", "o_orderpriority": "O_OrderPriority"}),
)
SHORT_NATION, BROKEN_EVERY, RAW_BUCKETS = 7, 5, 8


def order_drops(spark: SparkSession, root: str) -> str:
    """Orders as CSV files in two layouts, finished orders in the first."""
    base = scratch_path(spark, "csv-orders")
    o = read_table(spark, root, "orders")
    for i, (status, names) in enumerate(ORDER_LAYOUTS):
        rows = o.filter(F.col("o_orderstatus") == "F" if status else ~F.col("o_orderstatus").eqNullSafe(F.lit("F")))
        rows.select(*[F.col(c).alias(n) for c, n in names.items()]).write.option("header", "true").csv(f"{base}/{i}")
    return base


def raw_customer_drops(spark: SparkSession, root: str) -> str:
    """Customers as hand-made CSV text: names with quotes and line breaks, and rows that end early."""
    base = scratch_path(spark, "csv-raw")
    c = read_table(spark, root, "customer")
    name = F.when(F.col("c_custkey") % BROKEN_EVERY == 0,
                  F.concat(F.lit('"'), F.col("c_name"), F.lit(' ""the second""\nof, two lines"'))).otherwise(F.col("c_name"))
    key, segment = F.col("c_custkey").cast("string"), F.col("c_mktsegment")
    line = F.when(F.col("c_nationkey") == SHORT_NATION, F.concat_ws(",", key, name)).otherwise(
        F.concat_ws(",", key, name, segment))
    bucket = F.pmod(F.xxhash64("c_custkey"), F.lit(RAW_BUCKETS)).alias("bucket")
    rows = c.select(bucket, F.lit(1).alias("kind"), line.alias("value"))
    heads = spark.range(RAW_BUCKETS).select(F.col("id").alias("bucket"), F.lit(0).alias("kind"),
                                            F.lit("C CustKey,C Name,C MktSegment").alias("value"))
    (rows.unionByName(heads).repartition(RAW_BUCKETS, "bucket").sortWithinPartitions("bucket", "kind")
     .select("bucket", "value").write.partitionBy("bucket").option("compression", "none").text(base))
    return base


def customer_drops(spark: SparkSession, root: str) -> str:
    base = scratch_path(spark, "csv-customer")
    c = read_table(spark, root, "customer")
    wide = F.col("c_mktsegment").isin(*WIDE_SEGMENTS)
    c.filter(~wide).select(*NARROW_COLUMNS).write.option("header", "true").csv(f"{base}/narrow")
    c.filter(wide).select(*WIDE_COLUMNS).write.option("header", "true").csv(f"{base}/wide")
    return base


def q_csv_ingest(spark: SparkSession, root: str) -> DataFrame:
    """Both layouts read back with header-aware rescue: every value lands
    under its own column name, the extra column in ``_rescued_data``."""
    declared = list(NARROW_COLUMNS)
    out = read_drops(spark, customer_drops(spark, root), declared=declared)
    return out.select(*declared, "_rescued_data", "_corrupt_record")


def q_schema_drift_files(spark: SparkSession, root: str) -> DataFrame:
    """M1/X9 per source file: each drop file's header against the required and
    known columns, reported once per distinct finding."""
    obs = observed_headers(spark, customer_drops(spark, root)).select(
        F.lit("customer").alias("dataset"), F.lit("bronze").alias("layer"),
        F.lit("manual_run").alias("ingest_run_id"), F.col("cols").alias("actual_cols"),
        F.array(*[F.lit(c) for c in specs.CUSTOMER.required_columns]).alias("required_cols"),
        F.array(*[F.lit(c) for c in specs.CUSTOMER.known_columns]).cast("array<string>").alias("known_cols"))
    d = drift.schema_drift(obs)
    return d.select("dataset", "layer", "ingest_run_id",
                    *[F.array_join(c, ",").alias(c) for c in
                      ("actual_cols", "required_cols", "missing_required_cols", "unexpected_cols")],
                    "is_breaking_drift").distinct()


def q_schema_drift(spark: SparkSession, root: str) -> DataFrame:
    """Order drops with dirty headers; per distinct finding the required columns
    that are missing and the columns nobody expects."""
    obs = observed_headers(spark, order_drops(spark, root)).select(
        F.lit("orders").alias("dataset"), F.lit("bronze").alias("layer"),
        F.lit("manual_run").alias("ingest_run_id"), F.col("cols").alias("actual_cols"),
        F.array(*[F.lit(c) for c in specs.ORDERS.required_columns]).alias("required_cols"),
        F.array(*[F.lit(c) for c in specs.ORDERS.known_columns]).cast("array<string>").alias("known_cols"))
    return drift.schema_drift(obs).select(
        "dataset", "layer", "ingest_run_id",
        *[F.array_join(c, ",").alias(c) for c in
          ("actual_cols", "required_cols", "missing_required_cols", "unexpected_cols")],
        "is_breaking_drift").distinct()


def q_csv_malformed(spark: SparkSession, root: str) -> DataFrame:
    """Quoted line breaks read as one row, short rows kept whole in
    ``_corrupt_record``, and every row knows its file."""
    return _raw_rows(spark, root)


def q_csv_split(spark: SparkSession, root: str) -> DataFrame:
    """The same drops by byte ranges, as large files are read: records are cut where
    the state of the quotes before each range says."""
    return _raw_rows(spark, root, split_above=0)


def _raw_rows(spark: SparkSession, root: str, **how) -> DataFrame:
    declared = ["c_custkey", "c_name", "c_mktsegment"]
    rows = read_drops(spark, raw_customer_drops(spark, root), declared=declared, glob="*.txt", **how)
    bucket = F.regexp_extract("_source_file", "bucket=(\\d+)", 1)
    own = F.pmod(F.xxhash64(F.col("c_custkey").cast("bigint")), F.lit(RAW_BUCKETS)).cast("string")
    return rows.select(*declared, F.col("_corrupt_record").isNotNull().alias("is_corrupt"),
                       (bucket == own).alias("own_file"), (F.col("_source_file_size") > 0).alias("has_size"),
                       F.col("_source_file_mod_ts").isNotNull().alias("has_time"))


def q_bronze_append(spark: SparkSession, root: str) -> DataFrame:
    """Bronze grows by new files only; rows keep the day that first saw them."""
    from strata.plans.layers import ingest
    from strata.spec import Settings
    base, table = scratch_path(spark, "append-drops"), scratch_path(spark, "append-bronze")
    c = read_table(spark, root, "customer")
    wide = F.col("c_mktsegment").isin(*WIDE_SEGMENTS)
    first, second = Settings(now="2024-01-05 00:00:00"), Settings(now="2024-02-05 00:00:00")
    c.filter(~wide).select(*NARROW_COLUMNS).write.option("header", "true").csv(f"{base}/narrow")
    ingest(spark, base, specs.CUSTOMER, first, table)
    c.filter(wide).select(*WIDE_COLUMNS).write.option("header", "true").csv(f"{base}/wide")
    ingest(spark, base, specs.CUSTOMER, second, table)
    rows = ingest(spark, base, specs.CUSTOMER, second, table)
    return rows.select("c_custkey", "_dataset", F.col("_ingest_yyyymmdd").cast("int").alias("_ingest_yyyymmdd"))


DROP_QUERIES = {
    "schema_drift": q_schema_drift,
    "csv_malformed": q_csv_malformed,
    "csv_split": q_csv_split,
    "bronze_append": q_bronze_append,
    "csv_ingest": q_csv_ingest,
    "schema_drift_files": q_schema_drift_files,
}
