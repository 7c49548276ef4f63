"""Reading pipeline tables (parquet)."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import table_path


def read_table(spark: SparkSession, root: str, name: str, columns=None) -> DataFrame:
    """Batch read of ``root/name.parquet``; selecting ``columns`` here lets the
    scan read only those columns."""
    df = spark.read.parquet(table_path(root, name))
    return df.select(*columns) if columns else df


def as_strings(df: DataFrame, date_columns=(), keep=()) -> DataFrame:
    """All-string (bronze) view of a typed table: dates rendered ``yyyy-MM-dd``."""
    cols = []
    for c in df.columns:
        if c in keep:
            cols.append(F.col(c))
        elif c in date_columns:
            cols.append(F.date_format(F.col(c), "yyyy-MM-dd").alias(c))
        else:
            cols.append(F.col(c).cast("string").alias(c))
    return df.select(*cols)


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a parquet table with at least one file is at ``path``."""
    try:
        return bool(spark.read.parquet(path).columns)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise


def read_partitions(spark: SparkSession, path: str, column: str, values) -> DataFrame:
    """Rows of the given partitions only: the filter on the partition column is
    applied while listing files (``PartitionFilters``), other partitions are
    never opened. Used to read one ingest run or day of bronze."""
    return spark.read.parquet(path).filter(F.col(column).isin(list(values)))
