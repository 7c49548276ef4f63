"""Table sinks: overwrite, partitioned append."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by=None,
                max_records_per_file: int | None = None) -> str:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", str(max_records_per_file))
    w.parquet(path)
    return path


def overwrite_partitions(df: DataFrame, path: str, partition_by) -> str:
    """Replace only the partitions present in ``df`` (dynamic overwrite)."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(*partition_by).parquet(path))
    return path


def _folder(spark: SparkSession, path: str):
    """(file system, path) of whatever store Spark finds ``path`` in."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def remove_folder(spark: SparkSession, path: str) -> None:
    fs, at = _folder(spark, path)
    fs.delete(at, True)


def subfolders(spark: SparkSession, path: str, finished: bool = False) -> list[str]:
    """Folders directly under ``path`` (``finished``: those whose writer left its ``_SUCCESS``), none if it isn't there."""
    fs, at = _folder(spark, path)
    found = [f.getPath() for f in fs.listStatus(at) if f.isDirectory()] if fs.exists(at) else []
    return [str(f.toString()) for f in found if not finished or fs.exists(_folder(spark, f"{f.toString()}/_SUCCESS")[1])]


def folder_bytes(spark: SparkSession, path: str) -> int:
    fs, at = _folder(spark, path)
    return fs.getContentSummary(at).getLength() if fs.exists(at) else 0
