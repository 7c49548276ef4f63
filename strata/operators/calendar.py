"""Date spine (calendar dimension)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def calendar_columns(d: Column) -> list[Column]:
    return [
        F.date_format(d, "yyyyMMdd").cast("int").alias("date_key"),
        d.cast("date").alias("date"),
        F.year(d).cast("int").alias("year"),
        F.month(d).cast("int").alias("month"),
        F.dayofmonth(d).cast("int").alias("day"),
    ]


def calendar(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row per day in ``[start, end]``; the row count is known up front."""
    days = F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date")))
    return spark.range(1).select(days.alias("d")).select(*calendar_columns(F.col("d")))


def calendar_rows(start: str, end: str) -> int:
    return (dt.date.fromisoformat(end) - dt.date.fromisoformat(start)).days + 1


def calendar_spanning(df: DataFrame, date_col: str) -> DataFrame:
    """Calendar from the first to the last date found in ``df[date_col]``."""
    bounds = df.agg(F.min(F.col(date_col).cast("date")).alias("lo"),
                    F.max(F.col(date_col).cast("date")).alias("hi"))
    return (bounds.filter(F.col("lo").isNotNull())
                  .select(F.explode(F.sequence("lo", "hi")).alias("d"))
                  .select(*calendar_columns(F.col("d"))))
