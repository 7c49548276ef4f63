"""Write, audit, publish: tables of a run stand behind a pointer that moves when its checks pass.

    <root>/runs/run=N/<table>       what run N wrote
    <root>/published/run=N          the pointer: for each table its folder, or the partition folders it consists of

Readers take the newest finished pointer, so a run that fails its checks, or
stops half-way, leaves them on the tables of the run before. Retention moves the
pointer too: expired partitions leave the list and nothing is rewritten. What
the newest two pointers don't name is deleted.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.operators import ops
from strata.sources.sinks import remove_folder, subfolders, write_table
from strata.spec import Settings

#: Name of the partition of rows without a date (fixed by Spark).
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
POINTER = "name string, schema string, base string, paths array<string>"


def _number(at: str) -> int:
    return int(at.rsplit("=", 1)[-1])


def _pointers(spark: SparkSession, root: str) -> dict[int, str]:
    return {_number(at): at for at in subfolders(spark, f"{root}/published", finished=True)}


def _tables(spark: SparkSession, root: str, run: int | None = None) -> dict[str, tuple[str, str, list[str]]]:
    """Schema, folder and parts of each table that a pointer (None: the newest) shows."""
    found = _pointers(spark, root)
    run = max(found, default=None) if run is None else run
    rows = spark.read.parquet(found[run]).collect() if run in found else []     # a row a table
    return {r["name"]: (r["schema"], r["base"], list(r["paths"])) for r in rows}


class Run:
    """One run over the tables at ``root``; ``save`` writes them aside, ``publish`` shows them to readers."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        taken = [_number(at) for at in subfolders(spark, f"{self.root}/runs")] + list(_pointers(spark, self.root))
        self.number = max(taken, default=-1) + 1
        self.tables: dict[str, str] = {}
        self._schemas: dict[str, str] = {}

    def state(self, name: str) -> str:
        """Path of a table that runs add to (bronze, logs) and that no pointer hides."""
        return f"{self.root}/{name}"

    def save(self, name: str, df: DataFrame, partition_by=None) -> DataFrame:
        self.tables[name] = write_table(df, f"{self.root}/runs/run={self.number}/{name}", partition_by=partition_by)
        saved = self.spark.read.schema(df.schema).parquet(self.tables[name])    # no rows, no files, but a schema
        self._schemas[name] = saved.schema.json()
        return saved

    def publish(self, checks: DataFrame, settings: Settings) -> bool:
        """Move the pointer to this run's tables, unless checks fail and are enforced."""
        if settings.guardrails_enforced and checks.filter(~F.col("passed")).limit(1).count():
            return False
        _point(self.spark, self.root, self.number, {
            name: (self._schemas[name], at, _partitions(self.spark, at) or [at]) for name, at in self.tables.items()})
        _clear(self.spark, self.root)
        return True


def _partitions(spark: SparkSession, path: str) -> list[str]:
    return [at for at in subfolders(spark, path) if "=" in at.rsplit("/", 1)[-1]]


def _point(spark: SparkSession, root: str, run: int, tables: dict[str, tuple[str, str, list[str]]]) -> None:
    rows = spark.createDataFrame([(n, *rest) for n, rest in sorted(tables.items())], POINTER)
    write_table(rows.coalesce(1), f"{root}/published/run={run}")


def _clear(spark: SparkSession, root: str) -> None:
    """Delete runs, partitions and pointers that the newest two pointers don't need."""
    found = _pointers(spark, root)
    newest = sorted(found)[-2:]
    held = [p for run in newest for _, _, paths in _tables(spark, root, run).values() for p in paths]
    for run, at in found.items():
        if run not in newest:
            remove_folder(spark, at)
    for at in subfolders(spark, f"{root}/runs"):
        if _number(at) >= newest[-1]:
            continue
        names = [p for p in held if f"/runs/run={_number(at)}/" in p]
        if not names:
            remove_folder(spark, at)
            continue
        for table in subfolders(spark, at):     # some of an older run's partitions are still shown
            for part in _partitions(spark, table):
                if not any(_tail(p) == _tail(part) for p in names):
                    remove_folder(spark, part)


def _tail(path: str) -> str:
    """Run, table and partition of a path, however its root is spelled."""
    return path[path.index("/runs/run="):]


def published_run(spark: SparkSession, root: str) -> int | None:
    return max(_pointers(spark, root.rstrip("/")), default=None)


def read_published(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table as the newest pointer shows it; without any partition left it has its columns and no rows."""
    tables = _tables(spark, root.rstrip("/"))
    if name not in tables:
        raise ValueError(f"{name} was never published under {root}")
    schema, base, paths = tables[name]
    schema = StructType.fromJson(json.loads(schema))
    return spark.read.schema(schema).option("basePath", base).parquet(*paths) if paths else spark.createDataFrame([], schema)


def retire(spark: SparkSession, root: str, name: str, settings: Settings, date_col: str = "_ingest_date") -> int:
    """Take the expired partitions of a published table (partitioned by ``date_col``) from readers; returns how many.

    Partitions before ``now`` less ``quarantine_retention_days`` go, the one of
    rows without a date stays. What went is recorded, rows per day, in
    ``<root>/retention_log`` before the pointer moves; a repeat finds nothing."""
    root = root.rstrip("/")
    tables = _tables(spark, root)
    schema, base, paths = tables[name]
    today = spark.range(1).select(F.to_date(ops.now(settings)).alias("d")).first()["d"]
    cutoff = today - dt.timedelta(days=settings.quarantine_retention_days)

    def day(at: str) -> dt.date | None:
        value = at.rsplit(f"{date_col}=", 1)[-1]
        return None if value == NULL_PARTITION else dt.date.fromisoformat(value)

    gone = [at for at in paths if f"{date_col}=" in at and day(at) is not None and day(at) < cutoff]
    if not gone:
        return 0
    run = max(published_run(spark, root), Run(spark, root).number - 1) + 1
    rows = spark.read.option("basePath", base).parquet(*gone).groupBy(date_col).agg(F.count(F.lit(1)).alias("rows"))
    write_table(rows.select(F.lit(name).alias("name"), F.col(date_col).cast("date").alias("ingest_date"), "rows",
                            F.lit(cutoff).alias("cutoff")), f"{root}/retention_log/_run={run}")
    tables[name] = schema, base, [at for at in paths if at not in gone]
    _point(spark, root, run, tables)
    _clear(spark, root)
    return len(gone)
