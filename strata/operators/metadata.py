"""Ingest metadata: lineage, run and content-hash columns (one projection)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.normalize import record_hash
from strata.spec import DatasetSpec, Settings

LINEAGE_FROM_FILE = {
    "_source_file": ("_metadata.file_path", "string"),
    "_source_file_mod_ts": ("_metadata.file_modification_time", "timestamp"),
    "_source_file_size": ("_metadata.file_size", "bigint"),
}


def add_ingest_metadata(df: DataFrame, spec: DatasetSpec, settings: Settings,
                        ingest_ts: Column | None = None,
                        file_lineage: bool = True,
                        run_id: Column | None = None) -> DataFrame:
    """Add ``_ingest_ts/_date/_yyyymmdd``, ``_dataset``, ``_ingest_run_id``,
    file lineage and ``_record_hash``.

    ``ingest_ts`` defaults to ``settings.now`` when given (reproducible runs),
    else ``current_timestamp()``. File lineage reads the hidden ``_metadata``
    column of a file source; pass ``file_lineage=False`` when the input already
    carries the three ``_source_*`` columns.
    """
    if ingest_ts is None:
        ingest_ts = (F.lit(settings.now).cast("timestamp") if settings.now
                     else F.current_timestamp())
    ingest_date = F.to_date(ingest_ts)
    cols = {
        "_ingest_ts": ingest_ts,
        "_ingest_date": ingest_date,
        "_ingest_yyyymmdd": F.date_format(ingest_date, "yyyyMMdd").cast("int"),
        "_dataset": F.lit(spec.name),
        "_ingest_run_id": run_id if run_id is not None else F.lit(settings.run_id),
    }
    if file_lineage:
        for name, (path, typ) in LINEAGE_FROM_FILE.items():
            cols[name] = F.col(path).cast(typ)
    cols["_record_hash"] = record_hash(spec.hash_parts, df.schema)
    return df.withColumns(cols)
