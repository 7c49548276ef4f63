"""CSV drops -> bronze rows: all text, header-aware rescue, corrupt capture, lineage.

Plain CSV reading over files with different headers aligns values by
*position*, and schema inference changes keys (``007`` -> 7). So:

1. List the drop files (``binaryFile`` source with the content column pruned).
2. Read each file's header record on the executors (a few KB per file).
3. Per distinct header: one ``spark.read.csv`` over that header's files with
   the header itself (sanitised) as an all-string schema. Declared columns are
   kept, every other column goes into ``_rescued_data`` (JSON), a row with too
   few or too many fields lands in ``_corrupt_record``.
   Files above ``SPLIT_ABOVE`` bytes are cut into records by many tasks
   (``csv_split``) and parsed with ``from_csv``.
4. ``unionByName`` of the per-header reads.

The (path, header) table is collected on the driver: it has one row per file,
which is what Spark's own file index already holds for any file read.
"""

from __future__ import annotations

import csv
import io
import sys
from functools import reduce

from pyspark import cloudpickle

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

import strata.functions.names as _names
from strata.functions.names import sanitize_name, sanitize_names
from strata.sources.csv_split import read_records

# Header-scan helpers (this module and the sanitiser) travel with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(_names)

# Fixed values of the CSV dialect and reader columns: header row, multi-line
# records, quote and escape '"', permissive parsing with the raw text of a
# malformed row in "_corrupt_record", unknown columns in "_rescued_data".
CSV_OPTIONS = {
    "header": "true",
    "multiLine": "true",
    "quote": '"',
    "escape": '"',
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": "_corrupt_record",
    "enforceSchema": "true",
}
#: Larger files are split: Spark's reader gives a multi-line file to one task, however large.
SPLIT_ABOVE = 256 << 20
RESCUED = "_rescued_data"
CORRUPT = "_corrupt_record"


def list_drop_files(spark: SparkSession, location: str | list[str], glob: str = "*.csv") -> DataFrame:
    """path, size, modification time of every drop file of a folder or list (file contents not read)."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob)
            .option("recursiveFileLookup", "true").load(location)
            .select("path", "length", "modificationTime"))


def _local_path(path: str) -> str | None:
    if path.startswith("file:"):
        p = path[len("file:"):]
        while p.startswith("//"):
            p = p[1:]
        return p
    if path.startswith("/"):
        return path
    return None


def first_record(path: str, chunk: int = 65536) -> tuple[list[str], bool]:
    """The first CSV record of a file (quotes may span lines), and whether its line ends with a carriage return too."""
    local = _local_path(path)
    if local is not None:
        stream = open(local, "rb")
    else:  # remote file systems through pyarrow's Hadoop-compatible layer
        from pyarrow import fs
        filesystem, p = fs.FileSystem.from_uri(path)
        stream = filesystem.open_input_stream(p)
    buf = bytearray()
    in_quote = False
    with stream:
        done = False
        while not done:
            data = stream.read(chunk)
            if not data:
                break
            for b in data:
                if b == 0x22:
                    in_quote = not in_quote
                elif b == 0x0A and not in_quote:
                    done = True
                    break
                buf.append(b)
    text = buf.decode("utf-8-sig", errors="replace")
    crlf, text = text.endswith("\r"), text.rstrip("\r")
    rows = list(csv.reader(io.StringIO(text), quotechar='"', doublequote=True))
    return (rows[0] if rows else []), crlf


def _read_headers(batches):
    import pandas as pd
    for pdf in batches:
        headers, ends = zip(*[first_record(p) for p in pdf["path"]]) if len(pdf) else ((), ())
        yield pd.DataFrame({"path": pdf["path"], "length": pdf["length"], "crlf": ends, "header": headers,
                            "cols": [[sanitize_name(c) for c in h] for h in headers]})


def scan_headers(files: DataFrame) -> DataFrame:
    """(path, length, kind of line ends, header, sanitised columns) for every file, read on the executors.

    The few helpers the executors run are shipped with the task itself
    (pickled by value), so workers need no copy of this package.
    """
    return files.select("path", "length").mapInPandas(
        _read_headers, "path string, length long, crlf boolean, header array<string>, cols array<string>")


def _read_group(spark: SparkSession, paths: list[str], header: list[str], declared: list[str] | None,
                options: dict, split: bool = False, crlf: bool = False) -> DataFrame:
    names = sanitize_names(header)
    schema = StructType([StructField(n, StringType()) for n in names] + [StructField(CORRUPT, StringType())])
    if split:
        parsed = dict(options, header="false")
        ddl = ", ".join(f"`{f.name}` string" for f in schema.fields)
        # as Spark's reader has it: where lines end with both characters, line breaks in values are line feeds
        values = [F.replace(F.col(f"_row.{n}"), F.lit("\r\n"), F.lit("\n")).alias(n) if crlf else F.col(f"_row.{n}") for n in names]
        df = (read_records(spark, paths, options.get("sep", ","), crlf)
              .withColumn("_row", F.from_csv("record", ddl, parsed)).select(*values, f"_row.{CORRUPT}", *[
                  F.col(c).alias(f"_meta_{c}") for c in ("file_path", "file_modification_time", "file_size")]))
        meta = "_meta_"
    else:
        df, meta = spark.read.options(**options).schema(schema).csv(paths), "_metadata."
    keep = names if declared is None else [n for n in names if n in declared]
    extras = [] if declared is None else [n for n in names if n not in declared]
    cols = [F.col(n) for n in keep]
    if extras:
        m = F.map_filter(F.create_map(*[x for n in extras for x in (F.lit(n), F.col(n))]),
                         lambda k, v: v.isNotNull())
        cols.append(F.when(F.size(m) > 0, F.to_json(m)).alias(RESCUED))
    else:
        cols.append(F.lit(None).cast("string").alias(RESCUED))
    cols += [F.col(CORRUPT),
             F.col(f"{meta}file_path").alias("_source_file"),
             F.col(f"{meta}file_modification_time").cast("timestamp").alias("_source_file_mod_ts"),
             F.col(f"{meta}file_size").cast("bigint").alias("_source_file_size")]
    return df.select(*cols)


def read_drops(spark: SparkSession, location: str | list[str], declared=None, headers: str = "scan",
               glob: str = "*.csv", options: dict | None = None, split_above: int | None = SPLIT_ABOVE) -> DataFrame:
    """Bronze rows of every CSV drop under ``location`` (or of the given file list).

    ``declared``: the columns kept as columns (sanitised names); others are
    rescued. None keeps every column. ``headers="uniform"`` expects one header
    for all files and raises on a second one.
    Files of more than ``split_above`` bytes are read by many tasks (None: never);
    their rows are the same. Files of other quotes, escapes or encodings stay whole.
    """
    opts = dict(CSV_OPTIONS, **(options or {}))
    if opts["quote"] != '"' or opts["escape"] != '"' or {"encoding", "charset", "lineSep", "comment"} & set(opts):
        split_above = None
    paths_df = list_drop_files(spark, location, glob if isinstance(location, str) else "*")
    declared = list(declared) if declared is not None else None
    groups: dict[tuple, list[str]] = {}
    big = F.lit(False) if split_above is None else F.col("length") > split_above
    scanned = scan_headers(paths_df).withColumn("split", big)
    if headers == "uniform":
        kinds = scanned.select("header").distinct().limit(2).collect()
        if not kinds:
            raise ValueError(f"no drop files under {location}")
        if len(kinds) > 1:
            raise ValueError(f"headers differ under {location}: {kinds[0]['header']} and {kinds[1]['header']}")
    for r in scanned.drop("cols").collect():
        groups.setdefault((tuple(r["header"]), r["split"], r["split"] and r["crlf"]), []).append(r["path"])
    if not groups:
        raise ValueError(f"no drop files under {location}")
    parts = [_read_group(spark, sorted(p), list(h), declared, opts, split, crlf) for (h, split, crlf), p in sorted(groups.items())]
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    if declared is not None:
        missing = [c for c in declared if c not in out.columns]
        if missing:
            out = out.withColumns({c: F.lit(None).cast("string") for c in missing})
        out = out.select(*declared, RESCUED, CORRUPT, "_source_file", "_source_file_mod_ts",
                         "_source_file_size")
    return out


def observed_headers(spark: SparkSession, location: str, glob: str = "*.csv") -> DataFrame:
    """(path, sanitised column list) per drop file: the input of per-file schema drift."""
    return scan_headers(list_drop_files(spark, location, glob)).select("path", "cols")
