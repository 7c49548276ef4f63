"""One large CSV file read by many tasks, quoted line breaks included.

Spark's reader gives a file with quoted line breaks to one task, since a byte
range can't tell whether it begins inside a quoted field. Here it can:

1. The file is read as lines, in byte ranges. Each range is a map from the state
   it begins in (outside or inside quotes) to the state it ends in.
2. These maps are composed along each file by windows over one row per range, so
   every range knows the state it begins in.
3. The ranges are read again and cut into records. A record that crosses a border
   leaves pieces, one per range; only pieces are shuffled, and joined in order.

Lines never move between tasks but for those pieces.
"""

from __future__ import annotations

import sys

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.session import scratch_path

# The tasks' helpers travel with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Ranges at record-crossing borders that are broadcast at most (some 17 bytes each); more are joined by sort-merge.
MAX_BROADCAST_RANGES = 1 << 18
#: Kinds of rows: a whole record, a piece that goes on with an earlier range's record, a piece that begins one.
WHOLE, LATER, FIRST = 0, 1, 2


def inside_after(line: bytes, inside: bool, sep: bytes = b",") -> bool:
    """Whether the text is inside a quoted field after ``line``, given whether it was before.

    Doubled quotes stay inside. A quote within a plain field is text. A lone quote within a quoted field makes it
    a plain one, which ends at the next separator or at the end of the line."""
    i = 0
    while True:
        if not inside:
            if line[i:i + 1] != b'"':
                i = line.find(sep, i) + 1
                if not i:
                    return False
                continue
            i += 1
        i = line.find(b'"', i) + 1
        if not i:
            return True
        if line[i:i + 1] == b'"':
            i, inside = i + 1, True
            continue
        inside = False
        rest = line[i:]
        blank = len(rest) - len(rest.lstrip(b" \t\r"))
        if blank == len(rest):
            return False
        i = line.find(sep, i + blank) + 1
        if not i:
            return False


def _stretches(batch: pa.RecordBatch):
    """``(file, range, first row, last row)`` of the stretches of one range in a batch."""
    files, ranges = batch.column(0).to_numpy(), batch.column(1).to_numpy()
    cuts = ((files[1:] != files[:-1]) | (ranges[1:] != ranges[:-1])).nonzero()[0] + 1
    edges = [0, *cuts.tolist(), len(files)]
    for i, j in zip(edges[:-1], edges[1:]):
        if i < j:
            yield int(files[i]), int(ranges[i]), i, j


def _transitions(sep: bytes):
    schema = pa.schema([("file", pa.int64()), ("range", pa.int64()), ("outside", pa.bool_()), ("inside", pa.bool_())])

    def task(batches):
        last, states = None, (False, True)
        for batch in batches:
            done = []
            for file, start, i, j in _stretches(batch):
                if (file, start) != last:
                    if last:
                        done.append((*last, *states))
                    last, states = (file, start), (False, True)
                for line in batch.column(2).slice(i, j - i).drop_null().to_pylist():
                    states = tuple([inside_after(line, s, sep) for s in states])
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*done), schema)], schema=schema)
        if last:
            yield pa.RecordBatch.from_arrays([pa.array([v], type=f.type) for v, f in zip((*last, *states), schema)], schema=schema)

    return task


def _cut(sep: bytes, crlf: bool = False, batch_bytes: int = 16 << 20):
    schema = pa.schema([("file", pa.int64()), ("range", pa.int64()), ("kind", pa.int32()), ("head", pa.bool_()),
                        ("record", pa.binary())])

    def task(batches):
        last, inside, piece, later, head = None, False, [], False, False
        out, size = [], 0

        def emit(kind, record):
            nonlocal head, size
            if kind == WHOLE and (not record or crlf and record == b"\r"):
                return
            out.append((*last, kind, head, record))
            head, size = head and kind == LATER, size + len(record)

        def close(kind):
            nonlocal piece
            emit(kind, b"\n".join(piece))
            piece = []

        def handed():
            nonlocal out, size
            batch = pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*out), schema)], schema=schema)
            out, size = [], 0
            return batch

        for batch in batches:
            for file, start, i, j in _stretches(batch):
                if (file, start) != last:
                    if inside and last:
                        close(LATER if later else FIRST)
                    last, inside, piece = (file, start), bool(batch.column(3)[i].as_py()), []
                    later, head = inside, start == 0
                lines = batch.column(2).slice(i, j - i)
                quoted = pc.match_substring(lines, '"').to_pylist()
                for line, quotes in zip(lines.to_pylist(), quoted):
                    was = inside
                    if quotes:
                        inside = inside_after(line, inside, sep)
                    if not was and not inside:
                        emit(WHOLE, line)
                    else:
                        piece.append(line)
                        if not was:
                            later = False
                        if not inside:
                            close(LATER if later else WHOLE)
                    if size > batch_bytes:
                        yield handed()
            if out:
                yield handed()
        if inside and last:
            close(LATER if later else FIRST)
        if out:
            yield handed()

    return task


def ranges_of(lines: DataFrame, sep: bytes = b",") -> DataFrame:
    """file, range, begins, ends: the state every byte range begins and ends in (true: inside quotes).

    A range's map is the identity, a flip, or a constant. The state before a range is that of the last constant
    before it (outside, at the start of a file), flipped as often as there are flips since."""
    maps = lines.select("file", "range", F.when(F.contains("value", F.lit('"').cast("binary")), F.col("value"))).mapInArrow(
        _transitions(sep), "file long, range long, outside boolean, inside boolean")
    along = Window.partitionBy("file").orderBy("range")
    flip, fixed = F.expr("CAST(outside AND NOT inside AS INT)"), F.col("outside") == F.col("inside")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    flips = maps.withColumn("_flips", F.sum(flip).over(along) % 2)
    settled = F.when(fixed, F.col("outside").cast("int").bitwiseXOR(F.col("_flips").cast("int")))
    state = F.coalesce(F.last(settled, ignorenulls=True).over(before), F.lit(0)).bitwiseXOR(
        F.coalesce(F.last("_flips").over(before), F.lit(0)).cast("int"))
    return (flips.withColumn("begins", state == 1)
            .select("file", "range", "begins", F.when(F.col("begins"), F.col("inside")).otherwise(F.col("outside")).alias("ends")))


def read_records(spark: SparkSession, paths: list[str], sep: str = ",", crlf: bool = False) -> DataFrame:
    """CSV records of ``paths`` as text, header records left out, with ``file_path``, ``file_modification_time``
    and ``file_size``.

    Lines end with a line feed, with ``crlf`` after a carriage return; quote and escape are ``"``. Empty lines
    are no records, an empty file has none, and a quote that never closes runs to the end of its file. The ranges'
    states are one small table, written under ``spark.checkpoint.dir``."""
    mark = sep.encode("utf-8")
    file = F.xxhash64("_metadata.file_path").alias("file")
    lines = spark.read.option("lineSep", "\n").text(paths).select(
        file, F.col("_metadata.file_block_start").alias("range"), F.col("value").cast("binary").alias("value"))
    files = spark.read.format("binaryFile").load(paths).select(
        file, "_metadata.file_path", "_metadata.file_modification_time", "_metadata.file_size")
    path = scratch_path(spark, "csv-ranges")
    ranges_of(lines, mark).where("begins OR ends").write.parquet(path)
    crossed = spark.read.schema("file long, range long, begins boolean, ends boolean").parquet(path)

    if crossed.count() <= MAX_BROADCAST_RANGES:
        states = F.broadcast(crossed)
        known = lines.join(states, ["file", "range"], "left")       # the order of lines stays
    else:
        known = (lines.withColumn("_line", F.monotonically_increasing_id()).join(crossed.hint("merge"), ["file", "range"], "left")
                 .sortWithinPartitions("file", "range", "_line"))
    shape = "file long, range long, kind int, head boolean, record binary"
    told = ["file", "range", "value", F.coalesce("begins", F.lit(False)).alias("begins")]
    whole = known.select(*told).mapInArrow(_cut(mark, crlf), shape).where(f"kind = {WHOLE} AND NOT head").select("file", "record")
    # pieces lie in ranges that begin or end inside quotes only: the others don't reach the tasks again
    pieces = known.where("begins OR ends").select(*told).mapInArrow(_cut(mark, crlf), shape).where(f"kind != {WHOLE}")
    along = Window.partitionBy("file").orderBy("range", "kind")
    glued = (pieces.withColumn("_record", F.sum((F.col("kind") == FIRST).cast("int")).over(along))
             .groupBy("file", "_record").agg(F.sort_array(F.collect_list(F.struct("range", "kind", "record"))).alias("p"),
                                             F.max("head").alias("head"))
             .where("NOT head").select("file", F.expr("array_join(transform(p, x -> CAST(x.record AS STRING)), '\n')").alias("record")))
    records = whole.select("file", F.col("record").cast("string").alias("record")).unionByName(glued)
    if crlf:
        records = records.withColumn("record", F.expr(r"IF(endswith(record, '\r'), left(record, length(record) - 1), record)"))
    return (records.join(files, "file").select("record", "file_path", "file_modification_time", "file_size"))
