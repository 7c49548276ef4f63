"""Shared helpers: scratch tables, run detection over sorted partitions, word hashes."""

from __future__ import annotations

import contextlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import scratch_path, table_path

#: Mixing constants of the 64-bit rolling hashes (fixed values, any odd numbers do).
MIX = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


#: Paths that the open ``scratch`` blocks will delete, innermost last.
_open: list[list[str]] = []


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh folder under ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage with files that outlive any executor. Inside a ``scratch``
    block the folder is deleted at its end."""
    spark = df.sparkSession
    path = fresh(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_folder = path
    return out


def fresh(spark: SparkSession, name: str) -> str:
    """A new folder name under ``spark.checkpoint.dir``, deleted like those of ``saved``."""
    path = scratch_path(spark, name)
    if _open:
        _open[-1].append(path)
    return path


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder of whatever file system Spark finds it in."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


@contextlib.contextmanager
def scratch(spark: SparkSession):
    """Deletes at its end what ``saved`` wrote in it, but for tables passed to the yielded function.

    Those go to the block around it, or stay if there is none; the result of an
    operator may read them only."""
    own: list[str] = []
    _open.append(own)

    def keep(df: DataFrame) -> DataFrame:
        own.remove(df.scratch_folder)
        if len(_open) > 1:
            _open[-2].append(df.scratch_folder)
        return df

    try:
        yield keep
    finally:
        _open.pop()
        for path in own:
            delete(spark, path)


def clean_text(column: str = "text"):
    """The text, null as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def scalar(df: DataFrame, *aggregates) -> tuple:
    """One row of totals, the only thing that reaches the driver."""
    return tuple(df.agg(*aggregates).first())


def words_of(text: str | None) -> list[bytes]:
    """``[^\\x20\\x09-\\x0D]+`` of the text after lower-casing A-Z; null counts as empty."""
    return (text or "").encode("utf-8", "replace").lower().split()


class WordHashes(dict):
    """Memo of 64-bit word hashes, one per task; emptied when it holds ``limit`` words."""

    limit = 1 << 20

    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def __call__(self, words: list[bytes]) -> np.ndarray:
        if len(self) > self.limit:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


#: Bytes that end a word, a factor per byte, and the base of the sums over a text (fixed values, any odd base does).
_SPACE = np.isin(np.arange(256), (0x20, 9, 10, 11, 12, 13))
_BYTE = np.random.default_rng(1).integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = MIX[0]
#: Bytes of a text hashed at a time, and of a word that is hashed with its neighbours at most.
PIECE = 1 << 16


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, dtype=np.uint64)
    steps[0] = 1
    return np.cumprod(steps, dtype=np.uint64)


_UP, _DOWN = _powers(_BASE, 2 * PIECE), _powers(pow(_BASE, -1, 1 << 64), 2 * PIECE)


def text_hashes(text: str | None) -> np.ndarray:
    """64-bit hashes of ``words_of(text)``, from running sums over its bytes instead of a lookup per word.

    A word's sum is the difference of two running sums, moved to the word's own
    start by the inverse power. A text is cut at spaces into pieces of some
    ``PIECE`` bytes; words longer than that are hashed alone."""
    raw = (text or "").encode("utf-8", "replace").lower()
    data = np.frombuffer(raw, dtype=np.uint8)
    if len(data) <= PIECE:
        return _piece_hashes(raw, data)
    spaces = np.flatnonzero(_SPACE[data])
    at = np.searchsorted(spaces, np.arange(PIECE, len(data), PIECE))
    cuts = [0, *np.unique(spaces[at[at < len(spaces)]]).tolist(), len(data)]
    return np.concatenate([_piece_hashes(raw[a:b], data[a:b]) for a, b in zip(cuts[:-1], cuts[1:])])


def _piece_hashes(raw: bytes, data: np.ndarray) -> np.ndarray:
    return _placed_hashes(raw, data)[0]


def _placed_hashes(raw: bytes, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of a piece's words, and where they begin."""
    inside = np.zeros(len(data) + 2, dtype=bool)
    np.logical_not(_SPACE[data], out=inside[1:-1])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    some = data[:2 * PIECE]
    sums = np.zeros(len(some) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[some] * _UP[:len(some)], out=sums[1:])
    h = sums[np.minimum(ends, len(some))] - sums[np.minimum(starts, len(some))]
    h *= _DOWN[np.minimum(starts, len(some) - 1)] if len(some) else np.uint64(1)
    h ^= h >> np.uint64(32)
    h *= np.uint64(MIX[1])
    h ^= h >> np.uint64(29)
    for i in np.flatnonzero(ends - starts > PIECE).tolist():
        h[i] = xxhash.xxh3_64_intdigest(raw[starts[i]:ends[i]])
    return h, starts


def many_hashes(texts: Iterable[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``text_hashes`` of texts in order: the hashes of some texts at a time, and how many words each of them has.

    Texts of some ``PIECE`` bytes in all are hashed at once, longer ones alone."""
    held, size = [], 0
    for text in texts:
        raw = (text or "").encode("utf-8", "replace").lower()
        if held and size + len(raw) > PIECE:
            yield _joined_hashes(held)
            held, size = [], 0
        if len(raw) > PIECE:
            h = text_hashes(text)
            yield h, np.array([len(h)])
        else:
            held.append(raw)
            size += len(raw) + 1
    if held:
        yield _joined_hashes(held)


def _joined_hashes(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    raw = b" ".join(raws)
    h, starts = _placed_hashes(raw, np.frombuffer(raw, dtype=np.uint8))
    return h, np.diff(np.searchsorted(starts, np.cumsum([len(r) + 1 for r in raws])), prepend=0)


def shingle_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all ``k``-word shingles in order; fewer words give one hash of the whole."""
    if not len(h):
        return h
    k = min(k, len(h))
    n = len(h) - k + 1
    s = np.full(n, k, dtype=np.uint64)
    for j in range(k):
        s += h[j:j + n]
        s *= np.uint64(MIX[j % 3])
        s ^= s >> np.uint64(29 + j % 3)
    return s


#: Bytes of texts, binaries and lists in an Arrow batch that a task hands on (one row may be larger).
BATCH_BYTES = 32 << 20


def _width(value) -> int:
    return 0 if value is None else len(value) if isinstance(value, (bytes, str)) else 8 * len(value)


def batches_of(rows: Iterator[tuple], schema: pa.Schema, size: int = 4096, most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Arrow batches of row tuples, of ``size`` rows or some ``most`` bytes at the most."""
    wide = [i for i, f in enumerate(schema) if not pa.types.is_primitive(f.type)]
    held: list[tuple] = []
    n = 0
    for row in rows:
        more = sum([_width(row[i]) for i in wide])
        if held and (len(held) >= size or n + more > most):
            yield _batch(held, schema)
            held, n = [], 0
        held.append(row)
        n += more
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(col, type=f.type) for col, f in zip(zip(*rows), schema)], schema=schema)


def runs(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Consecutive rows with equal key columns, over batches of a sorted partition."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        new = np.zeros(batch.num_rows, dtype=bool)
        for c in cols:
            new[1:] |= c[1:] != c[:-1]
        first = tuple(c[0] for c in cols)
        if held and first != last:
            yield pa.Table.from_batches(held)
            held = []
        cuts = [0, *np.flatnonzero(new).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:]):
            if a and held:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
        last = tuple(c[-1] for c in cols)
    if held:
        yield pa.Table.from_batches(held)
