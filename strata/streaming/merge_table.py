"""Type-1 and type-2 tables kept by micro-batches: deltas, compaction, a manifest.

    <path>/spec                              what the table is: kind, keys, sequence, ...
    <path>/deltas/_source=S/_batch=N         the change rows of one batch
    <path>/base/version=V                    type 1: the latest row of every key; type 2: all change rows
    <path>/history/version=V                 type 2 only: the versions those rows make
    <path>/manifest/version=V                the last batch of each source that base V holds

A batch writes its own rows and nothing else: one delta folder, named by the
stream it came from and its batch id and overwritten by a retry. Several streams
may feed one table. A reader takes the newest manifest, its base, and the deltas
beyond it. When deltas outgrow a share of the base, or there are many, they are
compacted into a new base; it counts from the moment its manifest is written, so
a compaction that stops anywhere before is repeated, and one that stops after has
only left folders to clear. A folder counts once its ``_SUCCESS`` file is there.
What the manifest before the newest reads stays for running readers.

Columns may be added from batch to batch: rows written before hold null there.

A type-1 table with ``buckets`` keeps its rows bucketed by key, text keys in fewer
bytes: rows that were shuffled by key meet it (``held``) where they are and the
table isn't shuffled. A batch's rows are, once, when they are written, unless they
lie by bucket already (``dealt``). Deltas are read as the base is, so such a table
is compacted for its folders' number, or where a compaction drops rows.
"""

from __future__ import annotations

import contextlib
import hashlib
import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.normalize import packed, unpacked
from strata.operators import scd
from strata.sources.sinks import folder_bytes, remove_folder, subfolders
from strata.sources.tables import table_exists

SOURCE, BATCH = "_source", "_batch"
#: Compact when deltas hold this share of the base's bytes, or when there are so many folders to list.
DELTA_SHARE, MOST_DELTAS = 0.5, 64
#: Bytes of deltas that are never worth a compaction by their share alone.
LEAST_DELTA_BYTES = 64 << 20
#: Text keys of a bucketed table are stored packed, under this name and their own.
PACKED = "_packed_"


def by_keys(left: DataFrame, right: DataFrame, keys, how: str) -> DataFrame:
    """Semi / anti join on ``keys`` with NULL matching NULL."""
    r = right.select(*[F.col(k).alias(f"_k_{k}") for k in keys])
    cond = [left[k].eqNullSafe(r[f"_k_{k}"]) for k in keys]
    return left.join(r, cond, how)


def union(*frames: DataFrame | None) -> DataFrame | None:
    """By name, absent columns null; None counts as nothing."""
    out = None
    for f in frames:
        if f is not None:
            out = f if out is None else out.unionByName(f, allowMissingColumns=True)
    return out


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


class MergeTable:
    """A merged table at ``path``; created by the first call that names its ``kind`` and keys.

    ``kind`` "scd1": the latest row per key by ``sequence`` (then the other
    columns). "scd2": versions per key by the first ``sequence`` column, see
    ``scd.scd2``; rows may arrive in any order."""

    def __init__(self, spark: SparkSession, path: str, kind: str | None = None, keys=None, sequence=None, track=None,
                 tiebreak=None, bucket: str | None = "auto", open_first_version: bool = False, buckets: int | None = None):
        self.spark, self.path = spark, path.rstrip("/")
        if kind is not None:
            if kind not in ("scd1", "scd2"):
                raise ValueError("kind must be scd1 or scd2")
            if buckets and kind != "scd1":
                raise ValueError("only type 1 has buckets")
            seq = [sequence] if isinstance(sequence, str) else list(sequence)
            spec = {"kind": kind, "keys": list(keys), "sequence": seq, "track": list(track or []),
                    "tiebreak": list(tiebreak or []), "bucket": bucket, "open_first_version": open_first_version}
        held = self._spec()
        if held is None and kind is None:
            raise ValueError(f"no merge table at {path}")
        if held is None:
            spec["buckets"] = buckets
            spark.createDataFrame([(json.dumps(spec),)], "spec string").write.mode("overwrite").parquet(f"{self.path}/spec")
        elif kind is not None and {k: v for k, v in held.items() if k != "buckets"} != spec:
            raise ValueError(f"the table at {path} is {held}, not {spec}")
        self.spec = held or spec
        self.kind, self.keys, self.sequence = (self.spec[k] for k in ("kind", "keys", "sequence"))
        self.buckets = self.spec.get("buckets")     # as it was made, whatever ``buckets`` says

    def _spec(self) -> dict | None:
        at = f"{self.path}/spec"
        return json.loads(self.spark.read.parquet(at).first()["spec"]) if table_exists(self.spark, at) else None

    # -------------------------------------------------------------- state
    def _versions_of(self, folder: str) -> dict[int, str]:
        """Whole versions of a folder by number; one that was never finished isn't there."""
        return {int(at.rsplit("=", 1)[-1]): at for at in subfolders(self.spark, f"{self.path}/{folder}", finished=True)}

    def _manifest(self, back: int = 0) -> tuple[int, dict[str, int]]:
        """(version, last compacted batch of each source) of the newest manifest or the one ``back`` before; 0 is no base."""
        found = self._versions_of("manifest")
        version = max(found, default=0) - back
        if version not in found:
            return max(version, 0), {}
        return version, {r["source"]: r["last"] for r in self.spark.read.parquet(found[version]).collect()}   # a row a source

    def _delta_folders(self) -> list[tuple[str, int, str]]:
        """(source, batch, folder) of every whole batch."""
        return [(name.rsplit("=", 1)[-1], int(at.rsplit("=", 1)[-1]), at)
                for name in subfolders(self.spark, f"{self.path}/deltas")
                for at in subfolders(self.spark, name, finished=True)]

    def _live(self, compacted: dict[str, int]) -> list[str]:
        return [at for source, batch, at in self._delta_folders() if batch > compacted.get(source, -1)]

    def _deltas(self, live: list[str]) -> DataFrame | None:
        """Change rows that the base lacks, with the source and batch they came in."""
        reader = self.spark.read.option("mergeSchema", "true").option("basePath", f"{self.path}/deltas")
        live = self._filled(live)
        return self._unpacked(reader.parquet(*live)) if live else None

    def _base(self, version: int, folder: str = "base") -> DataFrame | None:
        at = self._filled([f"{self.path}/{folder}/version={version}"][:version])
        return self._unpacked(self.spark.read.parquet(*at)) if at else None

    def _filled(self, folders: list[str]) -> list[str]:
        """Folders with files: no row is no file in a bucketed table."""
        return [at for at in folders if folder_bytes(self.spark, at)] if self.buckets else folders

    @staticmethod
    def _name(source: str) -> str:
        return "s" + hashlib.sha256(source.encode()).hexdigest()[:16]

    def holds(self, batch_id: int, source: str) -> bool:
        """Whether the table holds this batch of this source."""
        name, (_, compacted) = self._name(source), self._manifest()
        return batch_id <= compacted.get(name, -1) or any((s, b) == (name, batch_id) for s, b, _ in self._delta_folders())

    # -------------------------------------------------------------- writing
    def merge(self, batch: DataFrame, batch_id: int, source: str = "", keep: Column | None = None,
              dealt: bool = False) -> None:
        """Add one batch of change rows; the same (source, batch id) again changes nothing.

        A batch that a base already holds is passed over; one that stopped
        before it was compacted overwrites its own folder. ``keep``: rows that a
        compaction may not drop (type 1). ``dealt``: files of the batch hold few
        buckets each, so it is stored without a shuffle."""
        name = self._name(source)
        _, compacted = self._manifest()
        if batch_id <= compacted.get(name, -1):
            return
        # as they came: readers and compactions merge them, so a shuffle here would be one too many
        self._store(batch, f"{self.path}/deltas/{SOURCE}={name}/{BATCH}={batch_id}", dealt)
        if self.outgrown(keep is not None):
            self.compact(keep)

    def outgrown(self, drops: bool = False) -> bool:
        """Whether a compaction (``drops``: one that drops rows) is due, by what the file system tells of folders."""
        version, compacted = self._manifest()
        live = self._live(compacted)
        if len(live) >= MOST_DELTAS:
            return True
        if self.buckets and not drops:
            return False
        held = sum(folder_bytes(self.spark, at) for at in live)
        base = folder_bytes(self.spark, f"{self.path}/base/version={version}") if version else 0
        return held > max(LEAST_DELTA_BYTES, DELTA_SHARE * base)

    def compact(self, keep: Column | None = None) -> None:
        """Deltas into a new base (type 2: and history), then the manifest, then the folders nobody needs."""
        version, compacted = self._manifest()
        live = self._live(compacted)
        if live:
            deltas = self._deltas(live)
            if self.kind == "scd2":
                self._write(self._versions(version, deltas), f"{self.path}/history/version={version + 1}")
            rows = union(self._base(version), None if deltas is None else deltas.drop(SOURCE, BATCH))
            if rows is not None:
                rows = rows if keep is None else rows.filter(keep)
                self._store(self._latest(rows) if self.kind == "scd1" else rows, f"{self.path}/base/version={version + 1}")
            last = dict(compacted)
            for source, batch, at in self._delta_folders():
                if at in live:
                    last[source] = max(last.get(source, -1), batch)
            self._commit(version + 1, last)
        self._clear()

    def _commit(self, version: int, last: dict[str, int]) -> None:
        rows = self.spark.createDataFrame(sorted(last.items()), "source string, last long")
        self._write(rows.coalesce(1), f"{self.path}/manifest/version={version}")

    def _clear(self) -> None:
        """Delete what neither the newest manifest nor the one before it reads."""
        version, _ = self._manifest()
        for folder in ("base", "history", "manifest"):
            for number, at in self._versions_of(folder).items():
                if number < version - 1:
                    remove_folder(self.spark, at)
        _, earlier = self._manifest(back=1)
        for source, batch, at in self._delta_folders():
            if batch <= earlier.get(source, -1):
                remove_folder(self.spark, at)

    @staticmethod
    def _write(rows: DataFrame, path: str) -> None:
        rows.write.mode("overwrite").parquet(path)

    def _store(self, rows: DataFrame, path: str, dealt: bool = False) -> None:
        if not self.buckets:
            return self._write(rows, path)
        rows, name = self._packed(rows), f"strata_merge_{uuid.uuid4().hex}"
        keys = self._stored_keys(rows)
        try:    # the files are the state, the name is forgotten
            rows = rows if dealt else rows.repartition(self.buckets, *keys)
            (rows.write.mode("overwrite").format("parquet").option("compression", "zstd").option("path", path)
             .bucketBy(self.buckets, *keys).saveAsTable(name))
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    # -------------------------------------------------------------- bucketed tables
    def _packed(self, rows: DataFrame) -> DataFrame:
        """Text keys packed, as they are stored."""
        text = [k for k in self.keys if k in rows.columns and rows.schema[k].dataType.typeName() == "string"]
        return rows.select(*[packed(F.col(c)).alias(PACKED + c) if c in text else F.col(c) for c in rows.columns])

    @staticmethod
    def _unpacked(rows: DataFrame) -> DataFrame:
        return rows.select(*[unpacked(F.col(c)).alias(c.removeprefix(PACKED)) if c.startswith(PACKED) else F.col(c)
                             for c in rows.columns])

    def _stored_keys(self, rows: DataFrame) -> list[str]:
        return [PACKED + k if PACKED + k in rows.columns else k for k in self.keys]

    @contextlib.contextmanager
    def held(self):
        """All rows as they came with text keys ``packed``, to be read inside the block; None before the first batch.

        Those of a bucketed table are read by bucket: base and deltas are partitions of one table."""
        version, compacted = self._manifest()
        folders = self._filled([*[f"{self.path}/base/version={version}"][:version], *self._live(compacted)])
        if not folders or not self.buckets:
            rows = self._packed(self.rows()) if folders else None
            yield rows if rows is None else rows.select(*[F.col(c).alias(c.removeprefix(PACKED)) for c in rows.columns])
            return
        name, sql = f"strata_merge_{uuid.uuid4().hex}", self.spark.sql
        first = self.spark.read.parquet(folders[0])
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in first.schema)
        keys = ", ".join(f"`{k}`" for k in self._stored_keys(first))
        try:
            sql(f"CREATE TABLE {name} ({columns}, _folder INT) USING parquet PARTITIONED BY (_folder) "
                f"CLUSTERED BY ({keys}) INTO {self.buckets} BUCKETS LOCATION {_quoted(f'{self.path}/tables/{name}')}")
            sql(f"ALTER TABLE {name} ADD " + " ".join(f"PARTITION (_folder = {i}) LOCATION {_quoted(at)}"
                                                      for i, at in enumerate(folders)))
            yield self.spark.table(name).select(*[F.col(c).alias(c.removeprefix(PACKED)) for c in first.columns])
        finally:
            sql(f"DROP TABLE IF EXISTS {name}")

    # -------------------------------------------------------------- reading
    def rows(self) -> DataFrame | None:
        """All rows as they came, not merged; None before the first batch."""
        version, compacted = self._manifest()
        deltas = self._deltas(self._live(compacted))
        return union(self._base(version), None if deltas is None else deltas.drop(SOURCE, BATCH))

    def read(self) -> DataFrame:
        """The merged rows as they are now."""
        version, compacted = self._manifest()
        deltas = self._deltas(self._live(compacted))
        if deltas is None and not version:
            raise ValueError(f"nothing was merged into {self.path} yet")
        if self.kind == "scd2":
            return self._versions(version, deltas)
        base = self._base(version)
        if deltas is None and base is None:
            raise ValueError(f"nothing was merged into {self.path} yet")
        return base if deltas is None else self._latest(union(base, deltas.drop(SOURCE, BATCH)))

    def _latest(self, rows: DataFrame) -> DataFrame:
        return scd.scd1(rows, self.keys, self.sequence, tiebreak=self.spec["tiebreak"])

    def _versions(self, version: int, deltas: DataFrame | None) -> DataFrame:
        """The base's versions, those of the deltas' keys made again from all rows of these keys."""
        kept = self._base(version, "history")
        if deltas is None:
            return kept
        rows = deltas.drop(SOURCE, BATCH)
        changed = rows.select(*self.keys).distinct()
        base = self._base(version)
        mine = union(None if base is None else by_keys(base, changed, self.keys, "left_semi"), rows)
        s = self.spec
        fresh = scd.scd2(mine, self.keys, self.sequence[0], s["track"], tiebreak=self.sequence[1:] + s["tiebreak"],
                         bucket=s["bucket"], open_first_version=s["open_first_version"])
        return union(None if kept is None else by_keys(kept, changed, self.keys, "left_anti"), fresh)


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the merge table at ``path``."""
    return MergeTable(spark, path).read()
