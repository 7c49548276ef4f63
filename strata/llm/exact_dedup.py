"""Exact de-duplication against a persistent digest index.

The index is a parquet table bucketed and sorted by SHA-256 digest. New data is
reduced to one row per digest, de-duplicated by a sort-merge anti-join with the
index and appended, so later loads compare with every earlier one without
reading any text again.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import clean_text, delete, saved, scalar, table
from strata.session import scratch_path
from strata.sources.sinks import folder_bytes

#: Rows of an index bucket aimed at, and the least and most buckets.
BUCKET_ROWS, LEAST_BUCKETS, MOST_BUCKETS = 4_000_000, 4, 65_536

#: Format of the index's files.
FORMAT = 1


def buckets_for(rows: int) -> int:
    return max(LEAST_BUCKETS, min(MOST_BUCKETS, -(-rows // BUCKET_ROWS)))


class DigestIndex:
    """``(digest binary, keep_id long)``, bucketed and sorted by digest, at ``path``.

    The files are the state; the table name is declared anew in each session.
    ``<path>_meta`` says how many buckets the files have and in what format: an
    index is opened by what is written there, whatever ``buckets`` says, and
    files without it, or in another format, are refused. ``rebucketed`` writes
    an index with more buckets. Admitting a batch again admits nothing, so a
    failed load can be repeated.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int):
        self.spark, self.path = spark, path.rstrip("/")
        held = self._meta()
        if held is None:
            if folder_bytes(spark, self.path):
                raise ValueError(f"{path} holds files but no {path}_meta: not an index of this format")
            meta = spark.createDataFrame([(FORMAT, buckets)], "format int, buckets int")
            meta.coalesce(1).write.mode("overwrite").parquet(f"{self.path}_meta")
            held = FORMAT, buckets
        if held[0] != FORMAT:
            raise ValueError(f"{path} is an index of format {held[0]}, not {FORMAT}")
        self.buckets = held[1]
        self.name = "strata_digests_" + hashlib.md5(f"{self.path} {self.buckets}".encode()).hexdigest()[:16]
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} (digest BINARY, keep_id BIGINT) USING parquet "
                  f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{self.path}'")

    def _meta(self) -> tuple[int, int] | None:
        if not folder_bytes(self.spark, f"{self.path}_meta"):
            return None
        return tuple(self.spark.read.parquet(f"{self.path}_meta").first())

    def rebucketed(self, path: str, buckets: int) -> DigestIndex:
        """The same digests at a new path, in ``buckets`` buckets."""
        other = DigestIndex(self.spark, path, buckets)
        self.rows().repartition(other.buckets, "digest").write.insertInto(other.name)
        return other

    def close(self, files: bool = False) -> None:
        """Forget the table's name, ``files``: and the index itself."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        if files:
            delete(self.spark, self.path)
            delete(self.spark, f"{self.path}_meta")

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def admit(self, batch: DataFrame) -> DataFrame:
        """Append the digests of ``batch`` (doc_id, digest) that the index lacks; return them.

        Of equal digests within the batch the largest doc_id is recorded; a digest
        that the index already has keeps its earlier row."""
        least = batch.groupBy("digest").agg(F.max("doc_id").alias("keep_id"))
        new = saved(least.hint("merge").join(self.rows().select("digest"), "digest", "left_anti"), "digest-new")
        new.repartition(self.buckets, "digest").write.insertInto(self.name)
        return new


def digests(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the SHA-256 of each whole text in UTF-8; null counts as empty."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.unhex(F.sha2(clean_text().cast("binary"), 256)).alias("digest"))


def exact_dedup(arrivals: list[DataFrame], index: DigestIndex) -> DataFrame:
    """Admit batches of ``(doc_id, digest)`` in order; one row per document with the row that stays.

    Columns: doc_id, keep_id, group_size, kept, text_sha256. A digest admitted
    by an earlier batch wins over later ones; within a batch the largest doc_id
    wins. A row without doc_id never stays beside one that has it; where all of
    a group lack it, keep_id is null and all are kept. Repeated rows share their
    doc_id, so they agree on ``kept``. Empty tables give an empty result.
    """
    for batch in arrivals:
        index.admit(batch)
    rows = arrivals[0]
    for batch in arrivals[1:]:
        rows = rows.unionByName(batch)
    groups = saved(rows.groupBy("digest").agg(F.count("*").alias("group_size"))
                   .join(index.rows().hint("merge"), "digest"), "digest-groups")
    return rows.join(groups, "digest").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in two loads, the upper half of the doc_id range first, so the largest doc_id of a group stays."""
    rows = saved(digests(table(spark, sf_dir, "documents")), "digests")
    low, high, n = scalar(rows, F.min("doc_id"), F.max("doc_id"), F.count("*"))
    middle = ((low or 0) + (high or 0) + 1) // 2
    newest = F.coalesce(F.col("doc_id") >= middle, F.lit(False))
    index = DigestIndex(spark, scratch_path(spark, "digest-index"), buckets_for(n))
    try:
        return exact_dedup([rows.where(newest), rows.where(~newest)], index)
    finally:    # the result reads the groups, not the index
        index.close(files=True)


OP3_SQL = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""
