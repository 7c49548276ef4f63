"""A training corpus from ``documents``: quality, line and near-duplicate filters, mixing, packing.

Every stage takes ``(spark, docs, sf_dir)``, works on all rows it is given, and
all but the last return the columns of ``documents``. Rows are told apart by
doc_id and a hash of their text; rows equal in both count as one document from
the near-duplicate stage on. Null and empty texts pass the quality and line
stages, link with nothing in the near-duplicate stage, and leave in the mix,
which takes words. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import clean_text, delete, saved, scratch, table
from strata.llm.line_dedup import drop_recurring_lines
from strata.llm.minhash import near_duplicates
from strata.llm.mixing import mix, sized
from strata.llm.packing import pack, tokenizer_path
from strata.llm.quality import classify, perplexities, trusted_ids


def _keyed(docs: DataFrame) -> DataFrame:
    """The rows whole, so that no name of theirs meets one of ours, with what tells them apart."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.col("doc_id").cast("long").alias("id"), F.xxhash64(clean_text()).alias("key"))


def _chosen(keyed: DataFrame, decisions: DataFrame) -> DataFrame:
    """Keyed rows that ``decisions`` (doc_id, text_key, unique) names, with its other columns."""
    same = F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("key") == F.col("text_key"))
    return keyed.join(decisions, same).drop("doc_id", "text_key")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the Kneser-Ney model of trusted text doesn't reject (operator 1)."""
    scores = classify(perplexities(docs, trusted_ids(table(spark, sf_dir, "labels"))))
    kept = scores.groupBy("doc_id", "text_key").agg(F.min("kept").alias("kept")).where("kept")
    return _chosen(_keyed(docs), kept).select("row.*")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without recurring lines (operator 5); ``n_chars`` follows the text."""
    out = drop_recurring_lines(docs)
    if "n_chars" in docs.columns:
        n_chars = F.when(F.col("n_dropped") > 0, F.length("text")).otherwise(F.col("n_chars"))
        out = out.withColumn("n_chars", n_chars.cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, five-word shingles, similarity 0.8 (operator 10)."""
    kept = near_duplicates(docs).where("kept").select("doc_id", "text_key").distinct()
    return _chosen(_keyed(docs), kept).dropDuplicates(["id", "key"]).select("row.*")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the amounts of the source mix (operator 7).

    A reading of a document stays whole if the mix takes half of its words or
    more; a document read twice appears twice."""
    pieces = mix(saved(sized(docs), "mix-sizes"))
    readings = (pieces.groupBy("_row", "doc_id", "text_key", "size", "epoch").agg(F.sum("length").alias("taken"))
                .where("taken > 0 AND 2 * taken >= size"))
    copies = readings.groupBy("doc_id", "text_key").agg(F.count("*").cast("int").alias("copies"))
    chosen = _chosen(_keyed(docs).dropDuplicates(["id", "key"]), copies)
    return chosen.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of 4096 (operator 9): one row per piece, its ids as unsigned 32-bit."""
    return pack(docs, tokenizer_path())


STAGES = [("quality", quality), ("line_dedup", lines), ("near_duplicates", near_copies), ("mixing", mixed),
          ("packing", packed)]

#: SQL can't express the language model or the tokenizer; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs, last = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        with scratch(spark) as keep:
            docs = keep(saved(stage(spark, docs, sf_dir), f"pipeline-{name}"))
        if last:
            delete(spark, last)     # the stage before has been read for the last time
        last = docs.scratch_folder
    return STAGES[-1][1](spark, docs, sf_dir)
