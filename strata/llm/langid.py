"""Language identification by compression (operator 12).

Every language has a zstandard dictionary of raw content, text of that language
and nothing trained. A text is encoded with each of them; the dictionary that
leaves the fewest bytes names the language. Learning reads a bounded sample,
prediction every whole text.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import batches_of, clean_text, table

#: The sample: languages at most (the most frequent), different texts of each, and characters from a place in each text.
MOST_LANGUAGES = 512
TEXTS = 1024
PIECE = 256

#: Compression level, and bytes encoded at once (a dictionary reaches all of such a block).
LEVEL = 6
BLOCK = 1 << 14

#: A prediction whose lead over the next language is a smaller share of that one's bytes is rejected.
MIN_MARGIN = 0.01

UNKNOWN = "und"
WORD = re.compile(r"[^\W\d_]+")


def spelled(text: str) -> bytes:
    """What is encoded: letter runs in lower case, one space apart; empty if there is no letter."""
    words = WORD.findall(text.lower())
    if not any(c.isalpha() for w in words for c in w):
        return b""
    return " ".join(words).encode("utf-8", "replace")


@dataclass(frozen=True)
class Dictionaries:
    """Languages, the most frequent first, and the raw content of each."""

    languages: tuple[str, ...]
    contents: tuple[bytes, ...]

    def encoders(self) -> list:
        out = []
        for content in self.contents:
            held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            how = zstandard.ZstdCompressionParameters.from_level(
                LEVEL, source_size=BLOCK, dict_size=len(content), write_content_size=False, write_dict_id=False)
            held.precompute_compress(compression_params=how)
            out.append(zstandard.ZstdCompressor(dict_data=held, compression_params=how).compress)
        return out


def predict(text: str, languages: tuple[str, ...], encoders: list) -> tuple[str, float]:
    """``(language, score)``: the score is the lead over the next language as a share of that one's bytes.

    Equal sizes go to the more frequent language. With a single language the score is 1."""
    raw = spelled(text)
    if not raw or not encoders:
        return UNKNOWN, 0.0
    blocks = [raw[at:at + BLOCK] for at in range(0, len(raw), BLOCK)]
    sizes = [sum(len(encode(b)) for b in blocks) for encode in encoders]
    best = min(range(len(sizes)), key=sizes.__getitem__)
    rest = [s for i, s in enumerate(sizes) if i != best]
    return languages[best], 1 - sizes[best] / min(rest) if rest else 1.0


def learn(labelled: DataFrame, texts: int = TEXTS, piece: int = PIECE, most: int = MOST_LANGUAGES) -> Dictionaries:
    """``text, lang`` -> dictionaries, from ``texts`` different texts of a language, ``piece`` characters of each.

    Rows without text or lang teach nothing. The sample is bounded by the three
    parameters and is all that reaches the driver (128 MB of characters at the
    most, one MB for four languages). Texts are chosen by their hash: copies
    count once, and the same rows give the same dictionaries however they are
    partitioned. Beyond ``most`` languages the rarest aren't learned."""
    known = (labelled.select(F.col("lang").cast("string").alias("lang"), clean_text().alias("text"))
             .where("lang IS NOT NULL AND text <> ''")
             .withColumn("order", F.xxhash64("text")))
    counted = (known.groupBy("lang").agg(F.approx_count_distinct("order").alias("n"))
               .orderBy(F.desc("n"), "lang").limit(most).collect())
    if not counted:
        return Dictionaries((), ())
    # about twice the texts wanted pass by their hash alone, so that ordering them is a small task
    share = labelled.sparkSession.createDataFrame(
        [(r["lang"], min(1.0, 2 * texts / max(1, r["n"]))) for r in counted], "lang string, share double")
    passed = known.join(F.broadcast(share), "lang").where(F.pmod("order", F.lit(1 << 31)) < F.col("share") * (1 << 31))
    start = F.pmod(F.xxhash64("order"), F.greatest(F.lit(1), F.length("text") - piece + 1)).cast("int") + 1
    pieces = passed.select("lang", "order", F.substring("text", start, F.lit(piece)).alias("piece"))
    kept = (pieces.groupBy("lang", "order").agg(F.min("piece").alias("piece"))
            .withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("order", "piece")))
            .where(F.col("n") <= texts).orderBy("lang", "n").collect())
    content = {r["lang"]: [] for r in counted}
    for r in kept:
        content[r["lang"]].append(spelled(r["piece"]))
    taught = {lang: b" ".join(p for p in parts if p) for lang, parts in content.items()}
    languages = tuple(lang for lang, raw in taught.items() if raw)
    return Dictionaries(languages, tuple(taught[lang] for lang in languages))


def _predictions(model: Dictionaries, min_margin: float):
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()),
                        ("score", pa.float64()), ("rejected", pa.bool_())])

    def task(batches):
        encoders = model.encoders()

        def rows():
            for batch in batches:
                for doc_id, held_out, text in zip(*batch.columns):
                    lang, score = predict(text.as_py(), model.languages, encoders)
                    yield doc_id.as_py(), held_out.as_py(), lang, score, score < min_margin

        yield from batches_of(rows(), schema)

    return task


def held_out():
    """The fold that teaches nothing: doc_id's text (null: empty) has a CRC that 5 divides."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 0


def identify(docs: DataFrame, model: Dictionaries, min_margin: float = MIN_MARGIN) -> DataFrame:
    """``doc_id, text`` -> one row per row: doc_id, held_out, lang_pred, score, rejected.

    Null and empty texts and those without a letter are ``und`` with score 0, as
    is everything if no language was learned. Texts of any length are read
    whole, block by block; repeated rows appear each; columns of other names
    aren't read. ``rejected``: the margin is narrower than ``min_margin``."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), clean_text().alias("text")).mapInArrow(
        _predictions(model, min_margin), "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")


def op12_zstd_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of all documents, learned from the four folds that aren't held out."""
    docs = table(spark, sf_dir, "documents")
    return identify(docs, learn(docs.where(~held_out())))
