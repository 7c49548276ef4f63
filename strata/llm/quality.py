"""Quality classifier: an interpolated modified Kneser-Ney model of trusted text.

The model predicts the characters of a word from the four before them. Text is
read once into blocks (tens of MB: distinct words, and the documents as word
numbers). Each block names its distinct 5-grams and how often its trusted
documents hold them; the counts of all orders are joined, hash-sharded by
n-gram, into one log-probability per 5-gram, and each block gets its own back.
So shuffles carry a block's distinct n-grams and never its text or tokens.

Documents fall into folds by a hash of doc_id. A fold is scored by the model of
the trusted text in the other folds, so trusted text is as new to its model as
any other, and limits drawn from its scores hold for all documents.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import batches_of, clean_text, fresh, saved, scalar, scratch, table

ORDER, FOLDS = 5, 2
START, END = "\x02", "\x03"
#: A block ends after so many bytes of text.
BLOCK_BYTES = 32 << 20
#: Spark's own limit of a table's buckets.
MOST_BUCKETS = 100_000
#: Symbols at the language's mean that are added to every document, so that short ones don't swing.
PRIOR = 64
#: A language's limit: its trusted median plus MARGIN times the way from there to its trusted QUANTILE.
QUANTILE, MARGIN = 0.99, 1.5
#: Trusted documents of a language for figures of its own.
LEAST_TRUSTED = 30

BLOCKS = ("block long, doc_ids array<long>, keys array<long>, langs array<string>, folds array<int>, ends array<long>, "
          "words array<string>, codes binary")


class _Numbers(dict):
    """Numbers words in order of appearance."""

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self)
        return n


def _block_task(block_bytes: int):
    schema = pa.schema([("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("keys", pa.list_(pa.int64())),
                        ("langs", pa.list_(pa.string())), ("folds", pa.list_(pa.int32())),
                        ("ends", pa.list_(pa.int64())), ("words", pa.list_(pa.string())), ("codes", pa.binary())])

    def task(batches):
        part, made = TaskContext.get().partitionId(), 0

        def block(docs, numbers, codes):
            nonlocal made
            made += 1
            ids, keys, langs, folds = zip(*docs)
            ends = np.cumsum([len(c) for c in codes]).tolist()
            row = ((part << 32) + made, ids, keys, langs, folds, ends, list(numbers), packed(np.concatenate(codes)))
            return pa.RecordBatch.from_arrays([pa.array([v], type=f.type) for v, f in zip(row, schema)], schema=schema)

        docs, numbers, codes, held = [], _Numbers(), [], 0
        for batch in batches:
            for doc_id, key, lang, fold, text in zip(*(batch.column(i).to_pylist() for i in range(4)), batch.column(4)):
                text = text.as_py()
                words = text.split()
                docs.append((doc_id, key, lang, fold))
                codes.append(np.sort(np.fromiter(map(numbers.__getitem__, words), dtype="<i4", count=len(words))))
                held += len(text)
                if held >= block_bytes:
                    yield block(docs, numbers, codes)
                    docs, numbers, codes, held = [], _Numbers(), [], 0
        if docs:
            yield block(docs, numbers, codes)

    return task


def word_grams(word: str, order: int = ORDER) -> list[str]:
    """The n-gram that ends in each character of the word, and in its end."""
    padded = START * (order - 1) + word + END
    return [padded[i:i + order] for i in range(len(word) + 1)]


def spelled(words: list[str], order: int = ORDER, part: int = 1 << 16) -> tuple[list[str], np.ndarray, np.ndarray]:
    """``word_grams`` of all words at once: distinct n-grams, the number of each word's n-grams in
    a row, and where each word's begin. Words are taken ``part`` at a time to bound the arrays."""
    lengths = np.array([len(w) + 1 for w in words], dtype=np.int64)
    names, numbers, at = _Numbers(), np.empty(lengths.sum(), dtype=np.int32), 0
    for i in range(0, len(words), part):
        found, own = _spell(words[i:i + part], lengths[i:i + part], order)
        known = np.fromiter(map(names.__getitem__, found), dtype=np.int32, count=len(found))
        numbers[at:at + len(own)] = known[own]
        at += len(own)
    return list(names), numbers, np.cumsum(lengths) - lengths


def _spell(words: list[str], lengths: np.ndarray, order: int) -> tuple[list[str], np.ndarray]:
    pad = START * (order - 1)
    text = "".join([pad + w + END for w in words])
    # a word's n-grams end at its characters and its end: all places but those of its padding
    places = np.arange(lengths.sum()) + np.repeat(np.arange(1, len(words) + 1) * (order - 1), lengths)
    symbols, ids = np.unique(np.frombuffer(text.encode("utf-32-le"), dtype="<u4"), return_inverse=True)
    keys = np.zeros(len(places), dtype=np.int64)
    for k in range(order - 1, -1, -1):
        if int(keys.max()) >= 2**62 // len(symbols):
            keys = np.unique(keys, return_inverse=True)[1]
        keys = keys * len(symbols) + ids[places - k]
    _, first, numbers = np.unique(keys, return_index=True, return_inverse=True)
    return [text[p - order + 1:p + 1] for p in places[first].tolist()], numbers


def packed(codes: np.ndarray) -> bytes:
    """Word numbers, sorted within each document, as compressed byte planes of their differences."""
    steps = np.diff(codes, prepend=np.int32(0)).astype("<i4")
    return zstandard.ZstdCompressor(level=3).compress(steps.view(np.uint8).reshape(-1, 4).T.tobytes())


def unpacked(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), dtype=np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<i4").ravel(), dtype=np.int32)


def _blocks(batches):
    """Block rows one at a time, so that a batch of several is never unpacked whole."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(name)[i] for name in batch.schema.names}


def _gram_task(order: int, folds: int, part: int = 50_000):
    """``block, words, codes, ends, folds, trusted`` -> the block's distinct n-grams, numbered as
    ``spelled`` does, with the counts of each fold's trusted text."""
    schema = pa.schema([("block", pa.int64()), ("i", pa.int32()), ("gram", pa.string()),
                        *[(f"n{f}", pa.int64()) for f in range(folds)]])

    def task(batches):
        for row in _blocks(batches):
            words, codes = row["words"].as_py(), unpacked(row["codes"].as_py())
            bounds, fold = [0, *row["ends"].as_py()], row["folds"].as_py()
            own = np.full(len(codes), -1, dtype=np.int8)
            for i in row["trusted"].as_py() or ():
                own[bounds[i]:bounds[i + 1]] = fold[i]
            counts = [np.bincount(codes[own == f], minlength=len(words)) for f in range(folds)]
            del codes, own
            names, numbers, begins = spelled(words, order)
            lengths = np.diff(begins, append=len(numbers))
            totals = [np.bincount(numbers, np.repeat(c, lengths), minlength=len(names)).astype(np.int64) for c in counts]
            for a in range(0, len(names), part):
                some = names[a:a + part]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(some), row["block"].as_py())), pa.array(np.arange(a, a + len(some), dtype=np.int32)),
                     pa.array(some, type=pa.string()), *[pa.array(t[a:a + part]) for t in totals]], schema=schema)

    return task


def _score_task(order: int, folds: int):
    """Blocks with the log-probabilities of their n-grams by number -> ``doc_id, text_key, lang, symbols, nll``."""
    schema = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("lang", pa.string()),
                        ("symbols", pa.int64()), ("nll", pa.float64())])

    def task(batches):
        def rows():
            for row in _blocks(batches):
                words = row["words"].as_py()
                size = np.array([len(w) + 1 for w in words], dtype=np.int64)
                _, numbers, begins = spelled(words, order)
                del words
                nll = [-np.add.reduceat(row[f"l{f}"].values.to_numpy().astype(np.float64)[numbers], begins) if len(size) else np.empty(0)
                       for f in range(folds)]
                codes, a = unpacked(row["codes"].as_py()), 0
                for doc_id, key, lang, f, b in zip(*(row[c].as_py() for c in ("doc_ids", "keys", "langs", "folds", "ends"))):
                    own = codes[a:b]
                    yield doc_id, key, lang, int(size[own].sum()), float(nll[f][own].sum())
                    a = b

        yield from batches_of(rows(), schema)

    return task


def kneser_ney(counts: DataFrame, needed: DataFrame, order: int = ORDER, folds: int = FOLDS) -> DataFrame:
    """``fold, gram, n`` counts of the highest order and ``gram`` to score -> ``fold, gram, p``, a model for each fold.

    Lower orders count the distinct symbols that precede an n-gram. Discounts
    for counts 1, 2 and 3 or more come from the counts of counts, a few numbers
    for each order. A gram never seen takes its probability from lower orders,
    the lowest being uniform over the symbols seen and one unseen."""
    by_order = {order: counts.select("fold", "gram", "n")}
    for k in range(order - 1, 0, -1):
        by_order[k] = saved(by_order[k + 1].groupBy("fold", F.substring("gram", 2, k).alias("gram"))
                            .agg(F.count("*").alias("n")), f"kn-order-{k}")
    spread = None
    for k, c in by_order.items():
        row = c.groupBy("fold").agg(F.lit(k).alias("k"), F.count("*").alias("types"),
                                    *[F.count_if(F.col("n") == i).alias(f"n{i}") for i in (1, 2, 3, 4)])
        spread = row if spread is None else spread.union(row)
    stats = {(r["fold"], r["k"]): r for r in spread.collect()}

    def of_fold(values):
        return F.element_at(F.array(*[F.lit(float(v)) for v in values]), F.col("fold") + 1)

    def spell(k):
        grams = needed if k == order else needed.select(F.substring("gram", order - k + 1, k).alias("gram")).distinct()
        return grams.withColumn("fold", F.explode(F.array(*map(F.lit, range(folds)))))

    unseen = [1.0 / ((stats[f, 1]["types"] if (f, 1) in stats else 0) + 1) for f in range(folds)]
    p = spell(1).select("fold", F.lit("").alias("gram"), of_fold(unseen).alias("p")).distinct()
    for k in range(1, order + 1):
        d = [discounts(*(stats[f, k][f"n{i}"] for i in (1, 2, 3, 4))) if (f, k) in stats else (0.5, 0.5, 0.5)
             for f in range(folds)]
        off = F.when(F.col("n") == 1, of_fold(x[0] for x in d)).when(
            F.col("n") == 2, of_fold(x[1] for x in d)).otherwise(of_fold(x[2] for x in d))
        context = F.substring("gram", 1, k - 1) if k > 1 else F.lit("")
        level = by_order[k].select("fold", "gram", "n", (F.col("n") - off).alias("rest"), off.alias("off"))
        contexts = level.groupBy("fold", context.alias("context")).agg(F.sum("n").alias("total"), F.sum("off").alias("held"))
        want = spell(k).withColumn("context", context).withColumn("tail", F.substring("gram", 2, k - 1) if k > 1 else F.lit(""))
        lower = p.select("fold", F.col("gram").alias("tail"), F.col("p").alias("below"))
        own = F.greatest(F.coalesce("rest", F.lit(0.0)), F.lit(0.0))
        p = saved(want.join(lower, ["fold", "tail"]).join(level.select("fold", "gram", "rest"), ["fold", "gram"], "left")
                  .join(contexts, ["fold", "context"], "left")
                  .select("fold", "gram", F.coalesce((own + F.col("held") * F.col("below")) / F.col("total"),
                                                     F.col("below")).alias("p")), f"kn-p-{k}")
    return p


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts from counts of counts; absent ones fall back to a plain half."""
    if not n1 or not n2:
        return 0.5, 0.5, 0.5
    y = n1 / (n1 + 2 * n2)
    d1, d2 = 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2
    d3 = 3 - 4 * y * n4 / n3 if n3 else d2
    return min(max(d1, 0.05), 0.95), min(max(d2, 0.05), 1.95), min(max(d3, 0.05), 2.95)


def perplexities(docs: DataFrame, trusted: DataFrame, order: int = ORDER, folds: int = FOLDS,
                 block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id, text, lang`` and the doc_ids of trusted text -> one row per document.

    Columns: doc_id, text_key (hash of the text), lang, trusted, symbols, nll.
    Null and empty texts have 0 symbols. Rows without doc_id are scored and never
    trusted; repeated rows are scored each. Without trusted text every symbol has
    the same probability. An empty table gives no rows."""
    spark = docs.sparkSession
    (total,) = scalar(docs, F.sum(F.octet_length(clean_text()).cast("long")))
    # with fewer buckets than shuffle partitions Spark would move the blocks after all
    buckets = min(MOST_BUCKETS, max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-(total or 0) // block_bytes)))
    with scratch(spark) as keep:
        path = fresh(spark, "kn-blocks")
        name = "strata_kn_" + hashlib.md5(path.encode()).hexdigest()[:16]
        rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(clean_text()).alias("key"),
                           F.col("lang").cast("string").alias("lang"),
                           F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(folds)).cast("int").alias("fold"),
                           clean_text().alias("text"))
        (rows.mapInArrow(_block_task(block_bytes), BLOCKS)
         .write.bucketBy(buckets, "block").option("path", path).saveAsTable(name))
        blocks = spark.table(name)   # bucketed by block, so what joins it is moved and the blocks are not

        placed = blocks.select("block", F.posexplode("doc_ids").alias("at", "doc_id"))
        ids = trusted.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id IS NOT NULL").distinct()
        chosen = saved(placed.join(ids, "doc_id").select("block", "at", "doc_id"), "kn-trusted")
        flags = chosen.groupBy("block").agg(F.collect_list("at").alias("trusted"))
        grams = saved(blocks.select("block", "words", "codes", "ends", "folds").join(flags, "block", "left")
                      .select("block", "words", "codes", "ends", "folds", "trusted")
                      .mapInArrow(_gram_task(order, folds), "block long, i int, gram string" + "".join(f", n{f} long" for f in range(folds))),
                      "kn-grams")
        totals = saved(grams.groupBy("gram").agg(*[F.sum(f"n{f}").alias(f"n{f}") for f in range(folds)]), "kn-counts")
        everything = sum((F.col(f"n{f}") for f in range(folds)), F.lit(0))
        sums = [n or 0 for n in scalar(totals, *[F.sum(f"n{f}") for f in range(folds)])]
        # a fold that holds all trusted text is scored by its own model
        others = F.array(*[F.struct(F.lit(f).alias("fold"), (everything - (F.col(f"n{f}") if sums[f] < sum(sums) else 0))
                                    .alias("n")) for f in range(folds)])
        counts = saved(totals.select("gram", F.explode(others).alias("m")).select("m.fold", "gram", "m.n").where("n > 0"),
                       "kn-fold-counts")
        p = kneser_ney(counts, totals.select("gram"), order, folds)
        logs = p.groupBy("gram").agg(*[F.max(F.when(F.col("fold") == f, F.log("p"))).cast("float").alias(f"l{f}")
                                      for f in range(folds)])
        fields = [f"l{f}" for f in range(folds)]
        own = (grams.select("block", "i", "gram").join(saved(logs, "kn-logs"), "gram")
               .groupBy("block").agg(F.array_sort(F.collect_list(F.struct("i", *fields))).alias("g"))
               .select("block", *[F.col(f"g.{f}").alias(f) for f in fields]))
        columns = ["doc_ids", "keys", "langs", "folds", "ends", "words", "codes", *fields]
        scored = keep(saved(blocks.join(own, "block", "left").select(*columns)
                       .mapInArrow(_score_task(order, folds), "doc_id long, text_key long, lang string, symbols long, nll double"),
                       "kn-scores"))
        spark.sql(f"DROP TABLE {name}")
    return scored.join(ids.withColumn("trusted", F.lit(True)), "doc_id", "left").withColumn(
        "trusted", F.coalesce("trusted", F.lit(False)))


def classify(scores: DataFrame, quantile: float = QUANTILE, margin: float = MARGIN, prior: int = PRIOR) -> DataFrame:
    """Adds perplexity, score, threshold and kept to ``perplexities`` rows.

    ``score`` is the mean negative log-probability after ``prior`` symbols at the
    mean of the language's trusted text. A language with fewer than
    ``LEAST_TRUSTED`` trusted documents, null included, takes the figures of all. A document is kept unless
    its score lies over the threshold; one without words, and every document
    where nothing is trusted, is kept."""
    good = scores.where("trusted AND symbols > 0")
    means = (good.select("lang", "symbols", "nll").union(good.select(F.lit("*").alias("lang"), "symbols", "nll"))
             .groupBy("lang").agg((F.sum("nll") / F.sum("symbols")).alias("mean"), F.count("*").alias("texts"))
             .where((F.col("texts") >= LEAST_TRUSTED) | (F.col("lang") == "*")).drop("texts"))
    means = saved(means, "kn-means")
    score = (F.col("nll") + prior * F.col("mean")) / (F.col("symbols") + prior)
    at = [0.5, quantile]
    spread = (good.select("lang", "symbols", "nll").union(good.select(F.lit("*").alias("lang"), "symbols", "nll"))
              .join(means, "lang").groupBy("lang").agg(F.percentile_approx(score, at, 10_000).alias("q")))
    limits = saved(spread.select("lang", (F.col("q")[0] + margin * (F.col("q")[1] - F.col("q")[0])).alias("threshold"))
                   .join(means, "lang").withColumn("known", F.lit(True)), "kn-limits")
    found = (scores.join(limits.select("lang", "known").withColumnRenamed("known", "_known"), "lang", "left")
             .withColumn("_lang", F.when(F.col("_known"), F.col("lang")).otherwise(F.lit("*"))).drop("_known")
             .join(limits.select(F.col("lang").alias("_lang"), "threshold", "mean"), "_lang", "left"))
    return found.select(
        "doc_id", "text_key", "lang", "trusted", "symbols",
        F.when(F.col("symbols") > 0, F.exp(F.col("nll") / F.col("symbols"))).alias("perplexity"),
        score.alias("score"), "threshold",
        F.coalesce((F.col("symbols") == 0) | (score <= F.col("threshold")), F.lit(True)).alias("kept"))


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Documents labelled good and not toxic; null labels trust nothing."""
    return labels.where("quality = 1 AND toxic = 0").select("doc_id")


def op1_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, the model trained on all that are labelled good."""
    scores = perplexities(table(spark, sf_dir, "documents"), trusted_ids(table(spark, sf_dir, "labels")))
    return classify(scores).drop("text_key")
