"""Mixing sources to target weights by a low-discrepancy schedule.

``2**m`` slots of equal words are laid out by the van der Corput sequence: its
points ``j / 2**m`` fall through the cumulative target weights, so a source owns
a run of ``j`` and its slots are the bit reversals, spread evenly in time. Slots
are ranked per source, and the r-th slot takes the r-th equal-token block of the
source's shuffled documents, read at most twice over.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import clean_text, saved, scalar, table

WEIGHTS = (5, 2, 1)       # by source in code-point order, null last, repeating
SHARE, EPOCHS = 1.5, 2    # words the mix takes over all words; most readings of a source
LEAST_BLOCK = 16          # words of a slot: so many to twice as many, however large the mix
MOST_TASKS = 1 << 14      # tasks that make the schedule
CHUNK_ROWS = 4096         # documents of a (source, chunk) aimed at if one source held all rows
WORDS = r"[^\x20\x09-\x0D]+"


def sized(docs: DataFrame, seed: int = 7) -> DataFrame:
    """``doc_id, source, size, text_key`` and the hash that orders a source's documents."""
    key = F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))))
    return docs.select("doc_id", "source", key.alias("_k"), F.xxhash64(clean_text()).alias("text_key"),
                       F.coalesce(F.regexp_count("text", F.lit(WORDS)), F.lit(0)).cast("long").alias("size"))


def targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """``source, source_size`` -> also ``target`` and the cumulative share ``lo`` to ``hi``.

    Targets stop at ``epochs`` times the source's size and the excess goes to the
    others by weight: ordered by size / weight, sources are capped up to a water
    level that the first uncapped one sets. One row per source throughout."""
    order = Window.orderBy(F.col("source").isNull(), "source")
    everything = Window.partitionBy(F.lit(0))
    nth = (F.row_number().over(order) - 1) % len(weights)
    s = (sources.withColumn("_w", F.element_at(F.array(*map(F.lit, weights)), (nth + 1).cast("int")).cast("long"))
         .withColumn("_cap", epochs * F.col("source_size"))
         .withColumn("_all", F.sum("source_size").over(everything) * F.lit(float(share))))
    fill = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").isNull(), "source")
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    s = (s.withColumn("_capped", F.coalesce(F.sum("_cap").over(before), F.lit(0)))
         .withColumn("_rest", F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(before), F.lit(0)))
         .withColumn("_level", (F.col("_all") - F.col("_capped")) / F.col("_rest")))
    free = F.col("_level") * F.col("_w") <= F.col("_cap")
    s = s.withColumn("_level", F.max(F.when(free, F.struct(-F.col("_capped"), F.col("_level")))).over(everything)["_level"])
    over = F.coalesce(F.col("_level") * F.col("_w") > F.col("_cap"), F.lit(True))
    s = (s.withColumn("target", F.when(over, F.col("_cap").cast("double")).otherwise(F.col("_level") * F.col("_w")))
         .withColumn("_c", F.when(over, F.col("_cap")).otherwise(0)).withColumn("_f", F.when(over, 0).otherwise(F.col("_w"))))
    to = order.rowsBetween(Window.unboundedPreceding, 0)

    def part(w):  # of all words, up to and with the sources of w; capped and free ones are summed as integers
        some = F.sum("_c").over(w) + F.coalesce(F.col("_level"), F.lit(0.0)) * F.sum("_f").over(w)
        return F.coalesce(F.try_divide(some, F.col("_all")), F.lit(0.0))

    last = F.row_number().over(order) == F.count("*").over(everything)
    return (s.withColumn("lo", part(order.rowsBetween(Window.unboundedPreceding, -1)))
            .withColumn("hi", F.when(last, F.lit(1.0)).otherwise(part(to)))
            .select("source", "source_size", "target", "lo", "hi"))


def mix(rows: DataFrame, weights=WEIGHTS, share: float = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """``sized`` rows -> the pieces of the mix in schedule order, and documents it leaves out.

    One row per piece: slot, doc_id, text_key, source, size, source_size, target, start
    and length (words of the document), epoch; ``slot`` is null with length 0
    for a document that the mix doesn't take. ``_row`` names the input row, so
    repeated rows and null or repeated doc_ids stay apart. A null source is a
    source of its own. Documents without words are never taken; if no document
    has words, no slot exists. An empty table gives an empty result.
    """
    n, total = scalar(rows, F.count("*"), F.sum("size"))
    total = total or 0
    words = share * total
    m = int(math.log2(max(1.0, words / LEAST_BLOCK)))
    slots, step = 1 << m, max(words, 1.0) / (1 << m)
    bits = max(4, min(28, math.ceil(math.log2(max(1, n / CHUNK_ROWS)))))

    rows = (rows.withColumn("_src", F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("-")))
            .withColumn("_chunk", F.shiftright(F.conv(F.substring("_k", 1, 8), 16, 10).cast("long"), 32 - bits)))
    # A chunk is a prefix of the order hash: sums run within (source, chunk) cells, then over a source's cells.
    cells = rows.groupBy("_src", "source", "_chunk").agg(F.sum("size").alias("_size"))
    prior = Window.partitionBy("_src").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    by_source = targets(cells.groupBy("_src", "source").agg(F.sum("_size").alias("source_size"))
                        .select("source", "source_size"), weights, share, epochs)
    by_source = saved(by_source.withColumn("_src", F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("-")))
                      .withColumn("_j0", F.ceil(F.col("lo") * slots)).withColumn("_j1", F.ceil(F.col("hi") * slots))
                      .withColumn("_n", F.when(F.col("source_size") > 0, F.greatest(F.col("_j1") - F.col("_j0"), F.lit(0)))
                                  .otherwise(0)), "mix-sources")
    offsets = (cells.withColumn("_offset", F.coalesce(F.sum("_size").over(prior), F.lit(0)))
               .join(by_source.drop("source"), "_src").select("_src", "_chunk", "_offset", "source_size", "target", "_n"))

    place = Window.partitionBy("_src", "_chunk").orderBy("_k", "doc_id", "size", "text_key")
    docs = (rows.withColumn("_in", F.coalesce(F.sum("size").over(place.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
            .withColumn("_ord", F.row_number().over(place))
            .join(offsets, ["_src", "_chunk"]))
    bound = lambda b: F.floor(b * F.lit(step))

    def block_at(t):  # the block that holds word t of the repeated stream
        b = F.floor(t / F.lit(step))
        return b + F.when(bound(b + 1) <= t, 1).when(bound(b) > t, -1).otherwise(0)

    epoch = F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))).alias("epoch")
    docs = docs.select("*", epoch).withColumn("_a", F.col("epoch") * F.col("source_size") + F.col("_offset") + F.col("_in"))
    reach = F.least(block_at(F.col("_a") + F.col("size") - 1), F.col("_n") - 1)
    blocks = F.when((F.col("size") > 0) & (block_at(F.col("_a")) <= reach), F.sequence(block_at(F.col("_a")), reach))
    pieces = docs.select("doc_id", "text_key", "source", "size", "source_size", "target", "epoch", "_src", "_a",
                         F.struct("_src", "_chunk", "_ord").alias("_row"), F.explode_outer(blocks).alias("_rank"))
    first = F.greatest(bound(F.col("_rank")), F.col("_a"))
    last = F.least(bound(F.col("_rank") + 1), F.col("_a") + F.col("size"))
    pieces = (pieces.withColumn("start", F.when(F.col("_rank").isNull(), 0).otherwise(first - F.col("_a")))
              .withColumn("length", F.when(F.col("_rank").isNull(), 0).otherwise(last - first)))
    # Spark takes the schedule for as small as the source table it grows from, and would broadcast it
    placed = pieces.join(_schedule(by_source, m).hint("merge"), ["_src", "_rank"], "left")
    return placed.select("slot", "doc_id", "text_key", "source", "size", "source_size", "target", "epoch", "start", "length", "_row")


def _schedule(by_source: DataFrame, m: int) -> DataFrame:
    """``_src, _rank, slot``: every source's slots in time order, ranked from 0."""
    part = m // 2    # a cell is 2**part slots in time or values of j: cells and their slots grow alike
    width = 1 << part
    runs = by_source.where("_n > 0").select("_src", "_j0", "_j1", F.explode(
        F.sequence(F.floor(F.col("_j0") / width), F.floor((F.col("_j1") - 1) / width))).alias("_c"))
    runs = runs.repartition(max(1, min(1 << m >> 14, MOST_TASKS)), "_src", "_c")   # a large source's slots are made by many tasks
    j = F.explode(F.sequence(F.greatest("_j0", F.col("_c") * width),
                             F.least("_j1", (F.col("_c") + 1) * width) - 1)).alias("_j")
    slot = F.conv(F.reverse(F.lpad(F.bin("_j"), max(1, m), "0")), 2, 10).cast("long") if m else F.lit(0).cast("long")
    slots = runs.select("_src", j).select("_src", slot.alias("slot")).withColumn("_cell", F.shiftright("slot", part))
    prior = Window.partitionBy("_src").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    counts = slots.groupBy("_src", "_cell").agg(F.count("*").alias("_count"))
    counts = counts.select("_src", "_cell", F.coalesce(F.sum("_count").over(prior), F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy("_src", "_cell").orderBy("slot")) - 1
    return (slots.withColumn("_within", within).join(counts.hint("merge"), ["_src", "_cell"])
            .select("_src", (F.col("_before") + F.col("_within")).alias("_rank"), "slot"))


def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the words that the mix takes from each."""
    pieces = mix(saved(sized(table(spark, sf_dir, "documents")), "mix-sizes"))
    return (pieces.groupBy("_row", "doc_id", "size", "source_size", "target").agg(F.sum("length").alias("taken"))
            .select("doc_id", "size", "source_size", "target", "taken"))


OP7_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
         md5('7|' || coalesce(doc_id::VARCHAR, '-')) AS k FROM documents
), t AS (SELECT 1.5::DOUBLE * sum(size)::DOUBLE AS words FROM d
), p AS (SELECT words, greatest(0, least(20, floor(log2(greatest(1.0, words / 16)))))::BIGINT AS m FROM t
), g AS (SELECT words, (1::BIGINT << m) AS slots, greatest(words, 1.0) / (1::BIGINT << m)::DOUBLE AS step FROM p
), s0 AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source IS NULL, source) AS rn
  FROM d GROUP BY source
), s1 AS (
  SELECT *, (CASE (rn - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END)::BIGINT AS w, 2 * source_size AS cap FROM s0
), s2 AS (
  SELECT *, coalesce(sum(cap) OVER b, 0)::BIGINT AS capped, (sum(w) OVER () - coalesce(sum(w) OVER b, 0))::BIGINT AS rest
  FROM s1 WINDOW b AS (ORDER BY cap / w, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), s3 AS (SELECT s2.*, words, slots, step, (words - capped) / rest AS lev FROM s2, g
), lv AS (SELECT arg_min(lev, capped) AS level FROM s3 WHERE lev * w <= cap
), s4 AS (
  SELECT s3.*, level, CASE WHEN coalesce(level * w > cap, true) THEN cap ELSE 0 END AS c,
         CASE WHEN coalesce(level * w > cap, true) THEN 0 ELSE w END AS f FROM s3, lv
), s5 AS (
  SELECT *, CASE WHEN f = 0 THEN cap::DOUBLE ELSE level * w END AS target,
         coalesce(sum(c) OVER b + coalesce(level, 0) * sum(f) OVER b, 0.0) / words AS lo,
         CASE WHEN rn = count(*) OVER () THEN 1.0::DOUBLE
              ELSE coalesce(sum(c) OVER a + coalesce(level, 0) * sum(f) OVER a, 0.0) / words END AS hi
  FROM s4 WINDOW b AS (ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                 a AS (ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
), s6 AS (
  SELECT source, source_size, target,
         least(floor((ceil(hi * slots) - ceil(lo * slots)) * step), 2 * source_size)::BIGINT AS reach FROM s5
), o AS (
  SELECT d.doc_id, d.size, s6.source_size, s6.target, reach,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id, size
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS a
  FROM d JOIN s6 ON d.source IS NOT DISTINCT FROM s6.source
)
SELECT doc_id, size, source_size, target,
       (least(size, greatest(0, reach - a)) + least(size, greatest(0, reach - source_size - a)))::BIGINT AS taken
FROM o
"""
