"""Line de-duplication by a log-template tree.

A line falls through a tree of fixed depth: its number of tokens, then its
leading tokens, a token with a digit counting as a variable field. Where a leaf
holds several different lines, positions without a common token become fields
too, and lines close to that template belong to it. Lines whose template recurs
in many different texts are dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import clean_text, saved, scratch, table

TOKEN = r"[^\x20\x09-\x0D]+"
FIELD = "<*>"
#: Leading tokens of the tree, least part of a line's tokens that equal its template's.
LEADING, SIMILAR = 3, 0.7
#: Different texts in which a recurring template occurs, at least.
MIN_TEXTS = 10
#: A text with more than this part of its tokens in recurring lines is a copy, and left to near-duplicate removal.
MOST_DROPPED = 0.5


def tokens(line):
    """The line's tokens, those with a digit as variable fields."""
    found = F.regexp_extract_all(line, F.lit(TOKEN), F.lit(0))
    return F.when(line.rlike("[0-9]"),
                  F.transform(found, lambda t: F.when(t.rlike("[0-9]"), F.lit(FIELD)).otherwise(t))).otherwise(found)


def tree_lines(docs: DataFrame) -> DataFrame:
    """``text_key, at, tokens, n, leaf, line`` of every line that has tokens."""
    lines = docs.select(F.xxhash64(clean_text()).alias("text_key"),
                        F.posexplode(F.split(clean_text(), "\n", -1)).alias("at", "raw"))
    # asked of the raw line: a condition on the tokens would make Spark spell them twice
    lines = lines.where(F.col("raw").rlike(TOKEN))
    lines = lines.select("text_key", "at", tokens(F.col("raw")).alias("tokens")).withColumn("n", F.size("tokens"))
    return lines.select("text_key", "at", "tokens", "n",
                        F.xxhash64("n", F.slice("tokens", 1, LEADING)).alias("leaf"),
                        F.xxhash64(F.lit(1), "tokens").alias("line"))


def drop_recurring_lines(docs: DataFrame, min_texts: int = MIN_TEXTS, most: float = MOST_DROPPED) -> DataFrame:
    """``docs`` with ``text`` less its recurring lines, and ``n_lines`` and ``n_dropped``.

    Texts are counted once however many rows repeat them. Lines without tokens
    stay. A null text stays null with no lines; an empty one is one empty line.
    Input columns called n_lines or n_dropped are replaced; other columns pass
    through. Repeated rows get the same result. An empty table gives no rows.
    """
    base = docs.select(clean_text().alias("text")).where(F.col("text") != "")
    with scratch(docs.sparkSession) as keep:
        lines = saved(tree_lines(base).drop("tokens"), "tree-lines")
        per_text = saved(lines.select("leaf", "line", "n", "text_key").distinct(), "tree-texts")
        kinds = per_text.groupBy("leaf", "line", "n").agg(F.count("*").alias("texts"))
        leaves = kinds.groupBy("leaf").agg(F.count("*").alias("kinds"), F.sum("texts").alias("most"))
        # no template of a leaf occurs in more texts than its lines do together
        kinds = saved(kinds.join(leaves.where(F.col("most") >= min_texts).select("leaf", "kinds"), "leaf"), "tree-kinds")

        several = kinds.where("kinds > 1").select("leaf", "line", "kinds", "n")
        spelled = (tree_lines(base).select("leaf", "line", "tokens").join(several, ["leaf", "line"])
                   .dropDuplicates(["leaf", "line"]))
        placed = saved(spelled.select("leaf", "line", "kinds", "n", F.posexplode("tokens").alias("position", "token")),
                       "tree-positions")
        votes = placed.groupBy("leaf", "position", "token", "kinds").agg(F.count("*").alias("votes"))
        template = (votes.where("2 * votes >= kinds").groupBy("leaf", "position")
                    .agg(F.max(F.struct("votes", "token"))["token"].alias("common")))
        members = (placed.join(template, ["leaf", "position"]).where("token = common")
                   .groupBy("leaf", "line", "n").agg(F.count("*").alias("same"))
                   .where(F.col("same") >= SIMILAR * F.col("n")).select("leaf", "line", F.lit(0).alias("own")))
        # a line outside its leaf's template is a template of its own
        assigned = saved(kinds.join(members, ["leaf", "line"], "left")
                         .select("leaf", "line", F.when(F.col("own").isNull(), F.col("line")).alias("template")), "tree-assigned")
        spread = (per_text.join(assigned, ["leaf", "line"]).select("leaf", "template", "text_key").distinct()
                  .groupBy("leaf", "template").agg(F.count("*").alias("texts")).where(F.col("texts") >= min_texts))
        a, s = assigned.alias("a"), saved(spread, "tree-recurring").alias("s")
        recurring = saved(a.join(s, (F.col("a.leaf") == F.col("s.leaf")) & F.col("a.template").eqNullSafe(F.col("s.template")))
                          .select("a.leaf", "a.line"), "tree-drops")

        hits = (lines.join(recurring, ["leaf", "line"]).groupBy("text_key")
                .agg(F.collect_set(F.struct("at", "n")).alias("hits")))
        sizes = lines.groupBy("text_key", "at", "n").agg(F.lit(1)).groupBy("text_key").agg(F.sum("n").alias("total"))
        dropped = F.aggregate("hits", F.lit(0).cast("long"), lambda t, x: t + x["n"])
        drops = keep(saved(hits.join(sizes, "text_key").where(dropped <= most * F.col("total"))
                      .select("text_key", F.col("hits.at").alias("drops")), "tree-decisions"))

    # the input row travels whole, so none of its names meets one of ours
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.col("text").cast("string").alias("text"), F.xxhash64(clean_text()).alias("text_key"))
    # always a sort-merge join, so that what is moved grows evenly with the input
    rows = rows.join(drops.hint("merge"), "text_key", "left")
    split = F.split("text", "\n", -1)
    left = F.filter(split, lambda x, i: ~F.array_contains("drops", i))
    text = F.when(F.col("drops").isNull(), F.col("text")).otherwise(F.array_join(left, "\n")).alias("text")
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(F.size(split)).cast("long").alias("n_lines")
    n_dropped = F.when(F.col("drops").isNull(), 0).otherwise(F.size("drops")).cast("long").alias("n_dropped")
    own = [text if c.lower() == "text" else F.col("row")[c].alias(c) for c in docs.columns
           if c.lower() not in ("n_lines", "n_dropped")]
    return rows.select(*own, n_lines, n_dropped)


def op5_template_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without their recurring lines."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return drop_recurring_lines(docs)


OP5_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents
), u AS (SELECT DISTINCT text FROM d WHERE text <> ''
), s AS (SELECT text, string_split(text, chr(10)) AS ls FROM u
), r AS (SELECT text, unnest(range(len(ls))) AS pos0, unnest(ls) AS raw FROM s
), l AS (
  SELECT text, pos0, list_transform(regexp_extract_all(raw, '{TOKEN}'),
         lambda t: CASE WHEN regexp_matches(t, '[0-9]') THEN '{FIELD}' ELSE t END) AS ts FROM r
), t AS (
  SELECT text, pos0, len(ts) AS n, (len(ts), ts[1:{LEADING}]) AS leaf, ts FROM l WHERE len(ts) > 0
), k AS (SELECT leaf, ts, n, count(DISTINCT text) AS texts FROM t GROUP BY leaf, ts, n
), f AS (SELECT leaf, count(*) AS kinds FROM k GROUP BY leaf
), p AS (
  SELECT leaf, ts, n, kinds, unnest(range(n)) AS pos, unnest(ts) AS token FROM k JOIN f USING (leaf) WHERE kinds > 1
), v AS (
  SELECT leaf, pos, token, count(*) AS votes FROM p GROUP BY leaf, pos, token, kinds HAVING 2 * count(*) >= kinds
), c AS (SELECT leaf, pos, max((votes, token))[2] AS common FROM v GROUP BY leaf, pos
), m AS (
  SELECT leaf, ts FROM p JOIN c USING (leaf, pos) WHERE token = common
  GROUP BY leaf, ts, n HAVING count(*) >= {SIMILAR} * n
), a AS (
  SELECT k.leaf, k.ts, CASE WHEN m.ts IS NULL THEN k.ts END AS template
  FROM k LEFT JOIN m ON m.leaf = k.leaf AND m.ts = k.ts
), q AS (
  SELECT a.leaf, template FROM t JOIN a ON t.leaf = a.leaf AND t.ts = a.ts
  GROUP BY a.leaf, template HAVING count(DISTINCT text) >= {MIN_TEXTS}
), x AS (
  SELECT DISTINCT a.leaf, a.ts FROM a JOIN q ON a.leaf = q.leaf AND a.template IS NOT DISTINCT FROM q.template
), h AS (
  SELECT t.text, sum(t.n) AS total, sum(t.n) FILTER (x.leaf IS NOT NULL) AS part,
         list(t.pos0) FILTER (x.leaf IS NOT NULL) AS ats
  FROM t LEFT JOIN x ON t.leaf = x.leaf AND t.ts = x.ts GROUP BY t.text
), g AS (SELECT text, ats FROM h WHERE part <= {MOST_DROPPED} * total
)
SELECT o.doc_id, CASE WHEN g.ats IS NULL THEN o.text
         ELSE array_to_string(list_filter(string_split(o.text, chr(10)), lambda y, i: NOT list_contains(g.ats, i - 1)), chr(10)) END AS text,
       CASE WHEN o.text IS NULL THEN 0 ELSE len(string_split(o.text, chr(10))) END AS n_lines,
       coalesce(len(g.ats), 0) AS n_dropped
FROM documents o LEFT JOIN g ON g.text = o.text
"""
