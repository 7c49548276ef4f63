"""Near-duplicate documents: universal hash minima, banding, signature and exact checks, components.

1. Documents with one shingle set form a class; a class goes on as its smallest doc_id.
2. 160 minima of universal hashes, 32 bands of 5: at a similarity of 0.8 a pair
   misses every band with probability 3e-6.
3. Each bucket's members are checked against its smallest member (a star, never
   all pairs): first by signature, then on full shingle sets.
4. Buckets whose members lie in several components are looked at once more:
   members outside the largest one are held against all others with close
   signatures on full sets, in blocks, until they are joined or every plausible
   pair has failed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import WordHashes, batches_of, clean_text, runs, saved, scratch, shingle_hashes, table, words_of
from strata.llm.components import connected_components

HASHES, ROWS = 160, 5
#: Signature agreement below which a pair is given up: at a similarity of 0.8 the chance is 6e-5.
PLAUSIBLE = 0.68
BLOCK = 1024
FEATURES = "doc_id long, text_key long, n_shingles long, digest binary, bands array<long>, sig binary"


def shingle_set(text: str | None, k: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct ``k``-word shingle hashes of the whole text."""
    return np.unique(shingle_hashes(hashes(words_of(text)), k))


def minima(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least value of each universal hash ``a * x + b mod 2**32`` over the set."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    sig = np.full(len(a), 0xFFFFFFFF, dtype=np.uint32)
    for j in range(0, len(x), 512):
        np.minimum(sig, (x[j:j + 512, None] * a + b).min(axis=0), out=sig)
    return sig


def _features(k: int, seed: int):
    schema = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("n_shingles", pa.int64()), ("digest", pa.binary()),
                        ("bands", pa.list_(pa.int64())), ("sig", pa.binary())])

    def task(batches):
        rng = np.random.default_rng(seed)
        a = rng.integers(0, 2**32, HASHES, dtype=np.uint32) | np.uint32(1)
        b = rng.integers(0, 2**32, HASHES, dtype=np.uint32)
        hashes = WordHashes()

        def rows():
            for batch in batches:
                for doc_id, key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                    s = shingle_set(text.as_py(), k, hashes)
                    sig = minima(s, a, b)
                    bands = [xxhash.xxh3_64_intdigest(sig[i:i + ROWS].tobytes(), seed=i) - 2**63
                             for i in range(0, HASHES, ROWS)]
                    yield (doc_id, key, len(s), xxhash.xxh3_128_digest(s.tobytes()), bands,
                           sig.astype(np.uint8).tobytes())

        yield from batches_of(rows(), schema, 512)

    return task


def _sets(k: int):
    schema = pa.schema([("node", pa.int64()), ("shingles", pa.list_(pa.int64()))])

    def task(batches):
        hashes = WordHashes()

        def rows():
            for batch in batches:
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                    yield doc_id, shingle_set(text.as_py(), k, hashes).view(np.int64)

        yield from batches_of(rows(), schema, 256)

    return task


def _signatures(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(-1, HASHES)


def _close(batches):
    """Pairs whose signatures agree well enough and whose set sizes allow a link."""
    for batch in batches:
        t = pa.Table.from_batches([batch])
        agree = (_signatures(t["sig_u"]) == _signatures(t["sig_v"])).mean(axis=1)
        yield from t.filter(pa.array(agree >= PLAUSIBLE)).select(["u", "v"]).to_batches()


def _plausible(group: pa.Table, percent: int):
    """Index pairs of a bucket (or of two blocks of it) in different components that may link.

    Rows that ``seek`` are outside the bucket's largest component and are held against the
    others. A pair of two such members counts once, and every pair in the first band that it
    shares, so that other buckets leave it."""
    node, comp, n, seek, rest = (group[c].to_numpy(zero_copy_only=False) for c in
                                 ("node", "comp", "n_shingles", "seek", "rest"))
    key = group["key"][0].as_py()
    sig = _signatures(group["sig"])
    bands = np.array(group["bands"].to_pylist(), dtype=np.int64)
    us, vs, agreed = [], [], []
    for u in np.flatnonzero(seek).tolist():
        v = np.flatnonzero(~seek & (comp != comp[u]) & (~rest | (node < node[u]))
                           & (100 * np.minimum(n, n[u]) >= percent * np.maximum(n, n[u])))
        if not len(v):
            continue
        agree = (sig[v] == sig[u]).mean(axis=1)
        v, agree = v[agree >= PLAUSIBLE], agree[agree >= PLAUSIBLE]
        own = bands[u][(bands[v] == bands[u]).argmax(axis=1)] == key
        us += [u] * int(own.sum())
        vs += v[own].tolist()
        agreed += agree[own].tolist()
    return us, vs, agreed


_MEMBER = ["key", "bi", "bj"]


def _needed(percent: int):
    """The members of a bucket that some plausible pair needs."""
    schema = pa.schema([("key", pa.int64()), ("bi", pa.int32()), ("bj", pa.int32()), ("node", pa.int64())])

    def task(batches):
        def rows():
            for group in runs(batches, _MEMBER):
                us, vs, _ = _plausible(group, percent)
                head = [group[c][0].as_py() for c in _MEMBER]
                node = group["node"].to_numpy()
                for x in sorted({*us, *vs}):
                    yield (*head, int(node[x]))

        yield from batches_of(rows(), schema)

    return task


def _linked(percent: int):
    """Exact checks of a bucket's plausible pairs, closest first; links that join components."""
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def task(batches):
        def rows():
            for group in runs(batches, _MEMBER):
                us, vs, agreed = _plausible(group, percent)
                node, comp = group["node"].to_numpy(), group["comp"].to_numpy()
                sets = [np.array(s, dtype=np.int64) for s in group["shingles"].to_pylist()]
                root = {c: c for c in comp.tolist()}

                def find(c):
                    while root[c] != c:
                        root[c] = c = root[root[c]]
                    return c

                for i in np.argsort(agreed)[::-1].tolist():
                    u, v = us[i], vs[i]
                    a, b = find(int(comp[u])), find(int(comp[v]))
                    if a == b:
                        continue
                    both = len(np.intersect1d(sets[u], sets[v], assume_unique=True))
                    if 100 * both >= percent * (len(sets[u]) + len(sets[v]) - both):
                        root[max(a, b)] = min(a, b)
                        yield int(node[u]), int(node[v])

        yield from batches_of(rows(), schema)

    return task


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, seed: int = 11) -> DataFrame:
    """``doc_id, text`` -> ``doc_id, text_key, n_shingles, component_id, kept`` for every row.

    ``text_key`` is a hash of the text that tells rows of one doc_id apart.

    Two documents link when 100 * intersection >= ``percent`` * union of their
    sets of ``k``-word shingles. A text with fewer words has one shingle, the
    whole; null and empty texts have none and link with nothing. Rows that share
    a doc_id count as one document, linked with what any of them links with. A
    row without doc_id joins its exact copies (kept is false) or, with none that
    has an id, stays alone with a null component. Empty tables give no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    with scratch(docs.sparkSession) as keep:
        feats = keep(saved(docs.select("doc_id", F.xxhash64(clean_text()).alias("text_key"), "text")
                      .mapInArrow(_features(k, seed), FEATURES), "minhash-features"))
        classes = saved(feats.where("n_shingles > 0").groupBy("digest").agg(F.min("doc_id").alias("node"))
                        .where("node IS NOT NULL"), "minhash-classes")
        reps = saved(feats.join(classes, "digest").where("doc_id = node").dropDuplicates(["node", "digest"])
                     .select("node", "n_shingles", "bands", "sig"), "minhash-reps")

        banded = reps.select("node", F.explode("bands").alias("key"))
        buckets = saved(banded.groupBy("key").agg(F.count("*").alias("size"), F.min("node").alias("hub"))
                        .where("size > 1"), "minhash-buckets")
        members = saved(banded.join(buckets, "key"), "minhash-members")
        nodes = members.select("node").distinct()
        texts = docs.join(nodes.withColumnRenamed("node", "doc_id"), "doc_id", "left_semi")
        sets = saved(texts.mapInArrow(_sets(k), "node long, shingles array<long>"), "minhash-sets")

        side = lambda c: reps.select(F.col("node").alias(c), F.col("n_shingles").alias(f"n_{c}"), F.col("sig").alias(f"sig_{c}"))
        stars = (members.where("node != hub").select(F.col("hub").alias("u"), F.col("node").alias("v")).distinct()
                 .join(side("u"), "u").join(side("v"), "v")
                 .where(100 * F.least("n_u", "n_v") >= percent * F.greatest("n_u", "n_v")))
        close = saved(stars.select("u", "v", "sig_u", "sig_v").mapInArrow(_close, "u long, v long").distinct(), "minhash-close")
        of = lambda c: sets.select(F.col("node").alias(c), F.col("shingles").alias(f"set_{c}"))
        both = F.size(F.array_intersect("set_u", "set_v"))
        links = (close.join(of("u"), "u").join(of("v"), "v")
                 .where(100 * both >= percent * (F.size("set_u") + F.size("set_v") - both)).select("u", "v"))
        comps = saved(connected_components(links), "minhash-components")

        more = saved(_between_components(reps, members, sets, comps, percent), "minhash-more")
        if not more.isEmpty():
            comp = lambda c: comps.select(F.col("node").alias(c), F.col("component").alias(f"c_{c}"))
            joined = (more.join(comp("u"), "u", "left").join(comp("v"), "v", "left")
                      .select(F.coalesce("c_u", "u").alias("u"), F.coalesce("c_v", "v").alias("v")))
            merged = connected_components(joined).select(F.col("node").alias("component"), F.col("component").alias("_to"))
            known = comps.join(merged, "component", "left").select("node", F.coalesce("_to", "component").alias("component"))
            # a node that had no link before is a component of its own
            comps = saved(merged.select(F.col("component").alias("node"), F.col("_to").alias("component"))
                          .join(comps.select("node"), "node", "left_anti").union(known), "minhash-merged")

        placed = keep(saved(classes.join(comps, "node", "left")
                       .select("digest", F.coalesce("component", "node").alias("component")), "minhash-placed"))
    rows = feats.select("doc_id", "text_key", "n_shingles", "digest").join(placed, "digest", "left")
    component = F.when(F.col("n_shingles") > 0, F.coalesce("component", "doc_id")).otherwise(F.col("doc_id"))
    return rows.select("doc_id", "text_key", "n_shingles", component.alias("component_id"),
                       F.col("doc_id").eqNullSafe(component).alias("kept"))


def _between_components(reps, members, sets, comps, percent) -> DataFrame:
    """Links between components that meet in a bucket.

    Members outside a bucket's largest component, few after the stars, are held against all
    members, block by block: rows are copied for the blocks of the other side only."""
    at = members.join(comps, "node", "left").select("key", "node", "size", F.coalesce("component", "node").alias("comp"))
    at = saved(at, "minhash-placed-members")
    counts = at.groupBy("key", "comp").agg(F.count("*").alias("n"))
    open_ = saved(counts.groupBy("key").agg(F.max(F.struct("n", "comp")).alias("top"), F.count("*").alias("comps"),
                                            F.sum("n").alias("all")).where("comps > 1")
                  .select("key", F.col("top.comp").alias("largest"), (F.col("all") - F.col("top.n")).alias("others")),
                  "minhash-open")
    at = at.join(open_, "key").withColumn("rest", F.col("comp") != F.col("largest"))
    hashed = F.xxhash64("node")
    seekers, found = (F.ceil(F.col(c) / BLOCK).cast("int") for c in ("others", "size"))
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    seek = at.where("rest").select("key", F.pmod(hashed, seekers).cast("int").alias("bi"), every(found).alias("bj"),
                                   "node", "comp", "rest", F.lit(True).alias("seek"))
    held = at.select("key", every(seekers).alias("bi"), F.pmod(hashed, found).cast("int").alias("bj"),
                     "node", "comp", "rest", F.lit(False).alias("seek"))
    at = saved(seek.union(held).join(reps, "node"), "minhash-open-members")
    dealt = lambda df: df.repartition(*_MEMBER).sortWithinPartitions(*_MEMBER)
    columns = [*_MEMBER, "node", "comp", "rest", "seek", "n_shingles", "bands", "sig"]
    needed = saved(dealt(at.select(*columns)).mapInArrow(_needed(percent), "key long, bi int, bj int, node long")
                   .distinct(), "minhash-needed")
    full = needed.join(at, [*_MEMBER, "node"]).join(sets, "node")
    return dealt(full.select(*columns, "shingles")).mapInArrow(_linked(percent), "u long, v long")


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, 4-word shingles, similarity 0.8 or more."""
    return near_duplicates(table(spark, sf_dir, "documents"), k=4).drop("text_key")


#: Exact links by counting shared shingles, and components by the smallest reachable doc_id.
OP10_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents
), s AS (
  SELECT doc_id, list_distinct(list_transform(range(1, greatest(2, len(ws) - 2)),
                                              lambda i: array_to_string(ws[i:i + 3], ' '))) AS g
  FROM w WHERE len(ws) > 0
), e AS (SELECT doc_id, unnest(g) AS x, len(g) AS n FROM s
), p AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS i, any_value(a.n) AS nu, any_value(b.n) AS nv
  FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2
), l AS (SELECT u, v FROM p WHERE 100 * i >= 80 * (nu + nv - i)
), b AS (SELECT u, v FROM l UNION ALL SELECT v, u FROM l
), r(node, reach) AS (
  SELECT u, u FROM b UNION SELECT r.node, b.v FROM r JOIN b ON b.u = r.reach
), c AS (SELECT node, min(reach) AS component FROM r GROUP BY node)
SELECT w.doc_id, coalesce(len(s.g), 0) AS n_shingles, coalesce(c.component, w.doc_id) AS component_id,
       coalesce(c.component, w.doc_id) = w.doc_id AS kept
FROM w LEFT JOIN s USING (doc_id) LEFT JOIN c ON c.node = w.doc_id
"""
