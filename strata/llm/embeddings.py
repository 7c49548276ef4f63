"""Near-duplicate vectors through a pivot-permutation index.

Reference points (pivots) are well-separated vectors of a bounded sample. Every
vector is described by its nearest pivots in order and filed in their inverted
lists. Two vectors are compared when they share enough pivots, in the list of
the first pivot they share, and linked when their cosine says so.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import batches_of, runs, saved, scalar, scratch, table
from strata.llm.components import connected_components

#: Pivots: one for every VECTORS_PER_PIVOT vectors, within bounds; fitted on SAMPLE vectors of each dimension at most.
VECTORS_PER_PIVOT, LEAST_PIVOTS, MOST_PIVOTS, SAMPLE = 24, 32, 2048, 8192
#: Nearest pivots that describe a vector, and how many two vectors must share to be compared.
NEAREST, SHARED = 12, 2
#: Pivots closer than this cosine count as one reference point.
SEPARATION = 0.7
#: Members of a list that one task compares with so many others at most; of them at a time, and pairs at a time.
BLOCK, TILE, SOME = 4096, 1024, 1 << 14
_LIST = ["pivot", "bi", "bj"]


def unit_vectors(df: DataFrame, column: str = "embedding") -> DataFrame:
    """``vec_id, digest, dim, unit`` of comparable vectors; null, empty, zero and non-finite ones are left out."""
    good = df.select(F.col("vec_id").cast("long").alias("vec_id"),
                     F.col(column).cast("array<double>").alias("v")).where(_comparable())
    return good.mapInArrow(_units, "vec_id long, digest binary, dim int, unit binary")


def _comparable():
    finite = ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size("v") > 0) & finite & F.exists("v", lambda x: x != 0), F.lit(False))


def _units(batches):
    schema = pa.schema([("vec_id", pa.int64()), ("digest", pa.binary()), ("dim", pa.int32()), ("unit", pa.binary())])

    def rows():
        for batch in batches:
            lengths = batch.column(1).value_lengths().to_numpy()
            for dim in np.unique(lengths).tolist():
                some = batch.filter(pa.array(lengths == dim))
                for vec_id, x, u in zip(some.column(0).to_pylist(), *_scaled(some.column(1), dim)):
                    yield vec_id, hashlib.md5(x).digest(), dim, u.tobytes()

    yield from batches_of(rows(), schema, 1024)


def _scaled(vectors: pa.ListArray, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of one length as rows of a matrix (-0 as 0), and the same at length 1."""
    x = vectors.flatten().to_numpy().reshape(-1, dim) + 0.0
    u = x / np.abs(x).max(axis=1, keepdims=True)
    return x, u / np.sqrt(np.einsum("ij,ij->i", u, u))[:, None]


def fit_pivots(units: DataFrame, n: int, seed: int = 3) -> dict[int, np.ndarray]:
    """Pivots by dimension, from ``SAMPLE`` vectors of each at most.

    The sample, and so what the driver holds, is bounded; sample vectors that lie
    close to a pivot already taken are passed over, so a crowd of near copies
    gives one reference point."""
    wanted = max(LEAST_PIVOTS, min(MOST_PIVOTS, n // VECTORS_PER_PIVOT))
    pivots = {}
    for (dim,) in units.select("dim").distinct().collect():     # vector lengths, as a rule one
        # the least hashes: every task keeps SAMPLE rows at most, and so does the driver
        sample = units.where(F.col("dim") == dim).orderBy(F.xxhash64("digest", F.lit(seed)), "digest").limit(SAMPLE)
        vectors = [np.frombuffer(r["unit"]) for r in sample.select("unit").collect()]
        taken = np.empty((min(wanted, len(vectors)), dim))
        size = 0
        for v in vectors:
            if size == len(taken):
                break
            if not size or (taken[:size] @ v).max() < SEPARATION:
                taken[size] = v
                size += 1
        pivots[dim] = taken[:size]
    return pivots


def _matrix(units: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(units.to_pylist())).reshape(-1, dim)


def _nearest(near: np.ndarray, nearest: int) -> np.ndarray:
    """Columns of the largest values of each row in order, of equal ones the first."""
    k = min(nearest, near.shape[1])
    top = np.argpartition(-near, k - 1, axis=1)[:, :k]
    value = np.take_along_axis(near, top, axis=1)
    order = np.take_along_axis(top, np.lexsort((top, -value), axis=1), axis=1)
    for i in np.flatnonzero((near >= value.min(axis=1, keepdims=True)).sum(axis=1) > k).tolist():
        order[i] = np.lexsort((np.arange(near.shape[1]), -near[i]))[:k]    # equal values on both sides of the cut
    return order


def _permutations(pivots: dict[int, np.ndarray], nearest: int):
    """Numbers of the nearest pivots in order; pivots of all dimensions are numbered through."""
    first, at = {}, 0
    for dim in sorted(pivots):
        first[dim] = at
        at += len(pivots[dim])
    schema = pa.schema([("node", pa.int64()), ("digest", pa.binary()), ("copies", pa.int64()), ("dim", pa.int32()),
                        ("unit", pa.binary()), ("permutation", pa.list_(pa.int32()))])

    def task(batches):
        def rows():
            for batch in batches:
                for at in range(0, batch.num_rows, TILE):
                    part = batch.slice(at, TILE)
                    dims = part.column(3).to_numpy()
                    for dim in np.unique(dims).tolist():
                        some = part.filter(pa.array(dims == dim))
                        order = _nearest(_matrix(some.column(4), dim) @ pivots[dim].T, nearest) + first[dim]
                        yield from zip(*(some.column(c).to_pylist() for c in range(5)), order.tolist())

        yield from batches_of(rows(), schema, 1024)

    return task


def _tiles(a: np.ndarray, b: np.ndarray | None):
    """Parts of ``a`` and of ``b`` (None: of ``a`` itself, each pair of parts once), ``TILE`` members each."""
    for i in range(0, len(a), TILE):
        for j in range(i if b is None else 0, len(a if b is None else b), TILE):
            yield a[i:i + TILE], (a if b is None else b)[j:j + TILE], b is None and i == j


def _linked(unit: np.ndarray, perm: np.ndarray, pivot: int, sides: tuple, cosine: float, shared: int):
    """Members of one side and of the other that have links, and which of them are linked, a tile at a time.

    A product in single precision, whose error is under ``slack``, settles
    nearly all pairs; the others are judged in double."""
    rough = unit.astype(np.float32)
    slack = (unit.shape[1] + 8) * 2.0 ** -22
    for x, y, same in _tiles(*sides):
        product = rough[x] @ rough[y].T
        linked = product >= np.float32(cosine - slack)
        if same:
            linked = np.triu(linked, 1)
        if not linked.any():
            continue
        rows, cols = (np.flatnonzero(linked.any(axis=k)) for k in (1, 0))
        x, y, linked, product = x[rows], y[cols], linked[np.ix_(rows, cols)], product[np.ix_(rows, cols)]
        for i, j in _some(linked & (product < np.float32(cosine + slack))):
            linked[i, j] = np.einsum("ij,ij->i", unit[x[i]], unit[y[j]]) >= cosine
        _belonging(perm[x], perm[y], pivot, shared, linked)
        if linked.any():
            yield x, y, linked


def _some(pairs: np.ndarray):
    """Places of a matrix that are true, ``SOME`` at a time."""
    at = np.flatnonzero(pairs)
    for k in range(0, len(at), SOME):
        yield np.divmod(at[k:k + SOME], pairs.shape[1])


def _belonging(a: np.ndarray, b: np.ndarray, pivot: int, shared: int, linked: np.ndarray) -> None:
    """Leaves in ``linked`` the pairs that share enough pivots, ``pivot`` the first of them: an earlier list has the others."""
    enough = min(shared, a.shape[1])
    pivots = np.intersect1d(a, b)
    if linked.sum() * 1024 > linked.size * len(pivots):     # many pairs, few pivots: counted by products of incidence matrices
        def incidence(perm):
            at = np.minimum(np.searchsorted(pivots, perm), len(pivots) - 1)
            held = np.zeros((len(perm), len(pivots) + 1), dtype=np.float32)
            np.put_along_axis(held, np.where(pivots[at] == perm, at, len(pivots)), 1, axis=1)
            return held[:, :-1]
        p, q, first = incidence(a), incidence(b), np.searchsorted(pivots, pivot)
        linked &= (p @ q.T >= enough) & (p[:, :first] @ q[:, :first].T == 0)
        return
    for i, j in _some(linked):
        same = a[i][:, :, None] == b[j][:, None, :]
        first = np.where(same.any(axis=2), a[i], np.iinfo(np.int32).max).min(axis=1)
        linked[i, j] = (same.sum(axis=(1, 2)) >= enough) & (first == pivot)


def _join(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """``root`` (the smallest member each one reaches) with the links ``i, j`` too."""
    while True:
        a, b = root[i], root[j]
        apart = a != b
        if not apart.any():
            return root
        a, b = a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root[root] != root).any():
            root = root[root]


def _links(cosine: float, shared: int):
    """Compares the members of an inverted list, or of two blocks of it.

    Yields each member that has a link here: its links, copies counted, and the
    smallest member that the links of this list reach."""
    schema = pa.schema([("node", pa.int64()), ("digest", pa.binary()), ("n", pa.int64()), ("peer", pa.int64())])

    def task(batches):
        def rows():
            for group in runs(batches, _LIST):
                if group.num_rows < 2:
                    continue
                pivot, bi, bj = (group[c][0].as_py() for c in _LIST)
                group = group.take(np.argsort(group["node"].to_numpy(), kind="stable"))
                perm = group["permutation"].combine_chunks().flatten().to_numpy().reshape(group.num_rows, -1)
                unit = _matrix(group["unit"], len(group["unit"][0].as_py()) // 8)
                block, copies = group["block"].to_numpy(), group["copies"].to_numpy()
                sides = (np.arange(len(perm)), None) if bi == bj else (np.flatnonzero(block == bi), np.flatnonzero(block == bj))
                counts, root = np.zeros(len(perm), dtype=np.int64), np.arange(len(perm))
                for x, y, linked in _linked(unit, perm, pivot, sides, cosine, shared):
                    counts[x] += linked @ copies[y]
                    counts[y] += copies[x] @ linked
                    i, j = np.nonzero(linked)
                    root = _join(root, x[i], y[j])
                found = np.flatnonzero(counts)
                if len(found):
                    node, digest = group["node"].to_numpy(), group["digest"].take(found).to_pylist()
                    yield from zip(node[found].tolist(), digest, counts[found].tolist(), node[root[found]].tolist())

        yield from batches_of(rows(), schema)

    return task


def near_vectors(df: DataFrame, cosine: float = 0.9, nearest: int = NEAREST, shared: int = SHARED,
                 column: str = "embedding") -> DataFrame:
    """``vec_id`` and vectors -> ``vec_id, n_links, component_id, kept`` for every row.

    Equal vectors are one node with copies; copies link with each other. Vectors
    of different lengths, and null, empty, zero or non-finite ones, link with
    nothing: n_links 0, component_id their own vec_id, kept true. ``n_links``
    counts rows, so repeated rows count each. Rows that share a vec_id but not
    the vector belong to one component. A row without vec_id takes the component
    of its copies (kept is false), or stays alone with a null one; where no copy
    has a vec_id, others don't count it. An empty table gives no rows.
    """
    with scratch(df.sparkSession) as keep:
        units = keep(saved(unit_vectors(df, column), "pivot-units"))
        nodes = saved(units.groupBy("digest", "dim").agg(F.min("vec_id").alias("node"), F.count("*").alias("copies"))
                      .where("node IS NOT NULL"), "pivot-nodes")
        own = units.dropDuplicates(["digest", "dim"]).select("digest", "dim", "unit")
        reps = nodes.join(own, ["digest", "dim"]).select("node", "digest", "copies", "dim", "unit")
        (n,) = scalar(nodes, F.count("*"))
        pivots = fit_pivots(units, n)
        described = saved(reps.mapInArrow(_permutations(pivots, nearest),
                                          "node long, digest binary, copies long, dim int, unit binary, permutation array<int>"),
                          "pivot-permutations")
        posted = described.withColumn("pivot", F.explode("permutation"))
        lists = saved(described.select(F.explode("permutation").alias("pivot")).groupBy("pivot").count(), "pivot-lists")
        blocks = F.ceil(F.col("count") / BLOCK).cast("int")
        posted = (posted.join(lists, "pivot").withColumn("blocks", blocks)
                  .withColumn("block", F.pmod(F.xxhash64("digest"), F.col("blocks")).cast("int"))
                  .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
        posted = posted.select("pivot", F.least("block", "other").alias("bi"), F.greatest("block", "other").alias("bj"),
                               "block", "node", "digest", "copies", "unit", "permutation")
        found = saved(posted.repartition(*_LIST).sortWithinPartitions(*_LIST)
                      .mapInArrow(_links(cosine, shared), "node long, digest binary, n long, peer long"), "pivot-links")
        comps = connected_components(found.select(F.col("node").alias("u"), F.col("peer").alias("v")))
        counts = found.groupBy("digest").agg(F.sum("n").alias("n"))
        placed = keep(saved(nodes.join(counts, "digest", "left").join(comps, "node", "left")
                       .select("digest", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
                               F.coalesce("component", "node").alias("component_id")), "pivot-placed"))
    ids = units.select("vec_id", "digest")
    good = ids.join(placed, "digest", "left")
    alone = df.select(F.col("vec_id").cast("long").alias("vec_id"),
                      F.col(column).cast("array<double>").alias("v")).where(~_comparable())
    rows = good.select("vec_id", "n_links", "component_id").unionByName(
        alone.select("vec_id", F.lit(None).cast("long").alias("n_links"), F.lit(None).cast("long").alias("component_id")))
    component = F.coalesce("component_id", "vec_id")
    return rows.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                       component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))


def op2_pivot_permutations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of ``embeddings``, cosine 0.9 or more."""
    return near_vectors(table(spark, sf_dir, "embeddings"))


OP2_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings
), g AS (
  SELECT vec_id, x FROM v WHERE len(x) > 0 AND len(list_filter(x, lambda e: e IS NULL OR NOT isfinite(e))) = 0
                            AND len(list_filter(x, lambda e: e <> 0)) > 0
), l AS (
  SELECT a.vec_id AS u, b.vec_id AS v FROM g a JOIN g b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
  WHERE CASE WHEN len(a.x) = len(b.x) THEN list_cosine_similarity(a.x, b.x) END >= 0.9
), r(node, reach) AS (
  SELECT u, u FROM l UNION SELECT r.node, l.v FROM r JOIN l ON l.u = r.reach
), c AS (SELECT node, min(reach) AS component FROM r GROUP BY node
), n AS (SELECT u, count(*) AS n_links FROM l GROUP BY u)
SELECT v.vec_id, coalesce(n.n_links, 0) AS n_links, coalesce(c.component, v.vec_id) AS component_id,
       coalesce(c.component, v.vec_id) = v.vec_id AS kept
FROM v LEFT JOIN n ON n.u = v.vec_id LEFT JOIN c ON c.node = v.vec_id
"""
