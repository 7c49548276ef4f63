import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from strata.llm import embeddings
from strata.llm.embeddings import near_vectors

SCHEMA = "vec_id long, embedding array<float>, label int, node long, digest string, n_links int"


def brute(rows):
    ok = [r[1] is not None and len(r[1]) > 0 and all(v is not None and np.isfinite(v) for v in r[1]) and any(r[1])
          for r in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    n = [0] * len(rows)
    for i in range(len(rows)):
        for j in range(len(rows)):
            if i != j and ok[i] and ok[j] and len(rows[i][1]) == len(rows[j][1]):
                a, b = (np.array(rows[x][1], dtype=np.float32).astype(float) for x in (i, j))
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= 0.9:
                    n[i] += 1
                    root[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        least.setdefault(find(i), []).append(r[0])
    out = []
    for i, r in enumerate(rows):
        c = min(v for v in least[find(i)])
        out.append((r[0], n[i], c, r[0] == c))
    return sorted(out)


def vectors(rng, n, dim=24):
    x = rng.normal(size=(n, dim))
    crowd = x[0] + 0.12 * rng.normal(size=(n // 3, dim)) * np.abs(rng.normal(size=(n // 3, 1)))
    pairs = x[1:20] + 0.3 * rng.normal(size=(19, dim))
    return np.concatenate([x, crowd, pairs])


@pytest.mark.parametrize("block", [16, 512])
def test_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(embeddings, "BLOCK", block)
    rng = np.random.default_rng(4)
    rows = [(i, [float(v) for v in x], 0, 1, "d", 2) for i, x in enumerate(vectors(rng, 240))]
    rows += [(1000 + i, rows[0][1], 0, 1, "d", 2) for i in range(5)]    # equal vectors
    rows += [(2000, None, None, None, None, None), (2001, [], 0, 1, "", 0), (2002, [0.0] * 24, 0, 1, "", 0),
             (2003, [float("nan")] + [1.0] * 23, 0, 1, "", 0), (2004, [float("inf")] * 24, 0, 1, "", 0),
             (2005, [None] + [1.0] * 23, 0, 1, "", 0), (2006, [1.0, 2.0], 0, 1, "", 0), (2007, [2.0, 4.1], 0, 1, "", 0),
             (2008, [1e38] * 24, 0, 1, "", 0), (2009, [1e-38] * 24, 0, 1, "", 0)]
    got = near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(tuple(r) for r in got) == brute(rows)


def test_rows_without_id_and_empty_table(spark):
    rows = [(1, [1.0, 0.0], 0, 1, "", 0), (None, [1.0, 0.0], 0, 1, "", 0), (None, [0.0, 1.0], 0, 1, "", 0), (None, None, 0, 1, "", 0)]
    got = sorted((tuple(r) for r in near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()), key=repr)
    assert got == sorted([(1, 1, 1, True), (None, 1, 1, False), (None, 0, None, True), (None, 0, None, True)], key=repr)
    assert near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0


def a_list(rng, n, crowd, pivots, block=0):
    """An inverted list of pivot 5: half of its members a crowd that shares few pivots."""
    x = rng.normal(size=(n, 16))
    x[::2] = x[0] + crowd * rng.normal(size=x[::2].shape)
    x /= np.sqrt((x * x).sum(axis=1))[:, None]
    perm = np.array([[5, *(rng.permutation(12 if k % 2 == 0 else pivots)[:6] + 6 * (rng.random() < 0.8))] for k in range(n)])
    perm[:, 1:][perm[:, 1:] == 5] = 4
    perm = np.array([p if len(set(p)) == 7 else [5, *range(100, 106)] for p in perm], dtype=np.int32)
    blocks = np.arange(n) // 2 % (block + 1)
    fields = {"pivot": [5] * n, "bi": [0] * n, "bj": [block] * n, "block": blocks, "permutation": perm.tolist(),
              "node": rng.permutation(n), "copies": 1 + np.arange(n) % 3, "digest": [str(k).encode() for k in range(n)],
              "unit": [u.tobytes() for u in x]}
    return pa.record_batch({k: pa.array(v) for k, v in fields.items()}), x, perm, blocks


def links_of(batch, cosine=0.9, shared=2):
    return {r[1]: (r[0], r[2], r[3]) for out in embeddings._links(cosine, shared)(iter([batch]))
            for r in zip(*(c.to_pylist() for c in out.columns))}


@pytest.mark.parametrize("block", [0, 1])
@pytest.mark.parametrize("crowd", [0.02, 0.12])
def test_a_list_in_tiles_has_every_link(monkeypatch, block, crowd):
    monkeypatch.setattr(embeddings, "TILE", 16, raising=False)
    monkeypatch.setattr(embeddings, "SOME", 64, raising=False)
    batch, x, perm, blocks = a_list(np.random.default_rng(3), 120, crowd, 400, block)
    node, copies = batch["node"].to_pylist(), batch["copies"].to_pylist()
    linked = [[j for j in range(120) if i != j and (not block or blocks[i] != blocks[j]) and x[i] @ x[j] >= 0.9
               and len(both := set(perm[i]) & set(perm[j])) >= 2 and min(both) == 5] for i in range(120)]
    want = {}
    for i in range(120):
        reached, todo = {i}, [i]
        while todo:
            new = set(linked[todo.pop()]) - reached
            reached |= new
            todo += new
        if linked[i]:
            want[str(i).encode()] = (node[i], sum(copies[j] for j in linked[i]), min(node[j] for j in reached))
    assert want and links_of(batch) == want


def test_a_long_list_is_compared_in_bounded_memory():
    """Before, all pairs of a list at once: some 150 MB here, and 144 passes over them."""
    batch, *_ = a_list(np.random.default_rng(3), 3000, 0.02, 400)
    tracemalloc.start()
    found = links_of(batch)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found) > 1000 and most < 64 << 20


def test_nearest_pivots_are_ordered_and_ties_go_to_the_first():
    near = np.array([[0.1, 0.5, 0.5, 0.5, 0.9], [0.5, 0.1, 0.2, 0.3, 0.4], [0.0] * 5])
    assert embeddings._nearest(near, 3).tolist() == [[4, 1, 2], [0, 4, 3], [0, 1, 2]]
    assert embeddings._nearest(near, 12).tolist() == [[4, 1, 2, 3, 0], [0, 4, 3, 2, 1], [0, 1, 2, 3, 4]]
