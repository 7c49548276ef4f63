import random

import pytest

from strata.llm import minhash
from strata.llm.common import words_of
from strata.llm.minhash import near_duplicates
from tests.llm.data import awkward, frame, prose, row


def shingles(text, k):
    w = words_of(text)
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute(rows, k):
    """Links between all rows; rows of one doc_id are one document."""
    sets = [shingles(r[1], k) for r in rows]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    key = [r[0] if r[0] is not None else ("row", i) for i, r in enumerate(rows)]
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = find(key[i]), find(key[j])
                if x != y:
                    lo, hi = sorted((x, y), key=lambda v: (isinstance(v, tuple), v))
                    root[hi] = lo
    out = []
    for i, r in enumerate(rows):
        c = find(key[i])
        c = None if isinstance(c, tuple) else c
        if not sets[i]:
            c = r[0]
        out.append((r[0], len(sets[i]), c, r[0] == c))
    return sorted(out, key=repr)


def family(rng, size, edits):
    """Copies of one text with a few words changed, some past the limit."""
    base = prose(rng, 150).split()
    for _ in range(size):
        w = list(base)
        for _ in range(rng.randrange(0, edits)):
            w[rng.randrange(len(w))] = prose(rng, 1)
        yield " ".join(w)


@pytest.mark.parametrize("block", [3, 1024])
def test_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    rng = random.Random(7)
    rows = [row(100 + i, t) for i, t in enumerate(family(rng, 60, 14))]
    rows += [row(300 + i, t) for i, t in enumerate(family(rng, 40, 9))]
    rows += [row(500 + i, prose(rng, rng.randrange(1, 60))) for i in range(60)]
    rng.shuffle(rows)
    got = near_duplicates(frame(spark, rows), k=4).drop("text_key").collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows, 4)


def test_awkward_rows(spark):
    rows = awkward()
    got = near_duplicates(frame(spark, rows)).drop("text_key").collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows, 5)


def test_empty_table(spark):
    assert near_duplicates(frame(spark, [])).count() == 0
