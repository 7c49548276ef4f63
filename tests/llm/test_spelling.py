"""Spelling variants against brute force: counts with lost letters, near words of all pairs, forms and roots."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from strata.llm import spelling
from tests.llm.data import awkward, frame, row


def occurrences(rows) -> Counter:
    n = Counter()
    for r in rows:
        doc, text = ("" if r[0] is None else str(r[0])), r[1] or ""
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        for run in re.findall("[a-zÀ-ÿ]+", low):
            h = zlib.crc32(f"{doc}:{run}".encode())
            n[run if h % 97 else run[:h % len(run)] + run[h % len(run) + 1:]] += 1
    return n


def one_apart(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows):
    words = {w: n for w, n in occurrences(rows).items() if len(w) >= 5 and n >= 3}
    near = {w: [o for o in words if one_apart(w, o)] for w in words}
    best = {w: min(near[w], key=lambda o: (-words[o], o)) for w in words if near[w]}
    form = {w: o for w, o in best.items() if words[o] >= 2 * words[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {w: (form.get(w), root(w), n, len(near[w]), words[form[w]] if w in form else None) for w, n in words.items()}


def garbled(rng, words, n):
    out = []
    for _ in range(n):
        w = list(rng.choice(words))
        kind, at = rng.randrange(6), rng.randrange(len(w))
        if kind == 0:
            w[at] = rng.choice("abéz")
        elif kind == 1:
            del w[at]
        elif kind == 2:
            w.insert(at, rng.choice("aéÿ"))
        out.append("".join(w))
    return " ".join(out)


@pytest.mark.parametrize("shard_letters", [1 << 16, 40])
def test_equals_brute_force(spark, shard_letters):
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdéz") for _ in range(rng.randrange(4, 9))) for _ in range(60)] + ["aaaaa", "aaaaaa", "x" * 300]
    rows = awkward() + [row(100 + i, garbled(rng, words[i % 7:], 200).title()) for i in range(20)]
    rows += [row(200, "x" * 299 + " " + "x" * 300 + "!" + "x" * 300)] * 3
    rows += [row(301, "qqqqq " * 4 + "qqqqqr " * 9 + "qqqqrr " * 20)]     # a chain of two forms
    got = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"])
           for r in spelling.spelling_variants(frame(spark, rows), shard_letters=shard_letters).collect()}
    want = brute(rows)
    assert got == want
    assert any(v[1] not in (w, v[0]) for w, v in want.items())


def test_empty_and_wordless_tables(spark):
    assert spelling.spelling_variants(frame(spark, [])).collect() == []
    assert spelling.spelling_variants(frame(spark, [row(1, None), row(None, "1 2 3"), row(2, "ab ab ab")])).collect() == []


def test_slices_cut_no_run(monkeypatch):
    monkeypatch.setattr(spelling, "SLICE", 7)
    text = "One twothree fourfivesix\n\n7 Élève élève×x " * 5
    assert [r for part in spelling.runs_of(text) for r in part] == re.findall("[a-zÀ-ÿ]+", text.encode().lower().decode())


def test_walks_reach_every_near_word():
    rng = random.Random(8)
    words = sorted({"".join(rng.choice("abcde") for _ in range(rng.randrange(5, 8))) for _ in range(400)})
    group = np.arange(256) % spelling.GROUPS
    v = dict(zip(words, spelling.vectors(words, group).tolist()))
    split = {"": 1, "5": 2, "6": 3, "6,0": 2, "6,1": 2, "7": 9, "7,0": 1, "7,0,0": 1, "7,0,0,1": 4}
    for a in words[:60]:
        reach = spelling.reached(v[a], split)
        assert len(reach) == len(set(reach))
        for b in words:
            if one_apart(a, b):
                assert spelling.home(v[b], b, split) in reach
