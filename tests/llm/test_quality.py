import collections
import math
import random

import numpy as np
import pytest

from strata.llm.quality import classify, discounts, kneser_ney, packed, perplexities, spelled, unpacked, word_grams
from tests.llm.data import awkward, frame, prose, row


def model(counts, order):
    """Interpolated modified Kneser-Ney by its textbook recursion."""
    tables = {order: dict(counts)}
    for k in range(order - 1, 0, -1):
        tables[k] = collections.Counter(g[1:] for g in tables[k + 1])
    d = {k: discounts(*(sum(1 for n in t.values() if n == i) for i in (1, 2, 3, 4))) for k, t in tables.items()}
    contexts = {k: collections.defaultdict(list) for k in tables}
    for k, t in tables.items():
        for g, n in t.items():
            contexts[k][g[:-1]].append(n)

    def p(g):
        k = len(g)
        if not k:
            return 1 / (len(tables[1]) + 1)
        seen = contexts[k].get(g[:-1])
        if not seen:
            return p(g[1:])
        off = lambda n: d[k][min(n, 3) - 1]
        n = tables[k].get(g, 0)
        return (max(n - off(n), 0) if n else 0) / sum(seen) + sum(map(off, seen)) / sum(seen) * p(g[1:])

    return p


def test_probabilities_equal_the_recursion_and_sum_to_one(spark):
    rng = random.Random(1)
    words = prose(rng, 300, 60).split()
    counts = collections.Counter(g for w in words for g in word_grams(w))
    other = collections.Counter(g for w in words[:40] for g in word_grams(w))
    needed = sorted({g for w in [*words, "unseen", "zzz"] for g in word_grams(w)})
    rows = [(0, g, n) for g, n in counts.items()] + [(1, g, n) for g, n in other.items()]
    got = kneser_ney(spark.createDataFrame(rows, "fold int, gram string, n long"),
                     spark.createDataFrame([(g,) for g in needed], "gram string")).collect()
    assert len(got) == 2 * len(needed)
    for fold, c in ((0, counts), (1, other)):
        p = model(c, 5)
        assert all(math.isclose(r["p"], p(r["gram"]), rel_tol=1e-9) for r in got if r["fold"] == fold)
        symbols = {g[-1] for g in c}
        total = sum(p(needed[0][:-1] + s) for s in symbols)
        assert total + 1 / (len(symbols) + 1) >= 0.99 and total <= 1 + 1e-9


def test_spelling_and_packing_round_trip():
    rng = random.Random(4)
    words = list(dict.fromkeys(["a", "Ünï", "日本語", "\x02x", "x" * 500, *prose(rng, 200).split(),
                                *(chr(0x4E00 + i) + chr(0x1F300 + i % 700) for i in range(9000))]))
    names, numbers, begins = spelled(words)
    assert len(names) == len(set(names))
    for w, a, b in zip(words, begins, [*begins[1:], len(numbers)]):
        assert [names[i] for i in numbers[a:b]] == word_grams(w)
    assert spelled([])[0] == []
    for codes in ([], [5], [3, 3, 900_000, 2, 0], list(range(300))):
        assert unpacked(packed(np.array(codes, dtype=np.int32))).tolist() == codes


def corpus():
    rng = random.Random(2)
    good = [row(2000 + i, ". ".join(prose(rng, 60).capitalize() for _ in range(3)), "en" if i % 3 else "de") for i in range(240)]
    bad = [row(1000 + i, " ".join(w.upper() + "!!" for w in prose(rng, 80).split())) for i in range(10)]
    bad += [row(1100 + i, " | ".join(f"{rng.random():.9f}" for _ in range(60)), None) for i in range(10)]
    return good, bad


def test_junk_goes_and_clean_text_stays(spark):
    good, bad = corpus()
    trusted = spark.createDataFrame([(r[0],) for r in good[:150]] + [(None,)], "doc_id long")
    got = classify(perplexities(frame(spark, good + bad + awkward()), trusted, block_bytes=20_000)).collect()
    assert len(got) == len(good + bad + awkward())
    kept = collections.defaultdict(list)
    for r in got:
        kept[r["doc_id"]].append(r["kept"])
    assert not any(kept[r[0]][0] for r in bad)
    fresh = [kept[r[0]][0] for r in good[150:]]       # clean text that the model hasn't seen
    assert sum(fresh) >= 0.97 * len(fresh)
    assert kept[4] == kept[6] == [True]               # no words, nothing to reject


def test_blocks_do_not_change_the_scores(spark):
    good, bad = corpus()
    trusted = spark.createDataFrame([(r[0],) for r in good[:150]], "doc_id long")
    both = [{(r["doc_id"], r["text_key"]): (r["symbols"], round(r["nll"], 6)) for r in
             perplexities(frame(spark, good + bad), trusted, block_bytes=n).collect()} for n in (5_000, 10**9)]
    assert both[0] == both[1]


@pytest.mark.parametrize("trusted", [[], [(1,)]])
def test_little_or_no_trusted_text_and_empty_table(spark, trusted):
    ids = spark.createDataFrame(trusted, "doc_id long")
    got = classify(perplexities(frame(spark, awkward()), ids))
    assert got.count() == len(awkward())
    if not trusted:
        assert got.where("NOT kept").count() == 0
    assert classify(perplexities(frame(spark, []), ids)).count() == 0
