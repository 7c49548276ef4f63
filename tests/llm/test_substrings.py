import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm.substrings import ANCHOR, GAP, chains, equal_runs, repeated_passages, stretches, syncmers
from tests.llm.data import awkward, frame, prose, row


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 120), st.integers(0, 120), st.integers(4, 20)), min_size=1, max_size=14, unique=True))
def test_best_chain_equals_all_pairs(segs):
    segs = sorted(segs)
    best = [0.0] * len(segs)
    for i, (a, b, n) in enumerate(segs):
        best[i] = n + max([0.0] + [best[j] - GAP * (a - x - m + b - y - m) for j, (x, y, m) in enumerate(segs)
                                   if x + m <= a and y + m <= b])
    got = chains(segs)

    def score(chain):
        skipped = sum((a - x - m) + (b - y - m) for (x, y, m), (a, b, _) in zip(chain, chain[1:]))
        return sum(n for _, _, n in chain) - GAP * skipped

    assert abs(score(got[0]) - max(best)) < 1e-9
    assert sorted(s for c in got for s in c) == segs
    for chain in got:
        assert all(x + m <= a and y + m <= b for (x, y, m), (a, b, _) in zip(chain, chain[1:]))


def test_align_spans_substitutions_and_insertions():
    rng = np.random.default_rng(2)
    a = rng.integers(0, 2**32, 300).astype("<u4")
    b = np.concatenate([rng.integers(0, 2**32, 30).astype("<u4"), a[100:150], [5, 6], a[150:220], rng.integers(0, 2**32, 9).astype("<u4")])
    b[50] = 1
    found = equal_runs(a, b, [(110, 40, 10), (160, 92, 20)])
    (x, y, _), (u, v, n) = found[0], found[-1]
    assert (x, u + n, y, v + n, sum(n for _, _, n in found)) == (100, 220, 30, 152, 119)


def corpus(rng):
    passage, longer = prose(rng, 70), prose(rng, 140)
    rows = []
    for i in range(12):
        words = passage.split()
        if i % 3 == 1:
            words[rng.randrange(20, 50)] = "swapped"
        if i % 3 == 2:
            words.insert(rng.randrange(20, 50), "inserted")
        rows.append((i, 0, row(100 + i, " ".join([prose(rng, 30 + 10 * i), *words, prose(rng, 40)]))))
    for i in range(3):
        rows.append((i, 1, row(200 + i, prose(rng, 100) + " " + longer)))
    clean = [row(300 + i, prose(rng, 250)) for i in range(30)]
    line = prose(rng, 12)
    clean += [row(400 + i, prose(rng, 60) + " " + line + " " + prose(rng, 60)) for i in range(15)]
    return rows, clean


def test_passages_are_found_and_clean_text_is_not(spark):
    rng = random.Random(3)
    planted, clean = corpus(rng)
    got = repeated_passages(frame(spark, [r for _, _, r in planted] + clean)).collect()
    spans = {r["doc_id"]: r for r in got}
    assert len(spans) == len(got) and set(spans) == {r[0] for _, _, r in planted}
    for i, kind, r in planted:
        start, n = (30 + 10 * i, 70 + (i % 3 == 2)) if kind == 0 else (100, 140)
        s = spans[r[0]]
        assert abs(s["start_word"] - start) <= 3 and abs(s["end_word"] - start - n) <= 3
        assert s["n_words"] == s["end_word"] - s["start_word"] and s["identity"] > 0.9
        assert s["partner_id"] // 100 == r[0] // 100 and s["partner_id"] != r[0]


def test_awkward_rows_and_empty_table(spark):
    got = {(r["doc_id"], r["start_word"], r["end_word"]) for r in repeated_passages(frame(spark, awkward())).collect()}
    assert {(1, 0, 120), (2, 0, 120), (3, 0, 120), (15, 0, 120)} <= got
    assert {d for d, _, _ in got} <= {1, 2, 3, 15}
    assert repeated_passages(frame(spark, [])).count() == 0


def test_stretches_cover_all_parts():
    rng = np.random.default_rng(4)
    for _ in range(200):
        a = rng.integers(0, 2**32, rng.integers(60, 300)).astype("<u4")
        b = np.where(rng.random(len(a)) < np.repeat(rng.random(10) * 0.5, 30)[:len(a)], 9, a).astype("<u4")
        b[5:9], b[-4:] = a[5:9], a[-4:]
        found = equal_runs(a, b, [(5, 5, 4), (len(a) - 4, len(a) - 4, 4)])
        got = stretches(a, b, found, 25, 0.7)
        assert all(a1 - a0 >= 25 and (a[a0:a1] == b[b0:b1]).sum() == n >= 0.7 * (a1 - a0) for a0, a1, b0, b1, n in got)
        held = {w for a0, a1, *_ in got for w in range(a0, a1)}
        for i, (x, _, n) in enumerate(found):
            for u, _, m in found[i:]:
                if n >= ANCHOR <= m and u + m - x >= 25 and (a[x:u + m] == b[x:u + m]).sum() >= 0.7 * (u + m - x):
                    assert held.issuperset(range(x, u + m))


def test_two_passages_of_a_pair_are_both_found(spark):
    """Whatever lies between them: a chain joins the passages where it is short, and 900 words are never compared."""
    rng = random.Random(8)
    rows, want = [], {}
    for i, (n, ga, gb) in enumerate(((60, 0, 80), (100, 0, 150), (100, 110, 110), (300, 400, 400), (700, 900, 900))):
        one, two = prose(rng, n), prose(rng, n)
        for side, gap in ((0, ga), (1, gb)):
            doc = 10 * i + side
            rows.append(row(doc, " ".join(filter(None, [prose(rng, 40), one, prose(rng, gap), two, prose(rng, 40)]))))
            want[doc] = set(range(40, 40 + n)) | set(range(40 + n + gap, 40 + 2 * n + gap))
    got = {doc: set() for doc in want}
    for r in repeated_passages(frame(spark, rows)).collect():
        got[r["doc_id"]] |= set(range(r["start_word"], r["end_word"]))
    for doc, words in want.items():
        assert len(words - got[doc]) <= 4 and len(got[doc] - words) <= 12, doc


def test_every_run_of_seven_words_has_a_seed():
    rng = np.random.default_rng(1)
    for _ in range(200):
        common, x, y = (rng.integers(0, 2**63, n, dtype=np.uint64) for n in (7, 40, 40))
        found = [set(syncmers(np.concatenate([z, common, z[::-1]]))[1].tolist()) for z in (x, y)]
        assert found[0] & found[1]
    assert not len(syncmers(common[:4])[0])


def test_edited_passages_are_found(spark):
    """60 words with a word changed every 8, and at random: the identity they keep is far over the limit."""
    rng, rows = random.Random(9), []
    for i in range(60):
        words = prose(rng, 60).split()
        other = list(words)
        for at in range(7, 60, 8) if i < 30 else rng.sample(range(60), 9):
            other[at] = "changed"
        rows += [row(2 * i + side, " ".join([prose(rng, 50), *w, prose(rng, 50)])) for side, w in ((0, words), (1, other))]
    got = {r["doc_id"]: r for r in repeated_passages(frame(spark, rows)).collect()}
    assert set(range(60)) <= set(got)                     # all that change every eighth word
    assert len(got) >= 114                                # at random, 15 % of the words
    assert all(abs(r["start_word"] - 50) <= 8 and abs(r["end_word"] - 110) <= 8 for d, r in got.items() if d < 60)


def test_all_exact_runs_of_fifty_words_are_covered(spark):
    """Against brute force over every 50-word run of every document: all its words, but for one or two at its ends
    that a document shares by chance with another than its partners."""
    from strata.llm.common import words_of
    rng = random.Random(12)
    shared = [prose(rng, n) for n in (50, 51, 64, 90, 200)]
    rows = awkward()
    for i in range(60):
        parts = [prose(rng, rng.randrange(5, 120))]
        for _ in range(i % 4):
            parts += [rng.choice(shared), prose(rng, rng.randrange(0, 200))]
        rows.append(row(1000 + i, " ".join(filter(None, parts))))
    rows += [row(2000 + i, "ka lo " * 120 + prose(rng, 60)) for i in range(8)]      # a very common pair of words
    places = {}
    for r in rows:
        words = words_of(r[1])
        for i in range(len(words) - 49):
            places.setdefault(tuple(words[i:i + 50]), set()).add((r[0], i))
    held = {}
    for r in repeated_passages(frame(spark, rows)).collect():
        held.setdefault(r["doc_id"], set()).update(range(r["start_word"], r["end_word"]))
    for found in places.values():
        if len({d for d, _ in found if d is not None}) > 1:
            for doc, i in found:
                if doc is not None:
                    missed = set(range(i, i + 50)) - held.get(doc, set())
                    assert len(missed) <= 2 and missed <= {i, i + 1, i + 48, i + 49}, (doc, i, missed)


def test_words_that_repeat_over_and_over(spark):
    """Runs of two, three and four words: few seeds, and all of the run is found but for a few words at its end."""
    rng, rows, runs = random.Random(14), [], {}
    for i in range(24):
        pattern = [f"p{i % 6}w{j}" for j in range(2 + i % 3)]
        before, n = rng.randrange(5, 60), rng.randrange(80, 400)
        rows.append(row(i, " ".join([prose(rng, before), *(pattern * n)[:n], prose(rng, 20)])))
        runs[i] = before, before + n
    words = np.tile(np.arange(1, 3, dtype=np.uint64), 500)
    assert len(syncmers(words)[0]) <= 260
    held = {}
    for r in repeated_passages(frame(spark, rows)).collect():
        held.setdefault(r["doc_id"], set()).update(range(r["start_word"], r["end_word"]))
    assert all(held[i].issuperset(range(a + 2, b - 6)) for i, (a, b) in runs.items())


def scattered(rng, passage: list[str], n: int, size: int = 8) -> list[str]:
    """Texts that hold all words of a passage in order, a few at a time."""
    pieces = [" ".join(passage[i:i + size]) for i in range(0, len(passage), size // 2)]
    return [" ".join(f"{p} {prose(rng, 30)}" for p in rng.sample(pieces, len(pieces))) for _ in range(n)]


def test_passages_whose_seeds_occur_elsewhere_are_found(spark):
    """A smallest and a largest document, or many others, hold every seed of a passage, but not the passage."""
    for others in (2, 60):
        rng = random.Random(others)
        passage, edited = prose(rng, 100).split(), prose(rng, 100).split()
        changed = [f"changed{i}" if i % 10 == 9 else w for i, w in enumerate(edited)]
        pieces = list(zip(scattered(rng, passage, others), scattered(rng, edited, others)))
        rows = [row(i if i % 2 else 1000 + i, f"{a} {b}") for i, (a, b) in enumerate(pieces)]
        for doc, words in ((500, passage), (510, passage), (520, edited), (530, changed)):
            rows.append(row(doc, " ".join([prose(rng, 40), *words, prose(rng, 40)])))
        got = {r["doc_id"]: r for r in repeated_passages(frame(spark, rows)).collect()}
        assert set(got) == {500, 510, 520, 530}
        for doc, partner in ((500, 510), (510, 500), (520, 530), (530, 520)):
            r = got[doc]
            assert r["partner_id"] == partner and abs(r["start_word"] - 40) <= 3 and abs(r["end_word"] - 140) <= 3


def test_matches_equal_brute_force_and_grow_with_places():
    """All pairs of a seed's few places, each place of others once, whatever the batches; contexts too."""
    import pyarrow as pa
    from strata.llm.substrings import FEW, _context_task, _match_task
    rng = random.Random(4)
    rows = sorted({(rng.choice((1, 1, 2, 3, rng.randrange(4, 400))), rng.randrange(30), rng.randrange(50)) for _ in range(2500)})

    def batches(rows, names, size):
        rows = sorted(rows, key=lambda r: r[:1] if names[0] == "seed" else r)       # a seed's places in any order
        types = [pa.int32() if c == "pos" else pa.int64() for c in names]
        for i in range(0, len(rows), size):
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows[i:i + size]), types)], names=names)

    def out(batches):
        return sorted((tuple(r.values()) for b in batches for r in b.to_pylist()), key=str)

    groups = {}
    for seed, doc, pos in set(rows):
        groups.setdefault(seed, []).append((doc, pos))
    want = [(s, d, None, p, None) for s, g in groups.items() if len(g) > FEW for d, p in g]
    want += [(None, a, b, x, y) for g in groups.values() if len(g) <= FEW for a, x in g for b, y in g if a < b]
    rng.shuffle(rows)
    turned = [(d, p, s) for s, d, p in rows + rows[-3:]]
    whole = out(_context_task(batches(turned, ["doc", "pos", "seed"], 10_000)))
    assert whole
    for size in (1, 7, 100, 10_000):
        assert out(_match_task(FEW)(batches(rows, ["seed", "doc", "pos"], size))) == sorted(want, key=str)
        assert out(_context_task(batches(turned, ["doc", "pos", "seed"], size))) == whole


def test_places_of_frequent_seeds_match_the_ends_of_their_groups():
    """Against brute force, whatever the batches and however few places a task holds; without the places on demand."""
    import pyarrow as pa
    from strata.llm.substrings import FEW, _match_task
    rng = random.Random(6)
    rows = sorted(((rng.choice((1, 1, 2, 3, 4, rng.randrange(5, 300))), rng.randrange(20), rng.randrange(90)) for _ in range(1500)),
                  key=lambda r: r[0])
    rows += [(999, 7, i) for i in range(40)]        # all in one document
    names, types = ["seed", "doc", "pos"], [pa.int64(), pa.int64(), pa.int32()]
    groups, places, ends = {}, [], set()
    for seed, doc, pos in rows:
        groups.setdefault(seed, []).append((doc, pos))
    for seed, g in groups.items():
        if len(g) > FEW:
            places += [(seed, d, None, p, None) for d, p in g]
            for place in g:
                for end in (min(g), max(g)):
                    if place[0] != end[0]:
                        (a, x), (b, y) = sorted((place, end))
                        ends.add((None, a, b, x, y))
    few = {(None, *min(((a, b, x, y), (b, a, y, x)))) for g in groups.values() if len(g) <= FEW
           for a, x in g for b, y in g if a != b}
    assert ends and few
    for size in (1, 7, 100, 5000):
        for most in (1, 60, 10_000):
            batches = [pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows[i:i + size]), types)], names=names)
                       for i in range(0, len(rows), size)]
            got = [tuple(r.values()) for b in _match_task(FEW, True, True, most)(iter(batches)) for r in b.to_pylist()]
            assert sorted((r for r in got if r[0] is not None), key=str) == sorted(places, key=str)
            assert {r for r in got if r[0] is None} == ends | few
            bare = [tuple(r.values()) for b in _match_task(FEW, False, True, most)(iter(batches)) for r in b.to_pylist()]
            assert set(bare) == ends | few


def test_seeds_of_texts_taken_together_are_those_of_each():
    """Short, empty and null texts, repetitions at their ends, and texts longer than are hashed at once."""
    import pyarrow as pa
    from strata.llm.common import PIECE, many_hashes, text_hashes
    from strata.llm.substrings import SEED, SUB, _seeds, _words
    rng = random.Random(5)
    texts = [None, "", " ", "a b c d", "x y " * 40, "y x " * 40, "x y " * 40, "z " * 30, "z " * 30, "\u00e9t\u00e9\u00a0A b\tC\x0b " * 9,
             prose(rng, 30_000), "w" * (PIECE + 9) + " " + prose(rng, 20), *[prose(rng, rng.randrange(60)) for _ in range(800)]]
    rng.shuffle(texts)
    each = [text_hashes(t) for t in texts]
    pieces = list(many_hashes(texts))
    assert len(pieces) < len(texts) and np.concatenate([n for _, n in pieces]).tolist() == [len(h) for h in each]
    assert (np.concatenate([h for h, _ in pieces]) == np.concatenate(each)).all()
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), type=pa.int64()), pa.array(texts)], names=["doc", "text"])
    want = [(int(s) >> 16, doc, int(at)) for doc, h in enumerate(each) for at, s in zip(*syncmers(h))]
    assert [tuple(r.values()) for b in _seeds(SEED, SUB)(iter([batch])) for r in b.to_pylist()] == want
    words = [tuple(r.values()) for b in _words(iter([batch])) for r in b.to_pylist()]
    assert words == [(doc, (h >> np.uint64(32)).astype("<u4").tobytes()) for doc, h in enumerate(each)]


def test_pairs_with_the_same_number_are_told_apart():
    import pyarrow as pa
    from strata.llm.substrings import SPARSE, SEED, _chain_task
    rows = [(5, 1, 2, 10, 20), (5, 3, 4, 10, 20), (5, 1, 2, 14, 24), (6, 1, 9, 0, 0), (7, 1, 3, 0, 0), (7, 1, 3, 50, 60)]
    types = [pa.int64()] * 3 + [pa.int32()] * 2
    for size in (1, 2, 6):
        batches = [pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows[i:i + size]), types)], names=["pair", "a", "b", "pa", "pb"])
                   for i in range(0, len(rows), size)]
        got = [tuple(r.values()) for b in _chain_task(SEED, SPARSE, GAP)(iter(batches)) for r in b.to_pylist()]
        assert sorted((a, b, a0, a1, b0, b1) for a, b, _, a0, a1, b0, b1, _ in got) == [
            (1, 2, 10, 19, 20, 29), (1, 3, 0, 5, 0, 5), (1, 3, 50, 55, 60, 65), (1, 9, 0, 5, 0, 5), (3, 4, 10, 15, 20, 25)]
