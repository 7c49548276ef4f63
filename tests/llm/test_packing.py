import collections

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from strata.llm.packing import WordIds, pack, pack_lengths, tokenizer_path
from tests.llm.data import awkward, frame


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 300), max_size=60), st.sampled_from([16, 64]))
def test_pieces_cover_and_fit(lengths, length):
    pieces = pack_lengths(lengths, length)
    by_doc, by_seq = collections.defaultdict(list), collections.defaultdict(list)
    for i, start, n, s, offset in pieces:
        by_doc[i].append((start, n))
        by_seq[s].append((offset, n))
    for i, n in enumerate(lengths):
        at = 0
        for start, m in sorted(by_doc[i]):
            assert start == at and m > 0
            at += m
        assert at == n
    for parts in by_seq.values():
        at = 0
        for offset, m in sorted(parts):
            assert offset == at
            at += m
        assert at <= length
    assert len(by_seq) == sum(n // length for n in lengths) + -(-sum(n % length for n in lengths) // length)


def test_costs_are_balanced():
    rng = np.random.default_rng(0)
    lengths = rng.integers(10, 900, 800).tolist()
    cost = collections.Counter()
    for _, _, n, s, _ in pack_lengths(lengths, 4096):
        cost[s] += n + n * n / 6144
    assert max(cost.values()) < 1.2 * np.median(list(cost.values()))


def test_word_ids_equal_the_tokenizer():
    ids, plain = WordIds(tokenizer_path()), Tokenizer.from_file(tokenizer_path())
    for text in ["", "Ünïcödé!! naïve's don't ÀÉß\tÿþ a<|endoftext|>b", "İstanbul ΣΑΣ x² ½ 日本語 \x1cabc a b é ́",
                 "a  b\r\nc <|startoftext|> 12 3.4 µm ſt ﬁ", "x" * 3000]:
        assert np.frombuffer(ids(text), dtype="<u4").tolist() == plain.encode(text, add_special_tokens=False).ids


def test_round_trip(spark):
    rows = awkward()
    plain = Tokenizer.from_file(tokenizer_path())
    got = pack(frame(spark, rows), tokenizer_path(), length=256, group_bytes=40_000).collect()
    want = collections.Counter((r[0], tuple(plain.encode(r[1] or "", add_special_tokens=False).ids + [2])) for r in rows)
    seq = collections.defaultdict(list)
    for r in got:
        assert len(r["ids"]) == 4 * r["length"]
        seq[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in seq.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 256
    whole = collections.Counter()
    by_doc = collections.defaultdict(list)
    for r in got:
        by_doc[r["doc_id"]].append((r["start"], np.frombuffer(r["ids"], dtype="<u4").tolist(), r["doc_tokens"]))
    for doc, parts in by_doc.items():
        if len({p[2] for p in parts}) == 1 and sum(len(p[1]) for p in parts) == parts[0][2]:
            whole[doc, tuple(i for p in sorted(parts) for i in p[1])] += 1
    single = {k: n for k, n in want.items() if sum(m for (d, _), m in want.items() if d == k[0]) == 1}
    assert all(whole[k] == 1 for k in single)
    assert sum(r["length"] for r in got) == sum(len(k[1]) * n for k, n in want.items())


def test_empty_table(spark):
    assert pack(frame(spark, []), tokenizer_path()).count() == 0
