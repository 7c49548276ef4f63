"""Arrow batches are bounded in rows and in bytes."""

import random

import pyarrow as pa

from strata.llm.common import PIECE, batches_of, text_hashes, words_of

SCHEMA = pa.schema([("id", pa.int64()), ("raw", pa.binary()), ("list", pa.list_(pa.int64()))])


def test_batches_are_cut_by_rows_and_bytes():
    rows = [(i, b"x" * (i % 7 * 100), [1] * (i % 3)) for i in range(1000)]
    for size, most in ((64, 1 << 30), (10_000, 2000), (64, 2000), (1, 1)):
        got = list(batches_of(iter(rows), SCHEMA, size, most))
        assert [tuple(r.values()) for b in got for r in b.to_pylist()] == rows
        assert all(b.num_rows <= size for b in got)
        assert all(b.num_rows == 1 or sum(len(r["raw"]) + 8 * len(r["list"]) for r in b.to_pylist()) <= most for b in got)
    assert list(batches_of(iter([]), SCHEMA)) == []


def test_rows_of_many_megabytes_stay_arrow_batches():
    """256 rows of 9 MB each don't fit one batch of 32-bit offsets."""
    raw = b"x" * (9 << 20)
    got = 0
    for batch in batches_of(((i, raw, None) for i in range(256)), SCHEMA, 256):
        assert isinstance(batch, pa.RecordBatch) and batch.nbytes < 48 << 20
        got += batch.num_rows
    assert got == 256


def test_text_hashes_depend_on_the_word_alone():
    """Wherever a word stands, in a short text, across pieces, or longer than a piece, it has one hash of its own."""
    draw = random.Random(3)
    letters = "abcDEFxyz0-\u00e9\u4e2d\u00a0\u2003\x1c\x85"
    words = ["".join(draw.choice(letters) for _ in range(draw.randint(1, 12))) for _ in range(3000)]
    words += ["ab", "ba", "aab", "aba", "baa", "\x00", "\x00\x00", "q" * PIECE, "q" * (PIECE + 1), "q" * (3 * PIECE), "q" * (3 * PIECE - 1)]
    texts = [None, "", " ", "\t\n\x0b\x0c\r ", *words[:50], *(" " + w + "\n" for w in words[-11:])]
    for n in (10, 1000, 40_000):
        texts.append("".join(draw.choice(words[:-4]) + draw.choice((" ", "\n", " \t", "\x0b\x0c\r ")) for _ in range(n)))
    texts.append("ab " * 3 + "q" * (3 * PIECE) + " ab " + "q" * (PIECE + 1) + " aba")
    texts.append("x" * (PIECE - 1) + " ab " + "x" * PIECE)
    seen = {}
    for text in texts:
        own, got = words_of(text), text_hashes(text).tolist()
        assert len(own) == len(got)
        for word, h in zip(own, got):
            assert seen.setdefault(word, h) == h
    assert len(set(seen.values())) == len(seen) > 2000
