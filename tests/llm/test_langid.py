"""Language identification: held-out accuracy, plain recomputation, awkward rows."""

import random
import zlib

import pytest
import zstandard

from strata.llm import langid
from strata.llm.common import table
from strata.llm.langid import BLOCK, LEVEL, Dictionaries, identify, learn, op12_zstd_language, predict, spelled
from tests.llm.data import awkward, frame, row

SYLLABLES = {"aa": ["ka", "lo", "mi", "ne"], "bb": ["sch", "ung", "ein", "der"], "cc": ["né", "ou", "eau", "ère"]}


def prose(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def labelled(rng, n=240):
    return [row(i, prose(rng, lang, rng.randrange(5, 80)), lang) for i, lang in zip(range(n), list(SYLLABLES) * n)]


def sizes(text, content):
    """Bytes of a text with a dictionary, by a fresh compressor for each block."""
    raw, total = spelled(text), 0
    for at in range(0, len(raw), BLOCK):
        held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        how = zstandard.ZstdCompressionParameters.from_level(LEVEL, source_size=BLOCK, dict_size=len(content),
                                                             write_content_size=False, write_dict_id=False)
        held.precompute_compress(compression_params=how)
        total += len(zstandard.ZstdCompressor(dict_data=held, compression_params=how).compress(raw[at:at + BLOCK]))
    return total


def test_equals_plain_recomputation(spark):
    rng = random.Random(1)
    docs = frame(spark, labelled(rng) + awkward())
    model = learn(docs.where(~langid.held_out()))
    assert set(model.languages) >= set(SYLLABLES)
    got = identify(docs, model).collect()
    source = docs.select("doc_id", "text").collect()
    assert len(got) == len(source)
    want = []
    for doc_id, text in source:
        out = zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5 == 0
        if not any(c.isalpha() for c in text or ""):
            want.append((doc_id, out, "und", 0.0, True))
            continue
        all_ = [sizes(text, c) for c in model.contents]
        best = all_.index(min(all_))
        score = 1 - all_[best] / min(s for i, s in enumerate(all_) if i != best)
        want.append((doc_id, out, model.languages[best], score, score < langid.MIN_MARGIN))
    key = lambda r: (r[0] is not None, r[0] or 0, r[2], r[3])
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_held_out_accuracy(spark):
    rng = random.Random(2)
    docs = frame(spark, labelled(rng, 400))
    model = learn(docs.where(~langid.held_out()))
    lang = {r["doc_id"]: r["lang"] for r in docs.collect()}
    judged = [r for r in identify(docs, model).collect() if r["held_out"]]
    wrong = [(r["doc_id"], r["lang_pred"], r["score"]) for r in judged if r["lang_pred"] != lang[r["doc_id"]]]
    assert len(judged) > 40 and len(wrong) <= 0.03 * len(judged), wrong


def test_held_out_accuracy_on_documents(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    lang = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    judged = [r for r in op12_zstd_language(spark, "/root/testdata/sf0.01").collect() if r["held_out"]]
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in judged) >= 0.98 * len(judged)


def test_learning_ignores_the_held_out_fold_and_partitioning(spark):
    rows = labelled(random.Random(3))
    poison = [row(r[0], "zzz qqq " * 50, r[2]) if zlib.crc32(str(r[0]).encode()) % 5 == 0 else r for r in rows]
    learned = [learn(frame(spark, x).repartition(n).where(~langid.held_out())) for x, n in ((rows, 1), (poison, 7), (rows + rows, 3))]
    assert learned[0] == learned[1] == learned[2]


def test_sample_is_bounded(spark):
    model = learn(frame(spark, labelled(random.Random(4))), texts=5, piece=30, most=2)
    assert len(model.languages) == 2 and all(len(c) <= 5 * 70 for c in model.contents)


def test_nothing_learned_and_one_language(spark):
    docs = frame(spark, [row(1, "ka lo", None), row(2, None, "aa"), row(3, "", "bb"), row(4, "12 ²", "cc")])
    model = learn(docs)
    assert model.languages == ()
    assert {(r["lang_pred"], r["score"]) for r in identify(docs, model).collect()} == {("und", 0.0)}
    assert identify(frame(spark, []), model).collect() == []
    assert predict("ka lo", ("aa",), Dictionaries(("aa",), (b"ka lo mi",)).encoders()) == ("aa", 1.0)


@pytest.mark.parametrize("text", ["", " \t", "123 ²³ ½ _-", "日本", "ÿ"])
def test_letters(text):
    assert bool(spelled(text)) == any(c.isalpha() for c in text)
