"""Every stage of the pipeline against a brute-force version of it, on the small tables."""

import collections
import random

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as P
from strata.llm.common import saved, table
from strata.llm.line_dedup import OP5_SQL
from strata.llm.packing import tokenizer_path
from strata.llm.quality import LEAST_TRUSTED, MARGIN, PRIOR, QUANTILE, word_grams
from tests.conftest import SF_SMALL
from tests.llm.data import awkward, frame, prose, row
from tests.llm.test_minhash import brute
from tests.llm.test_mixing import level
from tests.llm.test_quality import model


@pytest.fixture(scope="module")
def inputs(spark):
    """What each stage reads and what it returned."""
    docs, out = table(spark, SF_SMALL, "documents"), []
    for name, stage in P.STAGES:
        after = saved(stage(spark, docs, SF_SMALL), "test-" + name)
        out.append((docs, after))
        docs = after
    return {name: x for (name, _), x in zip(P.STAGES, out)}


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def test_stages_keep_the_columns(inputs, spark):
    columns = table(spark, SF_SMALL, "documents").columns
    assert [n for n, _ in P.STAGES] == ["quality", "line_dedup", "near_duplicates", "mixing", "packing"]
    assert all(inputs[n][1].columns == columns for n in list(inputs)[:-1])


def test_quality(spark, inputs):
    docs, kept = inputs["quality"]
    labels = {r["doc_id"]: r["quality"] == 1 and r["toxic"] == 0 for r in table(spark, SF_SMALL, "labels").collect()}
    fold = {r[0]: r[1] for r in docs.select("doc_id", F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(2))).collect()}
    docs = docs.collect()
    counts = [collections.Counter(), collections.Counter()]
    for r in docs:
        if labels.get(r["doc_id"]):
            counts[1 - fold[r["doc_id"]]].update(g for w in r["text"].split() for g in word_grams(w))
    import math
    memo = [{}, {}]
    models = [model(c, 5) for c in counts]

    def nll(text, f):
        total = n = 0
        for w in text.split():
            for g in word_grams(w):
                if g not in memo[f]:
                    memo[f][g] = -math.log(models[f](g))
                total += memo[f][g]
            n += len(w) + 1
        return total, n

    scored = {r["doc_id"]: (r["lang"], *nll(r["text"] or "", fold[r["doc_id"]])) for r in docs}
    good = collections.defaultdict(list)
    for d, (lang, total, n) in scored.items():
        if labels.get(d) and n:
            good[lang].append((total, n))
            good["*"].append((total, n))
    limits = {}
    for lang, xs in good.items():
        if len(xs) >= LEAST_TRUSTED or lang == "*":
            mean = sum(t for t, _ in xs) / sum(n for _, n in xs)
            s = sorted((t + PRIOR * mean) / (n + PRIOR) for t, n in xs)
            at = lambda q: s[max(0, math.ceil(q * len(s)) - 1)]
            limits[lang] = mean, at(0.5) + MARGIN * (at(QUANTILE) - at(0.5))
    want = set()
    for d, (lang, total, n) in scored.items():
        mean, limit = limits.get(lang, limits["*"])
        if not n or (total + PRIOR * mean) / (n + PRIOR) <= limit + 1e-12:
            want.add(d)
    got = {r["doc_id"] for r in kept.collect()}
    assert got == want
    clean = [d for d, ok in labels.items() if ok]
    assert sum(d in got for d in clean) >= 0.97 * len(clean)


def test_lines(inputs):
    before, after = inputs["line_dedup"]
    con = duckdb.connect()
    data = before.select("doc_id", "text").collect()
    con.register("documents", pa.table({"doc_id": [r[0] for r in data], "text": [r[1] for r in data]}))
    assert sorted(rows_of(after.select("doc_id", "text"))) == sorted(
        con.execute(f"SELECT doc_id, text FROM ({OP5_SQL})").fetchall())
    assert after.where("n_chars != length(text)").count() == 0


def test_near_copies(inputs):
    before, after = inputs["near_duplicates"]
    rows = rows_of(before.select("doc_id", "text"))
    assert sorted(r[0] for r in rows_of(after.select("doc_id"))) == [d for d, _, _, kept in sorted(brute(rows, 5)) if kept]


def test_mixture(inputs):
    before, after = inputs["mixing"]
    words = lambda t: len((t or "").encode().split())
    size, text = collections.Counter(), {}
    for r in before.collect():
        size[r["source"]] += words(r["text"])
        text[r["doc_id"]] = r["text"]
    taken, longest, copies = collections.Counter(), collections.Counter(), collections.Counter()
    for r in after.collect():
        assert text[r["doc_id"]] == r["text"]
        taken[r["source"]] += words(r["text"])
        copies[r["doc_id"]] += 1
    for r in before.collect():
        longest[r["source"]] = max(longest[r["source"]], words(r["text"]))
    target = level(dict(size))
    assert max(copies.values()) <= 2
    assert all(abs(taken[s] - target[s]) <= longest[s] + 64 for s in size)


def test_packing(inputs):
    before, after = inputs["packing"]
    plain = Tokenizer.from_file(tokenizer_path())
    want = collections.Counter(r["doc_id"] for r in before.collect())
    length = {r["doc_id"]: len(plain.encode(r["text"], add_special_tokens=False).ids) + 1 for r in before.collect()}
    total = collections.Counter()
    for r in after.collect():
        assert len(r["ids"]) == 4 * r["length"] and r["doc_tokens"] == length[r["doc_id"]]
        total[r["doc_id"]] += r["length"]
    assert total == {d: n * length[d] for d, n in want.items()}


def test_awkward_rows_pass_every_stage(spark, scratch):
    rng = random.Random(1)
    rows = awkward() + [row(500 + i, prose(rng, 80)) for i in range(10)]
    spark.createDataFrame([(500 + i, 1, 0) for i in range(8)] + [(None, None, None)], "doc_id long, quality int, toxic int"
                          ).write.parquet(f"{scratch}/labels.parquet")
    for data in (rows, []):
        docs = frame(spark, data)
        for name, stage in P.STAGES:
            after = saved(stage(spark, docs, scratch), "test-" + name)
            if name != "packing":
                assert after.columns == docs.columns
                assert after.count() > 0 or not data
            docs = after
