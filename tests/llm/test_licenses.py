import random
import re

from strata.llm.licenses import NOTICES, PHRASES, license_spans, op6_diagonal_voting, template_words
from tests.llm.data import awkward, frame, prose, row

LOWER = {c: c + 32 for c in range(65, 91)}
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(rows):
    out = []
    for r in rows:
        w = WORD.findall((r[1] or "").translate(LOWER))
        at, labels = [], set()
        for phrase, label in PHRASES.items():
            p = phrase.split()
            here = [i for i in range(len(w)) if w[i:i + len(p)] == p]
            at += here
            labels |= {label} if here else set()
        out.append((r[0], len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))))
    return sorted(out, key=repr)


def texts():
    rng = random.Random(8)
    out = awkward(rng)
    for i in range(40):
        words = prose(rng, 60).split()
        for _ in range(rng.randrange(0, 4)):
            words.insert(rng.randrange(len(words)), rng.choice(
                ["MIT License,", "mit-license", "Apache\nLicense", "general public license", "general Public", "mit mit license"]))
        out.append(row(100 + i, " ".join(words)))
    return out + [row(200, "mit license mit license"), row(201, "mİt license"), row(202, "mit licenſe"), row(203, "MIT K License")]


def read(spark, rows, scratch):
    frame(spark, rows).write.parquet(f"{scratch}/documents.parquet")
    return op6_diagonal_voting(spark, scratch)


def test_base_equals_brute_force(spark, scratch):
    got = read(spark, texts(), scratch).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(texts())


def test_notices_with_edits_are_found_and_prose_is_not(spark):
    rng = random.Random(9)
    rows, want = [], {}
    for i, (notice, label) in enumerate(NOTICES.items()):
        words = notice.split()
        if len(words) > 14:
            words[len(words) // 2] = "changed"
            words.insert(len(words) // 4, "inserted")
        rows.append(row(i, prose(rng, 50) + " " + " ".join(words) + " " + prose(rng, 50)))
        want[i] = label
    rows += [row(50 + i, prose(rng, 300)) for i in range(5)]
    found = {}
    for r in license_spans(frame(spark, rows)).where("NOT base").collect():
        found.setdefault(r["doc_id"], set()).add(r["label"])
        n = len(template_words(next(t for t, x in NOTICES.items() if x == r["label"])))
        assert r["start"] >= 45 and r["end"] - r["start"] <= 1.6 * max(n, 30) and 0.6 <= r["coverage"] <= 1
    assert all(want[i] in found[i] for i in want) and set(found) == set(want)


def test_empty_table(spark, scratch):
    assert read(spark, [], scratch).count() == 0
