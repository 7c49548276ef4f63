import collections
import math
import random

from strata.llm.common import saved
from strata.llm.mixing import mix, sized, targets
from tests.llm.data import awkward, frame, prose, row


def level(sizes, weights=(5, 2, 1), share=1.5):
    """Targets by handing the excess round until nothing is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    free, left, out = set(order), share * sum(sizes.values()), {}
    while free:
        rate = left / sum(w[s] for s in free)
        over = {s for s in free if rate * w[s] > 2 * sizes[s]}
        for s in over or free:
            out[s] = 2 * sizes[s] if over else rate * w[s]
            left -= out[s]
        free -= over or set(free)
    return out


def words(text):
    return len((text or "").split())    # ASCII white space in these texts only


def corpus():
    rng = random.Random(2)
    out = [row(100 + i, prose(rng, rng.randrange(1, 300)), source=rng.choice("aaaaabcdé")) for i in range(150)]
    return out + [row(300 + i, prose(rng, 20), source=None) for i in range(5)] + awkward()


def test_targets_equal_iteration(spark):
    rng = random.Random(3)
    for sizes in ({"a": 10, "b": 1000, "c": 5, None: 700}, {"x": 5}, {"a": 0, "b": 0}, {"a": 0, "b": 9},
                  {f"s{i}": rng.randrange(0, 500) for i in range(25)}):
        df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = targets(df).orderBy("lo", "hi").collect()
        want = level(sizes)
        assert all(math.isclose(r["target"], want[r["source"]], abs_tol=1e-6) for r in got)
        if sum(sizes.values()):
            assert got[0]["lo"] == 0 and max(r["hi"] for r in got) == 1


def test_mix_takes_its_targets(spark):
    rows = corpus()
    pieces = mix(saved(sized(frame(spark, rows)), "test-mix")).collect()
    slots = [r["slot"] for r in pieces if r["slot"] is not None]
    # each slot reads one block, in order, without overlap
    by_row = collections.defaultdict(list)
    for r in pieces:
        by_row[r["_row"], r["epoch"]].append(r)
    assert {r["_row"] for r in pieces} and len({r["_row"] for r in pieces}) == len(rows)
    taken, size, target = collections.Counter(), {}, {}
    for (_, _), ps in by_row.items():
        read = sorted((p["start"], p["length"]) for p in ps if p["slot"] is not None)
        at = read[0][0] if read else 0
        for start, n in read:
            assert start == at and n > 0
            at += n
        assert at <= ps[0]["size"]
        taken[ps[0]["source"]] += sum(n for _, n in read)
    for r in pieces:
        size[r["source"]], target[r["source"]] = r["source_size"], r["target"]
    want = collections.Counter()
    for r in rows:
        want[r[3]] += words(r[1]) if r[0] != 14 else 0
    step = 1.5 * sum(size.values()) / (max(slots) + 1)
    for s in size:
        assert abs(taken[s] - target[s]) <= 2 * step + 1
    assert all(abs(size[s] - want[s]) <= 20 for s in size)


def test_low_discrepancy_in_time(spark):
    """Any stretch of the schedule holds each source near its share."""
    rng = random.Random(4)
    rows = [row(i, prose(rng, 200), source="abc"[i % 3]) for i in range(60)]
    pieces = mix(saved(sized(frame(spark, rows)), "test-mix")).where("slot IS NOT NULL").collect()
    source_of = {r["slot"]: r["source"] for r in pieces}
    n = len(source_of)
    share = collections.Counter(source_of.values())
    for a in range(0, n - n // 4, n // 4):
        part = collections.Counter(source_of[s] for s in sorted(source_of)[a:a + n // 4])
        assert all(abs(part[s] - share[s] / 4) <= math.log2(n) for s in share)


def test_no_words_and_empty_table(spark):
    out = mix(saved(sized(frame(spark, [row(1, ""), row(2, None, None, None)])), "test-mix")).collect()
    assert len({r["_row"] for r in out}) == 2 and not any(r["length"] for r in out)
    assert mix(saved(sized(frame(spark, [])), "test-mix")).count() == 0


def test_small_sources_of_a_large_mix(spark):
    """75 million words: a slot stays under 32 words, so a source of 15 is in the mix, near its target."""
    rows = [(i, f"s{i:02}", f"{i:08x}", i, 15) for i in range(40)] + [
        (100 + i, "t", f"{i * 80_000_000:08x}", i, 1_000_000) for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, source string, _k string, text_key long, size long")
    got = mix(saved(df, "test-mix")).groupBy("source", "target").agg({"length": "sum", "slot": "count"}).collect()
    assert len(got) == 41 and sum(r["count(slot)"] for r in got) > 2**21
    assert all(r["sum(length)"] > 0 and abs(r["sum(length)"] - r["target"]) <= 32 for r in got)
