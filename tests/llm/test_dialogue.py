"""Conversation repair against every edit script, against the table with all splits, and on awkward rows."""

import hashlib
import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from strata.llm import dialogue
from strata.llm.dialogue import ACCEPTED, CELLS, INSERTED, NOTHING, Edits, Spans, deleted_cells, joined, row_cells

ROWS = "conv_id long, turn long, role string, text string, copies int"


def faults_of(rows):
    """(role, text) in order -> (fault or None) of each."""
    seen, out = set(), []
    for role, text in rows:
        core = text.strip(" \t\n\v\f\r")
        out.append("blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def every_script(rows):
    """The least (cost, audit, repaired turns) over all edit scripts with up to two inserts in a gap."""
    found = faults_of(rows)
    gaps = [g for n in range(3) for g in itertools.product(("user", "assistant"), repeat=n)]
    choices = [[("D", None)] + ([] if f in ("blank", "duplicate") else [("K", r), ("R", "user"), ("R", "assistant")])
               for (r, _), f in zip(rows, found)]
    best = None
    for fill in itertools.product(gaps, repeat=len(rows) + 1):
        for edits in itertools.product(*choices):
            turns, cost, audit = [], 0, ""
            for i, inserts in enumerate(fill):
                turns += [(r, "") for r in inserts]
                cost, audit = cost + 2 * len(inserts), audit + "I" * len(inserts)
                if i < len(rows):
                    letter, role = edits[i]
                    audit += letter
                    cost += {"D": 3, "K": 0, "R": 2}[letter] + (letter != "D" and found[i] == "truncated")
                    turns += [(role, rows[i][1])] if role is not None else []
            if re.fullmatch("(s?(ua)+)?", "".join(r[:1] or "-" for r, _ in turns)):
                best = min(best or (cost, audit, turns), (cost, audit, turns))
    return best


def of_table(cells):
    return min(cells[CELLS.index((NOTHING, q))] for q in ACCEPTED)


def cells_of(rows):
    return [row_cells(r[:1], f in ("blank", "duplicate"), f == "truncated") for (r, _), f in zip(rows, faults_of(rows))]


def some_rows(rng, n):
    return [(rng.choice(["system", "user", "assistant", "tool", "", "user", "assistant"]), rng.choice(["a.", "b", " ", "c!", "d?", "e"]))
            for _ in range(n)]


@pytest.mark.parametrize("seed", range(40))
def test_spans_equal_every_edit_script(seed):
    rng = random.Random(seed)
    rows = some_rows(rng, seed % 4)
    spans = Spans()
    for cells in cells_of(rows):
        spans.add(1, cells)
    cost, audit, turns = every_script(rows)
    assert of_table(spans.whole()) == (cost, audit)
    edits = Edits(audit)
    got = [t for r in rows for t in edits.row(*r, 1)] + list(edits.inserts())
    assert [(role, text) for _, _, role, text in got] == turns
    assert [p for p, *_ in got] == list(range(len(turns)))


@pytest.mark.parametrize("seed", range(12))
def test_one_split_equals_all_splits(seed):
    """The full interval table: every span, every split."""
    rng = random.Random(100 + seed)
    leaves = cells_of(some_rows(rng, 18))
    chart = {(i, i + 1): c for i, c in enumerate(leaves)}
    for length in range(2, len(leaves) + 1):
        for i in range(len(leaves) - length + 1):
            ways = [joined(chart[i, k], chart[k, i + length]) for k in range(i + 1, i + length)]
            assert all(w == ways[0] for w in ways)
            chart[i, i + length] = [min(w[c] for w in ways) for c in range(len(CELLS))]
    spans = Spans()
    for c in leaves:
        spans.add(1, c)
    assert spans.whole() == chart[0, len(leaves)]


def test_many_deletions_are_one_span():
    one = INSERTED
    for _ in range(5):
        one = joined(one, deleted_cells(1))
    assert one == deleted_cells(5)


def expected(conversations):
    """Rows (conv_id, turn, role, text) of the query's table -> its result, by plain Python."""
    import zlib
    by_conv = {}
    for conv_id, turn, role, text in conversations:
        here = by_conv.setdefault(conv_id, [])
        kind = zlib.crc32(f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        here += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    out = {}
    for conv_id, rows in by_conv.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, hashlib.sha256(f"{len(r[1])}:{r[1]}:{r[2]}".encode()).digest()))
        said = [r[1:] for r in rows]
        found = faults_of(said)
        turns = {t for t, _, _ in rows if t is not None}
        chart = INSERTED
        for c in cells_of(said):
            chart = joined(chart, c)
        cost, audit = of_table(chart)
        edits = Edits(audit)
        final = [t for r in said for t in edits.row(*r, 1)] + list(edits.inserts())
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(said, said[1:]))
        out[conv_id] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, found.count("blank"), found.count("duplicate"),
                        found.count("truncated"), illegal, cost, audit,
                        hashlib.sha256("\n".join(f"{r}:{t}" for _, _, r, t in final).encode()).hexdigest())
    return out


def result(df):
    return {r["conv_id"]: (r["gaps"], r["blank"], r["duplicate"], r["truncated"], r["illegal"], r["cost"], r["audit"],
                           r["repaired_sha256"]) for r in df.collect()}


def table_of(spark, rows):
    return spark.createDataFrame([(*r, 5, "x") for r in rows], "conv_id long, turn long, role string, text string, n long, audit string")


def test_query_on_awkward_rows(spark):
    rng = random.Random(4)
    rows = [(c, t, r, x) for c in range(60) for t, (r, x) in enumerate(some_rows(rng, rng.randrange(1, 9)))]
    rows += [(None, 1, "user", "no id."), (None, None, None, None), (61, None, "user", "no turn"), (61, None, "system", "s."),
             (61, 3, "user", "tie."), (61, 3, "assistant", "tie."), (61, 3, "assistant", "tie."), (62, 2, "", ""),
             (63, 0, "user", "x" * 200_000 + " \n"), (63, 1, "assistant", "\x1f.\t")]
    rows += [(64, t, ("user", "assistant")[t % 2], f"turn {t}" + "." * (t % 3)) for t in range(700)]
    rows += [(65, 7, "user", "again.")] * 500
    df = table_of(spark, rows)
    assert result(dialogue.structure_repair(df, dialogue.damaged(df))) == expected(rows)


def test_dropped_and_empty_conversations(spark):
    import zlib
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    df = table_of(spark, [(gone, 0, "user", "hi.")])
    assert result(dialogue.structure_repair(df, dialogue.damaged(df))) == {
        gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    none = table_of(spark, [])
    assert result(dialogue.structure_repair(none, dialogue.damaged(none))) == {}


def test_repaired_turns(spark):
    rows = spark.createDataFrame([(1, 0, "user", "a.", 1), (1, 1, "user", "b.", 1), (1, 2, "tool", "c", 2), (2, 0, "system", "s.", 1)], ROWS)
    audits = dialogue.repairs(rows)
    turns = dialogue.repaired_turns(rows, audits.select("conv_id", "audit")).orderBy("conv_id", "position").collect()
    assert [tuple(r) for r in turns if r["conv_id"] == 1] == [
        (1, 0, "K", "user", "a."), (1, 1, "I", "assistant", ""), (1, 2, "K", "user", "b."), (1, 3, "R", "assistant", "c")]
    assert {r["conv_id"]: (r["cost"], r["audit"]) for r in audits.collect()} == {1: (8, "KIKRD"), 2: (3, "D")}


def test_one_conversation_lies_in_many_tasks(spark):
    rows = spark.range(3000).select(F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.lit("user").alias("role"),
                                    F.concat(F.col("id").cast("string"), F.lit(".")).alias("text"), F.lit(1).alias("copies"))
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        order = ["conv_id", "turn", "digest"]
        told = dialogue.faults(rows).select(*order, "copies", "initial", "blank", "duplicate", "truncated")
        parts = told.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(dialogue._parse, dialogue.PARSED)
        assert parts.count() > 4
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    (best,) = dialogue.repairs(rows).collect()
    assert (best["cost"], best["audit"]) == (3000, "KR" * 1500)
