"""Conversation structure repair: weighted CYK interval parsing (operator 11).

A conversation is well formed if its role initials read ``(s?(ua)+)?``. The
repair grammar is in Chomsky normal form. Its nonterminals ``[p q]`` derive what
takes that pattern from state p to state q:

    [p q] -> [p r] [r q]        two neighbouring spans
    [p q] -> row                kept, given another role, or (p = q) deleted
    [p q] -> nothing            an inserted turn; closed over repetition
    start -> [nothing nothing] | [nothing pair]

A cell holds the least (cost, audit) of a nonterminal over a span. The pattern
is regular, so each nonterminal is split at every inner point with the same
minimum: costs add up, and of two equally dear audits of one span none begins
the other (their letters for rows are as many, and inserts cost), so the order
of ties is kept under joining too. One split per span is therefore enough, and
cells are combined bottom-up by span length, equal lengths first: 2 n spans
instead of n * n / 2, and spans may be cut anywhere, also between tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import batches_of, saved, scratch, table

#: States of the pattern: nothing yet, after the system turn, after a user turn, after a whole pair.
NOTHING, SYSTEM, USER, PAIR = range(4)
MOVES = {(NOTHING, "s"): SYSTEM, (NOTHING, "u"): USER, (SYSTEM, "u"): USER, (PAIR, "u"): USER, (USER, "a"): PAIR}
ACCEPTED = (NOTHING, PAIR)

#: Costs of the edits (fixed values of the query).
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
ROLES = {"u": "user", "a": "assistant"}
LEGAL = ("su", "ua", "au")

#: Nonterminals that derive anything, and for each the pairs that join to it.
CELLS = [(p, q) for p, reach in enumerate([(0, 1, 2, 3), (1, 2, 3), (2, 3), (2, 3)]) for q in reach]
SPLITS = [[(CELLS.index((p, r)), CELLS.index((r, q))) for r in range(4) if (p, r) in CELLS and (r, q) in CELLS]
          for p, q in CELLS]
NEVER = 1 << 60

Table = list[tuple[int, str]]


def joined(left: Table, right: Table) -> Table:
    """The cells of two neighbouring spans' union."""
    out = []
    for pairs in SPLITS:
        cost, audit = NEVER, ""
        for i, j in pairs:
            (a, x), (b, y) = left[i], right[j]
            if a + b < cost or (a + b == cost < NEVER and x + y < audit):
                cost, audit = a + b, x + y
        out.append((min(cost, NEVER), audit))
    return out


def _closure() -> Table:
    """Cells of the span without rows: inserted turns, as many as pay."""
    cells = [(0, "") if p == q else (INSERT, "I") if any(MOVES.get((p, x)) == q for x in ROLES) else (NEVER, "")
             for p, q in CELLS]
    while (more := joined(cells, cells)) != cells:
        cells = more
    return cells


INSERTED = _closure()


def row_cells(initial: str, required: bool, truncated: bool) -> Table:
    """Cells of one row; a ``required`` deletion leaves no other edit."""
    cells = []
    for p, q in CELLS:
        ways = [(DELETE, "D")] if p == q else []
        if not required:
            ways += [(int(truncated) * TRUNCATED, "K")] * (MOVES.get((p, initial)) == q)
            ways += [(REROLE + int(truncated) * TRUNCATED, "R")] * any(MOVES.get((p, x)) == q for x in ROLES)
        cells.append(min(ways, default=(NEVER, "")))
    return joined(joined(INSERTED, cells), INSERTED)


def deleted_cells(n: int) -> Table:
    """Cells of ``n`` rows that must go."""
    return joined(joined(INSERTED, [(DELETE * n, "D" * n) if p == q else (NEVER, "") for p, q in CELLS]), INSERTED)


class Spans:
    """Cells of a growing span: equal lengths are joined as soon as they are neighbours."""

    def __init__(self):
        self.held: list[tuple[int, Table]] = []

    def add(self, length: int, cells: Table):
        while self.held and self.held[-1][0] <= length:
            n, before = self.held.pop()
            length, cells = n + length, joined(before, cells)
        self.held.append((length, cells))

    def whole(self) -> Table:
        cells = INSERTED
        for _, before in reversed(self.held):
            cells = joined(before, cells)
        return cells


# ------------------------------------------------------------------ rows, faults, spans
def damaged(conversations: DataFrame) -> DataFrame:
    """The damage of the query: ``conv_id, turn, role, text, copies``, nulls of role and text as one space.

    By crc32 of ``conv_id:turn`` (nulls: one space) modulo 20, a row goes (0),
    loses its text (1) or its marks ``.!?`` (2), stands twice (3) or is the user's (4)."""
    spoken = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(spoken("conv_id"), F.lit(":"), spoken("turn"))) % 20
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(spoken("text"), "[.!?]", "")).otherwise(spoken("text"))
    return conversations.where(kind != 0).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.when(kind == 4, F.lit("user")).otherwise(spoken("role")).alias("role"), text.alias("text"),
        F.when(kind == 3, F.lit(2)).otherwise(F.lit(1)).alias("copies"))


def _digest():
    """Tells (role, text) apart; 32 bytes instead of a text."""
    return F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.lit(":"), F.col("text")), 256))


def faults(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, copies`` -> one row per conversation, turn, role and text, without the text.

    Columns: conv_id, turn, digest, copies, initial, blank, duplicate (an earlier
    turn says the same), truncated. Equal rows are counted where they are read,
    so a row repeated any number of times is one row from here on."""
    told = rows.select(
        "conv_id", "turn", _digest().alias("digest"), "copies", F.substring("role", 1, 1).alias("initial"),
        (~F.col("text").rlike(r"[^\x20\x09-\x0D]")).alias("blank"),
        (~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("truncated"))
    kinds = told.groupBy("conv_id", "turn", "digest", "initial", "blank", "truncated").agg(
        F.sum("copies").cast("long").alias("copies"))
    # nulls come first, as in the order of turns
    at = F.struct(F.col("turn").isNotNull().alias("later"), F.col("turn").alias("turn"))
    first = kinds.groupBy(F.col("conv_id").alias("c"), F.col("digest").alias("d")).agg(F.min(at).alias("first"))
    return (kinds.join(first, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d")))
            .select("conv_id", "turn", "digest", "copies", "initial", "blank", "truncated",
                    (~F.col("turn").eqNullSafe(F.col("first.turn"))).alias("duplicate")))


PARSED = ("conv_id long, turn long, digest binary, n long, costs array<long>, audits array<string>, blank long, "
          "duplicate long, truncated long, illegal long, first string, last string, least long, most long, turns long")
_PARSED = pa.schema([
    ("conv_id", pa.int64()), ("turn", pa.int64()), ("digest", pa.binary()), ("n", pa.int64()),
    ("costs", pa.list_(pa.int64())), ("audits", pa.list_(pa.string())), ("blank", pa.int64()), ("duplicate", pa.int64()),
    ("truncated", pa.int64()), ("illegal", pa.int64()), ("first", pa.string()), ("last", pa.string()),
    ("least", pa.int64()), ("most", pa.int64()), ("turns", pa.int64())])


class Stretch:
    """Neighbouring rows of one conversation: their cells and counts."""

    def __init__(self, conv_id, turn, digest):
        self.key = (conv_id, turn, digest)
        self.n = self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first = self.last = self.least = self.most = None
        self.spans = Spans()

    def _after(self, first, last, least, most, turns):
        if self.n and self.last + first not in LEGAL:
            self.illegal += 1
        if self.first is None:
            self.first = first
        self.last = last
        if least is not None:
            self.turns += turns - (self.most == least)
            self.least, self.most = least if self.least is None else self.least, most

    def row(self, memo, turn, copies, initial, blank, duplicate, truncated):
        self._after(initial, initial, turn, turn, 1)
        self.illegal += copies - 1
        fresh = not blank and not duplicate
        if blank:
            self.blank += copies
        else:
            self.duplicate += copies - fresh
            self.truncated += fresh and truncated
        self.n += copies
        if fresh:
            kind = (initial, truncated)
            if kind not in memo:
                memo[kind] = row_cells(initial, False, truncated)
            self.spans.add(1, memo[kind])
            copies -= 1
        if copies:
            if copies not in memo and copies < 64:
                memo[copies] = deleted_cells(copies)
            self.spans.add(copies, memo[copies] if copies in memo else deleted_cells(copies))

    def stretch(self, n, costs, audits, blank, duplicate, truncated, illegal, first, last, least, most, turns):
        self._after(first, last, least, most, turns)
        self.n += n
        self.blank += blank
        self.duplicate += duplicate
        self.truncated += truncated
        self.illegal += illegal
        self.spans.add(n, list(zip(costs, audits)))

    def out(self) -> tuple:
        cells = self.spans.whole()
        return (*self.key, self.n, [c for c, _ in cells], [a for _, a in cells], self.blank, self.duplicate,
                self.truncated, self.illegal, self.first, self.last, self.least, self.most, self.turns)


def _parse(batches):
    def rows() -> Iterator[tuple]:
        memo, here = {}, None
        for batch in batches:
            for conv_id, turn, digest, *facts in zip(*(c.to_pylist() for c in batch.columns)):
                if here is None or here.key[0] != conv_id:
                    if here:
                        yield here.out()
                    here = Stretch(conv_id, turn, digest)
                here.row(memo, turn, *facts)
        if here:
            yield here.out()

    yield from batches_of(rows(), _PARSED, 512)


def _combine(batches):
    def rows() -> Iterator[tuple]:
        here = None
        for batch in batches:
            for conv_id, turn, digest, *rest in zip(*(c.to_pylist() for c in batch.columns)):
                if here is None or here.key[0] != conv_id:
                    if here:
                        yield here.out()
                    here = Stretch(conv_id, turn, digest)
                here.stretch(*rest)
        if here:
            yield here.out()

    yield from batches_of(rows(), _PARSED, 512)


def repairs(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, copies`` -> one row per conversation that has rows.

    Columns: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit.
    Rows are dealt by ranges of (conv_id, turn, digest): a conversation of any
    length lies in as many tasks as its share of the rows asks for, each task
    parses its stretch, and one row a task and conversation is combined. Rows of
    one turn stand in the order of the digest of role and text."""
    order = ["conv_id", "turn", "digest"]
    told = faults(rows).select(*order, "copies", "initial", "blank", "duplicate", "truncated")
    stretches = told.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_parse, PARSED)
    whole = stretches.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(_combine, PARSED)
    start = [CELLS.index((NOTHING, q)) for q in ACCEPTED]
    best = F.array_min(F.array(*[F.struct(F.col("costs")[i].alias("cost"), F.col("audits")[i].alias("audit")) for i in start]))
    return whole.select("conv_id", F.coalesce(F.col("most") - F.col("least") + 1 - F.col("turns"), F.lit(0)).alias("gaps"),
                        "blank", "duplicate", "truncated", "illegal", best.alias("best")).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "best.cost", "best.audit")


# ------------------------------------------------------------------ edits applied
class Edits:
    """The repaired turns of a conversation, given its rows in order.

    The audit settles every role: an odd number of turns begins with the system's."""

    def __init__(self, audit: str):
        self.audit, self.at = audit, 0
        self.out, self.system = 0, (len(audit) - audit.count("D")) % 2

    def _turn(self, letter, role, text):
        if letter != "K":
            role = ROLES["ua"[(self.out - self.system) % 2]]
        self.out += 1
        return self.out - 1, letter, role, text

    def inserts(self):
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            yield self._turn("I", None, "")

    def row(self, role, text, copies):
        for _ in range(copies):
            yield from self.inserts()
            letter = self.audit[self.at]
            self.at += 1
            if letter != "D":
                yield self._turn(letter, role, text)


def _turns(batches):
    """``(conversation's column values, turns)`` of a partition sorted by conversation, audit row first; rows are read as asked."""
    edits = None
    for batch in batches:
        for conv_id, audit, role, copies, words in zip(*(c.to_pylist() for c in batch.columns)):
            if audit is not None:
                if edits:
                    yield from ((key, t) for t in edits.inserts())
                key, edits = conv_id, Edits(audit)
                yield key, None
            else:
                yield from ((key, t) for t in edits.row(role, words, copies))
    if edits:
        yield from ((key, t) for t in edits.inserts())


def _repaired(batches):
    schema = pa.schema([("conv_id", pa.int64()), ("position", pa.int64()), ("edit", pa.string()), ("role", pa.string()),
                        ("text", pa.string())])
    yield from batches_of(((key, *t) for key, t in _turns(batches) if t), schema, 256)


def _hashes(batches):
    schema = pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())])

    def rows():
        digest = None
        for key, turn in _turns(batches):
            if turn is None:
                if digest:
                    yield last, digest.hexdigest()
                last, digest = key, hashlib.sha256()
            else:
                position, _, role, text = turn
                digest.update(("\n" * (position > 0) + f"{role}:{text}").encode("utf-8", "replace"))
        if digest:
            yield last, digest.hexdigest()

    yield from batches_of(rows(), schema, 1024)


def _in_order(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """Each conversation's audit, then its rows, in one partition and in order; texts move once.

    A conversation is edited by one task, which holds a batch of its rows at a
    time (sorting spills): its hash can't be had from parts."""
    empty = lambda kind: F.lit(None).cast(kind)
    heads = audits.select("conv_id", "audit", empty("string").alias("role"), empty("int").alias("copies"),
                          empty("string").alias("text"), empty("long").alias("turn"), empty("binary").alias("digest"))
    said = rows.select("conv_id", empty("string").alias("audit"), "role", "copies", "text", "turn", _digest().alias("digest"))
    return (heads.unionByName(said).repartition("conv_id")
            .sortWithinPartitions("conv_id", F.col("audit").isNull(), "turn", "digest")
            .select("conv_id", "audit", "role", "copies", "text"))


def repaired_turns(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """The repaired conversations: ``conv_id, position, edit`` (K, R or I), ``role, text``."""
    return _in_order(rows, audits).mapInArrow(_repaired, "conv_id long, position long, edit string, role string, text string")


def repaired_hashes(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """``conv_id, repaired_sha256`` for every conversation of ``audits``: SHA-256 of ``role:text``, newline-joined."""
    return _in_order(rows, audits).mapInArrow(_hashes, "conv_id long, repaired_sha256 string")


def structure_repair(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """Faults, cheapest edits and hash of the repaired turns, for every ``conv_id`` of ``conversations``.

    ``rows``: their turns as ``conv_id, turn, role, text, copies``. A null
    conv_id is a conversation too. Null turns come first and count for no gap.
    Rows alike in all columns stand one after the other, the later ones
    duplicates; texts and conversations may have any length; columns of other
    names are not read. A conversation without rows has zeros, an empty audit
    and the hash of the empty string; an empty table has no conversations."""
    spark = conversations.sparkSession
    ids = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    with scratch(spark) as keep:
        parsed = repairs(rows).withColumnRenamed("conv_id", "c")
        zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
        found = keep(saved(ids.join(parsed, F.col("conv_id").eqNullSafe(F.col("c")), "left").select(
            "conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit")), "dialogue-repairs"))
    hashes = repaired_hashes(rows, found.select("conv_id", "audit")).withColumnRenamed("conv_id", "c")
    return found.join(hashes, F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")


def op11_cyk_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged and repaired."""
    conversations = table(spark, sf_dir, "conversations")
    return structure_repair(conversations, damaged(conversations))


def _sql() -> str:
    """The same by a walk over the rows, one state of the pattern at a time."""
    steps = []
    for (p, r), (cost, inserts) in zip(CELLS, INSERTED):
        if cost < NEVER:
            steps.append((p, r, cost + DELETE, inserts + "D", "-"))
            steps += [(p, q, cost, inserts + "K", x) for (o, x), q in MOVES.items() if o == r]
            steps += [(p, q, cost + REROLE, inserts + "R", "*") for (o, x), q in MOVES.items() if o == r and x in ROLES]
    last = [(p, c, a) for (p, q), (c, a) in zip(CELLS, INSERTED) if q in ACCEPTED and c < NEVER]
    return f"""
WITH RECURSIVE bits AS (
  SELECT range AS byte, range::BIGINT AS c, 0 AS k FROM range(256)
  UNION ALL
  SELECT byte, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8
), crc AS (SELECT list(c ORDER BY byte) AS t FROM bits WHERE k = 8
), steps AS (SELECT * FROM (VALUES {', '.join(map(str, steps))}) AS v(p, q, cost, letters, needs)
), closing AS (SELECT * FROM (VALUES {', '.join(map(str, last))}) AS v(p, cost, letters)
), keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations
), hit AS (
  SELECT *, xor(list_reduce(list_transform(range(1, length(key) + 1), lambda i: ascii(substr(key, i, 1))::BIGINT),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % 20 AS kind
  FROM keyed, crc
), said AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
  FROM hit WHERE kind <> 0
), numbered AS (
  SELECT coalesce(conv_id, -1) AS c, turn, role, text, substr(role, 1, 1) AS initial,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(role) || ':' || role || ':' || text)) AS i,
         NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') AS blank,
         NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') AS open
  FROM said
), judged AS (
  SELECT *, NOT blank AND row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 AS duplicate,
         lag(initial) OVER (PARTITION BY c ORDER BY i) || initial AS pair
  FROM numbered
), rows AS (
  SELECT *, blank OR duplicate AS required, open AND NOT blank AND NOT duplicate AS truncated FROM judged
), walk AS (
  SELECT DISTINCT c, 0::BIGINT AS i, {NOTHING} AS p, struct_pack(cost := 0::BIGINT, audit := '') AS best FROM rows
  UNION ALL
  SELECT w.c, w.i + 1, s.q, min(struct_pack(
           cost := w.best.cost + s.cost + CASE WHEN s.needs <> '-' AND r.truncated THEN {TRUNCATED} ELSE 0 END,
           audit := w.best.audit || s.letters))
  FROM walk w JOIN rows r ON r.c = w.c AND r.i = w.i + 1
    JOIN steps s ON s.p = w.p AND (s.needs = '-' OR (NOT r.required AND (s.needs = '*' OR s.needs = r.initial)))
  GROUP BY w.c, w.i, s.q
), ends AS (
  SELECT w.c, min(struct_pack(cost := w.best.cost + e.cost, audit := w.best.audit || e.letters)) AS best
  FROM walk w JOIN (SELECT c, max(i) AS n FROM rows GROUP BY c) l ON l.c = w.c AND w.i = l.n JOIN closing e ON e.p = w.p
  GROUP BY w.c
), counts AS (
  SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
         count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated,
         count(*) FILTER (pair IS NOT NULL AND pair NOT IN {LEGAL}) AS illegal
  FROM rows GROUP BY c
), letters AS (
  SELECT c, best.audit AS audit, unnest(range(1, length(best.audit) + 1)) AS pos FROM ends
), placed AS (
  SELECT c, pos, substr(audit, pos, 1) AS letter, length(replace(substr(audit, 1, pos), 'I', '')) AS i,
         length(replace(substr(audit, 1, pos), 'D', '')) - length(replace(audit, 'D', '')) % 2 AS turns
  FROM letters
), repaired AS (
  SELECT p.c, sha256(string_agg(CASE letter WHEN 'K' THEN r.role ELSE CASE turns % 2 WHEN 1 THEN 'user' ELSE 'assistant' END END
      || ':' || CASE letter WHEN 'I' THEN '' ELSE r.text END, chr(10) ORDER BY pos)) AS hash
  FROM placed p LEFT JOIN rows r ON r.c = p.c AND r.i = p.i AND p.letter <> 'I' WHERE letter <> 'D' GROUP BY p.c
)
SELECT d.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.cost, 0) AS cost,
       coalesce(best.audit, '') AS audit, coalesce(hash, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, coalesce(conv_id, -1) AS c FROM conversations) d
  LEFT JOIN counts USING (c) LEFT JOIN ends USING (c) LEFT JOIN repaired USING (c)
"""


OP11_SQL = _sql()
