"""Spelling variant grouping: words one edit apart, found in a frequency-vector trie (operator 13).

A word is arranged by its number of letters and then by how many of them fall in
each letter group. One inserted, deleted or replaced letter moves at most one
count up and one down, so a walk through the trie of these counts with a budget
of one surplus and one deficit meets every word one edit away; what a leaf holds
is verified letter by letter.

The upper part of the trie, nodes that hold more than a shard, is the only thing
every task knows (see ``split_nodes`` for its bound). It deals words to shards
and sends each word as a search to the shards its budget reaches; a shard builds
the rest of the trie in one task.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import batches_of, clean_text, saved, scalar, scratch, table

RUN = re.compile("[a-zÀ-ÿ]+")

#: Fixed values of the query: occurrences whose hash this divides lose a letter; least letters and occurrences of a word.
DIVISOR = 97
LEAST_LETTERS = 5
LEAST_COUNT = 3

#: Letter groups, and so levels of the trie below the length; bits of a group's count in a leaf's comparison.
GROUPS = 16
BITS = 4

#: Letters of the words in one shard, and the most shards of that size (beyond, shards grow).
SHARD_LETTERS = 1 << 16
MOST_SHARDS = 4096

#: Pairs of words that a leaf compares at once, and letters of the pairs it verifies at once.
LEAF_PAIRS = 1 << 16
LETTERS_AT_ONCE = 1 << 22

#: Different runs a task counts before it hands them on, runs hashed together, bytes from which a run is hashed
#: alone, and characters of a text searched at once.
HELD_WORDS = 300_000
WAITING = 1 << 20
LONG_RUN = 64
SLICE = 1 << 20


# ------------------------------------------------------------------ words and counts
def runs_of(text: str) -> Iterator[list[str]]:
    """The letter runs of a text, A-Z lower-cased, a slice of the text at a time; no run is cut."""
    low = text.encode("utf-8", "replace").lower().decode("utf-8")
    at = 0
    while at < len(low):
        end = min(at + SLICE, len(low))
        over = RUN.match(low, end)
        end = over.end() if over else end
        yield RUN.findall(low, at, end)
        at = end


class RunCounts(dict):
    """Counts of runs in one task; tokens are numbered and wait until enough are there to be hashed together.

    A CRC is linear: that of ``<doc_id>:<run>`` is the run's own, with what the
    prefix's becomes over as many zero bytes as the run has. The first is kept
    for each run, the second computed once for each document and run length."""

    def __init__(self):
        self._empty()

    def _empty(self):
        self.clear()
        self.runs, self.own, self.sizes = [], [], []
        self.counts, self.cut = np.zeros(0, dtype=np.int64), Counter()
        self._wait()

    def _wait(self):
        self.parts, self.starts, self.waiting = [], [], 0

    def __missing__(self, run: str) -> int:
        n = self[run] = len(self.runs)
        raw = run.encode()
        self.runs.append(run)
        self.sizes.append(len(raw) if len(raw) < LONG_RUN else LONG_RUN)
        self.own.append(zlib.crc32(raw) ^ zlib.crc32(bytes(self.sizes[-1])))
        return n

    def add(self, start: int, found: list[str]):
        self.parts.append(np.fromiter(map(self.__getitem__, found), dtype=np.int64, count=len(found)))
        self.starts.append(start)
        self.waiting += len(found)
        if self.waiting > WAITING:
            self.settle()

    def settle(self):
        if not self.parts:
            return
        ids = np.concatenate(self.parts)
        doc = np.repeat(np.arange(len(self.parts)), [len(p) for p in self.parts])
        sizes = np.array(self.sizes, dtype=np.int64)
        over = np.empty((len(self.parts), sizes.max(initial=0) + 1), dtype=np.int64)
        over[:, 0] = self.starts
        for k in range(1, over.shape[1]):
            over[:, k] = [zlib.crc32(b"\0", c) for c in over[:, k - 1].tolist()]
        h = np.array(self.own, dtype=np.int64)[ids] ^ over[doc, sizes[ids]]
        for i in np.flatnonzero(sizes[ids] == LONG_RUN).tolist():
            h[i] = zlib.crc32(self.runs[ids[i]].encode(), self.starts[doc[i]])
        hit = h % DIVISOR == 0
        for i in np.flatnonzero(hit).tolist():
            run = self.runs[ids[i]]
            at = int(h[i]) % len(run)
            self.cut[run[:at] + run[at + 1:]] += 1
        more = np.bincount(ids[~hit], minlength=len(self.runs))
        more[:len(self.counts)] += self.counts
        self.counts = more
        self._wait()

    def hand_on(self) -> Iterator[tuple[str, int]]:
        """Words and their counts; nothing is held afterwards."""
        self.settle()
        for word, n in zip(self.runs, self.counts.tolist()):
            if n and len(word) >= LEAST_LETTERS:
                yield word, n
        yield from ((word, n) for word, n in self.cut.items() if len(word) >= LEAST_LETTERS)
        self._empty()


def _counts(batches):
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])
    held = RunCounts()
    for batch in batches:
        for doc, text in zip(batch.column(0), batch.column(1)):
            start = zlib.crc32(((doc.as_py() or "") + ":").encode("utf-8", "replace"))
            for found in runs_of(text.as_py()):
                held.add(start, found)
                if len(held) > HELD_WORDS:
                    yield from batches_of(held.hand_on(), schema, 1 << 16)
    yield from batches_of(held.hand_on(), schema, 1 << 16)


def vocabulary(docs: DataFrame, least: int = LEAST_COUNT) -> DataFrame:
    """``doc_id, text`` -> ``word, n``: words of at least five letters with ``least`` occurrences or more.

    Null texts have no words; a null doc_id hashes as the empty string. Tasks
    count before the shuffle, so a word that is everywhere arrives once per task."""
    keyed = docs.select(F.col("doc_id").cast("string").alias("doc"), clean_text().alias("text"))
    return (keyed.mapInArrow(_counts, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= least))


# ------------------------------------------------------------------ frequency vectors and the upper trie
def _letters(batches):
    schema = pa.schema([("code", pa.int32()), ("n", pa.int64())])
    total = np.zeros(256, dtype=np.int64)
    for batch in batches:
        text = "".join(batch.column(0).to_pylist()).encode("latin-1")
        total += np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256)
    yield from batches_of(((c, n) for c, n in enumerate(total.tolist()) if n), schema)


def letter_groups(words: DataFrame, groups: int = GROUPS) -> np.ndarray:
    """Group of each letter code: letters by falling frequency, each to the lightest group so far.

    At most 256 totals reach the driver. Groups only steer the search; any grouping finds the same words."""
    counted = words.select("word").mapInArrow(_letters, "code int, n long").groupBy("code").agg(F.sum("n").alias("n"))
    group, load = np.zeros(256, dtype=np.int64), [0] * groups
    for code, n in sorted(map(tuple, counted.collect()), key=lambda r: (-r[1], r[0])):
        group[code] = load.index(min(load))
        load[group[code]] += n
    return group


def vectors(words: list[str], group: np.ndarray, groups: int = GROUPS) -> np.ndarray:
    """One row per word: its length, then the letters it has in each group."""
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    codes = np.frombuffer("".join(words).encode("latin-1"), dtype=np.uint8)
    row = np.repeat(np.arange(len(words)), sizes)
    counts = np.bincount(row * groups + group[codes], minlength=len(words) * groups).reshape(len(words), groups)
    return np.column_stack([sizes, counts])


def unary(v: np.ndarray) -> np.ndarray:
    """The group counts of ``vectors`` as runs of bits: of two words, bits of one alone are its surplus.

    Counts above ``BITS`` are cut to it, which can only bring words closer."""
    runs_ = (np.uint64(1) << np.minimum(v[:, 1:], BITS).astype(np.uint64)) - np.uint64(1)
    return (runs_ << (np.arange(v.shape[1] - 1, dtype=np.uint64) * np.uint64(BITS))).sum(axis=1, dtype=np.uint64)


def _weights(level: int, split: dict, group: np.ndarray):
    schema = pa.schema([("node", pa.string()), ("letters", pa.int64())])

    def task(batches):
        held: Counter[str] = Counter()
        for batch in batches:
            words = batch.column(0).to_pylist()
            for v in vectors(words, group).tolist():
                if ",".join(map(str, v[:level - 1])) in split:
                    held[",".join(map(str, v[:level]))] += v[0]
        yield from batches_of(iter(held.items()), schema)

    return task


def split_nodes(words: DataFrame, group: np.ndarray, shard_letters: int = SHARD_LETTERS,
                most_shards: int = MOST_SHARDS) -> dict[str, int]:
    """Nodes of the trie with more than a shard of letters -> shards of that size they hold.

    Bounded: a shard has at least 1 / ``most_shards`` of all letters, so every
    level has at most ``most_shards`` such nodes and the trie 17 times as many."""
    (letters,) = scalar(words, F.sum(F.length("word")))
    limit = max(shard_letters, -(-(letters or 0) // most_shards))
    split = {"": 1}
    for level in range(1, GROUPS + 2):
        heavy = (words.select("word").mapInArrow(_weights(level, split, group), "node string, letters long")
                 .groupBy("node").agg(F.sum("letters").alias("letters")).where(F.col("letters") > limit).collect())
        split |= {node: -(-n // limit) for node, n in heavy}
        if not heavy:
            break
    return split


def home(v: list[int], word: str, split: dict[str, int]) -> str:
    """The shard a word lies in."""
    for level in range(1, len(v) + 1):
        node = ",".join(map(str, v[:level]))
        if node not in split:
            return node
    return f"{node}/{xxhash.xxh3_64_intdigest(word.encode()) % split[node]}"


def reached(v: list[int], split: dict[str, int]) -> list[str]:
    """The shards that hold words within one surplus and one deficit of a vector, depth first."""
    out: list[str] = []

    def walk(node: str, level: int, surplus: int, deficit: int):
        if node not in split:
            out.append(node)
        elif level == len(v):
            out.extend(f"{node}/{b}" for b in range(split[node]))
        else:
            at = v[level]
            walk(f"{node},{at}", level + 1, surplus, deficit)
            if surplus:
                walk(f"{node},{at + 1}", level + 1, 0, deficit)
            if deficit and at:
                walk(f"{node},{at - 1}", level + 1, surplus, 0)

    size = v[0]
    walk(f"{size}", 1, 1, 1)            # a replaced letter
    walk(f"{size + 1}", 1, 1, 0)        # the other word has one more
    if size > 1:
        walk(f"{size - 1}", 1, 0, 1)
    return out


def _dealt(split: dict, group: np.ndarray):
    schema = pa.schema([("shard", pa.string()), ("search", pa.bool_()), ("word", pa.string()), ("n", pa.int64())])

    def task(batches):
        def rows():
            for batch in batches:
                words = batch.column(0).to_pylist()
                for v, word, n in zip(vectors(words, group).tolist(), words, batch.column(1).to_pylist()):
                    yield home(v, word, split), False, word, n
                    for shard in reached(v, split):
                        yield shard, True, word, n

        yield from batches_of(rows(), schema, 1 << 14)

    return task


# ------------------------------------------------------------------ the trie of a shard
class Trie:
    """Words of one length, sorted by their counts; a node is a run of rows with equal leading counts."""

    def __init__(self, words: list[str], counts: list[int], group: np.ndarray):
        v = vectors(words, group)
        order = np.lexsort(v.T[::-1])
        self.group, self.size = group, len(words[0])
        self.v, self.bits = v[order, 1:], unary(v)[order]
        self.letters = np.frombuffer("".join(words).encode("latin-1"), dtype=np.uint8).reshape(len(words), -1)[order]
        # place of each word when the most frequent come first, ties in code-point order
        ranked = sorted(range(len(words)), key=lambda i: (-counts[i], words[i]))
        place = np.empty(len(words), dtype=np.int64)
        place[ranked] = np.arange(len(words))
        self.place, self.best = place[order], [(counts[i], words[i]) for i in ranked]

    def search(self, words: list[str]) -> Iterator[tuple[str, int, int, str]]:
        """``(word, near words here, occurrences of the most frequent of them, that word)`` for words that have any."""
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        for size in (self.size - 1, self.size, self.size + 1):
            some = np.flatnonzero(sizes == size)
            if not len(some):
                continue
            found = [words[i] for i in some]
            v = vectors(found, self.group)
            self.q, self.q_bits = v[:, 1:], unary(v)
            self.q_letters = np.frombuffer("".join(found).encode("latin-1"), dtype=np.uint8).reshape(len(found), -1)
            self.near = np.zeros(len(found), dtype=np.int64)
            self.first = np.full(len(found), len(self.place), dtype=np.int64)
            budget = np.ones(len(found), dtype=np.int64)
            self._walk(0, len(self.v), 0, np.arange(len(found)), budget * (size <= self.size), budget * (size >= self.size))
            for i in np.flatnonzero(self.near).tolist():
                yield found[i], int(self.near[i]), *self.best[self.first[i]]

    def _walk(self, lo: int, hi: int, level: int, alive: np.ndarray, surplus: np.ndarray, deficit: np.ndarray):
        if not len(alive):
            return
        if level == self.v.shape[1] or (hi - lo) * len(alive) <= LEAF_PAIRS:
            self._leaf(lo, hi, alive)
            return
        column = self.v[lo:hi, level]
        cuts = [0, *(np.flatnonzero(column[1:] != column[:-1]) + 1).tolist(), hi - lo]
        own = self.q[alive, level]
        for a, b in zip(cuts[:-1], cuts[1:]):
            more = column[a] - own
            go = (more <= surplus) & (-more <= deficit)
            self._walk(lo + a, lo + b, level + 1, alive[go], (surplus - np.maximum(more, 0))[go],
                       (deficit - np.maximum(-more, 0))[go])

    def _leaf(self, lo: int, hi: int, alive: np.ndarray):
        step = max(1, LEAF_PAIRS // (hi - lo))
        for at in range(0, len(alive), step):
            some = alive[at:at + step]
            own, other = self.bits[lo:hi, None], self.q_bits[None, some]
            both = own & other
            i, j = np.nonzero((np.bitwise_count(own ^ both) <= 1) & (np.bitwise_count(other ^ both) <= 1))
            pairs = max(1, LETTERS_AT_ONCE // self.size)
            for p in range(0, len(i), pairs):
                a, b = i[p:p + pairs] + lo, some[j[p:p + pairs]]
                one = one_edit(self.letters[a], self.q_letters[b])
                np.add.at(self.near, b[one], 1)
                np.minimum.at(self.first, b[one], self.place[a[one]])


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether rows of letters of ``a`` and ``b`` differ by exactly one inserted, deleted or replaced letter."""
    if a.shape[1] == b.shape[1]:
        return (a != b).sum(axis=1) == 1
    if a.shape[1] < b.shape[1]:
        a, b = b, a
    head = np.logical_and.accumulate(a[:, :-1] == b, axis=1).sum(axis=1)
    tail = np.logical_and.accumulate((a[:, 1:] == b)[:, ::-1], axis=1).sum(axis=1)
    return head + tail >= b.shape[1]


def _search(group: np.ndarray, block: int = 1 << 12):
    schema = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("near_n", pa.int64()), ("near", pa.string())])

    def task(batches):
        def rows():
            shard, words, counts, trie = None, [], [], None
            for batch in batches:
                shards, searches, texts, ns = (c.to_pylist() for c in batch.columns)
                at = 0
                while at < len(shards):
                    end = at + 1
                    while end < len(shards) and end - at < block and \
                            shards[end] == shards[at] and searches[end] == searches[at]:
                        end += 1
                    if shards[at] != shard:
                        shard, words, counts, trie = shards[at], [], [], None
                    if not searches[at]:
                        words += texts[at:end]
                        counts += ns[at:end]
                    elif words:
                        trie = trie or Trie(words, counts, group)
                        yield from trie.search(texts[at:end])
                    at = end

        yield from batches_of(rows(), schema, 1 << 14)

    return task


def near_words(words: DataFrame, shard_letters: int = SHARD_LETTERS) -> DataFrame:
    """``word, n`` -> ``word, n_near, near_n, near`` for words with a word one edit away.

    ``near`` is the most frequent such word (ties: the smallest in code-point
    order). ``words`` is read several times and holds letters up to U+00FF; a
    word of any length has a shard."""
    group = letter_groups(words)
    split = split_nodes(words, group, shard_letters)
    dealt = words.select("word", "n").mapInArrow(_dealt(split, group), "shard string, search boolean, word string, n long")
    found = (dealt.repartition("shard").sortWithinPartitions("shard", "search")
             .mapInArrow(_search(group), "word string, n_near long, near_n long, near string"))
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select(
        "word", "n_near", (-F.col("best.less")).alias("near_n"), F.col("best.near").alias("near"))


def roots(forms: DataFrame) -> DataFrame:
    """``word, form`` -> ``word, root``: forms followed to the last, twice as far in each round.

    Occurrences at least double with each step, so a chain of forms is at most
    64 words long and seven rounds end it."""
    links = saved(forms.select("word", F.col("form").alias("root")), "spelling-links")
    while True:
        on = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        links = saved(links.join(on, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-links")
        (moved,) = scalar(links, F.count_if("moved"))
        links = links.drop("moved")
        if not moved:
            return links


def spelling_variants(docs: DataFrame, least: int = LEAST_COUNT, shard_letters: int = SHARD_LETTERS) -> DataFrame:
    """``doc_id, text`` -> one row per word: word, form, root, n, n_near, form_n.

    A word's form is its most frequent near word, if that occurs at least twice
    as often. Null, empty and letterless texts add nothing; repeated rows count
    each; texts and words may have any length; columns of other names are not
    read. An empty table has no words."""
    with scratch(docs.sparkSession) as keep:
        words = keep(saved(vocabulary(docs, least), "spelling-words"))
        near = near_words(words, shard_letters)
        is_form = F.col("near_n") >= 2 * F.col("n")
        formed = keep(saved(words.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(is_form, F.col("near")).alias("form"),
            F.when(is_form, F.col("near_n")).alias("form_n")), "spelling-forms"))
        last = saved(roots(formed.where("form IS NOT NULL")), "spelling-roots")
        keep(last)
    return formed.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13_frequency_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All words of all documents with their near words, forms and roots."""
    return spelling_variants(table(spark, sf_dir, "documents"))


#: The CRC by its bitwise rule (reflected polynomial 0xEDB88320); words one edit apart share the word with
#: one letter left out (insertion) or blanked (replacement).
OP13_SQL = f"""
WITH RECURSIVE bits AS (
  SELECT range AS byte, range::BIGINT AS c, 0 AS k FROM range(256)
  UNION ALL
  SELECT byte, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8
), crc AS (SELECT list(c ORDER BY byte) AS t FROM bits WHERE k = 8
), runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS doc, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run
  FROM documents
), counted AS (SELECT doc, run, count(*) AS n FROM runs GROUP BY ALL
), hashed AS (
  SELECT run, n, xor(list_reduce(list_transform(range(0, octet_length(encode(doc || ':' || run))::BIGINT),
      lambda i: ('0x' || substr(hex(encode(doc || ':' || run)), 2 * i + 1, 2))::BIGINT),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295::BIGINT), 4294967295::BIGINT) AS h
  FROM counted, crc
), cut AS (
  SELECT CASE WHEN h % {DIVISOR} = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2)
              ELSE run END AS word, n FROM hashed
), v AS (
  SELECT word, sum(n)::BIGINT AS n FROM cut WHERE length(word) >= {LEAST_LETTERS} GROUP BY word HAVING sum(n) >= {LEAST_COUNT}
), spots AS (
  SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v
), near AS (
  SELECT a.word, b.word AS other, b.n FROM spots a JOIN spots b ON a.i = b.i AND a.word <> b.word
    AND substr(a.word, 1, a.i - 1) || '_' || substr(a.word, a.i + 1) = substr(b.word, 1, b.i - 1) || '_' || substr(b.word, b.i + 1)
  UNION
  SELECT a.word, b.word, b.n FROM spots a JOIN v b ON substr(a.word, 1, a.i - 1) || substr(a.word, a.i + 1) = b.word
  UNION
  SELECT b.word, a.word, a.n FROM spots a JOIN v b ON substr(a.word, 1, a.i - 1) || substr(a.word, a.i + 1) = b.word
), best AS (
  SELECT word, count(*) AS n_near, max(n) AS most, min(struct_pack(less := -n, other := other)).other AS other FROM near GROUP BY word
), formed AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 2 * v.n THEN other END AS form,
         CASE WHEN most >= 2 * v.n THEN most END AS form_n
  FROM v LEFT JOIN best USING (word)
), walk AS (
  SELECT word, word AS here, 0 AS step FROM formed
  UNION ALL
  SELECT walk.word, f.form, step + 1 FROM walk JOIN formed f ON f.word = walk.here WHERE f.form IS NOT NULL
)
SELECT word, form, root, n, n_near, form_n
FROM formed JOIN (SELECT word, max_by(here, step) AS root FROM walk GROUP BY word) USING (word)
"""
