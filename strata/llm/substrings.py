"""Fuzzy repeated passages by collinear chaining.

Documents are sampled into seeds (closed syncmers of word k-mers: a k-mer is a
seed or not wherever it stands, and any run of ``2 * SEED - SUB - 1`` equal
words has one). All places of a seed match each other, as long as they are few.
Where they are many, so that pairs would grow with their square, the places are
told apart by what follows and precedes them: by seeds some words on (a place
matches all few places with the same two seeds) and by all seeds of some 25
words. Groups that are still large share these words, and each of their places
matches the one in the smallest and the one in the largest document, as does each
place of a frequent seed. So a run of 25 words that two documents share is found
whatever else holds its seeds, and matches grow with places. The matches of two documents are chained in order with gap costs through a
Fenwick tree, and each chain is aligned on the words themselves, a short one on
the few words around it first.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import MIX, batches_of, many_hashes, saved, scratch, shingle_hashes, table

#: Words of a seed, and of the parts whose least one is its first or last.
SEED, SUB = 5, 2
#: Longest period of words that repeat over and over, and how far apart their seeds stand: a multiple of every period,
#: so that all phases are seen in each stride, and less than ``ALIGNED``, so that alignments from two seeds meet.
PERIOD, STRIDE = 4, 24
#: Words of a repeated passage, and of one alignment that may be part of it.
PASSAGE, ALIGNED = 50, 25
#: Part of an alignment's words that match, cost of a skipped word in a chain.
IDENTITY, GAP = 0.7, 0.25
#: Words between seeds of a segment at most.
SPARSE = 24
#: A single segment of fewer words is looked at with so many words on either side, before it is aligned in full.
SHORT, NEAR = 16, 16
CHUNK, REACH, DROP = 128, 64, 12
#: Equal words at either end of a part of a chain.
ANCHOR = 4
#: Places of a seed, or of a seed in its context, that are all matched with each other.
FEW = 16
#: Places of one seed that a task holds in memory; more wait in a file of its own until the seed's last.
HELD = 1 << 18
#: Stands between two texts whose words are looked at together; no k-mer across it counts.
BETWEEN = np.uint64(MIX[2])
#: How many words on a frequent seed's partner begins at least (each gives a context), and at most.
FOLLOWING, WITHIN = (8, 16), 24
#: Words of the context made of all seeds: any two places with the same have ``ALIGNED`` equal words.
CONTEXT = ALIGNED + SEED - SUB - 1


def syncmers(h: np.ndarray, k: int = SEED, sub: int = SUB, place: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the k-mers whose least ``sub``-mer is their first or their last.

    A k-mer equal to the one before it is passed over, so a repeated word isn't a seed at every place. Where a
    k-mer overlaps an equal one otherwise (two to four words over and over), it is a seed in ``PERIOD`` out of
    every ``STRIDE`` words: each of its phases is among them, and an alignment reaches further than to the next.
    The last ``PERIOD`` of such a run are seeds too, so that the ends of two runs meet whatever their strides.
    ``place`` counts each text's words where ``h`` holds several texts."""
    if len(h) < k:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64)
    kmers, parts = shingle_hashes(h, k), shingle_hashes(h, sub)
    n = len(kmers)
    ends = np.minimum(parts[:n], parts[k - sub:])
    chosen = np.ones(n, dtype=bool)
    for j in range(1, k - sub):
        chosen &= ends <= parts[j:n + j]
    chosen[1:] &= kmers[1:] != kmers[:-1]
    again = np.zeros(n, dtype=bool)
    for p in range(2, PERIOD + 1):
        again[p:] |= kmers[p:] == kmers[:-p]
    if again.any():
        last = again.copy()
        last[:-PERIOD] &= ~again[PERIOD:]
        chosen &= ~again | last | ((np.arange(n) if place is None else place[:n]) % STRIDE < PERIOD)
    at = np.flatnonzero(chosen)
    return at, kmers[at]


def _words(batches):
    schema = pa.schema([("doc", pa.int64()), ("words", pa.binary())])

    def rows():
        for batch in batches:
            docs = iter(batch.column(0).to_pylist())
            for h, n in many_hashes(text.as_py() for text in batch.column(1)):
                words, ends = (h >> np.uint64(32)).astype("<u4").tobytes(), np.cumsum(4 * n)
                for start, end, doc in zip((ends - 4 * n).tolist(), ends.tolist(), docs):
                    yield doc, words[start:end]

    yield from batches_of(rows(), schema)


def _seeds(k: int, sub: int):
    schema = pa.schema([("seed", pa.int64()), ("doc", pa.int64()), ("pos", pa.int32())])

    def task(batches):
        for batch in batches:
            at, seeds, docs, done = [], [], [], 0
            for h, n in many_hashes(text.as_py() for text in batch.column(1)):
                text = np.repeat(np.arange(len(n)), n + 1)      # each text's words and ``BETWEEN``
                place = np.arange(len(text)) - (np.cumsum(n + 1) - n - 1)[text]
                line = np.full(len(text), BETWEEN)
                line[place < n[text]] = h
                own, found = syncmers(line, k, sub, place)
                inside = place[own] + k <= n[text[own]]
                own = own[inside]
                at.append(place[own])
                seeds.append(found[inside])
                docs.append(batch.column(0).slice(done, len(n)).to_numpy()[text[own]])
                done += len(n)
            if at:
                yield pa.RecordBatch.from_arrays(
                    # 48 bits: what collides is compared word by word
                    [pa.array((np.concatenate(seeds) >> np.uint64(16)).view(np.int64)), pa.array(np.concatenate(docs)),
                     pa.array(np.concatenate(at).astype(np.int32))], schema=schema)

    return task


def _match_task(few: int, places: bool = True, ends: bool = False, most: int = HELD):
    """``seed, doc, pos`` by seed -> ``seed, a, b, pa, pb``: matches of all places of a seed that has ``few`` at most,
    the smaller document first. Of other seeds each place (b null) if ``places``, and if ``ends`` its matches with the
    places in the smallest and the largest document. Holds a batch and ``most`` rows."""
    schema = pa.schema([("seed", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("pa", pa.int32()), ("pb", pa.int32())])
    place = np.dtype([("doc", "<i8"), ("pos", "<i4")])

    def batch_of(seed, a, b, x, y):
        return pa.RecordBatch.from_arrays([pa.array(v) if v is not None else pa.nulls(len(a), f.type)
                                           for v, f in zip((seed, a, b, x, y), schema)], schema=schema)

    def lowest(doc, pos, first, size):
        """Smallest document of each group and its first place."""
        low = np.minimum.reduceat(doc, first)
        return low, np.minimum.reduceat(np.where(doc == np.repeat(low, size), pos, np.iinfo(np.int32).max), first)

    def highest(doc, pos, first, size):
        high = np.maximum.reduceat(doc, first)
        return high, np.maximum.reduceat(np.where(doc == np.repeat(high, size), pos, -1), first)

    def to_ends(doc, pos, low, low_at, high, high_at):
        own = doc != low
        if own.any():
            yield batch_of(None, low[own], doc[own], low_at[own], pos[own])
        own = doc != high
        if own.any():
            yield batch_of(None, doc[own], high[own], pos[own], high_at[own])

    def found(seed, doc, pos):
        first = np.flatnonzero(np.concatenate([[True], seed[1:] != seed[:-1]]))
        size = np.diff(first, append=len(seed))
        many = size > few
        if many.any():
            own, n = np.repeat(many, size), size[many]
            s, d, p = seed[own], doc[own], pos[own]
            if places:
                yield batch_of(s, d, None, p, None)
            if ends:
                begins = np.cumsum(n) - n
                yield from to_ends(d, p, *(np.repeat(v, n) for f in (lowest, highest) for v in f(d, p, begins, n)))
        own = np.repeat(~many & (size > 1), size)
        s, d, p = seed[own], doc[own], pos[own]
        for t in range(1, few):
            same = s[t:] == s[:-t]
            if not same.any():
                break
            at = np.flatnonzero(same & (d[t:] != d[:-t]))
            if len(at):
                low = np.where(d[at] < d[at + t], at, at + t)
                high = 2 * at + t - low
                yield batch_of(None, d[low], d[high], p[low], p[high])

    def filed(held, file):
        """Places of a seed that has too many to hold: to the file, in ``places``."""
        for seed, doc, pos in held:
            rows = np.empty(len(doc), dtype=place)
            rows["doc"], rows["pos"] = doc, pos
            file.write(rows.tobytes())
            if places:
                yield batch_of(seed, doc, None, pos, None)

    def pieces(file):
        file.seek(0)
        while raw := file.read(place.itemsize * HELD):
            rows = np.frombuffer(raw, dtype=place)
            yield rows["doc"].copy(), rows["pos"].copy()

    def filed_ends(file):
        if not ends:
            return
        whole = np.zeros(1, dtype=np.int64)
        sides = [[f(d, p, whole, [len(d)]) for d, p in pieces(file)] for f in (lowest, highest)]
        low, high = (pick((int(d[0]), int(p[0])) for d, p in side) for pick, side in zip((min, max), sides))
        for doc, pos in pieces(file):
            yield from to_ends(doc, pos, *(np.full(len(doc), v, dtype=t) for end in (low, high) for v, t in zip(end, ("i8", "i4"))))

    def task(batches):
        held, file = [], None       # of the last seed
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [c.to_numpy() for c in batch.columns]
            if held or file:
                more = int(np.searchsorted(cols[0], last, side="right"))
                if more == len(cols[0]) or file:
                    held.append([c[:more] for c in cols])
                    if file or sum(len(h[0]) for h in held) > max(most, few):
                        file = file or tempfile.TemporaryFile()
                        yield from filed(held, file)
                        held = []
                    if more == len(cols[0]):
                        continue
                    yield from filed_ends(file)
                    file = file.close()
                    cols = [c[more:] for c in cols]
                else:
                    cols = [np.concatenate(c) for c in zip(*held, cols)]
            last = cols[0][-1]
            cut = int(np.searchsorted(cols[0], last))
            if cut:
                yield from found(*(c[:cut] for c in cols))
            held = [[c[cut:] for c in cols]]
        if file:
            yield from filed_ends(file)
            file.close()
        elif held:
            yield from found(*(np.concatenate(c) for c in zip(*held)))

    return task


def contexts(seed: np.ndarray, doc: np.ndarray, pos: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places ordered by document and position -> ``(numbers of places, hash of the context)``.

    A context is the place's seed and the first one ``FOLLOWING`` words on, or all seeds of ``CONTEXT`` words from
    the place on or up to it; these it has if the last begins where it must in a run of equal words."""
    s, n = seed.view(np.uint64), len(seed)
    line = np.cumsum(np.concatenate([[0], doc[1:] != doc[:-1]])) * (1 << 33) + pos

    def mixed(h, v, j):
        h = (h ^ v) * np.uint64(MIX[j % 3])
        return h ^ (h >> np.uint64(29))

    for j, words in enumerate(FOLLOWING):
        at = np.searchsorted(line, line + words)
        own = np.flatnonzero(line[np.minimum(at, n - 1)] - line <= WITHIN)
        own = own[at[own] < n]
        yield own, mixed(mixed(np.full(len(own), j + 1, dtype=np.uint64), s[own], 0), s[at[own]], 1)
    last = CONTEXT - SEED       # how far on the last seed may begin
    for side in (1, -1):
        h, reached = np.full(n, 8 + side, dtype=np.uint64), np.zeros(n, dtype=np.int64)
        for t in range(min(last + 1, n)):
            one, other = (slice(0, n - t), slice(t, n))[::side]
            far = line[t:] - line[:n - t]
            near = far <= last
            if not near.any():
                break
            h[one] = np.where(near, mixed(mixed(h[one], s[other], 0), far.astype(np.uint64), 1), h[one])
            reached[one] = np.where(near, far, reached[one])
        own = np.flatnonzero(reached >= ALIGNED - SEED)
        yield own, h[own]


def _context_task(batches):
    """Sorted ``doc, pos, seed`` -> ``seed, doc, pos`` with the place's contexts for seeds; holds a batch and some words."""
    schema = pa.schema([("seed", pa.int64()), ("doc", pa.int64()), ("pos", pa.int32())])
    reach = max(WITHIN, CONTEXT)

    def found(doc, pos, seed, start, stop):
        for own, h in contexts(seed, doc, pos):
            own, h = (v[(own >= start) & (own < stop)] for v in (own, h))
            if len(own):
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(doc[own]), pa.array(pos[own])], schema=schema)

    held, done = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [c.to_numpy() for c in batch.columns]
        if held is not None:
            cols = [np.concatenate(c) for c in zip(held, cols)]
        new = np.concatenate([[True], np.logical_or.reduce([c[1:] != c[:-1] for c in cols])])
        doc, pos, seed = cols = [c[new] for c in cols]
        mine = int(np.searchsorted(doc, doc[-1]))
        stop = mine + int(np.searchsorted(pos[mine:], pos[-1] - reach))      # contexts beyond may go on in the next batch
        yield from found(*cols, done, stop)
        keep = mine + int(np.searchsorted(pos[mine:], pos[-1] - 2 * reach))
        held, done = [c[keep:] for c in cols], max(stop, done) - keep
    if held is not None:
        yield from found(*held, done, len(held[0]))


def _chunks(size: int):
    schema = pa.schema([("doc", pa.int64()), ("chunk", pa.int32()), ("payload", pa.binary())])

    def task(batches):
        def rows():
            for batch in batches:
                for doc, words in zip(batch.column(0).to_pylist(), batch.column(1)):
                    raw = words.as_py()
                    for i in range(0, len(raw), 4 * size):
                        yield doc, i // (4 * size), raw[i:i + 4 * size]

        yield from batches_of(rows(), schema)

    return task


def _surroundings(size: int, before: int, after: int):
    """Chunks with the words around them, 0 where the text ends, as 8-bit hashes: what they refute differs."""
    schema = pa.schema([("doc", pa.int64()), ("chunk", pa.int32()), ("n", pa.int32()), ("payload", pa.binary())])

    def task(batches):
        def rows():
            for batch in batches:
                for doc, words in zip(batch.column(0).to_pylist(), batch.column(1)):
                    h = np.maximum(np.frombuffer(words.as_py(), dtype="<u4") >> np.uint32(24), np.uint32(1)).astype(np.uint8)
                    padded = bytes(before) + h.tobytes() + bytes(size + after)
                    for i in range(0, len(h), size):
                        yield doc, i // size, min(size, len(h) - i), padded[i:i + before + size + after]

        yield from batches_of(rows(), schema)

    return task


def segments(pair: np.ndarray, pa_: np.ndarray, pb: np.ndarray, k: int = SEED, reach: int = SPARSE) -> tuple[np.ndarray, ...]:
    """Matches of numbered pairs merged along their diagonals: ``pair, start in a, start in b, words``, by pair."""
    order = np.lexsort((pb, pb - pa_, pair))
    g, a, b = pair[order], pa_[order], pb[order]
    new = np.ones(len(a), dtype=bool)
    new[1:] = (g[1:] != g[:-1]) | (np.diff(b - a) != 0) | (np.diff(b) > reach)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(a)) - 1
    return g[first], a[first], b[first], b[last] - b[first] + k


class Fenwick:
    """Largest value over a prefix of positions."""

    def __init__(self, n: int):
        self.best = [(float("-inf"), -1)] * (n + 1)

    def add(self, i: int, value: tuple) -> None:
        i += 1
        while i < len(self.best):
            if value > self.best[i]:
                self.best[i] = value
            i += i & -i

    def most(self, i: int) -> tuple:
        """Over positions below ``i``."""
        found = (float("-inf"), -1)
        while i > 0:
            if self.best[i] > found:
                found = self.best[i]
            i -= i & -i
        return found


def chains(segs: list[tuple[int, int, int]], gap: float = GAP) -> list[list[tuple[int, int, int]]]:
    """Segments joined in order in both documents, best chain first; each segment is in one chain.

    A chain scores its words less ``gap`` for each word skipped in either document."""
    if len(segs) == 1:
        return [segs]
    ends = sorted({b + n for _, b, n in segs})
    rank = {e: i for i, e in enumerate(ends)}
    tree, score, back = Fenwick(len(ends)), [0.0] * len(segs), [-1] * len(segs)
    starts = np.searchsorted(ends, [b for _, b, _ in segs], side="right").tolist()
    # open segments enter the tree when a later one starts after their end in a
    by_end = sorted(range(len(segs)), key=lambda i: segs[i][0] + segs[i][2])
    entered = 0
    for i, (a, b, n) in enumerate(segs):
        while entered < len(segs) and segs[by_end[entered]][0] + segs[by_end[entered]][2] <= a:
            j = by_end[entered]
            aj, bj, nj = segs[j]
            tree.add(rank[bj + nj], (score[j] + gap * (aj + nj + bj + nj), j))
            entered += 1
        before, j = tree.most(starts[i])
        gain = before - gap * (a + b)
        score[i], back[i] = (n + gain, j) if gain > 0 else (float(n), -1)
    used, found = [False] * len(segs), []
    for i in sorted(range(len(segs)), key=lambda i: -score[i]):
        chain = []
        while i >= 0 and not used[i]:
            used[i] = True
            chain.append(segs[i])
            i = back[i]
        if chain:
            found.append(chain[::-1])
    return found


def _pairs(batches):
    """``a, b, pa, pb`` of a partition sorted by the number of a pair, its first column, cut only where that changes,
    ordered by pair."""
    def ordered(pieces):
        number, *cols = (np.concatenate(c) for c in zip(*pieces))
        a, b = cols[:2]
        if ((number[1:] == number[:-1]) & ((a[1:] != a[:-1]) | (b[1:] != b[:-1]))).any():     # two pairs with one number
            order = np.lexsort((b, a))
            cols = [c[order] for c in cols]
        return cols

    held = []
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [c.to_numpy() for c in batch.columns]
        last = int(np.searchsorted(cols[0], cols[0][-1]))
        if last or held and held[-1][0][-1] != cols[0][0]:
            yield ordered([*held, [c[:last] for c in cols]])
            held = []
        held.append([c[last:] for c in cols])
    if held:
        yield ordered(held)


def _payloads(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> pa.Array:
    """Chains of one segment each."""
    raw = np.stack([x, y, n], axis=1).astype("<i4").tobytes()
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(12), len(x), [None, pa.py_buffer(raw)]).cast(pa.binary())


def _chain_task(k: int, reach: int, gap: float):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("c", pa.int32()), ("a0", pa.int32()), ("a1", pa.int32()),
                        ("b0", pa.int32()), ("b1", pa.int32()), ("payload", pa.binary())])

    def singles(a, b, x, y, n):   # pairs of one segment, all at once
        ends = [pa.array(v.astype(np.int32)) for v in (np.zeros(len(x)), x, x + n, y, y + n)]
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), *ends, _payloads(x, y, n)], schema=schema)

    def task(batches):
        for a, b, x, y in _pairs(batches):
            new = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
            a, b = a[new], b[new]
            pair, x, y, n = segments(np.cumsum(new) - 1, x.astype(np.int64), y.astype(np.int64), k, reach)
            first = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]]))
            size = np.diff(first, append=len(pair))
            alone = size == 1
            if alone.any():
                at = first[alone]
                yield singles(a[alone], b[alone], x[at], y[at], n[at])

            def rows():
                for i, at, m in zip(np.flatnonzero(~alone).tolist(), first[~alone].tolist(), size[~alone].tolist()):
                    segs = sorted(zip(*(v[at:at + m].tolist() for v in (x, y, n))))
                    for c, chain in enumerate(chains(segs, gap)):
                        (a0, b0, _), (a1, b1, w) = chain[0], chain[-1]
                        yield int(a[i]), int(b[i]), c, a0, a1 + w, b0, b1 + w, np.array(chain, dtype="<i4").tobytes()

            yield from batches_of(rows(), schema)

    return task


def _ends(same: np.ndarray, drop: int) -> tuple[np.ndarray, np.ndarray]:
    """``_extend`` of many runs at once: words that are shared, and whether the run may go on beyond its end."""
    score = np.cumsum(np.where(same, 1, -2), axis=1)
    fallen = np.maximum.accumulate(np.maximum(score, 0), axis=1) - score > drop
    closed = fallen.any(axis=1)
    before = np.logical_or.accumulate(fallen, axis=1)
    score = np.where(before, -1, score)
    return np.where(score.max(axis=1) > 0, score.argmax(axis=1) + 1, 0), ~closed


def _near_task(aligned: int, short: int, near: int, drop: int):
    """Single segments with the words around them -> the chains of those whose alignment isn't surely under ``aligned``
    words."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("a0", pa.int32()), ("a1", pa.int32()), ("b0", pa.int32()),
                        ("b1", pa.int32()), ("payload", pa.binary())])

    def task(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), dtype=np.uint8).reshape(-1, 2 * near + short)
                    for i in (5, 6))
            a, b, a0, b0, n = (batch.column(i).to_numpy() for i in range(5))
            same = (x == y) & (x != 0)
            left, more = _ends(same[:, :near][:, ::-1], drop)
            right, most = _ends(np.take_along_axis(same, near + n[:, None] + np.arange(near), axis=1), drop)
            keep = more | most | (left + n + right >= aligned)
            a, b, a0, b0, n = (v[keep] for v in (a, b, a0, b0, n))
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in (a, b, a0, a0 + n, b0, b0 + n)] + [_payloads(a0, b0, n)],
                                             schema=schema)

    return task


def _extend(x: np.ndarray, y: np.ndarray, drop: int) -> tuple[int, int]:
    """Words that two equally directed runs share before mismatches outweigh them, and how many match."""
    n = min(len(x), len(y))
    if not n:
        return 0, 0
    same = x[:n] == y[:n]
    if same.all():
        return n, n
    score = np.cumsum(np.where(same, 1, -2))
    fallen = np.maximum.accumulate(np.maximum(score, 0)) - score > drop
    stop = int(fallen.argmax()) if fallen.any() else n
    if not stop or score[:stop].max() <= 0:
        return 0, 0
    best = int(score[:stop].argmax()) + 1
    return best, int(same[:best].sum())


def _equal(a: np.ndarray, b: np.ndarray, x: int, y: int, n: int) -> list[tuple[int, int, int]]:
    """Runs of equal words on a diagonal of ``n`` words."""
    same = a[x:x + n] == b[y:y + n]
    if same.all():
        return [(x, y, n)] if n else []
    same = np.concatenate([[False], same, [False]])
    edges = np.flatnonzero(same[1:] != same[:-1]).tolist()
    return [(x + i, y + i, j - i) for i, j in zip(edges[::2], edges[1::2])]


def equal_runs(a: np.ndarray, b: np.ndarray, chain: list[tuple[int, int, int]], reach: int = REACH,
               drop: int = DROP) -> list[tuple[int, int, int]]:
    """A chain on the words themselves: runs of equal words, in order in both.

    Segments are compared word by word, gaps between them by their longest
    matching blocks (large ones along the diagonals of their two ends), and both
    ends of the chain grow along their diagonal."""
    found, last = [], None
    for x, y, n in chain:
        if last:
            p, q = last
            ga, gb = a[p:x], b[q:y]
            if len(ga) and len(gb) and max(len(ga), len(gb)) <= 4 * CHUNK:
                blocks = SequenceMatcher(None, ga.tolist(), gb.tolist(), autojunk=False).get_matching_blocks()
                found += [(p + m.a, q + m.b, m.size) for m in blocks if m.size]
            elif len(ga) and len(gb):
                after, _ = _extend(ga, gb, drop)
                before, _ = _extend(ga[after:][::-1], gb[after:][::-1], drop)
                found += _equal(a, b, p, q, after) + _equal(a, b, x - before, y - before, before)
        n = min(n, len(a) - x, len(b) - y)
        found += _equal(a, b, x, y, n)
        last = (x + n, y + n)
    x, y, _ = chain[0]
    left, _ = _extend(a[max(0, x - reach):x][::-1], b[max(0, y - reach):y][::-1], drop)
    right, _ = _extend(a[last[0]:last[0] + reach], b[last[1]:last[1] + reach], drop)
    return _equal(a, b, x - left, y - left, left) + found + _equal(a, b, *last, right)


def stretches(a: np.ndarray, b: np.ndarray, found: list[tuple[int, int, int]], aligned: int, identity: float,
              reach: int = REACH, drop: int = DROP) -> list[tuple[int, int, int, int, int]]:
    """``(start a, end a, start b, end b, words that match)`` of the stretches of ``equal_runs`` that hold
    ``aligned`` words and the identity.

    The whole where it holds, else its parts: from each run of ``ANCHOR`` words the
    longest stretch to another, grown along its ends' diagonals, less those inside
    the one before. So a gap costs what it joins and nothing else."""
    if not found:
        return []
    x, y, n = np.array(found, dtype=np.int64).T
    matched, out, seen = np.cumsum(n), [], -1

    def holds(a0, a1, b0, b1, words):
        return min(a1 - a0, b1 - b0) >= aligned and words >= identity * max(a1 - a0, b1 - b0)

    whole = tuple(int(v) for v in (x[0], x[-1] + n[-1], y[0], y[-1] + n[-1], matched[-1]))
    if holds(*whole):
        return [whole]
    anchors = np.flatnonzero(n >= ANCHOR)
    for k, i in enumerate(anchors):
        j = anchors[k:]
        words = matched[j] - matched[i] + n[i]
        j = int(j[np.flatnonzero(words >= identity * np.maximum(x[j] + n[j] - x[i], y[j] + n[j] - y[i]))[-1]])
        if j <= seen:
            continue
        seen = j
        a0, a1, b0, b1 = (int(v) for v in (x[i], x[j] + n[j], y[i], y[j] + n[j]))
        part = a0, a1, b0, b1, int(matched[j] - matched[i] + n[i])
        left, more = _extend(a[max(0, a0 - reach):a0][::-1], b[max(0, b0 - reach):b0][::-1], drop)
        right, most = _extend(a[a1:a1 + reach], b[b1:b1 + reach], drop)
        grown = a0 - left, a1 + right, b0 - left, b1 + right, part[-1] + more + most
        if holds(*grown) or holds(*part):
            out.append(grown if holds(*grown) else part)
        if seen == anchors[-1]:
            break
    return out


def _align_task(aligned: int, identity: float):
    schema = pa.schema([("doc", pa.int64()), ("partner", pa.int64()), ("start", pa.int64()), ("end", pa.int64()),
                        ("identity", pa.float64())])

    def around(words: dict[int, np.ndarray], start: int, end: int) -> tuple[int, np.ndarray]:
        """The chunks that hold a chain's side and the words around it, and the word they begin with."""
        first, last = max(0, start - REACH) // CHUNK, (end + REACH) // CHUNK
        return first * CHUNK, np.concatenate([words[i] for i in range(first, last + 1) if i in words])

    def aligned_rows(pair, held, sides):
        a, b = pair
        for chain in held:
            (p, q, _), (u, v, n) = chain[0], chain[-1]
            (at, x), (to, y) = around(sides[0], p, u + n), around(sides[1], q, v + n)
            own = [(p - at, q - to, n) for p, q, n in chain]
            for a0, a1, b0, b1, matched in stretches(x, y, equal_runs(x, y, own), aligned, identity):
                share = matched / max(a1 - a0, b1 - b0)
                yield a, b, a0 + at, a1 + at, share
                yield b, a, b0 + to, b1 + to, share

    def task(batches):
        def rows():
            pair, held, sides = None, [], ({}, {})
            for batch in batches:
                for a, b, side, chunk, payload, some in zip(*(c.to_pylist() for c in batch.columns)):
                    if (a, b) != pair:
                        yield from aligned_rows(pair or (a, b), held, sides)
                        pair, held, sides = (a, b), [], ({}, {})
                    if side < 0:
                        held = [np.frombuffer(c, dtype="<i4").reshape(-1, 3).tolist() for c in some]
                    else:   # repeated rows of a document bring a chunk twice
                        sides[side].setdefault(chunk, np.frombuffer(payload, dtype="<u4"))
            yield from aligned_rows(pair, held, sides) if pair else ()

        yield from batches_of(rows(), schema)

    return task


def repeated_passages(docs: DataFrame, passage: int = PASSAGE, aligned: int = ALIGNED, identity: float = IDENTITY,
                      k: int = SEED, sub: int = SUB, few: int = FEW) -> DataFrame:
    """``doc_id, text`` -> passages of ``passage`` words or more that other documents hold too.

    Columns: doc_id, start_word, end_word (exclusive, words from 0), n_words,
    partner_id (smallest doc_id that shares part of it), identity (best
    alignment's matching part). Alignments of ``aligned`` words or more that
    overlap or touch make one passage. All documents that hold it are listed.
    Rows without doc_id are left out; rows that share one count as one document,
    whose passages then belong to any of the rows. Null, empty and short texts
    have no passages, nor does an empty table.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc"), F.col("text").cast("string").alias("text")).where(
        "doc IS NOT NULL")
    with scratch(docs.sparkSession) as keep:
        def matched(places: DataFrame, own: bool) -> DataFrame:
            """One shuffle: a seed's places meet, and only matches go on, and the places of frequent seeds if ``own``."""
            rows = places.repartition("seed").sortWithinPartitions("seed")      # a radix sort: one number
            return rows.mapInArrow(_match_task(few, own, True), "seed long, a long, b long, pa int, pb int")

        plain = saved(matched(docs.mapInArrow(_seeds(k, sub), "seed long, doc long, pos int"), True), "chain-matches")
        ordered = (plain.where("b IS NULL").select(F.col("a").alias("doc"), F.col("pa").alias("pos"), "seed")
                   .repartition("doc").sortWithinPartitions("doc", "pos", "seed"))
        inside = matched(ordered.mapInArrow(_context_task, "seed long, doc long, pos int"), False)
        # a match may come twice: on its diagonal it counts once
        matches = plain.where("b IS NOT NULL").union(inside).select(F.xxhash64("a", "b").alias("pair"), "a", "b", "pa", "pb")
        pairs = matches.repartition("pair").sortWithinPartitions("pair")        # one number again
        joined = saved(pairs.mapInArrow(_chain_task(k, SPARSE, GAP),
                                        "a long, b long, c int, a0 int, a1 int, b0 int, b1 int, payload binary"), "chain-chains")
        # the texts are hashed once more when the seeds are gone, for their windows and chunks: less disk at a time
        hashed = saved(docs.mapInArrow(_words, "doc long, words binary"), "chain-words")
        near = hashed.mapInArrow(_surroundings(CHUNK, NEAR, NEAR + SHORT), "doc long, chunk int, n int, payload binary")
        # most chains are a seed that two documents share by chance: a few words around it refute them
        lone = F.expr(f"length(payload) = 12 AND a1 - a0 < {SHORT}")
        around = joined.where(lone).select("a", "b", "a0", "b0", (F.col("a1") - F.col("a0")).alias("m"))
        for doc, start, words in (("a", "a0", "x"), ("b", "b0", "y")):
            at = F.col("n") > F.col(start) % CHUNK
            own = near.withColumnsRenamed({"doc": doc, "chunk": "_chunk"})
            window = F.substring(F.col("payload"), F.col(start) % CHUNK + 1, F.lit(2 * NEAR + SHORT))
            around = (around.withColumn("_chunk", F.floor(F.col(start) / CHUNK).cast("int")).join(own, [doc, "_chunk"])
                      .where(at).withColumn(words, window).drop("_chunk", "n", "payload"))
        whole = "a long, b long, a0 int, a1 int, b0 int, b1 int, payload binary"
        open_ = around.select("a", "b", "a0", "b0", "m", "x", "y").mapInArrow(_near_task(aligned, SHORT, NEAR, DROP), whole)
        # repeated rows of a document bring a chain twice
        found = joined.where(~lone).drop("c").unionByName(open_.distinct())

        def reach(start: str, end: str):
            """Chunks of a chain's side and of the words around it."""
            return F.sequence(F.greatest(F.lit(0), F.floor((F.col(start) - REACH) / CHUNK)).cast("int"),
                              F.floor((F.col(end) + REACH) / CHUNK).cast("int"))

        # all chains of two documents are aligned together, so a chunk is fetched once however many lie in it
        pairs = saved(found.select("a", "b", "payload", reach("a0", "a1").alias("x"), reach("b0", "b1").alias("y"))
                      .groupBy("a", "b").agg(F.collect_list("payload").alias("chains"),
                                             *[F.array_distinct(F.flatten(F.collect_set(c))).alias(c) for c in ("x", "y")]),
                      "chain-pairs")

        def wanted(side: int, doc: str, held: str) -> DataFrame:
            return pairs.select("a", "b", F.lit(side).alias("side"), F.col(doc).alias("doc"), F.explode(held).alias("chunk"))

        chunks = hashed.mapInArrow(_chunks(CHUNK), "doc long, chunk int, payload binary")
        none = F.lit(None).cast("array<binary>").alias("chains")
        texts = (wanted(0, "a", "x").union(wanted(1, "b", "y")).join(chunks, ["doc", "chunk"])
                 .select("a", "b", "side", "chunk", "payload", none))
        heads = pairs.select("a", "b", F.lit(-1).alias("side"), F.lit(0).alias("chunk"), F.lit(None).cast("binary").alias("payload"), "chains")
        spans = keep(saved(texts.union(heads).repartition("a", "b").sortWithinPartitions("a", "b")
                      .mapInArrow(_align_task(aligned, identity), "doc long, partner long, start long, end long, identity double")
                      .groupBy("doc", "start", "end").agg(F.min("partner").alias("partner"), F.max("identity").alias("identity")),
                      "chain-spans"))

    along = Window.partitionBy("doc").orderBy("start", "end")
    before = F.max("end").over(along.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.when(F.col("start") <= before, 0).otherwise(1)
    return (spans.withColumn("_new", fresh).withColumn("_passage", F.sum("_new").over(along))
            .groupBy("doc", "_passage").agg(F.min("start").alias("start_word"), F.max("end").alias("end_word"),
                                            F.min("partner").alias("partner_id"), F.max("identity").alias("identity"))
            .withColumn("n_words", F.col("end_word") - F.col("start_word")).where(F.col("n_words") >= passage)
            .select(F.col("doc").alias("doc_id"), "start_word", "end_word", "n_words", "partner_id", "identity"))


def op8_collinear_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All passages of 50 words or more that several documents hold."""
    return repeated_passages(table(spark, sf_dir, "documents"))
