"""Cost-balanced packing of tokenised documents into sequences of fixed length.

A document's cost is linear plus quadratic in its tokens (projections plus
attention). Whole multiples of the sequence length fill sequences of their own;
within a group the rest is dealt in descending order, each document to the
lowest-cost sequence that has capacity left. What doesn't fit there is cut and
dealt again, so only the last sequence of a group is padded.
"""

from __future__ import annotations

import heapq
import re
import struct

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import batches_of, clean_text, runs, scalar, table

LENGTH, END = 4096, 2
#: Bytes of text in a group, so at most one padded sequence for each.
GROUP_BYTES = 4 << 20
#: Cost of a piece of n tokens: n + QUADRATIC * n * n.
QUADRATIC = 1 / 6144
VOCABULARY = "word_bpe_49k.json"
PIECES = ("doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")


#: The byte-level alphabet writes bytes 128-160 and 173 as the characters from 290 on, other high bytes as themselves.
HIGH_BYTES = {**{b: 290 + b - 128 for b in range(128, 161)}, 173: 323}


class WordIds(dict):
    """Packed ids of white-space separated words, one memo per task, emptied when it holds ``limit`` words.

    The tokenizer drops white space and never merges across it, so a text's ids
    are those of its words. A word of Latin letters and a tail of punctuation is
    further split there, as the tokenizer does, to share the letters' ids.
    """

    limit = 1 << 20

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.parts: dict[str, bytes] = {}
        self.plain = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")
        self[""] = b""

    def _letters(self, part: str) -> bytes:
        ids = self.parts.get(part)
        if ids is None:
            spelled = part if part.isascii() else part.encode().decode("latin-1").translate(HIGH_BYTES)
            ids = self.parts[part] = _packed([t.id for t in self.tokenizer.model.tokenize(spelled)])
        return ids

    def _any(self, part: str) -> bytes:
        ids = self.parts.get(part)
        if ids is None:
            ids = self.parts[part] = _packed(self.tokenizer.encode(part, add_special_tokens=False).ids)
        return ids

    def __missing__(self, word: str) -> bytes:
        m = self.plain.fullmatch(word)
        if m:
            letters, tail = m.groups()
            ids = self._letters(letters.lower()) + self._any(tail) if tail else self._letters(letters.lower())
        else:
            ids = _packed(self.tokenizer.encode(word, add_special_tokens=False).ids)
        self[word] = ids
        return ids

    def __call__(self, text: str) -> bytes:
        """Ids as unsigned 32-bit little-endian."""
        if len(self) > self.limit:
            self.clear()
            self[""] = b""
        if len(self.parts) > self.limit:
            self.parts.clear()
        words = text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
        return b"".join(map(self.__getitem__, words))


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def _tokenise(path: str, end: int):
    schema = pa.schema([("doc_id", pa.int64()), ("pack_group", pa.int64()), ("ids", pa.binary())])

    def task(batches):
        ids_of = WordIds(path)
        end_id = _packed([end])

        def rows():
            for batch in batches:
                for doc_id, group, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                    yield doc_id, group, ids_of(text.as_py()) + end_id

        yield from batches_of(rows(), schema, 256)

    return task


def pack_lengths(lengths: list[int], length: int = LENGTH, quadratic: float = QUADRATIC) -> list[tuple]:
    """Documents by their number of tokens -> pieces ``(document, start, length, sequence, offset)``."""
    cost = lambda n: n + quadratic * n * n
    pieces, sequence = [], 0
    rest = []     # longest first; ties by position
    for i, n in enumerate(lengths):
        full = n // length
        for j in range(full):
            pieces.append((i, j * length, length, sequence, 0))
            sequence += 1
        if n % length:
            rest.append((-(n % length), i, full * length))
    heapq.heapify(rest)
    bins = -(-sum(-r[0] for r in rest) // length)
    used = dict.fromkeys(range(sequence, sequence + bins), 0)
    open_ = [(0.0, s) for s in used]
    while rest:
        n, i, start = heapq.heappop(rest)
        total, s = heapq.heappop(open_)
        take = min(-n, length - used[s])
        pieces.append((i, start, take, s, used[s]))
        used[s] += take
        if used[s] < length:
            heapq.heappush(open_, (total + cost(take), s))
        if take < -n:
            heapq.heappush(rest, (n + take, i, start + take))
    return pieces


def _pack(length: int, quadratic: float):
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
                        ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])

    def task(batches):
        def rows():
            for group in runs(batches, ["pack_group"]):
                ids = group["ids"].to_pylist()
                doc_ids = group["doc_id"].to_pylist()
                order = sorted(range(len(ids)), key=lambda i: (doc_ids[i] is None, doc_ids[i] or 0, ids[i]))
                first = group["pack_group"][0].as_py() << 32
                for i, start, n, sequence, offset in pack_lengths([len(ids[i]) // 4 for i in order], length, quadratic):
                    own = ids[order[i]]
                    yield (doc_ids[order[i]], start, n, own[4 * start:4 * (start + n)], len(own) // 4,
                           first + sequence, offset)

        yield from batches_of(rows(), schema, 512)

    return task


def tokenizer_path(name: str = VOCABULARY) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def pack(docs: DataFrame, vocabulary: str, length: int = LENGTH, end: int = END,
         group_bytes: int = GROUP_BYTES, quadratic: float = QUADRATIC) -> DataFrame:
    """``doc_id, text`` -> one row per piece with its token ids (unsigned 32-bit, little-endian).

    Columns: doc_id, start, length, ids, doc_tokens, sequence_id, offset. Every
    id, the end token of a document included, lies in exactly one piece; an
    empty or null text is its end token alone. Documents are dealt to groups by
    a hash of doc_id and text, so rows without doc_id spread too; repeated rows
    are packed each on their own. A group never spans sequences of another, and
    its sequences are numbered from ``group << 32``. A text of any length is cut
    into as many sequences as it fills. An empty table gives no pieces.
    ``vocabulary``: a tokenizers file that executors can open.
    """
    (total,) = scalar(docs, F.sum(F.octet_length(clean_text()).cast("long")))
    groups = max(1, -(-(total or 0) // group_bytes))
    group = F.pmod(F.xxhash64("doc_id", clean_text()), F.lit(groups)).alias("pack_group")
    tokens = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), group, clean_text().alias("text"))
              .mapInArrow(_tokenise(vocabulary, end), "doc_id long, pack_group long, ids binary"))
    return (tokens.repartition("pack_group").sortWithinPartitions("pack_group")
            .mapInArrow(_pack(length, quadratic), PIECES))


def op9_cost_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 4096 ids."""
    pieces = pack(table(spark, sf_dir, "documents"), tokenizer_path())
    return (pieces.withColumn("ids_crc32", F.crc32("ids"))
            .select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"))
