"""License scans by diagonal voting.

All rolling word k-gram hashes of a document are joined with the positions of
the same k-grams in license templates. A match votes for the diagonal document
position minus template position; neighbouring diagonals are merged, so a few
inserted or dropped words don't split a notice, and a merged span counts when
enough of its template's k-grams are found in about the template's length.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import WordHashes, saved, shingle_hashes, table

#: Phrases that stand consecutively, and their labels.
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

#: Notices found with small changes, and their labels.
NOTICES = {
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the Software), to deal in the Software without restriction": "mit",
    "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance "
    "with the License": "apache",
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
    "Public License as published by the Free Software Foundation": "gpl",
    "This work is licensed under the GNU General Public License, version 3": "gpl",
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
    "the following conditions are met": "bsd",
    "This Source Code Form is subject to the terms of the Mozilla Public License": "mpl",
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted": "isc",
    "This is free and unencumbered software released into the public domain": "unlicense",
    "This work is licensed under a Creative Commons Attribution": "cc",
    "Licensed under CC BY-NC 4.0": "cc-by-nc",
}

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PHRASE_K, NOTICE_K = 2, 3
#: Diagonals up to so many words apart merge.
NEIGHBOURS = 3
#: Least part of a notice's k-grams, and most words over its own length, for a span to count.
COVERAGE, STRETCH = 0.6, 1.5


#: Bytes of a word as they are, A-Z in lower case, all other ASCII a space.
WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def license_words(text: str | None) -> list[bytes]:
    """Words of the whole text with A-Z in lower case; null counts as empty."""
    return (text or "").encode("utf-8", "replace").translate(WORD_BYTES).split()


def _rolled(words: list[bytes], k: int, hashes: WordHashes) -> np.ndarray:
    return (shingle_hashes(hashes(words), k) if len(words) >= k else np.empty(0, dtype=np.uint64)).view(np.int64)


def _grams(batches):
    """``doc_id, text_key, text`` -> a row for each k: the hashes of all its rolling k-grams."""
    schema = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("grams", pa.list_(pa.int64()))])
    hashes = WordHashes()
    for batch in batches:
        for a in range(0, batch.num_rows, 512):
            part = batch.slice(a, 512)
            rolled = []
            for text in part.column(2):
                words = license_words(text.as_py())
                rolled += [_rolled(words, k, hashes) for k in (PHRASE_K, NOTICE_K)]
            ends = np.concatenate([[0], np.cumsum([len(r) for r in rolled])]).astype(np.int32)
            twice = np.repeat(np.arange(part.num_rows), 2)
            yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(twice)), part.column(1).take(pa.array(twice)),
                                              pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(rolled)))],
                                             schema=schema)


def _counts(batches):
    for batch in batches:
        n = pa.array([len(license_words(t.as_py())) for t in batch.column(2)], type=pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), n], names=["doc_id", "text_key", "n_words"])


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.xxhash64(F.coalesce(text, F.lit(""))).alias("text_key"), text.alias("text"))


def template_words(text: str) -> list[str]:
    return [w.decode() for w in license_words(text)]


def templates(spark: SparkSession) -> DataFrame:
    """``gram, template, label, base, grams, at``: one row per template position (a few hundred in all)."""
    rows, hashes = [], WordHashes()
    known = [(t, x, True, PHRASE_K) for t, x in PHRASES.items()] + [(t, x, False, NOTICE_K) for t, x in NOTICES.items()]
    for n, (text, label, base, k) in enumerate(known):
        rolled = _rolled(license_words(text), k, hashes).tolist()
        rows += [(g, n, label, base, len(rolled), at) for at, g in enumerate(rolled)]
    return spark.createDataFrame(rows, "gram long, template int, label string, base boolean, grams int, at int")


def license_spans(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` -> spans ``doc_id, text_key, label, base, start, end, coverage``.

    ``text_key`` is a hash of the text: rows with the same doc_id and text share
    their spans, which appear once. Words are numbered from 0 and ``end`` is
    exclusive. A phrase counts where its words stand consecutively (coverage 1);
    a notice by merged diagonals. Null and empty texts have no spans."""
    rolled = (_keyed(docs).mapInArrow(_grams, "doc_id long, text_key long, grams array<long>")
              .select("doc_id", "text_key", F.posexplode("grams").alias("pos", "gram")))
    # the templates are fixed values of this module, so their size is known
    hits = (rolled.join(F.broadcast(templates(docs.sparkSession)), "gram")
            .select("doc_id", "text_key", "template", "label", "base", "grams", "at", "pos").distinct())
    hits = hits.withColumn("diagonal", F.col("pos") - F.col("at"))

    votes = (hits.groupBy("doc_id", "text_key", "template", "label", "base", "grams", "diagonal")
             .agg(F.count("*").alias("votes"), F.min("pos").alias("first"), F.max("pos").alias("last"),
                  F.collect_set("at").alias("ats")))
    places = votes.where("base AND votes = grams").select(
        "doc_id", "text_key", "label", "base", F.col("diagonal").cast("long").alias("start"),
        (F.col("last") + PHRASE_K).cast("long").alias("end"), F.lit(1.0).alias("coverage"))

    along = Window.partitionBy("doc_id", "text_key", "template").orderBy("diagonal")
    far = F.col("diagonal") - F.lag("diagonal").over(along) > NEIGHBOURS
    merged = (votes.where("NOT base").withColumn("_new", F.coalesce(far.cast("int"), F.lit(1)))
              .withColumn("island", F.sum("_new").over(along))
              .groupBy("doc_id", "text_key", "template", "label", "base", "grams", "island")
              .agg(F.min("first").cast("long").alias("start"), (F.max("last") + NOTICE_K).cast("long").alias("end"),
                   F.size(F.array_distinct(F.flatten(F.collect_list("ats")))).alias("found")))
    spans = merged.withColumn("coverage", F.col("found") / F.col("grams")).where(
        (F.col("coverage") >= COVERAGE) & (F.col("end") - F.col("start") <= STRETCH * (F.col("grams") + NOTICE_K - 1)))
    return places.unionByName(spans.select(*places.columns))


def op6_diagonal_voting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their license phrases and notices."""
    docs = table(spark, sf_dir, "documents")
    spans = license_spans(docs)
    by_doc = saved(spans.groupBy("doc_id", "text_key").agg(
        F.count_if("base").alias("n_base"), F.min(F.when(F.col("base"), F.col("start"))).alias("first_word"),
        F.max(F.when(F.col("base"), F.col("start"))).alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("base"), F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
        F.max("coverage").alias("score")), "license-spans")
    rows = _keyed(docs).mapInArrow(_counts, "doc_id long, text_key long, n_words long").alias("d")
    s = by_doc.alias("s")
    same = F.col("d.doc_id").eqNullSafe(F.col("s.doc_id")) & (F.col("d.text_key") == F.col("s.text_key"))
    zero = lambda c, v: F.coalesce(F.col(c), F.lit(v)).alias(c)
    return rows.join(s, same, "left").select(
        F.col("d.doc_id").alias("doc_id"), "n_words", zero("n_base", 0), "first_word", "last_word",
        zero("base_labels", ""), zero("labels", ""), zero("score", 0.0))


def _sql() -> str:
    known = [f"({n}, '{label}', {base}, {k}, {template_words(text)!r})" for n, (text, label, base, k) in enumerate(
        [(t, l, "true", PHRASE_K) for t, l in PHRASES.items()] + [(t, l, "false", NOTICE_K) for t, l in NOTICES.items()])]
    return rf"""
WITH t0 AS (SELECT * FROM (VALUES {', '.join(known)}) AS v(template, label, base, k, ws)
), t AS (
  SELECT template, label, base, k, len(ws) - k + 1 AS grams,
         unnest(list_transform(range(0, len(ws) - k + 1), lambda i: struct_pack(tpos := i, gram := array_to_string(ws[i + 1:i + k], ' ')))) AS g
  FROM t0
), d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '{WORD}') AS ws FROM documents
), g AS (
  SELECT doc_id, ks.k, unnest(list_transform(range(0, len(ws) - ks.k + 1), lambda i: struct_pack(pos := i, gram := array_to_string(ws[i + 1:i + ks.k], ' ')))) AS g
  FROM d, (VALUES ({PHRASE_K}), ({NOTICE_K})) AS ks(k) WHERE len(ws) >= ks.k
), h AS (
  SELECT doc_id, template, label, base, grams, t.k, t.g.tpos AS tpos, g.g.pos AS pos, g.g.pos - t.g.tpos AS diagonal
  FROM g JOIN t ON g.k = t.k AND g.g.gram = t.g.gram
), v AS (
  SELECT doc_id, template, label, base, grams, k, diagonal, count(*) AS votes, min(pos) AS first, max(pos) AS last
  FROM h GROUP BY ALL
), n AS (
  SELECT *, CASE WHEN diagonal - lag(diagonal) OVER w <= {NEIGHBOURS} THEN 0 ELSE 1 END AS fresh
  FROM v WHERE NOT base WINDOW w AS (PARTITION BY doc_id, template ORDER BY diagonal)
), i AS (
  SELECT *, sum(fresh) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS island FROM n
), m AS (
  SELECT i.doc_id, i.template, i.label, i.grams, i.k, island, min(h.pos) AS s, max(h.pos) + i.k AS e,
         count(DISTINCT h.tpos) / i.grams AS coverage
  FROM i JOIN h ON h.doc_id = i.doc_id AND h.template = i.template AND h.diagonal = i.diagonal
  GROUP BY i.doc_id, i.template, i.label, i.grams, i.k, island
), spans AS (
  SELECT doc_id, label, true AS base, diagonal AS s, 1.0::DOUBLE AS coverage FROM v WHERE base AND votes = grams
  UNION ALL
  SELECT doc_id, label, false, s, coverage FROM m
  WHERE coverage >= {COVERAGE} AND e - s <= {STRETCH} * (grams + k - 1)
), r AS (
  SELECT doc_id, count(*) FILTER (base) AS n_base, min(s) FILTER (base) AS first_word, max(s) FILTER (base) AS last_word,
         coalesce(array_to_string(list_sort(list(DISTINCT label) FILTER (base)), ','), '') AS base_labels,
         array_to_string(list_sort(list(DISTINCT label)), ',') AS labels, max(coverage) AS score
  FROM spans GROUP BY doc_id
)
SELECT d.doc_id, len(ws) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
FROM d LEFT JOIN r USING (doc_id)
"""


OP6_SQL = _sql()
