"""License scans by diagonal voting.

Words are runs of letters, digits and bytes above 0x7F, A-Z lower-cased. Two
things are looked for: exact phrases (the base), and templates, longer notices
that may have a few words inserted, left out or replaced.

1. Every text's rolling hashes of ``k`` words are joined with the templates'
   (hash, template, position).
2. A match votes for its diagonal, its place in the text less its place in the
   template; votes are gathered per (document, template, diagonal). Diagonals of
   a template not more than ``drift`` apart are one span: an inserted or
   missing word moves the rest to a neighbouring diagonal.
3. Spans with enough votes are verified on the words themselves: the longest common
   subsequence of the template and the span's words, over the longer of the two, is
   the span's share, which must reach ``min_share``. Of overlapping spans the
   one of the highest share stays, then the one with more words in common,
   then the earlier template.

The texts are read twice: for their hashes, and for the base, when the words of
documents with spans are handed on for verification; those are found by a
bit filter of fixed size and then exactly. The templates' hashes are broadcast
if there are at most ``BROADCAST`` of them, else joined by a shuffle.

Defined results: null and empty text have no words and no labels; rows that
repeat a doc_id and its text get the same result each; a null doc_id is a
document like any other; long texts are sent in parts of ``PART`` hashes; an
empty table gives an empty table; further columns are ignored."""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import textnum as T
from .line_dedup import bit_filter, passes
from .staging import stage

U = np.uint64
PART = 1 << 16
BROADCAST = 1 << 18
_OUTSIDE = T.byte_class((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))

# The phrases of the base with their labels.
PHRASES = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))

# Wording of common public license notices.
TEMPLATES = (
    ("mit", "Released under the MIT License"),
    ("mit", "Licensed under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
            "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
            "Public License as published by the Free Software Foundation"),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
             "General Public License as published by the Free Software Foundation"),
    ("agpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
             "General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
            "the following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
                "was not distributed with this file, You can obtain one at"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-nc-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc-by-4.0", "Licensed under CC BY 4.0"),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0"),
    ("cc0-1.0", "has dedicated all copyright and related and neighboring rights to this work to the public domain worldwide"),
)


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    raw, offsets = T.byte_view(texts)
    raw = T.lower(raw)
    return raw, *T.words(raw, offsets, _OUTSIDE)


def word_list(text: str | None) -> list[bytes]:
    raw, starts, ends, _ = _words(pa.array([text or ""], pa.large_string()))
    data = raw.tobytes()
    return [data[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]


def _hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(word hashes, row) of all words."""
    raw, starts, ends, row = _words(texts)
    return T.word_hashes(raw, starts, ends), row


def _rolling(hashes: np.ndarray, k: int) -> np.ndarray:
    n = max(0, len(hashes) - k + 1)
    odd = T.mix(np.arange(1, k + 1, dtype=np.uint64)) | U(1)
    acc = np.zeros(n, np.uint64)
    for j in range(k):
        acc += T.mix(hashes[j:j + n]) * odd[j]
    return T.mix(acc)


def template_grams(spark, templates, k: int) -> DataFrame:
    """(gram, template, place) of all templates."""
    rows = []
    for t, (_, text) in enumerate(templates):
        grams = _rolling(_hashes(pa.array([text], pa.large_string()))[0], k)
        if not len(grams):
            raise ValueError(f"template {t} has fewer than {k} words")
        rows += [(int(g), t, i) for i, g in enumerate(grams.view(np.int64))]
    out = spark.createDataFrame(rows, "gram bigint, template int, place int")
    return F.broadcast(out) if len(rows) <= BROADCAST else out


def base_table(rows: DataFrame, phrases, candidates: np.ndarray) -> DataFrame:
    """doc_id, tie, n_words, n_base, first_word, last_word and base (labels) of
    ``rows`` (doc_id, tie, h, text), and the text of those whose ``h`` passes
    the bit filter of ``candidates``."""
    filtered = rows.sparkSession.sparkContext.broadcast(candidates)     # of fixed size
    wanted = [(_hashes(pa.array([p], pa.large_string()))[0], label) for p, label in phrases]

    def run(batches):
        for b in batches:
            texts = T.string_array(b.column(3))
            outside = ~passes(filtered.value, b.column(2).to_numpy().view(np.uint64))
            for i, j in T.slices(T.byte_view(texts)[1]):
                hashes, row = _hashes(texts.slice(i, j - i))
                n = np.bincount(row, minlength=j - i)
                before = np.cumsum(n) - n
                at, of = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
                for p, (own, _) in enumerate(wanted):
                    size = max(0, len(hashes) - len(own) + 1)
                    ok = np.ones(size, bool)
                    for m, h in enumerate(own):
                        ok &= hashes[m:m + size] == h
                    hit = np.flatnonzero(ok)
                    hit = hit[row[hit] == row[hit + len(own) - 1]]
                    at.append(hit)
                    of.append(np.full(len(hit), p))
                at, of = np.concatenate(at), np.concatenate(of)
                where, place = row[at], at - before[row[at]]
                total = np.bincount(where, minlength=j - i)
                first, last = np.full(j - i, 2**62), np.full(j - i, -1)
                np.minimum.at(first, where, place)
                np.maximum.at(last, where, place)
                labels = [[] for _ in range(j - i)]
                for w, p in sorted({(int(w), int(p)) for w, p in zip(where, of, strict=True)}):
                    labels[w].append(wanted[p][1])
                none = total == 0
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i), b.column(1).slice(i, j - i), pa.array(n, pa.int64()), pa.array(total, pa.int64()),
                     pa.array(first, pa.int64(), mask=none), pa.array(last, pa.int64(), mask=none),
                     pa.array(labels, pa.list_(pa.string())),
                     texts.take(pa.array(np.arange(i, j), mask=outside[i:j])).cast(pa.string())],
                    ["doc_id", "tie", "n_words", "n_base", "first_word", "last_word", "base", "text"])

    return rows.mapInArrow(run, "doc_id bigint, tie bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
                                "base array<string>, text string")


def gram_table(rows: DataFrame, k: int) -> DataFrame:
    """(doc_id, tie, pos, gram): all rolling hashes of ``rows``."""
    def run(batches):
        for b in batches:
            texts = T.string_array(b.column(2))
            for i, j in T.slices(T.byte_view(texts)[1]):
                hashes, row = _hashes(texts.slice(i, j - i))
                grams = _rolling(hashes, k).view(np.int64)
                n = np.bincount(row, minlength=j - i)
                start = np.cumsum(n) - n
                parts = [(d, s, min(PART, n[d] - k + 1 - s)) for d in range(j - i) for s in range(0, max(0, int(n[d]) - k + 1), PART)]
                if parts:
                    doc, first, size = np.array(parts).T
                    inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                    flat = grams[np.repeat(start[doc] + first, size) + inside]
                    own = pa.array(doc + i)
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).take(own), b.column(1).take(own), pa.array(first),
                         pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32()), pa.array(flat))],
                        ["doc_id", "tie", "first", "grams"])

    parts = rows.mapInArrow(run, "doc_id bigint, tie bigint, first bigint, grams array<bigint>")
    return (parts.select("doc_id", "tie", "first", F.posexplode("grams").alias("at", "gram"))
            .select("doc_id", "tie", (F.col("first") + F.col("at")).alias("pos"), "gram"))


def voted_spans(rows: DataFrame, templates, k: int, drift: int, votes: float) -> DataFrame:
    """(doc_id, tie, template, low, high, votes): merged diagonals with enough
    votes; ``votes``: share of a template's hashes."""
    spark = rows.sparkSession
    # a diagonal holds at most one place per hash of the template, and rows
    # that repeat a document vote once
    diagonals = (gram_table(rows, k).join(template_grams(spark, templates, k), "gram")
                 .groupBy("doc_id", "tie", "template", (F.col("pos") - F.col("place")).alias("diagonal"))
                 .agg(F.size(F.collect_set("place")).alias("n")))
    own = W.partitionBy("doc_id", "tie", "template").orderBy("diagonal")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(own) > drift, F.lit(True))
    needed = F.create_map(*[F.lit(x) for t, (_, text) in enumerate(templates)
                            for x in (t, max(1, int(np.ceil(votes * (len(word_list(text)) - k + 1)))))])
    return (diagonals.withColumn("new", apart.cast("int"))
            .withColumn("span", F.sum("new").over(own)).groupBy("doc_id", "tie", "template", "span")
            .agg(F.min("diagonal").alias("low"), F.max("diagonal").alias("high"), F.sum("n").alias("votes"))
            .where(F.col("votes") >= needed[F.col("template")]).drop("span"))


def common_words(template: list[bytes], words: list[bytes]) -> int:
    """Length of the longest common subsequence, by bits of an integer."""
    full = (1 << len(template)) - 1
    places: dict[bytes, int] = {}
    for i, w in enumerate(template):
        places[w] = places.get(w, 0) | 1 << i
    row = full
    for w in words:
        hit = row & places.get(w, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(template) - row.bit_count()


def verified(words: list[bytes], spans: list[tuple[int, int, int]], templates: list[list[bytes]], min_share: float) -> list[tuple]:
    """(template, start, end, share) of the spans (template, low, high) that
    hold on the words, without overlaps, in order of place."""
    good = []
    for t, low, high in spans:
        start, end = max(0, low), min(len(words), high + len(templates[t]))
        common = common_words(templates[t], words[start:end])
        share = common / max(len(templates[t]), end - start)
        if share >= min_share:
            good.append((-share, -common, t, start, end))
    taken: list[tuple] = []
    for share, _, t, start, end in sorted(good):
        i = bisect_left(taken, (start,))
        if (i == 0 or taken[i - 1][1] <= start) and (i == len(taken) or taken[i][0] >= end):
            insort(taken, (start, end, t, -share))
    return [(t, start, end, share) for start, end, t, share in taken]


_SPANS = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("share", pa.float64())]))


def scan_licenses(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", templates=TEMPLATES, phrases=PHRASES,
                  k: int = 3, drift: int = 4, votes: float = 0.4, min_share: float = 0.85) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word,
    base (labels of phrases), spans (label, start and end word, share of
    verified templates)."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(F.col(text)).alias("tie"), F.col(text).alias("text"))
    found = stage(voted_spans(rows, templates, k, drift, votes).groupBy("doc_id", "tie")
                  .agg(F.collect_list(F.struct("template", "low", "high")).alias("voted")), "license-spans")
    name = F.xxhash64("doc_id", "tie")
    base = base_table(rows.select("doc_id", "tie", name.alias("h"), "text"), phrases, bit_filter(found.select(name.alias("h"))))
    spans = found.withColumnsRenamed({"doc_id": "_doc", "tie": "_tie"})
    joined = (base.join(spans, base["doc_id"].eqNullSafe(spans["_doc"]) & (base["tie"] == spans["_tie"]), "left")
              .select(*_BASE, "text", "voted"))
    lists, labels = [word_list(t) for _, t in templates], [label for label, _ in templates]

    def checked(batches):
        for b in batches:
            out = [[] for _ in range(b.num_rows)]
            for i in np.flatnonzero(pc.is_valid(b.column(len(_BASE) + 1)).to_numpy(zero_copy_only=False)).tolist():
                voted = [(s["template"], s["low"], s["high"]) for s in b.column(len(_BASE) + 1)[i].as_py()]
                out[i] = [{"label": labels[t], "start": a, "end": z, "share": s} for t, a, z, s in
                          verified(word_list(b.column(len(_BASE))[i].as_py()), voted, lists, min_share)]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in range(len(_BASE))), pa.array(out, _SPANS)], [*_BASE, "spans"])

    return joined.mapInArrow(checked, "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
                                      "base array<string>, spans array<struct<label string, start bigint, end bigint, share double>>")


_BASE = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base"]


def op12_license_scan(spark, sf_dir: str) -> DataFrame:
    got = scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    every = F.concat("base", F.transform("spans", lambda s: s["label"]))
    joined = lambda labels: F.array_join(F.sort_array(F.array_distinct(labels)), ",")
    best = F.coalesce(F.array_max(F.transform("spans", lambda s: s["share"])), F.lit(0.0))
    return got.select("doc_id", "n_words", "n_base", "first_word", "last_word", joined(F.col("base")).alias("base_labels"),
                      joined(every).alias("labels"), F.when(F.col("n_base") > 0, 1.0).otherwise(best).alias("score"))
