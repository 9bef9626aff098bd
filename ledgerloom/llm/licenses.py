"""License scans: exact set-similarity join of text blocks with license templates, and exact phrases.

A block is ``BLOCK_WORDS`` consecutive words, beginning at every multiple of ``STEP``; a template of up to ``STEP`` words therefore lies whole
in some block. A block meets a template if it holds at least ``THRESHOLD`` of the template's distinct words.

The join is exact. A first pass counts how often each template word occurs in all documents; words are ordered by that, rarest
first. A block that meets a template must hold one of the first ``|T| - need + 1`` words of the template (prefix
filter), have ``need`` words at all (length filter), and, from the rarest common word on, enough words left on both sides
(positional filter). Only what passes is compared. Templates are a parameter, checked to be at most ``MOST_TEMPLATES``, so broadcasting
them is bounded; documents never leave their task.

Defined results: null and empty texts have no words, no labels and score 0; repeated rows are judged alike; extra columns stay in ``doc``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.arrays import Words, slices, text_of, tidy, whole

THRESHOLD = 0.8
BLOCK_WORDS = 128
STEP = 64
MOST_TEMPLATES = 10_000

# Phrases and their labels.
PHRASES = (("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license"))

# Opening words of public license texts and notices, at most 64 words each.
TEMPLATES = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("apache", "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License. To view a copy of this license, visit"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
)


def words_of(text: str) -> Words:
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    return Words(data, np.array([0, len(data)]))


def _vocabulary(templates: Sequence[tuple[str, str]]) -> np.ndarray:
    return np.unique(np.concatenate([words_of(t).hash for _, t in templates]))


def _lookup(vocabulary: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Place of each word in the vocabulary, or -1."""
    at = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
    return np.where(vocabulary[at] == hashes, at, -1)


def frequencies(docs: DataFrame, text: str, vocabulary: np.ndarray) -> np.ndarray:
    """How often each word of the vocabulary occurs in all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(vocabulary), dtype=np.int64)
        for batch in batches:
            for _, _, data, offsets in slices(batch.column(0)):
                found = _lookup(vocabulary, Words(data, offsets).hash)
                total += np.bincount(found[found >= 0], minlength=len(vocabulary))
        full = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(full), pa.array(total[full])], names=["word", "n"])

    counted = docs.select(F.col(text).cast("string")).mapInArrow(tidy(count), "word long, n long")
    out = np.zeros(len(vocabulary), dtype=np.int64)
    for row in counted.groupBy("word").agg(F.sum("n").alias("n")).collect():  # at most one row per template word
        out[row["word"]] = row["n"]
    return out


class Index:
    """Templates as ordered word numbers, and for each prefix word the templates it may begin."""

    def __init__(self, templates: Sequence[tuple[str, str]], vocabulary: np.ndarray, frequency: np.ndarray, threshold: float):
        self.vocabulary = vocabulary
        rank = np.empty(len(vocabulary), dtype=np.int64)
        rank[np.lexsort([vocabulary, frequency])] = np.arange(len(vocabulary))
        #: number of a word in the global order, by place in the vocabulary
        self.rank = rank
        self.sets, self.need = [], []
        self.begins: dict[int, list[tuple[int, int]]] = {}
        for k, (_, text) in enumerate(templates):
            own = np.unique(rank[_lookup(vocabulary, words_of(text).hash)]).tolist()
            need = max(1, ceil(threshold * len(own) - 1e-9))
            self.sets.append(own)
            self.need.append(need)
            for i, word in enumerate(own[: len(own) - need + 1]):
                self.begins.setdefault(word, []).append((k, i))
        self.is_prefix = np.zeros(len(vocabulary), dtype=bool)
        self.is_prefix[list(self.begins)] = True

    def matches(self, words: Words) -> list[tuple[int, int, int, int, float]]:
        """(row, template, first word, end word, containment) of every block that meets a template."""
        place = _lookup(self.vocabulary, words.hash)
        rank = np.where(place >= 0, self.rank[place], -1)
        at = np.flatnonzero(rank >= 0)
        at = at[self.is_prefix[rank[at]]]
        row = words.row[at]
        block = (at - words.first[row]) // STEP
        # A word lies in the block that begins at its step and in those before that still reach it.
        both = [(row[keep], block[keep] - back) for back in range(BLOCK_WORDS // STEP) if (keep := block >= back).any()]
        blocks = sorted({x for r, b in both for x in zip(r.tolist(), b.tolist())})
        out = []
        for r, b in blocks:
            begin = int(words.first[r]) + b * STEP
            end = min(begin + BLOCK_WORDS, int(words.first[r + 1]))
            own = np.unique(rank[begin:end])
            own = own[own >= 0].tolist()
            tried: set[int] = set()
            for j, word in enumerate(own):
                for k, i in self.begins.get(word, ()):
                    if k in tried:
                        continue
                    tried.add(k)  # this is the rarest word in common
                    need, template = self.need[k], self.sets[k]
                    if end - begin < need or min(len(template) - i, len(own) - j) < need:
                        continue
                    common = len(set(own[j:]).intersection(template))
                    if common >= need:
                        out.append((r, k, begin - int(words.first[r]), end - int(words.first[r]), common / len(template)))
        return out


def license_scan(docs: DataFrame, text: str = "text", templates: Sequence[tuple[str, str]] = TEMPLATES,
                 phrases: Sequence[tuple[str, str]] = PHRASES, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: ``doc``, n_words, places (label, word) of phrases, blocks (label, template, first, end, containment)."""
    if len(templates) > MOST_TEMPLATES:
        raise ValueError(f"more than {MOST_TEMPLATES} templates")
    if any(len(words_of(t).hash) > STEP for _, t in templates):
        raise ValueError(f"a template has more than {STEP} words")
    vocabulary = _vocabulary(templates)
    shared = docs.sparkSession.sparkContext.broadcast((list(templates), vocabulary, frequencies(docs, text, vocabulary)))
    sought = [(label, words_of(p).hash) for label, p in phrases]
    at = docs.columns.index(text)
    rows = docs.select(whole(docs))
    place = T.StructType([T.StructField("label", T.StringType()), T.StructField("word", T.LongType())])
    block = T.StructType([T.StructField("label", T.StringType()), T.StructField("template", T.LongType()), T.StructField("first", T.LongType()),
                          T.StructField("end", T.LongType()), T.StructField("containment", T.DoubleType())])
    schema = T.StructType([rows.schema["doc"], T.StructField("n_words", T.LongType()), T.StructField("places", T.ArrayType(place)), T.StructField("blocks", T.ArrayType(block))])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        templates_, vocabulary_, frequency = shared.value
        index = Index(templates_, vocabulary_, frequency, threshold)
        for batch in batches:
            for first, n, data, offsets in slices(text_of(batch, at)):
                words = Words(data, offsets)
                places: list[list[dict]] = [[] for _ in range(n)]
                for label, phrase in sought:
                    start = np.flatnonzero(words.hash[: len(words.hash) - len(phrase) + 1] == phrase[0]) if len(words.hash) >= len(phrase) else np.zeros(0, dtype=np.int64)
                    start = start[words.row[start] == words.row[start + len(phrase) - 1]]
                    for k in range(1, len(phrase)):
                        start = start[words.hash[start + k] == phrase[k]]
                    for s in start.tolist():
                        r = int(words.row[s])
                        places[r].append({"label": label, "word": s - int(words.first[r])})
                blocks: list[list[dict]] = [[] for _ in range(n)]
                for r, k, a, b, c in index.matches(words):
                    blocks[r].append({"label": templates_[k][0], "template": k, "first": a, "end": b, "containment": c})
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(first, n), pa.array(np.diff(words.first)),
                    pa.array(places, pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64())]))),
                    pa.array(blocks, pa.list_(pa.struct([("label", pa.string()), ("template", pa.int64()), ("first", pa.int64()), ("end", pa.int64()), ("containment", pa.float64())]))),
                ], names=schema.names)

    return rows.mapInArrow(tidy(scan), schema)
