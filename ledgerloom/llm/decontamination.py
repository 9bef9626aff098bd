"""Benchmark decontamination: Wu-Manber search for runs of benchmark words in documents.

The alphabet is words (64-bit hashes of the lower-cased bytes). Patterns are the windows of ten consecutive words of an
item, or the whole item if it has fewer. For each pattern length there is a shift table over blocks of two words: it
says how far a window can move before any pattern could end there, so most positions are never looked at. A shift of
zero selects the bucket of patterns with that last block; their words are compared one by one, then their bytes.

Many cursors, one per stretch of ``STRETCH`` positions, move through a batch together, which keeps the search in numpy.
Patterns are broadcast in blocks of at most ``BLOCK`` windows, so the broadcast is bounded whatever the size of the
benchmark; documents go through the blocks one after the other.

Defined results: a null or empty text has no words and is clean; items without words match nothing; items with a null
id are searched but not listed; repeated items and windows count once per id; extra columns stay inside ``doc``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.arrays import U64, Words, mixed, runs, slices, text_of, tidy, whole
from ledgerloom.scale import durable

WINDOW = 10
BLOCK = 500_000
STRETCH = 128


def windows(benchmark: DataFrame, id: str, text: str, size: int) -> DataFrame:
    """Distinct windows of all items: n (words), words (their hashes), bytes (words joined by a space), items."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, n, data, offsets in slices(batch.column(1)):
                words = Words(data, offsets)
                ids, n_, hashes, texts = [], [], [], []
                for row in range(n):
                    a, b = int(words.first[row]), int(words.first[row + 1])
                    k = min(size, b - a)
                    for at in range(a, b - k + 1 if k else a):
                        ids.append(batch.column(0)[first + row].as_py())
                        n_.append(k)
                        hashes.append(words.hash[at : at + k].tobytes())
                        texts.append(b" ".join(words.lower[s:e].tobytes() for s, e in zip(words.start[at : at + k], words.end[at : at + k])))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(n_, pa.int32()), pa.array(hashes, pa.binary()), pa.array(texts, pa.binary())],
                    names=["item", "n", "words", "bytes"],
                )

    rows = benchmark.select(F.col(id).cast("long"), F.col(text).cast("string"))
    cut_ = rows.mapInArrow(tidy(cut), "item long, n int, words binary, bytes binary")
    return cut_.groupBy("n", "words", "bytes").agg(F.array_sort(F.collect_set("item")).alias("items"))


class Patterns:
    """Shift table, suffix buckets and words of the patterns of one length."""

    def __init__(self, words: np.ndarray, texts: list[bytes], items: list[list[int]]):
        self.n = words.shape[1]
        self.block = min(2, self.n)
        self.bits = max(12, min(20, (8 * len(words) * self.n).bit_length()))
        self.shift = np.full(1 << self.bits, self.n - self.block + 1, dtype=np.int32)
        for end in range(self.block - 1, self.n):
            cell = self.cell(words[:, end - self.block + 1], words[:, end])
            np.minimum.at(self.shift, cell, self.n - 1 - end)
        last = self.cell(words[:, self.n - self.block], words[:, self.n - 1])
        order = np.argsort(last, kind="stable")
        self.words, self.texts, self.items = words[order], [texts[i] for i in order], [items[i] for i in order]
        self.bucket = np.searchsorted(last[order], np.arange((1 << self.bits) + 1))

    def cell(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        return (mixed(first * U64(0x9E3779B97F4A7C15) ^ last) >> U64(64 - self.bits)).astype(np.int64)

    def find(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """First word and pattern of every occurrence."""
        ends = []
        low, high = words.first[:-1] + self.n - 1, words.first[1:]
        stretches = np.maximum(-(-(high - low) // STRETCH), 0)
        at = np.repeat(low, stretches) + (np.arange(stretches.sum()) - np.repeat(np.cumsum(stretches) - stretches, stretches)) * STRETCH
        stop = np.minimum(at + STRETCH, np.repeat(high, stretches))
        while len(at):
            shift = self.shift[self.cell(words.hash[at - self.block + 1], words.hash[at])]
            ends.append(at[shift == 0])
            at = at + np.maximum(shift, 1)
            on = at < stop
            at, stop = at[on], stop[on]
        end = np.concatenate(ends) if ends else np.zeros(0, dtype=np.int64)
        cell = self.cell(words.hash[end - self.block + 1], words.hash[end])
        count = self.bucket[cell + 1] - self.bucket[cell]
        pattern = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count - self.bucket[cell], count)
        start = np.repeat(end, count) - self.n + 1
        for k in range(self.n):
            same = words.hash[start + k] == self.words[pattern, k]
            start, pattern = start[same], pattern[same]
        spell = lambda a: b" ".join(words.lower[s:e].tobytes() for s, e in zip(words.start[a : a + self.n], words.end[a : a + self.n]))
        true = np.array([spell(a) == self.texts[p] for a, p in zip(start.tolist(), pattern.tolist())], dtype=bool)
        return start[true], pattern[true]


def _scan(docs: DataFrame, tables, at: int) -> DataFrame:
    """Adds the words and items that one block of patterns hits to those found so far."""
    schema = T.StructType([docs.schema["doc"], T.StructField("n_words", T.LongType()), T.StructField("mask", T.BinaryType()),
                           T.StructField("items", T.ArrayType(T.LongType()))])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searched = [Patterns(*x) for x in tables.value]
        for batch in batches:
            for first, rows, data, offsets in slices(text_of(batch, at)):
                words = Words(data, offsets)
                cover = np.zeros(len(words.start) + 1, dtype=np.int64)
                items: list[set[int]] = [set() for _ in range(rows)]
                for patterns in searched:
                    start, pattern = patterns.find(words)
                    np.add.at(cover, start, 1)
                    np.add.at(cover, start + patterns.n, -1)
                    for row, p in set(zip(words.row[start].tolist(), pattern.tolist())):
                        items[row].update(patterns.items[p])
                hit = np.cumsum(cover[:-1]) > 0
                masks = []
                for row in range(rows):
                    own = hit[words.first[row] : words.first[row + 1]]
                    before = batch.column(2)[first + row].as_py() if batch.num_columns > 2 else None
                    if before is not None:
                        own = own | np.unpackbits(np.frombuffer(before, dtype=np.uint8), count=len(own)).astype(bool)
                        items[row].update(batch.column(3)[first + row].as_py())
                    masks.append(np.packbits(own).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, rows), pa.array(np.diff(words.first)), pa.array(masks, pa.binary()),
                     pa.array([sorted(x) for x in items], pa.list_(pa.int64()))],
                    names=["doc", "n_words", "mask", "items"],
                )

    return docs.mapInArrow(tidy(scan), schema)


def _summed(scanned: DataFrame) -> DataFrame:
    schema = T.StructType([*(f for f in scanned.schema.fields if f.name != "mask"), T.StructField("n_hit", T.LongType()),
                           T.StructField("hits", T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("end", T.LongType())])))])

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_hit, hits = [], []
            for mask in batch.column(2).to_pylist():
                if any(mask):
                    bits = np.unpackbits(np.frombuffer(mask, dtype=np.uint8)).astype(bool)
                    a, b = runs(bits, np.array([0, len(bits)]))
                    n_hit.append(int(bits.sum()))
                    hits.append([{"first": x, "end": y} for x, y in zip(a.tolist(), b.tolist())])
                else:
                    n_hit.append(0)
                    hits.append([])
            kind = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(3), pa.array(n_hit, pa.int64()), pa.array(hits, kind)],
                names=["doc", "n_words", "items", "n_hit", "hits"],
            )

    return scanned.mapInArrow(tidy(add_up), schema)


def contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
                  window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """One row per document: ``doc``, n_words, items (ids found, ascending), n_hit (words hit), hits (their runs, end exclusive)."""
    spark = docs.sparkSession
    found = durable(windows(benchmark, item_id, item_text, window))
    blocks = max(1, -(-found.count() // block))
    out = docs.select(whole(docs))
    at = docs.columns.index(text)
    for k in range(blocks):
        rows = found.filter(F.pmod(F.xxhash64("words"), F.lit(blocks)) == k).orderBy("words").collect()
        by_length: dict[int, list] = {}
        for row in rows:
            by_length.setdefault(row["n"], []).append(row)
        tables = [
            (np.frombuffer(b"".join(r["words"] for r in own), dtype=U64).reshape(len(own), n),
             [bytes(r["bytes"]) for r in own], [r["items"] for r in own])
            for n, own in sorted(by_length.items())
        ]
        out = _scan(out, spark.sparkContext.broadcast(tables), at)
        if k + 1 < blocks:
            out = durable(out)
    return _summed(out)
