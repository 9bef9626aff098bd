"""Phrase collocations from counts in depth-truncated suffix trees, built part by part.

A suffix tree over the words of all texts, cut after three words, holds every phrase of one to three words; the number of
suffixes below a node is its count. The tree is partitioned vertically: the counts of prefixes, known from the level above, say
how many suffixes a prefix brings. Prefixes are grouped until a group reaches the memory budget; a prefix beyond the budget
is extended by a word and its extensions are dealt to groups of their own. Every group's subtrees are built on their own, from
sorted suffixes whose equal neighbours are leaves, and the counts are read from the leaf totals. The tree grows by one word in each pass
over the texts, and only below prefixes frequent enough to matter: a phrase is never more frequent than its parts, so
nothing that counts is left out.

Words and phrases travel as 64-bit hashes of their bytes and their language; equal hashes stand for equal phrases. The filters that
passes share are bit tables over such hashes, sized by the number of keys up to ``FILTER_BITS``: a wrong hit only sends a suffix that
its group then finds to be rare. Suffixes are counted in each task before they are sent.

Null texts are empty, a null language is ``und``. Ties are settled by the phrase's bytes. Repeated rows count each time. Empty
tables give no phrases. Only the two named columns are read, so other names cannot clash. Very long texts are handled whole; a batch
of texts is cut into slices of bytes, a single text of any length is one slice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.arrays import LOWER, U64, Sums, mixed, runs, slices, tidy
from ledgerloom.scale import durable

#: Suffixes in one group; a group's task holds about 100 bytes for each.
BUDGET = 1 << 20
#: Cells of first words, the units that are grouped.
CELLS = 1 << 14
#: Suffixes that a task counts before it sends them on.
HELD = 1 << 20
FILTER_BITS = 1 << 28
#: Parts of a language whose best phrases are found on their own first.
PARTS = 64

BREAK = np.zeros(256, dtype=bool)
BREAK[[ord(c) for c in ".,;:!?"] + list(range(0x0A, 0x0E))] = True
INSIDE = ~BREAK
INSIDE[[0x20, 0x09]] = False


def _salted(lang: str) -> int:
    body = np.frombuffer(lang.encode() + b"\x00", dtype=np.uint8)
    return int(mixed(Sums(body).of(np.array([0]), np.array([len(body)])))[0])


def _tokens(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, list]]:
    """Per slice of texts: word ids, whether the next word follows in the same piece, row of each word, their bytes' bounds, and the bytes."""
    langs = ["und" if x is None else x for x in batch.column(1).to_pylist()]
    salts = {x: _salted(x) for x in set(langs)}
    by_row = np.array([salts[x] for x in langs], dtype=U64)
    for first, n, data, offsets in slices(batch.column(0)):
        start, end = runs(INSIDE[data], offsets)
        if not len(start):
            continue
        lower = LOWER[data]
        row = np.searchsorted(offsets, start, side="right") - 1
        ids = mixed(Sums(lower).of(start, end) ^ by_row[first + row])
        breaks = np.cumsum(BREAK[data])[start]
        follows = np.zeros(len(start), dtype=bool)
        follows[:-1] = (row[1:] == row[:-1]) & (breaks[1:] == breaks[:-1])
        yield ids, follows, first + row, np.stack([start, end]), lower, langs


def extended(prefix: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a phrase from the hash of all its words but the last, and the last."""
    return mixed(prefix * U64(3) + U64(0x51ED270B9F1D3A6D) ^ mixed(word))


def _folded(keys: np.ndarray, counts: np.ndarray, *others: np.ndarray) -> tuple[np.ndarray, ...]:
    """Equal keys as one, their counts added."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, dtype=np.int64)
    return keys[heads], np.add.reduceat(counts[order], heads) if len(heads) else counts[:0], *[o[order][heads] for o in others]


def word_counts(texts: DataFrame) -> DataFrame:
    """(id, lang, word, n) of all words of ``texts(text, lang)``: the prefixes of one word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "lang", "word", "n"]

        def out(parts: list) -> pa.RecordBatch:
            ids, counts, at = _folded(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]), np.arange(sum(len(p[0]) for p in parts)))
            take = pa.array(at)
            langs, words = (pa.concat_arrays([p[k] for p in parts]).take(take) for k in (2, 3))
            return pa.RecordBatch.from_arrays([pa.array(ids.view(np.int64)), langs, words, pa.array(counts)], names)

        parts, held = [], 0
        for batch in batches:
            for ids, _, row, bounds, lower, langs in _tokens(batch):
                ids, counts, at = _folded(ids, np.ones(len(ids), dtype=np.int64), np.arange(len(ids)))
                lengths = bounds[1][at] - bounds[0][at]
                offsets = np.concatenate([[0], np.cumsum(lengths)])
                body = lower[np.arange(offsets[-1]) + np.repeat(bounds[0][at] - offsets[:-1], lengths)]
                words = pa.Array.from_buffers(pa.large_string(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(body)]).cast(pa.string())
                parts.append((ids, counts, pa.array(np.array(langs, dtype=object)[row[at]], pa.string()), words))
                held += len(ids)
                if held > HELD:
                    yield out(parts)
                    parts, held = [], 0
        if parts:
            yield out(parts)

    counted = texts.mapInArrow(tidy(run), "id long, lang string, word string, n long")
    return counted.groupBy("id", "lang", "word").agg(F.sum("n").alias("n"))


class _Plan:
    """Where suffixes go: cells of first words share groups or, beyond the budget, are split by a hash of the first two words.

    ``heavy`` pairs are beyond the budget themselves and split by a hash of all three words. The plan holds ``CELLS`` numbers and
    at most one pair for every ``budget`` suffixes.
    """

    def __init__(self, weights: dict[int, int], heavy: list[tuple[int, int]], budget: int):
        self.base, self.ways = np.zeros(CELLS, dtype=np.int64), np.ones(CELLS, dtype=U64)
        group, fill = 0, 0
        for cell, weight in sorted(weights.items()):
            if weight > budget:
                group += 1 if fill else 0
                self.base[cell], self.ways[cell] = group, -(-2 * weight // budget)
                group, fill = group + int(self.ways[cell]), 0
            else:
                if fill + weight > budget:
                    group, fill = group + 1, 0
                self.base[cell] = group
                fill += weight
        heavy = sorted(heavy)
        self.heavy = np.array([k for k, _ in heavy], dtype=U64)
        ways = [-(-2 * n // budget) for _, n in heavy]
        self.heavy_ways = np.array(ways, dtype=U64)
        self.heavy_base = group + 1 + np.concatenate([[0], np.cumsum(ways)]).astype(np.int64)

    def groups(self, first: np.ndarray, pair: np.ndarray, phrase: np.ndarray) -> np.ndarray:
        """Group of each suffix, by the hashes of its first word, its first two words and all its words."""
        cell = (first & U64(CELLS - 1)).astype(np.int64)
        out = self.base[cell] + (mixed(pair) % self.ways[cell]).astype(np.int64)
        if len(self.heavy):
            at = np.minimum(np.searchsorted(self.heavy, pair), len(self.heavy) - 1)
            hit = self.heavy[at] == pair
            out[hit] = self.heavy_base[at[hit]] + (mixed(phrase[hit]) % self.heavy_ways[at[hit]]).astype(np.int64)
        return out


class KeyFilter:
    """Bits of a set of hashes: no misses, wrong hits with a probability of about keys / bits."""

    BLOCK = 1 << 16

    def __init__(self, keys: DataFrame, n: int):
        """``keys(key)``; every block of bits is set in a task of its own."""
        self.bits = min(FILTER_BITS, 1 << max(16, (16 * n - 1).bit_length()))
        size, block = self.bits, self.BLOCK

        def fill(key: tuple, table: pa.Table) -> pa.Table:
            bits = np.zeros(block, dtype=np.uint8)
            bits[table["at"].to_numpy()] = 1
            return pa.table({"block": pa.array([key[0].as_py()], pa.int64()), "bits": pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())})

        place = F.shiftright(F.col("key"), 7).bitwiseAND(size - 1)
        placed = keys.select(F.floor(place / block).cast("long").alias("block"), (place % block).alias("at")).distinct()
        self.table = np.zeros(size // 8, dtype=np.uint8)
        for row in placed.groupBy("block").applyInArrow(fill, "block long, bits binary").toLocalIterator():
            self.table[row["block"] * block // 8 : (row["block"] + 1) * block // 8] = np.frombuffer(row["bits"], dtype=np.uint8)

    def has(self, keys: np.ndarray) -> np.ndarray:
        place = (keys >> U64(7)) & U64(self.bits - 1)
        return (self.table[(place >> U64(3)).astype(np.int64)] >> (place & U64(7)).astype(np.uint8)) & 1 == 1


def _grown(texts: DataFrame, depth: int, kept: KeyFilter, plan: _Plan, least: int) -> DataFrame:
    """(w1, .., w<depth>, a): phrases of ``depth`` words with at least ``least`` occurrences.

    ``kept`` says of words (depth 2) or pairs (depth 3) whether they are frequent; suffixes go down only below such prefixes.
    """
    names = [f"w{k + 1}" for k in range(depth)]
    shared = texts.sparkSession.sparkContext.broadcast((vars(kept), vars(plan)))  # numbers and arrays

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filter_, plan = KeyFilter.__new__(KeyFilter), _Plan.__new__(_Plan)
        vars(filter_).update(shared.value[0])
        vars(plan).update(shared.value[1])

        def out(parts: list) -> pa.RecordBatch:
            key, n, pair, *words = _folded(*[np.concatenate([p[k] for p in parts]) for k in range(3 + depth)])
            group = plan.groups(words[0], pair, key)
            order = np.lexsort((words[0], group))
            group = group[order]
            heads = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
            ends = [*heads[1:], len(group)]
            columns = [*[w[order] for w in words], n[order].astype(np.uint32)]
            blobs = [b"".join(c[a:b].tobytes() for c in columns) for a, b in zip(heads, ends)]
            return pa.RecordBatch.from_arrays([pa.array(group[heads]), pa.array(blobs, pa.binary())], ["part", "suffixes"])

        parts, held = [], 0
        for batch in batches:
            for ids, follows, *_ in _tokens(batch):
                pair = extended(ids[:-1], ids[1:])
                if depth == 2:
                    good = filter_.has(ids)
                    at = np.flatnonzero(follows[:-1] & good[:-1] & good[1:])
                    key, first = pair[at], pair[at]
                else:
                    good = follows[:-1] & filter_.has(pair)
                    at = np.flatnonzero(good[:-1] & good[1:])
                    key, first = extended(pair[at], ids[at + 2]), pair[at]
                if len(at):
                    parts.append(_folded(key, np.ones(len(at), dtype=np.int64), first, *[ids[at + k] for k in range(depth)]))
                    held += len(parts[-1][0])
                if held > HELD:
                    yield out(parts)
                    parts, held = [], 0
        if parts:
            yield out(parts)

    def subtree(table: pa.Table) -> pa.Table:
        columns: list[list[np.ndarray]] = [[] for _ in range(depth + 1)]
        for blob in table["suffixes"]:
            body = blob.as_buffer()
            n = body.size // (8 * depth + 4)
            for k in range(depth):
                columns[k].append(np.frombuffer(body, dtype=U64, count=n, offset=8 * n * k))
            columns[depth].append(np.frombuffer(body, dtype=np.uint32, count=n, offset=8 * n * depth))
        *words, counts = [np.concatenate(c) for c in columns]
        order = np.lexsort(words[::-1])
        words = [w[order] for w in words]
        new = np.ones(len(order), dtype=bool)
        new[1:] = np.logical_or.reduce([w[1:] != w[:-1] for w in words])
        leaves = np.flatnonzero(new)
        totals = np.add.reduceat(counts[order].astype(np.int64), leaves)
        leaves, totals = leaves[totals >= least], totals[totals >= least]
        return pa.table([*[pa.array(w[leaves].view(np.int64)) for w in words], pa.array(totals)], [*names, "a"])

    sent = texts.mapInArrow(tidy(send), "part long, suffixes binary")
    return sent.groupBy("part").applyInArrow(subtree, ", ".join(f"{c} long" for c in (*names, "a")))


def _cells(rows: DataFrame, word: str, weight: str) -> dict[int, int]:
    cell = F.col(word).bitwiseAND(CELLS - 1)
    return {r["cell"]: r["w"] for r in rows.groupBy(cell.alias("cell")).agg(F.sum(weight).alias("w")).collect()}


def phrase_counts(texts: DataFrame, least: int = 10, budget: int = BUDGET) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Stored tables of words(id, lang, word, n), pairs(w1, w2, a) and triples(w1, w2, w3, a) of ``texts(text, lang)``.

    All words are there; pairs and triples with at least ``least`` occurrences.
    """
    words = durable(word_counts(texts))
    frequent = words.filter(F.col("n") >= least)
    pairs = durable(_grown(texts, 2, KeyFilter(frequent.select(F.col("id").alias("key")), frequent.count()), _Plan(_cells(frequent, "id", "n"), [], budget), least))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w1, w2 = (batch.column(k).to_numpy(zero_copy_only=False).view(U64) for k in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(extended(w1, w2).view(np.int64))], ["key"])

    keys = pairs.select("w1", "w2").mapInArrow(keyed, "key long")
    as_unsigned = lambda x: np.array([x], dtype=np.int64).view(U64)
    heavy = [(int(extended(as_unsigned(r["w1"]), as_unsigned(r["w2"]))[0]), r["a"]) for r in pairs.filter(F.col("a") > budget).toLocalIterator()]
    triples = durable(_grown(texts, 3, KeyFilter(keys, pairs.count()), _Plan(_cells(pairs, "w1", "a"), heavy, budget), least))
    return words, pairs, triples


def _score(a: str, left: str, right: str) -> Column:
    """floor(1000000 * a * a / (left * right)) in exact decimals of 38 digits; at most 1000000, as no phrase is more frequent than its parts."""
    return F.expr(f"cast(1000000 as decimal(7, 0)) * (cast({a} as decimal(15, 0)) * cast({a} as decimal(15, 0))) div (cast({left} as decimal(15, 0)) * cast({right} as decimal(15, 0)))")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", *, least: int = 10, share: int = 50, top: int = 2000, budget: int = BUDGET) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of two or three words of each language.

    ``a`` occurrences of the phrase, ``l`` and ``r`` of the parts at its weakest cut, ``n`` words of the language. A phrase inside a longer
    candidate with at least ``share`` percent of its occurrences is left out.
    """
    texts = docs.select(F.col(f"`{text}`").cast("string").alias("text"), F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"))
    words, pairs, triples = phrase_counts(texts, least, budget)
    word = words.filter(F.col("n") >= least)
    count = lambda name, n: word.select(F.col("id").alias(name), F.col("n").alias(n))
    of_pair = lambda x, y, n: pairs.select(F.col("w1").alias(x), F.col("w2").alias(y), F.col("a").alias(n))
    within = triples.select("w1", "w2", "a").unionAll(triples.select("w2", "w3", "a")).groupBy("w1", "w2").agg(F.max("a").alias("longer"))
    two = (
        pairs.join(within, ["w1", "w2"], "left").filter(F.col("longer").isNull() | (100 * F.col("longer") < share * F.col("a")))
        .join(count("w1", "l"), "w1").join(count("w2", "r"), "w2")
        .select(F.array("w1", "w2").alias("ids"), "a", "l", "r", _score("a", "l", "r").alias("score"))
    )
    cuts = (
        triples.join(of_pair("w2", "w3", "r1"), ["w2", "w3"]).join(of_pair("w1", "w2", "l2"), ["w1", "w2"])
        .join(count("w1", "l1"), "w1").join(count("w3", "r2"), "w3")
        .withColumns({"s1": _score("a", "l1", "r1"), "s2": _score("a", "l2", "r2")})
    )
    second = F.col("s2") < F.col("s1")
    three = cuts.select(
        F.array("w1", "w2", "w3").alias("ids"), "a", F.when(second, F.col("l2")).otherwise(F.col("l1")).alias("l"),
        F.when(second, F.col("r2")).otherwise(F.col("r1")).alias("r"), F.least("s1", "s2").alias("score"))
    tongue = word.select(F.col("id").alias("first"), "lang")
    found = two.unionAll(three).withColumn("first", F.col("ids")[0]).join(tongue, "first").drop("first")
    # A language may hold nearly all phrases: parts of it pass on their best only. Phrases that tie with the last one stay until
    # their words are known.
    best = found.withColumn("part", F.pmod(F.xxhash64("ids"), F.lit(PARTS)))
    for group in (["lang", "part"], ["lang"]):
        by_score = Window.partitionBy(*group).orderBy(F.desc("score"), F.desc("a"))
        best = best.withColumn("place", F.rank().over(by_score)).filter(F.col("place") <= top)
    best = durable(best.drop("place", "part"))
    parts = best.select("*", F.posexplode("ids").alias("at", "id")).join(words.select("id", "word"), "id")
    phrase = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ")
    named = parts.groupBy("lang", "ids", "a", "l", "r", "score").agg(phrase.alias("phrase"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    ranked = named.withColumn("rank", F.row_number().over(order).cast("bigint")).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
