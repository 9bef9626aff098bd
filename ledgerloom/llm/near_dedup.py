"""Near-duplicate classes: improved consistent weighted sampling over TF-IDF shingles, banded, then verified.

Weights. A shingle (five words) weighs ``(1 + ln tf) * (1 + idf / idf_max) / 2``. Document frequencies cover all
documents and live in a table of ``2 ** CELLS`` hashed cells, whose size does not depend on the input, so broadcasting
it is safe. The damping keeps passages that half the corpus shares from deciding, and keeps copies of which there are
thousands together.

Candidates. Each text gets ``SAMPLES`` consistent samples; texts that agree on all ``ROWS`` samples of one of ``BANDS`` bands share a
bucket. A pair of similarity 0.8 is missed with probability (1 - 0.8**3)**12 = 0.0002.

Links. Copies with the same words are one node from the start. In every bucket the most popular member (the one that meets
most others over all buckets) is compared with the others, and links merge components: a group of thousands of near copies mostly ends
here, after one comparison each. The share of equal samples estimates a pair's similarity first, and only pairs that may reach the threshold
(``MARGIN`` standard deviations) are verified on their texts. Buckets that still hold several components are compared in blocks of
``CHUNK`` members: the same estimate finds the members that may be near another component; these alone meet again with their texts, are
verified inside the block's task, and give the links of a spanning forest. So every candidate pair is verified, estimated to be too far
apart, or already connected: there is no cap, and pairs of a block never become rows.

Moves. Texts and samples of texts that share a bucket are picked where they lie, by a bit table of their ids; a wrong hit is a row that
no join asks for. Whole documents move once, to meet their labels; labels grow with the table and are never broadcast.

Defined results: null and empty texts have no words and form one class; a text of fewer than five words is one
shingle; rows with a null or repeated id stay separate rows; extra columns stay inside the struct ``doc``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.arrays import U64, Words, mixed, shingles, slices, tidy, whole
from ledgerloom.llm.collocations import KeyFilter
from ledgerloom.scale import components, durable

THRESHOLD = 0.8
SIZE = 5
BANDS, ROWS = 12, 3
SAMPLES = 144
MARGIN = 4
CHUNK = 512
CHUNK_BYTES = 4 << 20
CELLS = 18
_HASH_BITS = U64(48)
_HASH_MASK = U64((1 << 48) - 1)


def _elements(data: np.ndarray, offsets: np.ndarray, size: int):
    """Distinct shingles by row: key (row and 48 bits of hash, ascending), times found; and the words."""
    words = Words(data, offsets)
    found, begin = shingles(words.hash, words.first, size)
    row = np.repeat(np.arange(len(offsets) - 1, dtype=U64), np.diff(begin))
    keys = np.sort((row << _HASH_BITS) | (found >> U64(16)))
    new = np.ones(len(keys), dtype=bool)
    new[1:] = keys[1:] != keys[:-1]
    at = np.flatnonzero(new)
    return keys[at], np.diff(np.append(at, len(keys))), words


def _cell(keys: np.ndarray, cells: int) -> np.ndarray:
    return (mixed(keys & _HASH_MASK) & U64((1 << cells) - 1)).astype(np.int64)


def _weights(keys: np.ndarray, times: np.ndarray, idf: np.ndarray) -> np.ndarray:
    cells = len(idf).bit_length() - 1
    return ((1 + np.log(times)) * idf[_cell(keys, cells)]).astype(np.float32)


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Quantiles of the Gamma(2, 1) law, as r and as ln c, for 16 random bits each."""
    x = np.concatenate([[0], np.geomspace(1e-4, 40, 200_000)])
    at = (np.arange(1 << 16) + 0.5) / (1 << 16)
    r = np.interp(at, 1 - np.exp(-x) * (1 + x), x)
    return r.astype(np.float32), np.log(r).astype(np.float32)


def _samples(elements: np.ndarray, weights: np.ndarray, begin: np.ndarray, count: int) -> np.ndarray:
    """One consistent sample per function and row, as 32 bits that are equal where element and level are equal."""
    r_of, lnc_of = _tables()
    out = np.full((count, len(begin) - 1), np.inf, dtype=np.float32)
    seeds = mixed(np.arange(1, count + 1, dtype=U64) * U64(0xD1342543DE82EF95)) | U64(1)
    lnw = np.log(weights)
    step = 1 << 15
    first = 0
    while first < len(begin) - 1:  # whole rows, about ``step`` elements at a time, so that all arrays stay in cache
        last = max(int(np.searchsorted(begin, begin[first] + step, side="right")) - 1, first + 1)
        a, b = begin[first], begin[last]
        own = np.diff(begin[first : last + 1]) > 0
        at = (begin[first:last][own] - a).astype(np.int64)
        if b > a:
            h, w = elements[a:b], lnw[a:b]
            for k in range(count):
                x = h * seeds[k]
                x ^= x >> U64(29)
                x *= U64(0xBF58476D1CE4E5B9)
                bits = x.view(np.uint16).reshape(-1, 4)
                r = r_of.take(bits[:, 3])
                beta = bits[:, 1] * np.float32(2**-16)
                level = np.floor(w / r + beta)
                level -= beta
                level += np.float32(1)
                level *= r
                out[k, first:last][own] = np.minimum.reduceat(lnc_of.take(bits[:, 2]) - level, at)
        first = last
    return out.view(np.uint32)


def document_frequencies(texts: DataFrame, size: int, cells: int) -> tuple[np.ndarray, int]:
    """Documents per hashed cell, over all documents, and their number: the result has a fixed size."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros(1 << cells, dtype=np.int64), 0
        for batch in batches:
            for _, rows, data, offsets in slices(batch.column(0)):
                keys, _, _ = _elements(data, offsets, size)
                total += np.bincount(_cell(keys, cells), minlength=1 << cells)
                seen += rows
        full = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(full, -1)), pa.array(np.append(total[full], seen))], names=["cell", "n"]
        )

    counts = texts.mapInArrow(tidy(count), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    found = counts.toArrow()
    cell, n = found["cell"].to_numpy(), found["n"].to_numpy()
    table = np.zeros(1 << cells, dtype=np.int64)
    table[cell[cell >= 0]] = n[cell >= 0]
    return table, int(n[cell < 0].sum())


def idf_table(table: np.ndarray, texts: int) -> np.ndarray:
    idf = np.log1p(texts / np.maximum(table, 1))
    return ((1 + idf / max(idf.max(), 1e-9)) / 2).astype(np.float32)


def _signed(docs: DataFrame, idf, size: int, bands: int, rows: int, samples: int) -> DataFrame:
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, n, data, offsets in slices(batch.column(1)):
                keys, times, words = _elements(data, offsets, size)
                begin = np.searchsorted(keys >> _HASH_BITS, np.arange(n + 1, dtype=U64))
                drawn = _samples(mixed(keys & _HASH_MASK), _weights(keys, times, idf.value), begin, samples)
                own = np.ascontiguousarray(drawn.T)
                buckets = np.empty((n, bands), dtype=U64)
                for band in range(bands):
                    x = np.full(n, band + 1, dtype=U64)
                    for k in range(rows):
                        x = mixed(x ^ drawn[band * rows + k])
                    buckets[:, band] = x
                w = words.hash.tobytes()
                digests = [hashlib.blake2b(w[8 * a : 8 * b], digest_size=16).digest()
                           for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist())]
                flat = pa.array(buckets.view(np.int64).ravel())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, n), batch.column(1).slice(first, n), pa.array(digests, pa.binary()),
                     pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * bands), flat),
                     pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(np.arange(n + 1, dtype=np.int32) * (4 * samples)), pa.py_buffer(own)])],
                    names=["uid", "text", "digest", "buckets", "samples"],
                )

    return docs.mapInArrow(tidy(sign), "uid long, text string, digest binary, buckets array<long>, samples binary")


def _similar(pairs: DataFrame, idf, size: int) -> DataFrame:
    """(a, b, similarity) of pairs (a, b, text_a, text_b)."""

    def side(batch: pa.RecordBatch, column: str, table: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        parts = []
        for first, _, data, offsets in slices(batch.column(column)):
            keys, times, _ = _elements(data, offsets, size)
            parts.append((keys + (U64(first) << _HASH_BITS), _weights(keys, times, table)))
        return [np.concatenate(x) for x in zip(*parts)]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                (ka, wa), (kb, wb) = side(batch, "text_a", idf.value), side(batch, "text_b", idf.value)
                _, ia, ib = np.intersect1d(ka, kb, assume_unique=True, return_indices=True)
                n = batch.num_rows
                add = lambda k, w: np.bincount((k >> _HASH_BITS).astype(np.int64), weights=w, minlength=n)
                both = add(ka[ia], np.minimum(wa[ia], wb[ib]))
                either = add(ka, wa) + add(kb, wb) - both
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(both / np.maximum(either, 1e-12))], names=["a", "b", "similarity"]
                )

    return pairs.select("a", "b", "text_a", "text_b").mapInArrow(tidy(compare), "a long, b long, similarity double")


def _least(threshold: float, samples: int) -> float:
    return threshold - MARGIN * (threshold * (1 - threshold) / samples) ** 0.5


def _estimated(pairs: DataFrame, drawn: DataFrame, threshold: float, samples: int) -> DataFrame:
    """Those pairs (a, b) whose samples don't rule the threshold out; drawn: node, samples."""
    least = _least(threshold, samples)
    of = lambda name: drawn.select(F.col("node").alias(name), F.col("samples").alias(f"samples_{name}"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(k).to_pylist()), dtype=np.uint32).reshape(-1, samples) for k in (2, 3))
            yield batch.select(["a", "b"]).filter(pa.array((x == y).mean(axis=1) >= least))

    return pairs.join(of("a"), "a").join(of("b"), "b").select("a", "b", "samples_a", "samples_b").mapInArrow(tidy(compare), "a long, b long")


def _among(nodes: DataFrame, uid: str = "uid") -> Column:
    """Whether a row's id is one of ``nodes(node)``: true for all of them and, with a probability of about 1/16 or less, for others."""
    bits = nodes.sparkSession.sparkContext.broadcast(vars(KeyFilter(nodes.select(F.xxhash64("node").alias("key")), nodes.count())))

    @F.pandas_udf("boolean")
    def has(keys: pd.Series) -> pd.Series:
        filter_ = KeyFilter.__new__(KeyFilter)
        vars(filter_).update(bits.value)
        return pd.Series(filter_.has(keys.to_numpy().view(U64)))

    return has(F.xxhash64(uid))


def _blocks(members: DataFrame, *fields: str) -> DataFrame:
    """(bucket, band, held, others, alone): each pair of a bucket's chunks; members have band, bucket, chunk, chunks and the fields.

    Most buckets are one chunk, which meets itself where it is; other pairs are dealt by bucket and second chunk.
    """
    held = durable(members.groupBy("band", "bucket", "chunk", "chunks").agg(F.collect_list(F.struct(*fields)).alias("held")))
    alone = held.select("bucket", "band", "held", F.col("held").alias("others"), F.lit(True).alias("alone"))
    ahead = held.filter("chunk < chunks - 1").withColumn("other", F.explode(F.sequence(F.col("chunk") + 1, F.col("chunks") - 1)))
    others = held.filter("chunks > 1").select("bucket", F.col("chunk").alias("other"), F.col("held").alias("others"))
    return alone.unionAll(ahead.join(others, ["bucket", "other"]).select("bucket", "band", "held", "others", F.lit(False).alias("alone")))


def _near(x: pa.Array, y: pa.Array, alone: bool, band: int, rows: int, samples: int, least: float):
    """Places in two lists of members (node, root, samples) whose roots differ and whose samples don't rule the threshold out, and
    their shares of equal samples. A pair belongs to the first band in which it shares a bucket."""
    nodes, roots, drawn = zip(*[(m.field("node").to_numpy(), m.field("root").to_numpy(), np.frombuffer(b"".join(m.field("samples").to_pylist()), dtype=np.uint32).reshape(-1, samples))
                                for m in (x, y)])
    for first in range(0, len(nodes[0]), 64):
        part = slice(first, first + 64)
        equal = drawn[0][part, None, :] == drawn[1][None, :, :]
        share = equal.mean(axis=2)
        on = (share >= least) & (roots[0][part, None] != roots[1][None, :])
        if alone:
            on &= nodes[0][part, None] < nodes[1][None, :]
        i, j = np.nonzero(on)
        new = ~equal[i, j, : band * rows].reshape(len(i), band, rows).all(axis=2).any(axis=1) if band else np.ones(len(i), dtype=bool)
        yield first + i[new], j[new], share[i[new], j[new]]


def _open_members(members: DataFrame, threshold: float, rows: int, samples: int) -> DataFrame:
    """(bucket, node) of members (band, bucket, size, node, root, samples) that may be near a member of another root."""
    chunks = F.greatest(F.ceil(F.col("size") / CHUNK), F.lit(1))
    dealt = members.withColumn("chunks", chunks).withColumn("chunk", F.pmod(F.xxhash64("node"), "chunks"))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                bucket, band, alone = (batch.column(c)[at].as_py() for c in (0, 1, 4))
                x, y = batch.column(2)[at].values, batch.column(3)[at].values
                hit = [np.zeros(0, dtype=np.int64)]
                for i, j, _ in _near(x, y, alone, band, rows, samples, _least(threshold, samples)):
                    hit += [x.field("node").to_numpy()[i], y.field("node").to_numpy()[j]]
                hit = np.unique(np.concatenate(hit))
                if len(hit):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(hit), bucket)), pa.array(hit)], names=["bucket", "node"])

    return _blocks(dealt, "node", "root", "samples").mapInArrow(tidy(mark), "bucket long, node long").distinct()


def _forest(members: DataFrame, idf, threshold: float, size: int, rows: int, samples: int) -> DataFrame:
    """Links (a, b) of roots, at most one less than members in each block: all pairs of members (band, bucket, node, root, samples, text)
    are verified on their texts, ruled out by their samples, or connected in the block before."""
    held = members.groupBy("bucket").agg(F.greatest(F.ceil(F.count(F.lit(1)) / CHUNK), F.ceil(F.sum(F.octet_length("text")) / CHUNK_BYTES), F.lit(1)).alias("chunks"))
    dealt = members.join(held, "bucket").withColumn("chunk", F.pmod(F.xxhash64("node"), "chunks"))

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                band, alone = (batch.column(c)[at].as_py() for c in (1, 4))
                x, y = batch.column(2)[at].values, batch.column(3)[at].values
                found = [np.concatenate(k) for k in zip(*_near(x, y, alone, band, rows, samples, _least(threshold, samples)))]
                left, right, share = found if found else [np.zeros(0)] * 3
                if not len(left):
                    continue
                sides = [(_shingles_of(m.field("text"), size, idf.value), m.field("root").to_pylist()) for m in (x, y)]
                parent: dict[int, int] = {}

                def top(r: int) -> int:
                    while parent.get(r, r) != r:
                        parent[r] = r = parent.get(parent[r], parent[r])
                    return r

                links = []
                for k in np.argsort(-share, kind="stable").tolist():  # likely links first, so that most others are connected by then
                    (mine, mine_root), (their, their_root) = ((side[0][i], side[1][i]) for side, i in zip(sides, (int(left[k]), int(right[k]))))
                    a, b = top(mine_root), top(their_root)
                    if a != b and _similarity(mine, their) >= threshold:
                        parent[max(a, b)] = min(a, b)
                        links.append((mine_root, their_root))
                if links:
                    yield pa.RecordBatch.from_arrays([pa.array([l for l, _ in links]), pa.array([r for _, r in links])], names=["a", "b"])

    return _blocks(dealt, "node", "root", "samples", "text").mapInArrow(tidy(link), "a long, b long").distinct()


def _shingles_of(texts: pa.Array, size: int, idf: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Shingles, ascending, and their weights, of each text."""
    out = []
    for _, n, data, offsets in slices(texts):
        keys, times, _ = _elements(data, offsets, size)
        weights, begin = _weights(keys, times, idf), np.searchsorted(keys >> _HASH_BITS, np.arange(n + 1, dtype=U64))
        out += [(keys[i:j] & _HASH_MASK, weights[i:j]) for i, j in zip(begin[:-1], begin[1:])]
    return out


def _similarity(x: tuple[np.ndarray, np.ndarray], y: tuple[np.ndarray, np.ndarray]) -> float:
    _, i, j = np.intersect1d(x[0], y[0], assume_unique=True, return_indices=True)
    both = float(np.minimum(x[1][i], y[1][j]).sum(dtype=np.float64))
    return both / max(float(x[1].sum(dtype=np.float64) + y[1].sum(dtype=np.float64)) - both, 1e-12)


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD,
                    size: int = SIZE, bands: int = BANDS, rows: int = ROWS, samples: int = SAMPLES, cells: int = CELLS) -> DataFrame:
    """One row per document: ``doc`` (its columns), uid, representative (a uid), class_id (smallest id), class_size.

    The representative of a class is its row with the smallest id (nulls last).
    """
    spark = docs.sparkSession
    table, texts = document_frequencies(docs.select(F.col(text).cast("string").alias("text")), size, cells)
    idf = spark.sparkContext.broadcast(idf_table(table, texts))

    keyed = docs.select(F.monotonically_increasing_id().alias("uid"), whole(docs))
    keyed = durable(keyed)
    plain = keyed.select("uid", F.coalesce(F.col("doc").getField(text).cast("string"), F.lit("")).alias("text"))
    signed = durable(_signed(plain, idf, size, bands, rows, samples).select("uid", "digest", "buckets", "samples"))
    same = durable(signed.groupBy("digest").agg(F.min("uid").alias("node"), F.min("buckets").alias("buckets")))
    # Word-less texts share one digest and so are one node that meets nobody else.
    drawn = same.select("node", F.posexplode("buckets").alias("band", "bucket"))
    shared = drawn.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    live = durable(drawn.join(shared, "bucket"))
    nodes = durable(live.groupBy("node").agg(F.sum("size").alias("popularity")))
    meets = _among(nodes)
    bodies = durable(plain.filter(meets))

    def links(pairs: DataFrame) -> DataFrame:
        texts_of = lambda name: bodies.select(F.col("uid").alias(name), F.col("text").alias(f"text_{name}"))
        compared = _similar(pairs.join(texts_of("a"), "a").join(texts_of("b"), "b"), idf, size)
        return durable(compared.filter(F.col("similarity") >= threshold).select("a", "b"))

    hubs = live.join(nodes, "node").groupBy("bucket").agg(F.max_by("node", F.struct("popularity", "node")).alias("hub"))
    to_hubs = live.join(hubs, "bucket").filter("node <> hub").select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()
    drawn_of = durable(signed.filter(meets).select(F.col("uid").alias("node"), "samples"))
    first = links(durable(_estimated(to_hubs, drawn_of, threshold, samples)))
    of_first = components(first)
    roots = durable(nodes.join(of_first, "node", "left").select("node", F.coalesce("root", "node").alias("root")))
    placed = live.join(roots, "node")
    open_ = placed.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo < hi").select("bucket")
    members = placed.join(open_, "bucket", "left_semi").join(drawn_of, "node")
    left = durable(_open_members(members, threshold, rows, samples))
    again = members.join(left, ["bucket", "node"], "left_semi").join(bodies.select(F.col("uid").alias("node"), "text"), "node")
    merged = components(durable(_forest(again, idf, threshold, size, rows, samples)))
    roots = (
        roots.join(merged.select(F.col("node").alias("root"), F.col("root").alias("new")), "root", "left")
        .select("node", F.coalesce("new", "root").alias("root"))
    )

    grouped = (
        signed.select("uid", "digest").join(same.select("digest", "node"), "digest")
        .join(roots, "node", "left").select("uid", F.coalesce("root", "node").alias("root"))
    )
    # Labels are settled on narrow rows; the documents themselves move once.
    ids = durable(grouped.join(keyed.select("uid", F.col("doc").getField(id).alias("id")), "uid"))
    best = ids.groupBy("root").agg(
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "uid")).alias("first"), F.count(F.lit(1)).alias("class_size")
    ).select("root", F.col("first.uid").alias("representative"), F.col("first.id").alias("class_id"), "class_size")
    labels = ids.select("uid", "root").join(best, "root").drop("root")
    return keyed.join(labels.hint("shuffle_hash"), "uid").select("doc", "uid", "representative", "class_id", "class_size")
