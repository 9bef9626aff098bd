"""LM scoring: cross-entropy difference of a target and a background bigram model over one vocabulary.

Vocabulary. All words of all documents and a mark ``BOUNDARY`` at both ends of a text: nothing is left out or shared, so the models grow
with the corpus. Words and bigrams are told apart by 47 bits of their hashes.

Models. ``P(w | c) = (n(c, w) + prior * P(w)) / (n(c) + prior)`` with ``P(w) = (n(w) + 1) / (N + V)``, counted over the target documents and
over all documents. V and the prior are the same for both, and the background's counts are scaled to the target's total, so neither
gains from its size. A document's own counts are taken out of both models before it is scored: no text vouches for itself.

Work. Texts are read once and do not move. A task makes *blocks* of about ``BLOCK_BYTES`` of text: words by number, and the block's
words. The n-grams of a block go to key ranges (*buckets*), each of them once per block, sorted and packed; there they meet the same
n-grams of other blocks, and the totals go back to the blocks, which score their documents. A frequent n-gram is thus one entry per
block and never one row per document. The number of buckets follows the bytes of the corpus, so a bucket's size does not grow.

A document's score is its mean target loss less its mean background loss: below 0 it is more like the target.

Defined results: null and empty texts have no tokens and losses and score 0.0; without target documents both models are the background and
every score is 0.0; a repeated id in ``target`` counts once, all rows of an id are target then; rows with a null id are background;
copies of a text count as other documents; equal word counts need no order; very long texts are blocks of their own; all columns but the
text stay in ``doc``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.arrays import U64, Words, mixed, slices, tidy
from ledgerloom.scale import durable, join_unique

BLOCK_BYTES = 16 << 20
BLOCK_ROWS = 1 << 15
BUCKET_BYTES = 8 << 20
PRIOR = 10.0
BOUNDARY = U64(0x9E3779B97F4A7C15)
KEY_BITS = 48


def packed(*columns: tuple[np.ndarray, int]) -> bytes:
    """Columns of numbers and their widths in bytes, laid out byte place by byte place and compressed."""
    places = [np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).ravel() for x, width in columns]
    return pa.compress(np.concatenate(places).tobytes(), codec="zstd", asbytes=True)


def unpacked(blob: bytes, n: int, *widths: int) -> list[np.ndarray]:
    raw = np.frombuffer(pa.decompress(blob, n * sum(widths), codec="zstd", asbytes=True), dtype=np.uint8)
    out, first = [], 0
    for width in widths:
        full = np.zeros((n, 8), dtype=np.uint8)
        full[:, :width] = raw[first : first + n * width].reshape(width, n).T
        out.append(full.view("<u8").ravel())
        first += n * width
    return out


class Block:
    """The predictions of a block's texts: word and the word before it by number, row, and the block's distinct n-grams by key."""

    def __init__(self, vocabulary: np.ndarray, lengths: np.ndarray, sequence: np.ndarray):
        self.tokens = lengths.astype(np.int64)
        full = np.flatnonzero(self.tokens)
        n = self.tokens[full]
        self.row = np.repeat(full, n + 1)
        self.context, self.word = np.zeros(len(self.row), dtype=np.int64), np.zeros(len(self.row), dtype=np.int64)  # 0: the boundary
        at = np.arange(len(sequence)) + np.repeat(np.arange(len(full)), n)
        self.word[at] = sequence
        self.context[at + 1] = sequence
        pairs, self.pair = np.unique((self.context << 32) | self.word, return_inverse=True)
        before, after = vocabulary[pairs >> 32], vocabulary[pairs & 0xFFFFFFFF]
        size = len(vocabulary)
        hashes = np.concatenate([mixed(vocabulary ^ U64(0xD1342543DE82EF95)), mixed(mixed(before + U64(1)) ^ after)])
        single = (np.arange(len(hashes)) < size).astype(U64)  # words have odd keys, bigrams even ones
        keys = ((hashes >> U64(64 - KEY_BITS + 1)) << U64(1)) | single
        self.words, self.order = size, np.argsort(keys, kind="stable")
        self.keys = keys[self.order]

    def counts(self, weights: np.ndarray | None = None) -> np.ndarray:
        """Times of each n-gram in key order, over the rows with weight 1."""
        weights = None if weights is None else weights[self.row]
        words = np.bincount(self.word, weights=weights, minlength=self.words)
        pairs = np.bincount(self.pair, weights=weights, minlength=len(self.keys) - self.words)
        return np.concatenate([words, pairs])[self.order].astype(np.int64)

    def own(self, number: np.ndarray) -> np.ndarray:
        """How often each prediction's number (a word or pair) is predicted in its own row."""
        _, at, times = np.unique((self.row << 32) | number, return_inverse=True, return_counts=True)
        return times[at]

    def own_contexts(self) -> np.ndarray:
        """How often each prediction's context occurs in its own row; contexts are predicted as often as they occur."""
        _, at, times = np.unique((self.row << 32) | self.context, return_inverse=True, return_counts=True)
        return times[at]


def _blocks(docs: DataFrame, text: str) -> DataFrame:
    """Rows (block, doc: array of the rows' other columns, words, tokens, vocabulary, body) of about ``BLOCK_BYTES`` of text."""
    others = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text]).alias("doc")
    rows = docs.select(F.monotonically_increasing_id().alias("block"), others, F.col(f"`{text}`").cast("string").alias("text"))
    schema = T.StructType([T.StructField("block", T.LongType()), T.StructField("doc", T.ArrayType(rows.schema["doc"].dataType)),
                           T.StructField("words", T.LongType()), T.StructField("tokens", T.LongType()),
                           T.StructField("vocabulary", T.BinaryType()), T.StructField("lengths", T.BinaryType()), T.StructField("sequence", T.BinaryType())])

    def closed(block: int, held: list) -> pa.RecordBatch:
        kept = pa.concat_arrays([x for x, _, _ in held])
        hashes, lengths = np.concatenate([x for _, x, _ in held]), np.concatenate([x for _, _, x in held])
        found, number, times = np.unique(hashes, return_inverse=True, return_counts=True)
        falling = np.argsort(-times, kind="stable")  # frequent words get small numbers, which pack well
        rank = np.empty(len(found), dtype=np.int64)
        rank[falling] = np.arange(1, len(found) + 1)
        vocabulary = np.concatenate([[BOUNDARY], found[falling]]).astype(U64)
        return pa.RecordBatch.from_arrays(
            [pa.array([block]), pa.ListArray.from_arrays(pa.array([0, len(kept)], pa.int32()), kept), pa.array([len(vocabulary)]), pa.array([len(hashes)]),
             pa.array([vocabulary.tobytes()], pa.binary()), pa.array([packed((lengths, 8))], pa.binary()), pa.array([packed((rank[number], 4))], pa.binary())],
            names=schema.names,
        )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, rows, block = [], 0, 0, None
        for batch in batches:
            for first, n, data, offsets in slices(batch.column(2)):
                if held and (size + len(data) > BLOCK_BYTES or rows + n > BLOCK_ROWS):
                    yield closed(block, held)
                    held, size, rows = [], 0, 0
                if not held:
                    block = batch.column(0)[first].as_py()
                words = Words(data, offsets)
                held.append((batch.column(1).slice(first, n), words.hash, np.diff(words.first)))
                size, rows = size + len(data), rows + n
        if held:
            yield closed(block, held)

    return rows.mapInArrow(tidy(task), schema)


def _opened(row: dict) -> Block:
    sequence, = unpacked(row["sequence"], row["tokens"], 4)
    lengths, = unpacked(row["lengths"], row["rows"], 8)
    return Block(np.frombuffer(row["vocabulary"], dtype=U64), lengths, sequence.astype(np.int64))


def _marked(row: dict) -> np.ndarray:
    mark = np.zeros(row["rows"])
    mark[row["chosen"] or []] = 1
    return mark


def _totals(blocks: DataFrame, buckets: int) -> DataFrame:
    """Counts over all blocks, given back to each: rows (block, bucket, n, totals) and, once a bucket, its words and their totals."""
    shift = U64(KEY_BITS - (buckets - 1).bit_length())

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = _opened(row)
                t, b = block.counts(_marked(row)), block.counts()
                bucket = (block.keys >> shift).astype(np.int64)
                cut = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(bucket))
                blobs = [packed((np.diff(block.keys[i:j], prepend=U64(0)), 6), (t[i:j], 4), (b[i:j], 4)) for i, j in zip(cut[:-1].tolist(), cut[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket[cut[:-1]]), pa.array(np.full(len(blobs), row["block"])), pa.array(np.diff(cut)), pa.array(blobs, pa.binary())],
                    names=["bucket", "block", "n", "grams"],
                )

    def total(table: pa.Table) -> pa.Table:
        n = table["n"].to_numpy()
        parts = [unpacked(blob.as_py(), k, 6, 4, 4) for blob, k in zip(table["grams"], n.tolist())]
        keys, at = np.unique(np.concatenate([np.cumsum(k) for k, _, _ in parts]), return_inverse=True)
        t, b = (np.bincount(at, weights=np.concatenate([p[c] for p in parts]), minlength=len(keys)).astype(np.int64) for c in (1, 2))
        ends = np.cumsum(n)
        blobs = [packed((t[at[j - k : j]], 8), (b[at[j - k : j]], 8)) for j, k in zip(ends.tolist(), n.tolist())]
        single = (keys & U64(1)) == 1
        once = [np.concatenate([[x], np.zeros(len(n) - 1, dtype=np.int64)]).astype(np.int64) for x in (single.sum(), t[single].sum(), b[single].sum())]
        return pa.table([table["block"], table["bucket"], table["n"], pa.array(blobs, pa.binary()), *map(pa.array, once)],
                        names=["block", "bucket", "n", "totals", "words", "target", "every"])

    narrow = blocks.select("block", "words", "tokens", "vocabulary", "lengths", "sequence", "rows", "chosen")
    sent = narrow.mapInArrow(tidy(send), "bucket long, block long, n long, grams binary")
    return sent.groupBy("bucket").applyInArrow(total, "block long, bucket long, n long, totals binary, words long, target long, every long")


def _losses(block: Block, counts: np.ndarray, size: int, kinds: int, scale: float, prior: float, taken: np.ndarray) -> np.ndarray:
    """Mean loss of each row; counts: totals in key order; taken: 1 where a row's own counts are among them."""
    of = np.empty(len(counts))
    of[block.order] = counts
    words, pairs = of[: block.words], of[block.words :]
    minus = taken[block.row]
    left = lambda total, own: (total - minus * own) * scale
    share = (left(words[block.word], block.own(block.word)) + 1) / (left(size, (block.tokens + 1)[block.row]) + kinds)
    loss = -np.log((left(pairs[block.pair], block.own(block.pair)) + prior * share) / (left(words[block.context], block.own_contexts()) + prior))
    return np.bincount(block.row, weights=loss, minlength=len(block.tokens)) / (block.tokens + 1)


def cross_entropy_difference(docs: DataFrame, target: DataFrame, id: str = "doc_id", text: str = "text", prior: float = PRIOR) -> DataFrame:
    """One row per document: ``doc`` (its columns but the text), n_tokens, target_loss, background_loss, score.

    target: ids (column ``id``) of the target documents.
    """
    size = docs.agg(F.sum(F.octet_length(F.col(f"`{text}`").cast("string")))).first()[0] or 0
    buckets = 1 << max(0, size // BUCKET_BYTES).bit_length()
    stored = durable(_blocks(docs, text)).withColumn("rows", F.size("doc").cast("long"))
    chosen = target.select(F.col(f"`{id}`").alias("id")).filter("id IS NOT NULL").distinct().withColumn("is_target", F.lit(True))
    ids = stored.select("block", F.posexplode(F.transform("doc", lambda d: d.getField(id))).alias("at", "id"))
    marks = join_unique(ids, chosen, ["id"], "left").filter("is_target").groupBy("block").agg(F.collect_list("at").alias("chosen"))  # at most BLOCK_ROWS
    blocks = join_unique(stored, marks, ["block"], "left")
    totals = durable(_totals(blocks, buckets))
    kinds, n_target, n_every = (x or 0 for x in totals.agg(F.sum("words"), F.sum("target"), F.sum("every")).first())
    schema = T.StructType([T.StructField("doc", stored.schema["doc"].dataType.elementType), T.StructField("n_tokens", T.LongType()), T.StructField("target_loss", T.DoubleType()),
                           T.StructField("background_loss", T.DoubleType()), T.StructField("score", T.DoubleType())])

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.drop_columns(["doc"]).to_pylist()[0]
        block = _opened(row)
        parts = sorted(right.select(["bucket", "n", "totals"]).to_pylist(), key=lambda r: r["bucket"])
        t, b = (np.concatenate(x).astype(np.float64) for x in zip(*[unpacked(p["totals"], p["n"], 8, 8) for p in parts]))
        background = _losses(block, b, n_every, kinds, n_target / n_every if n_target else 1.0, prior, np.ones(row["rows"]))
        wanted = _losses(block, t, n_target, kinds, 1.0, prior, _marked(row)) if n_target else background
        doc = left["doc"].combine_chunks().flatten()
        return pa.table([doc, pa.array(block.tokens), pa.array(wanted), pa.array(background), pa.array(wanted - background)], names=schema.names)

    return blocks.groupBy("block").cogroup(totals.select("block", "bucket", "n", "totals").groupBy("block")).applyInArrow(score, schema)
