"""Best-fit packing: partitions pack locally, nearly full bins are final, the rest is merged up a tree.

A partition sorts its items by size, largest first, and puts each into the bin with the least room that still holds it (in blocks
of ``BLOCK`` items or ``BLOCK_BYTES``, so that its memory is bounded). Bins
filled to ``NEARLY_FULL`` of the capacity are final. The others go up as *items* of their own: nodes of ``FAN`` children
pack them again, round by round, until one node is left. A node passes on at most ``CARRIED`` bins, the emptiest; fuller
ones are final too, so that no node ever holds more than ``FAN * CARRIED`` bins, whatever the input.

Defined results: rows with a null or repeated id are documents of their own; a null or empty text is the end id alone;
of equal items any order is right; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.arrays import slices, tidy
from ledgerloom.llm.tokens import chunk_ids
from ledgerloom.scale import durable

CAPACITY = 2048
NEARLY_FULL = 0.99
FAN = 8
CARRIED = 1024
BLOCK = 200_000
BLOCK_BYTES = 32 << 20
#: Text that is encoded at once: what encoding holds besides the vocabulary is many times as much.
SLICE_BYTES = 1 << 19


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and place in it for each item, largest first; fill of each bin."""
    room: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_, bins = 0, 0
    bin_of, place = np.zeros(len(sizes), dtype=np.int64), np.zeros(len(sizes), dtype=np.int64)
    left_of: list[int] = []
    values = sizes.tolist()
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = values[i]
        fitting = open_ >> size
        if fitting:
            left = size + (fitting & -fitting).bit_length() - 1
            b = room[left].pop()
            if not room[left]:
                open_ ^= 1 << left
        else:
            left, b = capacity, bins
            bins += 1
            left_of.append(capacity)
        bin_of[i], place[i] = b, capacity - left
        left -= size
        left_of[b] = left
        if left:
            room[left].append(b)
            open_ |= 1 << left
    return bin_of, place, capacity - np.array(left_of, dtype=np.int64)


def _final(fill: np.ndarray, capacity: int, last: bool) -> np.ndarray:
    """Which bins are final: the nearly full ones, and of the others all but the ``CARRIED`` emptiest."""
    done = fill >= NEARLY_FULL * capacity if not last else np.ones(len(fill), dtype=bool)
    left = np.flatnonzero(~done)
    if len(left) > CARRIED:
        done[left[np.argsort(fill[left], kind="stable")[CARRIED:]]] = True
    return done


def pack(items: DataFrame, size: str, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to rows of sizes from 1 to ``capacity``; the other columns stay in ``item``."""
    item = items.select(F.struct(*[F.col(f"`{c}`") for c in items.columns]).alias("item"), F.col(size).cast("long").alias("size"))
    state = T.StructType([
        item.schema["item"], T.StructField("node", T.LongType()), T.StructField("bin", T.LongType()),
        T.StructField("offset", T.LongType()), T.StructField("fill", T.LongType()), T.StructField("final", T.BooleanType()),
    ])

    def rows(items_: pa.Array, node: int, bin_: np.ndarray, offset: np.ndarray, fill: np.ndarray, final: np.ndarray) -> list:
        return [items_, pa.array(np.full(len(bin_), node)), pa.array(bin_), pa.array(offset), pa.array(fill), pa.array(final)]

    def leaf(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, before = TaskContext.get().partitionId(), 0

        def packed(block: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            nonlocal before
            sizes = np.concatenate([b.column(1).to_numpy(zero_copy_only=False) for b in block])
            if len(sizes) and (sizes.max() > capacity or sizes.min() < 1):
                raise ValueError(f"sizes must be from 1 to {capacity}")
            bin_of, place, fill = best_fit(sizes, capacity)
            final = _final(fill, capacity, False)
            at = 0
            for b in block:
                own = bin_of[at : at + b.num_rows]
                yield pa.RecordBatch.from_arrays(
                    rows(b.column(0), node, own + before, place[at : at + b.num_rows], fill[own], final[own]), names=state.names)
                at += b.num_rows
            before += len(fill)

        block, held, size_ = [], 0, 0
        for batch in batches:
            block.append(batch)
            held, size_ = held + batch.num_rows, size_ + batch.nbytes
            if held >= BLOCK or size_ >= BLOCK_BYTES:
                yield from packed(block)
                block, held, size_ = [], 0, 0
        if block:
            yield from packed(block)

    def merged(last: bool):
        def merge(table: pa.Table) -> pa.Table:
            node = int(table["node"][0].as_py()) // FAN
            keys = np.stack([table["node"].to_numpy(), table["bin"].to_numpy()], axis=1)
            _, first, code = np.unique(keys, axis=0, return_index=True, return_inverse=True)
            code = code.ravel()
            bin_of, place, fill = best_fit(table["fill"].to_numpy()[first], capacity)
            final = _final(fill, capacity, last)
            own = bin_of[code]
            items_ = pa.chunked_array(table["item"].chunks, table["item"].type).combine_chunks()
            return pa.Table.from_arrays(rows(items_, node, own, table["offset"].to_numpy() + place[code], fill[own], final[own]), names=state.names)

        return merge

    level = durable(item.mapInArrow(tidy(leaf), state))
    done, round_ = [level.filter("final").withColumn("round", F.lit(0).cast("long"))], 0
    highest = level.agg(F.max("node")).first()[0]
    while highest is not None:
        last = highest < FAN
        round_ += 1
        up = level.filter(~F.col("final"))
        level = durable(up.groupBy(F.floor(F.col("node") / FAN).alias("parent")).applyInArrow(merged(last), state))
        done.append(level.filter("final").withColumn("round", F.lit(round_).cast("long")))
        highest = None if last else highest // FAN
    all_ = reduce(DataFrame.unionByName, done)
    sequence = F.shiftleft("round", 57).bitwiseOR(F.shiftleft("node", 24)).bitwiseOR(F.col("bin"))
    return all_.select("item", sequence.alias("sequence_id"), F.col("offset"))


def pieces(docs: DataFrame, tokenizer: str, id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """Ids of each document with the end id, cut where longer than ``capacity``: id, piece, start, length, ids (unsigned 32 bits)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = chunk_ids(tokenizer)
        for batch in batches:
            for first, rows, data, offsets in slices(batch.column(1), SLICE_BYTES):
                ids, begin = encoder.encode(data, offsets)
                ids = np.insert(ids, begin[1:], end_id).astype("<u4")
                begin = begin + np.arange(rows + 1)
                n = np.diff(begin)
                count = -(-n // capacity)
                row = np.repeat(np.arange(rows), count)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                start = piece * capacity
                length = np.minimum(n[row] - start, capacity)
                ends = (begin[row] + start + length) * 4
                blob = pa.Array.from_buffers(pa.large_binary(), len(row), [None, pa.py_buffer(np.concatenate([[0], ends]).astype(np.int64)), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays(
                    [pc.take(batch.column(0), pa.array(row + first)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), blob.cast(pa.binary())],
                    names=["id", "piece", "start", "length", "ids"],
                )

    found = docs.select(F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text")).mapInArrow(
        tidy(cut), "id long, piece int, start long, length long, ids binary")
    return found.withColumnRenamed("id", id)


def packed_sequences(docs: DataFrame, tokenizer: str, id: str = "doc_id", text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents with their ids, sequence_id and offset."""
    # Stored first: encoding and packing in one task would hold the memory of both. Only places and sizes are packed; a piece's ids
    # join its place at the end. A row number tells equal ids and pieces apart.
    stored = durable(pieces(docs, tokenizer, id, text, capacity).withColumn("row", F.monotonically_increasing_id()))
    placed = durable(pack(stored.select("row", "length"), "length", capacity).select(F.col("item.row").alias("row"), "sequence_id", "offset"))
    return stored.join(placed, "row").drop("row")
