"""Token ids in binary files: patched frame-of-reference blocks.

A file holds documents in ascending id order. Ids are cut into blocks of ``BLOCK``. A block stores its minimum, a width, and
the differences from the minimum packed at that width; the width is the number of bits that ``PERCENT`` per cent of the
differences fit into. Higher bits of the others stand in the block's exception list (position, rest). An index of
block starts and a table of documents close the file, so that any range of ids is read by decoding its blocks alone.

    magic, blocks (minimum u32, width u8, exceptions u8, packed bits, positions u8[], rests u32[]),
    block starts u64[], document ids i64[], document id given u8[], document starts u64[], counts u64 x 3

Documents are dealt by ranges of (id, hash of text), so a repeated id is no hot key. Tasks write to a name of their own and move the
file into place, so a repeated or lost task leaves one whole file. The manifest has one row per file.

Defined results: null ids come first; a null or empty text is the end id alone; rows with equal ids stay separate
documents; an empty table writes no files; only id and text are read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.arrays import slices, tidy
from ledgerloom.llm.tokens import chunk_ids
from ledgerloom.scale import durable, shared_folder

MAGIC = b"PFORv001"
BLOCK = 128
PERCENT = 90
FILE_IDS = 8 << 20


def _bits(x: np.ndarray) -> np.ndarray:
    return np.where(x > 0, np.floor(np.log2(np.maximum(x, 1))).astype(np.int64) + 1, 0)


def encode_blocks(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all blocks and where each begins (and the end)."""
    n = -(-len(ids) // BLOCK)
    if n == 0:
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    padded = np.full(n * BLOCK, ids[-1], dtype=np.int64)
    padded[: len(ids)] = ids
    blocks = padded.reshape(n, BLOCK)
    low = blocks.min(axis=1)
    over = blocks - low[:, None]
    rank = -(-PERCENT * BLOCK // 100) - 1
    width = _bits(np.partition(over, rank, axis=1)[:, rank])
    rest = over >> width[:, None]
    row, position = np.nonzero(rest)
    exceptions = np.bincount(row, minlength=n)
    size = 6 + BLOCK // 8 * width + 5 * exceptions
    begin = np.concatenate([[0], np.cumsum(size)])
    out = np.zeros(begin[-1], dtype=np.uint8)
    at = begin[:-1]
    out[at[:, None] + np.arange(4)] = low.astype("<u4").view(np.uint8).reshape(n, 4)
    out[at + 4], out[at + 5] = width, exceptions
    for w in np.unique(width[width > 0]).tolist():
        own = np.flatnonzero(width == w)
        for part in np.array_split(own, -(-len(own) // 4096)):
            bits = (over[part][:, :, None] >> np.arange(w)) & 1
            packed = np.packbits(bits.astype(np.uint8).reshape(len(part), -1), axis=1, bitorder="little")
            out[at[part][:, None] + 6 + np.arange(packed.shape[1])] = packed
    k = np.arange(len(row)) - np.repeat(np.cumsum(exceptions) - exceptions, exceptions)
    list_ = at[row] + 6 + BLOCK // 8 * width[row]
    out[list_ + k] = position
    places = (list_ + exceptions[row] + 4 * k)[:, None] + np.arange(4)
    out[places] = rest[row, position].astype("<u4").view(np.uint8).reshape(-1, 4)
    return out, begin


def decode_blocks(data: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Ids of the blocks that begin at ``begin`` in ``data``."""
    n = len(begin)
    if n == 0:
        return np.zeros(0, dtype=np.int64)
    low = data[begin[:, None] + np.arange(4)].view("<u4").ravel().astype(np.int64)
    width, exceptions = data[begin + 4].astype(np.int64), data[begin + 5].astype(np.int64)
    over = np.zeros((n, BLOCK), dtype=np.int64)
    for w in np.unique(width[width > 0]).tolist():
        own = np.flatnonzero(width == w)
        for part in np.array_split(own, -(-len(own) // 4096)):
            packed = data[begin[part][:, None] + 6 + np.arange(BLOCK // 8 * w)]
            bits = np.unpackbits(packed, axis=1, bitorder="little").reshape(len(part), BLOCK, w)
            over[part] = bits @ (1 << np.arange(w, dtype=np.int64))
    row = np.repeat(np.arange(n), exceptions)
    k = np.arange(len(row)) - np.repeat(np.cumsum(exceptions) - exceptions, exceptions)
    list_ = begin[row] + 6 + BLOCK // 8 * width[row]
    rest = data[(list_ + exceptions[row] + 4 * k)[:, None] + np.arange(4)].view("<u4").ravel().astype(np.int64)
    over[row, data[list_ + k]] += rest << width[row]
    return (over + low[:, None]).ravel()


def file_bytes(ids: np.ndarray, doc_ids: list[int | None], starts: np.ndarray) -> bytes:
    body, begin = encode_blocks(ids)
    given = np.array([x is not None for x in doc_ids], dtype=np.uint8)
    return b"".join([
        MAGIC, body.tobytes(), (begin[:-1] + len(MAGIC)).astype("<u8").tobytes(),
        np.array([x or 0 for x in doc_ids], dtype="<i8").tobytes(), given.tobytes(), starts.astype("<u8").tobytes(),
        np.array([len(begin) - 1, len(doc_ids), len(ids)], dtype="<u8").tobytes(),
    ])


class TokenFile:
    """A file of ids in memory or mapped: documents, and any range of ids."""

    def __init__(self, data: bytes):
        self.data = np.frombuffer(data, dtype=np.uint8)
        if data[: len(MAGIC)] != MAGIC:
            raise ValueError("not a token file")
        blocks, docs, self.n_ids = np.frombuffer(data[-24:], dtype="<u8").astype(np.int64).tolist()
        at = len(data) - 24 - 8 * docs
        self.starts = np.append(np.frombuffer(data, "<u8", docs, at).astype(np.int64), self.n_ids)
        at -= docs
        given = np.frombuffer(data, np.uint8, docs, at).astype(bool)
        at -= 8 * docs
        ids = np.frombuffer(data, "<i8", docs, at)
        self.doc_ids = [int(x) if g else None for x, g in zip(ids.tolist(), given.tolist())]
        self.begin = np.frombuffer(data, "<u8", blocks, at - 8 * blocks).astype(np.int64)

    def ids(self, start: int, end: int) -> np.ndarray:
        first, last = start // BLOCK, -(-end // BLOCK)
        return decode_blocks(self.data, self.begin[first:last])[start - first * BLOCK : end - first * BLOCK].astype("<u4")


def write_tokens(docs: DataFrame, tokenizer: str, folder: str | None = None, id: str = "doc_id", text: str = "text",
                 end_id: int = 2, file_ids: int = FILE_IDS) -> DataFrame:
    """Writes the files; the stored manifest: path, partition, part, n_docs, n_ids, start (ids in all files before)."""
    spark = docs.sparkSession
    folder = folder or f"{shared_folder(spark)}/tokens-{uuid.uuid4().hex}"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
        store.create_dir(root, recursive=True)
        encoder, context = chunk_ids(tokenizer), TaskContext.get()
        held: list[np.ndarray] = []
        doc_ids: list[int | None] = []
        sizes: list[np.ndarray] = []
        part = 0

        def flush() -> pa.RecordBatch:
            nonlocal held, doc_ids, sizes, part
            ids, size = np.concatenate(held), np.concatenate(sizes)
            name = f"{root}/{context.partitionId():08d}-{part:05d}.pfor"
            with store.open_output_stream(f"{name}.{context.taskAttemptId()}") as out:
                out.write(file_bytes(ids, doc_ids, np.cumsum(size) - size))
            store.move(f"{name}.{context.taskAttemptId()}", name)
            row = pa.RecordBatch.from_pylist([{
                "path": name[len(root) + 1 :], "partition": context.partitionId(), "part": part, "n_docs": len(doc_ids), "n_ids": len(ids)}])
            held, doc_ids, sizes, part = [], [], [], part + 1
            return row

        for batch in batches:
            for first, rows, data, offsets in slices(batch.column(1), most=min(2 << 20, 4 * file_ids)):
                ids, begin = encoder.encode(data, offsets)
                held.append(np.insert(ids, begin[1:], end_id))
                sizes.append(np.diff(begin) + 1)
                doc_ids += batch.column(0).slice(first, rows).to_pylist()
                if sum(map(len, held)) >= file_ids:
                    yield flush()
        if doc_ids:
            yield flush()

    rows = docs.select(F.col(id).cast("long").alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    order = [F.col("id").asc_nulls_first(), F.xxhash64("text")]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    files = durable(dealt.mapInArrow(tidy(write), "path string, partition long, part long, n_docs long, n_ids long"))
    # One row per file of millions of ids: the window's single task sees no more than that.
    before = Window.orderBy("partition", "part").rowsBetween(Window.unboundedPreceding, -1)
    return durable(files.select("*", F.lit(folder).alias("folder"), F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("start")))


def read_tokens(manifest: DataFrame) -> DataFrame:
    """Documents from the files: id, start (over all files), n_tokens, ids (unsigned 32 bits, little-endian)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            for row in batch.to_pylist():
                store, root = fs.FileSystem.from_uri(row["folder"] if "://" in row["folder"] else f"file://{row['folder']}")
                with store.open_input_file(f"{root}/{row['path']}") as f:
                    file = TokenFile(f.read())
                docs, at = len(file.doc_ids), 0
                while at < docs:  # about a million ids at a time
                    to = min(docs, max(at + 1, int(np.searchsorted(file.starts, file.starts[at] + (1 << 20)))))
                    ids = file.ids(int(file.starts[at]), int(file.starts[to]))
                    offsets = (file.starts[at : to + 1] - file.starts[at]) * 4
                    blob = pa.Array.from_buffers(pa.large_binary(), to - at, [None, pa.py_buffer(offsets), pa.py_buffer(ids)])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(file.doc_ids[at:to], pa.int64()), pa.array(file.starts[at:to] + row["start"]),
                         pa.array(np.diff(file.starts[at : to + 1])), blob.cast(pa.binary())], names=["id", "start", "n_tokens", "ids"])
                    at = to

    spread = manifest.select("folder", "path", "start").repartition(F.col("path"))
    return spread.mapInArrow(tidy(read), "id long, start long, n_tokens long, ids binary")
