"""Suffix-array dedup: every byte covered by a string of ``LENGTH`` bytes that also starts anywhere else.

Sampling. All ``GRAM``-byte hashes that are least in some window of ``LENGTH - GRAM + 1`` of them become *anchors* (about one per 175 bytes).
A string of ``LENGTH`` bytes holds an anchor at the same place wherever it stands, so no repeat escapes. An anchor's context is what a repeat
around it can reach: ``LENGTH - GRAM`` bytes before it and ``LENGTH`` from it on, inside its document. Anchors whose hash is
alone are dropped; contexts found twice are covered as a whole, so exact copies, however many, end here as one counted row.

Trees. Two contexts that share a repeat agree on 225 bytes from the anchor or on 175 before it, so the rest meet in buckets by these two
hashes. A bucket's contexts are sorted as suffixes (an enhanced suffix array: order and common prefixes of neighbours);
a stack scan yields the tree of common-prefix intervals. In each interval the left sides are sorted too: a member's longest common left
extension with another member plus the interval's prefix length says whether they share ``LENGTH`` bytes. Intervals whose left neighbours
differ are maximal repeats: ``repeat_groups`` returns them with all occurrences (a report for tables of moderate repetition: it
keeps every bucket whole).

For removal, buckets of more than ``LARGE`` different contexts don't go through one task: their windows are hashed and counted as
rows, which gives the same result.

Defined results: a null text has no bytes; texts shorter than ``LENGTH`` keep everything; matches never cross documents and are judged on the
input; repeated rows are copies of each other; extra columns stay in ``doc``.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.arrays import U64, Sums, mixed, slices, text_of, tidy, whole
from ledgerloom.scale import durable

LENGTH = 400
GRAM = 50
#: contexts of a bucket that one task takes: about 50 MB of bytes
LARGE = 100_000


class Shape(NamedTuple):
    length: int = LENGTH
    gram: int = GRAM

    @property
    def before(self) -> int:
        return self.length - self.gram

    @property
    def half(self) -> int:
        return (self.length - self.gram) // 2


def _sliding(x: np.ndarray, width: int, take) -> np.ndarray:
    """Least or greatest of each run of ``width`` values, by prefixes and suffixes of blocks."""
    n = len(x) - width + 1
    fill = np.iinfo(np.uint64).max if take is np.minimum else 0
    padded = np.full(-(-len(x) // width) * width, fill, dtype=U64)
    padded[: len(x)] = x
    blocks = padded.reshape(-1, width)
    up = take.accumulate(blocks, axis=1).ravel()
    down = take.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return take(down[:n], up[width - 1 : width - 1 + n])


def _anchors(sums: Sums, offsets: np.ndarray, shape: Shape) -> np.ndarray:
    """Places of all hashes that are least in some window inside one row."""
    size, width = int(offsets[-1]), shape.before + 1
    if size < shape.length:
        return np.zeros(0, dtype=np.int64)
    at = np.arange(size - shape.gram + 1)
    grams = sums.of(at, at + shape.gram) | U64(1)
    least = _sliding(grams, width, np.minimum)
    start = np.arange(len(least))
    row_end = offsets[np.searchsorted(offsets, start, side="right")]
    least[start + shape.length > row_end] = 0  # a window over the end of its row
    around = np.concatenate([np.zeros(width - 1, dtype=U64), least, np.zeros(width - 1, dtype=U64)])
    return np.flatnonzero(_sliding(around, width, np.maximum) == grams)


def anchors(texts: DataFrame, shape: Shape) -> DataFrame:
    """(key, position, gram, context, ahead, behind, left, right) of every anchor; texts: key, text."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, _, data, offsets in slices(batch.column(1)):
                sums = Sums(data)
                at = _anchors(sums, offsets, shape)
                row = np.searchsorted(offsets, at, side="right") - 1
                low, high = np.maximum(offsets[row], at - shape.before), np.minimum(offsets[row + 1], at + shape.length)
                left, right = at - low, high - at
                context = mixed(sums.of(low, high) ^ mixed((left * 65536 + right).astype(U64)))
                ahead_ok, behind_ok = right >= shape.gram + shape.half, left >= shape.half
                ahead = sums.of(at, np.where(ahead_ok, at + shape.gram + shape.half, at))
                behind = mixed(sums.of(np.where(behind_ok, at - shape.half, at), at + shape.gram) ^ U64(0x5851F42D4C957F2D))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(row + first)), pa.array((at - offsets[row]).astype(np.int32)),
                    pa.array(sums.of(at, at + shape.gram).view(np.int64)), pa.array(context.view(np.int64)),
                    pa.array(ahead.view(np.int64), mask=~ahead_ok), pa.array(behind.view(np.int64), mask=~behind_ok),
                    pa.array(left.astype(np.int32)), pa.array(right.astype(np.int32)),
                ], names=["key", "position", "gram", "context", "ahead", "behind", "left", "right"])

    return texts.mapInArrow(tidy(find), "key binary, position int, gram long, context long, ahead long, behind long, left int, right int")


def _common(x: np.ndarray, size: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Length of the common prefix of rows i and j."""
    out = np.empty(len(i), dtype=np.int64)
    for a in range(0, len(i), 8192):
        p, q = i[a : a + 8192], j[a : a + 8192]
        differs = x[p] != x[q]
        out[a : a + 8192] = np.where(differs.any(axis=1), differs.argmax(axis=1), x.shape[1])
    return np.minimum(out, np.minimum(size[i], size[j]))


def _order(x: np.ndarray, group: np.ndarray) -> np.ndarray:
    return np.lexsort((np.ascontiguousarray(x).view(f"S{x.shape[1]}").ravel(), group))


def intervals(lcp: list[int]) -> Iterator[tuple[int, int, int]]:
    """(prefix length, first, last) of the common-prefix intervals of sorted suffixes; lcp[i] is shared by i and i + 1."""
    stack = [(0, 0)]
    for i, value in enumerate([*lcp, 0], start=1):
        first = i - 1
        while stack and stack[-1][0] > value:
            length, first = stack.pop()
            yield length, first, i - 1
        if not stack or stack[-1][0] < value:
            stack.append((value, first))


class Side(NamedTuple):
    """One side of the contexts of a batch: bytes outward from the part a bucket has in common, and how many there are."""

    data: np.ndarray
    size: np.ndarray
    shared: int


def _tree(left: Side, right: Side, group: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(member, left extent, right extent, interval, maximal) where a member shares ``length`` bytes within a prefix interval of its group."""
    n = len(group)
    order = _order(right.data, group)
    # One more than the common bytes; 0 closes all intervals between groups.
    lcp = np.where(group[order[:-1]] == group[order[1:]], _common(right.data, right.size, order[:-1], order[1:]) + 1, 0)
    place = np.empty(n, dtype=np.int64)
    by_left = _order(left.data, group)
    place[by_left] = np.arange(n)
    found = np.array(list(intervals(lcp.tolist())), dtype=np.int64).reshape(-1, 3)
    sizes = found[:, 2] - found[:, 1] + 1
    upto = np.cumsum(sizes)
    first = 0
    while first < len(found):  # some intervals at a time, about two million members
        last = max(int(np.searchsorted(upto, (upto[first - 1] if first else 0) + (2 << 20), side="right")), first + 1)
        own, size = found[first:last], sizes[first:last]
        number = np.repeat(np.arange(first, last), size)
        at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size - own[:, 1], size)
        # Members of each interval by their left sides.
        key = np.sort(number * n + place[order[at]])
        number, member = key // n, by_left[key % n]
        same = number[1:] == number[:-1]
        common = np.full(len(member) + 1, -1, dtype=np.int64)
        pair = np.flatnonzero(same)
        common[pair + 1] = _common(left.data, left.size, member[pair], member[pair + 1])
        best = np.maximum(common[:-1], common[1:]) + left.shared
        prefix = found[number, 0] - 1 + right.shared
        # Left-diverse: the bytes before the members are not all the same.
        before = np.where(left.size[member] > 0, left.data[member, 0], -1) if left.shared == 0 else None
        if before is None:
            diverse = np.ones(len(found), dtype=bool)
        else:
            diverse = np.zeros(len(found), dtype=bool)
            diverse[number[1:][same & ((before[1:] != before[:-1]) | (before[1:] < 0))]] = True
        on = best + prefix >= length
        yield member[on], best[on], prefix[on], number[on], diverse[number[on]]
        first = last


def _sides(table: pa.Table, shape: Shape, ahead: bool) -> tuple[Side, Side]:
    body = table["body"].combine_chunks()
    width = 2 * shape.before - shape.half
    start = int(np.frombuffer(body.buffers()[1], dtype=np.int32)[body.offset])
    data = np.frombuffer(body.buffers()[2], dtype=np.uint8)[start : start + len(body) * width].reshape(-1, width)
    cut = shape.before if ahead else shape.before - shape.half
    shared_left, shared_right = (0, shape.gram + shape.half) if ahead else (shape.half, shape.gram)
    return (
        Side(data[:, :cut], table["left"].to_numpy().astype(np.int64) - shared_left, shared_left),
        Side(data[:, cut:], table["right"].to_numpy().astype(np.int64) - shared_right, shared_right),
    )


def _trees(contexts: DataFrame, shape: Shape, groups: bool) -> DataFrame:
    """Buckets through the trees: extents of each context, with ``groups`` for each interval."""
    names = ["context", "l", "r", *(["interval", "maximal"] if groups else [])]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None

        def done(table: pa.Table) -> Iterator[pa.RecordBatch]:
            for ahead in (True, False):
                own = table.filter(pc.equal(table["is_ahead"], ahead)).combine_chunks()
                if own.num_rows < 2:
                    continue
                bucket, context = own["bucket"].to_numpy(), own["context"].to_numpy()
                left, right = _sides(own, shape, ahead)
                l, r = np.full(len(bucket), -1, dtype=np.int64), np.full(len(bucket), -1, dtype=np.int64)
                for member, a, b, interval, maximal in _tree(left, right, np.cumsum(np.concatenate([[0], bucket[1:] != bucket[:-1]])), shape.length):
                    if groups:
                        name = mixed(bucket[member].view(U64) ^ mixed(interval.astype(U64))).view(np.int64)
                        yield pa.RecordBatch.from_arrays([pa.array(context[member]), pa.array(a), pa.array(b), pa.array(name), pa.array(maximal)], names=names)
                    else:
                        np.maximum.at(l, member, a)
                        np.maximum.at(r, member, b)
                on = l >= 0
                if on.any():
                    yield pa.RecordBatch.from_arrays([pa.array(context[on]), pa.array(l[on]), pa.array(r[on])], names=names)

        for batch in batches:
            table = pa.Table.from_batches([batch] if rest is None else [*rest.to_batches(), batch])
            bucket = table["bucket"].to_numpy()
            cut = int(np.searchsorted(bucket, bucket[-1])) if len(bucket) else 0
            if cut:
                yield from done(table.slice(0, cut))
            rest = table.slice(cut)
        if rest is not None:
            yield from done(rest)

    dealt = contexts.repartition("bucket").sortWithinPartitions("bucket")
    kinds = {"context": "long", "l": "long", "r": "long", "interval": "long", "maximal": "boolean"}
    return dealt.mapInArrow(tidy(scan), ", ".join(f"{c} {kinds[c]}" for c in names))


def _windows(contexts: DataFrame, shape: Shape) -> DataFrame:
    """The same extents for large buckets: all windows of ``length`` bytes around the anchors, hashed and counted."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            for ahead in (True, False):
                own = table.filter(pc.equal(table["is_ahead"], ahead)).combine_chunks()
                if not own.num_rows:
                    continue
                left, right = _sides(own, shape, ahead)
                for at, (bucket, context) in enumerate(zip(own["bucket"].to_pylist(), own["context"].to_pylist())):
                    # A window goes ``back`` bytes before the anchor; what the bucket has in common need not be hashed.
                    back = np.arange(max(left.shared, shape.length - right.shared - int(right.size[at])), min(left.shared + int(left.size[at]), shape.length - right.shared) + 1)
                    if len(back):
                        zero = np.zeros(len(back), dtype=np.int64)
                        a = Sums(left.data[at]).of(zero, back - left.shared)
                        b = Sums(right.data[at]).of(zero, shape.length - back - right.shared)
                        window = mixed(mixed(a ^ mixed(b + back.astype(U64))) ^ np.array([bucket]).view(U64))
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(back), context)), pa.array(window.view(np.int64)), pa.array(back)], names=["context", "window", "back"])

    rows = durable(contexts.mapInArrow(tidy(cut), "context long, window long, back long"))
    twice = rows.groupBy("window").agg(F.min("context").alias("a"), F.max("context").alias("b")).filter("a <> b").select("window")
    held = rows.join(twice, "window", "left_semi").groupBy("context").agg(F.max("back").alias("l"), (F.lit(shape.length) - F.min("back")).alias("r"))
    return held.select("context", "l", "r")


def _found(docs: DataFrame, text: str, shape: Shape, large: int, groups: bool = False) -> tuple[DataFrame, DataFrame]:
    """Anchors that may repeat, and extents of their contexts: the largest, with ``groups`` those of each interval."""
    texts = docs.filter(F.length(text) > 0).select(F.unhex(F.md5(F.col(text).cast("binary"))).alias("key"), F.col(text).cast("string").alias("text"))
    every = durable(anchors(texts, shape))
    twice = every.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("gram")
    shared = durable(every.join(twice, "gram", "left_semi").drop("gram"))
    distinct = durable(shared.groupBy("context").agg(
        F.count(F.lit(1)).alias("n"), *[F.first(c).alias(c) for c in ("ahead", "behind", "left", "right")], F.min(F.struct("key", "position")).alias("at"))
        .withColumn("repeated", (F.col("n") > 1) & (F.col("left") + F.col("right") >= shape.length))
        .withColumn("whole", F.col("repeated") & (F.col("left") == shape.before) & (F.col("right") == shape.length)))
    full = distinct.filter("repeated").select("context", F.col("left").cast("long").alias("l"), F.col("right").cast("long").alias("r"))
    by_bucket = distinct.select(
        "context", "at", "whole", F.posexplode(F.array("ahead", "behind")).alias("kind", "bucket")).filter("bucket IS NOT NULL")
    # A bucket in which every context is covered as a whole has nothing to add.
    sizes = by_bucket.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), F.bool_and("whole").alias("settled")).filter(
        "size > 1" if groups else "size > 1 AND NOT settled").select("bucket", "size")
    meeting = by_bucket.join(sizes, "bucket").select(
        F.col("at.key").alias("key"), F.struct(F.col("at.position").alias("position"), "context", "bucket", (F.col("kind") == 0).alias("is_ahead"), (F.col("size") > large).alias("large")).alias("a"))
    wanted = durable(meeting.groupBy("key").agg(F.collect_list("a").alias("anchors")))
    bodies = texts.groupBy("key").agg(F.first("text").alias("text"))
    width = 2 * shape.before - shape.half

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column(0).cast(pa.binary())
            for doc in range(batch.num_rows):
                row = batch.column(1)[doc].values
                position, context, bucket, ahead, big = (row.field(k).to_numpy(zero_copy_only=False) for k in range(5))
                body = np.frombuffer(raw[doc].as_buffer(), dtype=np.uint8)
                # Outward from what the bucket has in common, filled up with zeros.
                padded = np.concatenate([np.zeros(shape.length, dtype=np.uint8), body, np.zeros(shape.length, dtype=np.uint8)])
                at = position.astype(np.int64) + shape.length
                sides = np.empty((len(at), width), dtype=np.uint8)
                for kind, skip_left, skip_right in ((ahead, 0, shape.gram + shape.half), (~ahead, shape.half, shape.gram)):
                    p = at[kind][:, None]
                    sides[kind] = np.concatenate([
                        padded[p - 1 - np.arange(skip_left, shape.before)], padded[p + np.arange(skip_right, shape.length)]], axis=1)
                yield pa.RecordBatch.from_arrays([
                    pa.array(bucket), pa.array(context), pa.array(ahead), pa.array(big),
                    pa.array(np.minimum(position, shape.before).astype(np.int32)), pa.array(np.minimum(len(body) - position, shape.length).astype(np.int32)),
                    pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(np.arange(0, (len(at) + 1) * width, width, dtype=np.int32)), pa.py_buffer(sides)]),
                ], names=["bucket", "context", "is_ahead", "large", "left", "right", "body"])

    contexts = bodies.join(wanted, "key").select("text", "anchors").mapInArrow(
        tidy(cut), "bucket long, context long, is_ahead boolean, large boolean, left int, right int, body binary")
    crowded = not sizes.filter(F.col("size") > large).isEmpty()
    if crowded:
        contexts = durable(contexts)
    found = _trees(contexts.filter("NOT large").drop("large") if crowded else contexts.drop("large"), shape, groups)
    if crowded and not groups:
        found = found.unionByName(_windows(contexts.filter("large").drop("large"), shape))
    if groups:
        full = full.select("*", F.col("context").alias("interval"), F.lit(True).alias("maximal"))
        return shared, durable(found.unionByName(full))
    return shared, durable(found.unionByName(full).groupBy("context").agg(F.max("l").alias("l"), F.max("r").alias("r")))


def repeat_groups(docs: DataFrame, text: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(group, key, start, end): maximal repeats around anchors with all their occurrences; key is the MD5 of the text."""
    shared, found = _found(docs, text, Shape(length, gram), 1 << 62, groups=True)
    return shared.join(found.filter("maximal"), "context").select(
        F.col("interval").alias("group"), "key", (F.col("position") - F.col("l")).alias("start"), (F.col("position") + F.col("r")).alias("end")).distinct()


def without_repeats(docs: DataFrame, text: str = "text", length: int = LENGTH, gram: int = GRAM, large: int = LARGE) -> DataFrame:
    """One row per document: ``doc``, n_bytes, removed (maximal runs of bytes, end exclusive), kept (the other bytes)."""
    shared, extents = _found(docs, text, Shape(length, gram), large)
    spans = shared.select("key", "position", "context").distinct().join(extents, "context").select(
        "key", F.struct((F.col("position") - F.col("l")).alias("start"), (F.col("position") + F.col("r")).alias("end")).alias("span"))
    removed = spans.groupBy("key").agg(F.collect_set("span").alias("spans"))
    at = docs.columns.index(text)
    rows = docs.select(F.unhex(F.md5(F.col(text).cast("binary"))).alias("key"), whole(docs)).join(removed, "key", "left").select("doc", "spans")
    run = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    schema = T.StructType([rows.schema["doc"], T.StructField("n_bytes", T.LongType()), T.StructField("removed", run), T.StructField("kept", T.BinaryType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = text_of(batch, at).cast(pa.binary())
            for first in range(0, batch.num_rows, 1000):
                sizes, runs_, kept = [], [], []
                for body, spans_ in zip(raw.slice(first, 1000).to_pylist(), batch.column(1).slice(first, 1000).to_pylist()):
                    body, merged = body or b"", []
                    for s in sorted(spans_ or [], key=lambda s: s["start"]):
                        if merged and s["start"] <= merged[-1]["end"]:
                            merged[-1]["end"] = max(merged[-1]["end"], s["end"])
                        else:
                            merged.append(dict(s))
                    cuts = [0, *[x for s in merged for x in (s["start"], s["end"])], len(body)]
                    sizes.append(len(body))
                    runs_.append(merged)
                    kept.append(b"".join(body[a:b] for a, b in zip(cuts[::2], cuts[1::2])))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(first, len(sizes)), pa.array(sizes, pa.int64()),
                    pa.array(runs_, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.binary())], names=schema.names)

    return rows.mapInArrow(tidy(cut), schema)
