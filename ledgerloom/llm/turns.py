"""Conversations as chunks of consecutive turns, and digests over the chunks of one conversation.

Nearly every conversation is one chunk. One of very many rows, or of very many bytes, becomes several, so that no row and
no task has to hold it: its rows are numbered by a range partitioning, and tasks see one chunk at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.scale import dense_index, durable, join_unique

CHUNK_ROWS = 16_384
CHUNK_BYTES = 16 << 20


def _key(column: str) -> Column:
    """Text that tells a null id from all others."""
    return F.coalesce(F.concat(F.lit("="), F.col(f"`{column}`").cast("string")), F.lit(""))


def chunked(rows: DataFrame, id: str, order: Sequence[str], text: str, chunk_rows: int = CHUNK_ROWS, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(key, id, chunk, long, turns): all rows of each conversation, sorted by ``order`` with nulls first.

    ``turns`` holds the columns of ``rows`` but the id, the order's columns first. Rows that are equal in ``order`` must be
    equal in all columns. ``long`` marks conversations with more than one chunk. A chunk has at most ``chunk_rows`` rows and,
    on average over its conversation, ``chunk_bytes`` bytes. The result is a stored table.
    """
    keyed = rows.withColumn("__key", _key(id))
    size = keyed.groupBy("__key").agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length(F.coalesce(text, F.lit("")))), F.lit(0)).alias("bytes"))
    per = F.greatest(F.lit(1), F.least(F.lit(chunk_rows), F.floor(F.col("n") * chunk_bytes / F.greatest(F.col("bytes"), F.lit(1))))).cast("bigint")
    long = durable(size.filter((F.col("n") > chunk_rows) | (F.col("bytes") > chunk_bytes) & (F.col("n") > 1)).select("__key", per.alias("__per")))
    struct = F.struct(*order, *[c for c in rows.columns if c not in (*order, id)])
    if long.isEmpty():
        placed = keyed.select("__key", F.col(id), F.lit(0).cast("bigint").alias("chunk"), F.lit(False).alias("long"), struct.alias("turn"))
    else:
        marked = join_unique(keyed, long, ["__key"])
        short = marked.filter("__per IS NULL").select("__key", F.col(id), F.lit(0).cast("bigint").alias("chunk"), F.lit(False).alias("long"), struct.alias("turn"))
        # The last part of the order tells equal rows apart: they are interchangeable, but may not meet in one partition.
        apart = durable(marked.filter("__per IS NOT NULL").withColumn("__row", F.monotonically_increasing_id()))
        numbered = dense_index(apart, ["__key", *[F.col(o).asc_nulls_first() for o in order], "__row"], "__place")
        placed = short.unionAll(numbered.select(
            "__key", F.col(id), F.floor(F.col("__place") / F.col("__per")).cast("bigint"), F.lit(True), struct.alias("turn")))
    grouped = placed.groupBy("__key", id, "chunk", "long").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    return durable(grouped.withColumnRenamed("__key", "key"))


def in_order(parts: DataFrame, value: str, task: Callable[[list], list], result: T.DataType) -> DataFrame:
    """(key, chunk, value): ``task`` sees one small value per chunk of a conversation, in order, and gives one per chunk.

    A conversation of n rows has about n / ``CHUNK_ROWS`` chunks, so its list stays small.
    """
    lists = parts.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("chunk", F.col(value).alias("v")))).alias("list"))
    schema = T.StructType([parts.schema["key"], T.StructField("list", T.ArrayType(T.StructType([T.StructField("chunk", T.LongType()), T.StructField("v", result)])))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                given = task([x["v"] for x in row["list"]])
                out.append({"key": row["key"], "list": [{"chunk": x["chunk"], "v": v} for x, v in zip(row["list"], given)]})
            yield pa.RecordBatch.from_pylist(out, arrow)

    return lists.mapInArrow(run, schema).select("key", F.inline("list")).withColumnRenamed("v", value)


def sha256_in_order(parts: DataFrame, texts: Sequence[str], lead: int = 0) -> DataFrame:
    """(key, one hex digest per column in ``texts``) of the column's texts laid end to end in the order of ``chunk``.

    Chunks stream through the task that holds their conversation; it keeps a digest's state and one chunk. The first
    ``lead`` bytes of each conversation are left out (a separator that stands before every item).
    """
    texts = list(texts)
    ordered = parts.select("key", "chunk", *texts).repartition("key").sortWithinPartitions("key", "chunk").drop("chunk")
    schema = T.StructType([parts.schema["key"], *[T.StructField(t, T.StringType()) for t in texts]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(key, states):
            return pa.RecordBatch.from_arrays([pa.array([key], pa.string()), *[pa.array([s.hexdigest()], pa.string()) for s in states]], ["key", *texts])

        now, states, skip = None, [], []
        for batch in batches:
            for r in range(batch.num_rows):
                key = batch.column(0)[r].as_py()
                if key != now:
                    if now is not None:
                        yield row(now, states)
                    now, states, skip = key, [hashlib.sha256() for _ in texts], [lead] * len(texts)
                for k in range(len(texts)):
                    body = batch.column(k + 1)[r].as_py().encode()
                    states[k].update(body[skip[k]:])
                    skip[k] = max(0, skip[k] - len(body))
        if now is not None:
            yield row(now, states)

    return ordered.mapInArrow(run, schema)


def digested(parts: DataFrame, any_long: bool, id: str, sums: Sequence[str], texts: Sequence[str]) -> DataFrame:
    """One row per conversation of ``parts(key, id, chunk, long, *sums, *texts)``: sums, and a digest per text of its chunks in order.

    Without any conversation of several chunks (``any_long``) nothing has to meet.
    """
    short = parts.filter("NOT long").select(id, *sums, *[F.sha2(t, 256).alias(t) for t in texts])
    if not any_long:
        return short
    long = durable(parts.filter("long"))
    whole = long.groupBy("key", id).agg(*[F.sum(c).alias(c) for c in sums])
    return short.unionByName(whole.join(sha256_in_order(long, texts), "key").drop("key"))
