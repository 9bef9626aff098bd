"""Conversation structure repair: cheapest edits that make a conversation ``(system? (user assistant)+)?``.

Every row is a symbol: the initial of its role and its fault. Equal consecutive symbols form a run. A symbol is a matrix
over the four places in the pattern (beginning, after system, after user, after assistant) in min-plus algebra; a run of n
rows moves the vector of remaining costs by cached powers 1, 2, 4, ... of its matrix. From the vectors at the run's ends the
choices are unrolled row by row, forwards, for the audit.

A conversation of several chunks (see ``turns``) is settled in rounds over one small value per chunk: the chunk's matrix,
from which follow the costs behind every chunk; then where a chunk leads from each place, from which follows where every
chunk begins; then all chunks unroll on their own.

Null roles and texts count as one space; null turns come first; null ids are one conversation. Rows of one turn are ordered by role
and text, so repeated rows are adjacent. A role with another initial than s, u or a fits nowhere. Empty tables give no rows. Other
columns are not read, so their names cannot clash. Very long texts are handled whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ledgerloom.llm.arrays import tidy
from ledgerloom.llm.turns import CHUNK_BYTES, CHUNK_ROWS, chunked, in_order, sha256_in_order
from ledgerloom.scale import durable

BEGIN, SYSTEM, USER, ASSISTANT = range(4)
PLACES = range(4)
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
FAR = 1 << 50
#: What may come next at each place, and where it leads.
NEXT = (USER, USER, ASSISTANT, USER)
KEEP = {"s": {BEGIN: SYSTEM}, "u": {BEGIN: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
ROLE = {USER: "user", ASSISTANT: "assistant"}
LEGAL = {"su", "ua", "au"}
#: Costs behind the last row: what is missing is inserted.
END = (0, 2 * INSERT, INSERT, 0)
FINE, CUT, GONE = ".", "t", "x"

Vector = tuple[int, ...]
Matrix = tuple[Vector, ...]


def _edits(symbol: str, place: int) -> list[tuple[str, int, int]]:
    """(initial, place after, cost) of the edits of one row, in ASCII order."""
    role, fault = symbol
    edits = [("D", place, DELETE)]
    if fault != GONE:
        more = TRUNCATED if fault == CUT else 0
        if place in KEEP.get(role, ()):
            edits.append(("K", KEEP[role][place], more))
        edits.append(("R", NEXT[place], REROLE + more))
    return edits


def _times(a: Matrix, b: Matrix) -> Matrix:
    return tuple(tuple(min(FAR, *(a[i][k] + b[k][j] for k in PLACES)) for j in PLACES) for i in PLACES)


def _behind(a: Matrix, v: Vector) -> Vector:
    return tuple(min(a[i][j] + v[j] for j in PLACES) for i in PLACES)


@lru_cache(None)
def _power(symbol: str, k: int) -> Matrix:
    """The matrix of 2 ** k rows of one symbol; inserts may stand before each row."""
    if k:
        half = _power(symbol, k - 1)
        return _times(half, half)
    rows = []
    for place in PLACES:
        costs, at, paid = [FAR] * 4, place, 0
        for _ in PLACES:
            for _, to, cost in _edits(symbol, at):
                costs[to] = min(costs[to], paid + cost)
            at, paid = NEXT[at], paid + INSERT
        rows.append(tuple(costs))
    return tuple(rows)


def _runs(symbols: str) -> list[tuple[str, int]]:
    pairs = [symbols[k : k + 2] for k in range(0, len(symbols), 2)]
    return [(s, sum(1 for _ in g)) for s, g in groupby(pairs)]


def _before(symbol: str, n: int, v: Vector) -> Vector:
    """Remaining costs before a run of n rows, from those behind it."""
    k = 0
    while n:
        if n & 1:
            v = _behind(_power(symbol, k), v)
        n, k = n >> 1, k + 1
    return v


def matrix(symbols: str) -> Matrix:
    """The product of all runs."""
    out = tuple(tuple(0 if i == j else FAR for j in PLACES) for i in PLACES)
    for symbol, n in _runs(symbols):
        k = 0
        while n:
            if n & 1:
                out = _times(out, _power(symbol, k))
            n, k = n >> 1, k + 1
    return out


@lru_cache(1 << 16)
def _step(symbol: str, v: Vector) -> Vector:
    """Costs before one row, less their least (only differences decide)."""
    before = _behind(_power(symbol, 0), v)
    low = min(before)
    return tuple(x - low for x in before)


@lru_cache(1 << 16)
def _choose(symbol: str, v: Vector, place: int) -> tuple[str, int]:
    """Edits at one row, given the costs behind it: the ASCII-least of the cheapest; and the place after."""
    here, out = _behind(_power(symbol, 0), v), ""
    while True:
        options = [(c, to, cost + v[to]) for c, to, cost in _edits(symbol, place)] + [("I", NEXT[place], INSERT + here[NEXT[place]])]
        edit, place = min((c, to) for c, to, cost in options if cost == here[place])
        out += edit
        if edit != "I":
            return out, place


def unroll(symbols: str, behind: Vector, place: int) -> tuple[list[str], int]:
    """Edits of every row (an edit of the row itself ends each), and the place after the last."""
    runs = _runs(symbols)
    low = min(behind)
    v, ends = tuple(x - low for x in behind), []
    for symbol, n in reversed(runs):
        ends.append(v)
        v = _before(symbol, n, v)
        low = min(v)
        v = tuple(x - low for x in v)
    edits = []
    for symbol, n in runs:
        inside = [ends.pop()]
        for _ in range(n - 1):
            inside.append(_step(symbol, inside[-1]))
        for v in reversed(inside):
            edit, place = _choose(symbol, v, place)
            edits.append(edit)
    return edits, place


def closing(place: int) -> str:
    return "I" * (END[place] // INSERT)


def rewritten(turns: list[tuple[str, str]], edits: list[str], place: int, last: bool) -> list[dict]:
    """Turns after the edits."""
    out = []

    def put(role: str, text: str) -> None:
        out.append({"role": role, "text": text})

    for (role, text), edit in zip(turns, [*edits]):
        for c in edit:
            if c == "I":
                place = NEXT[place]
                put(ROLE[place], "")
            elif c == "R":
                place = NEXT[place]
                put(ROLE[place], text)
            elif c == "K":
                place = KEEP[role[:1]][place]
                put(role, text)
    for _ in closing(place) if last else ():
        place = NEXT[place]
        put(ROLE[place], "")
    return out


def damage(rows: DataFrame, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turn, role, text) with planted faults: by crc32 of ``id:turn`` modulo 20, row 0 goes, 1 loses its text, 2 its
    sentence marks, 3 comes twice, 4 is said by the user. Nulls count as one space."""
    said = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    kind = F.crc32(F.concat_ws(":", said(id), said(turn)).cast("binary")) % 20
    return rows.select(
        F.col(f"`{id}`").alias("conv_id"), F.col(f"`{turn}`").alias("turn"), F.when(kind == 4, "user").otherwise(said(role)).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(said(text), "[.!?]", "")).otherwise(said(text)).alias("text"), kind.alias("kind"),
    ).filter("kind <> 0").select(
        "conv_id", "turn", "role", "text", F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy")


_PART = T.StructType([T.StructField(c, t) for c, t in (
    ("key", T.StringType()), ("chunk", T.LongType()), ("long", T.BooleanType()), ("symbols", T.StringType()), ("blank", T.LongType()),
    ("duplicate", T.LongType()), ("truncated", T.LongType()), ("illegal", T.LongType()), ("low", T.LongType()), ("high", T.LongType()),
    ("n_turns", T.LongType()), ("cost", T.LongType()), ("audit", T.StringType()),
    ("repaired", T.ArrayType(T.StructType([T.StructField("role", T.StringType()), T.StructField("text", T.StringType())]))))])


def _marked(row: dict) -> dict:
    """Symbols and counts of one chunk; ``seen``, ``said`` and ``turn_before`` come from the chunks before it."""
    seen = set(row.get("seen") or ())
    before, symbols = row.get("said"), []
    counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
    for t in row["turns"]:
        role = t["role"]
        name = hashlib.md5(f"{len(role)}:{role}{t['text']}".encode()).hexdigest() if row["long"] else (role, t["text"])
        fault = None
        if t["last"] == "":
            fault = "blank"
        elif name in seen:
            fault = "duplicate"
        elif t["last"] not in ".!?":
            fault = "truncated"
        seen.add(name)
        if fault:
            counts[fault] += 1
        initial = role[:1]
        if before is not None and before + initial not in LEGAL:
            counts["illegal"] += 1
        before = initial
        symbols.append((initial if initial in KEEP else "?") + (CUT if fault == "truncated" else GONE if fault else FINE))
    turns = {t["turn"] for t in row["turns"]} - {None}
    n = len(turns) - (row.get("turn_before") in turns)
    return {"key": row["key"], "chunk": row["chunk"], "long": row["long"], "symbols": "".join(symbols), **counts,
            "low": min(turns, default=None), "high": max(turns, default=None), "n_turns": n}


def _repair_chunk(row: dict) -> dict:
    part = _marked(row)
    behind = tuple(row.get("behind") or END)
    place, last = row.get("place") or BEGIN, row.get("place_behind") is None
    edits, after = unroll(part["symbols"], behind, place)
    turns = [(t["role"], t["text"]) for t in row["turns"]]
    part["repaired"] = rewritten(turns, edits, place, last)
    part["audit"] = "".join(edits) + (closing(after) if last else "")
    part["cost"] = part["audit"].count("D") * DELETE + (part["audit"].count("I") + part["audit"].count("R")) * INSERT + sum(
        TRUNCATED for k, e in enumerate(edits) if part["symbols"][2 * k + 1] == CUT and e[-1] != "D")
    return part


def _each(task, schema: T.StructType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(schema)
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                yield pa.RecordBatch.from_pylist([task(r) for r in batch.slice(first, 256).to_pylist()], arrow)

    return tidy(run)


def _long_chunks(chunks: DataFrame) -> DataFrame:
    """Chunks of long conversations with what they need of the others: texts seen, the row before, costs behind, place."""
    ends = chunks.select("key", "chunk", F.substring(F.element_at("turns", -1)["role"], 1, 1).alias("initial"), F.element_at("turns", -1)["turn"].alias("turn"))
    by_chunk = Window.partitionBy("key").orderBy("chunk")
    carried = ends.select("key", "chunk", F.lag("initial").over(by_chunk).alias("said"), F.lag("turn").over(by_chunk).alias("turn_before"))
    text = chunks.select("key", "chunk", F.explode("turns").alias("t")).select(
        "key", "chunk", F.md5(F.concat(F.length("t.role").cast("string"), F.lit(":"), F.col("t.role"), F.col("t.text")).cast("binary")).alias("name")).distinct()
    first = text.groupBy("key", "name").agg(F.min("chunk").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    seen = text.join(first, ["key", "name"]).filter("chunk > first").groupBy("key", "chunk").agg(F.collect_set("name").alias("seen"))
    held = chunks.join(carried, ["key", "chunk"]).join(seen, ["key", "chunk"], "left")
    schema = T.StructType([T.StructField("key", T.StringType()), T.StructField("chunk", T.LongType()), T.StructField("symbols", T.StringType()),
                           T.StructField("matrix", T.ArrayType(T.LongType()))])

    def flat(row: dict) -> dict:
        part = _marked(row)
        return {"key": row["key"], "chunk": row["chunk"], "symbols": part["symbols"], "matrix": [x for r in matrix(part["symbols"]) for x in r]}

    symbols = durable(held.mapInArrow(_each(flat, schema), schema))

    def backwards(matrices: list) -> list:
        out, v = [], END
        for m in reversed(matrices):
            out.append(list(v))
            v = _behind(tuple(tuple(m[4 * i : 4 * i + 4]) for i in PLACES), v)
        return out[::-1]

    behind = durable(in_order(symbols, "matrix", backwards, T.ArrayType(T.LongType())).withColumnRenamed("matrix", "behind"))
    exits = T.StructType([T.StructField("key", T.StringType()), T.StructField("chunk", T.LongType()), T.StructField("place", T.ArrayType(T.LongType()))])
    leads = symbols.drop("matrix").join(behind, ["key", "chunk"]).mapInArrow(
        _each(lambda r: {"key": r["key"], "chunk": r["chunk"], "place": [unroll(r["symbols"], tuple(r["behind"]), p)[1] for p in PLACES]}, exits), exits)

    def forwards(maps: list) -> list:
        places = [BEGIN]
        for m in maps:
            places.append(m[places[-1]])
        return [[a, b] for a, b in zip(places, [*places[1:-1], None])]

    places = in_order(leads, "place", forwards, T.ArrayType(T.LongType()))
    return held.join(behind, ["key", "chunk"]).join(places, ["key", "chunk"]).withColumns(
        {"place_behind": F.col("place")[1], "place": F.col("place")[0]})


def repair(rows: DataFrame, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           chunk_rows: int = CHUNK_ROWS, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(key, id, chunk, long, counts of faults, cost, audit, repaired): one row per chunk of a conversation.

    ``repaired`` holds the chunk's turns after the edits, ``audit`` the initials of its edits (Delete, Insert, Keep, Rerole).
    The result is a stored table.
    """
    last = F.right(F.rtrim(F.col("text"), F.lit(" \t\n\x0b\x0c\r")), F.lit(1))
    one_space = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    clean = rows.select(F.col(f"`{id}`").alias(id), F.col(f"`{turn}`").cast("bigint").alias("turn"), one_space(role).alias("role"), one_space(text).alias("text"))
    chunks = chunked(clean.withColumn("last", last), id, ["turn", "role", "text"], "text", chunk_rows, chunk_bytes)
    extra = chunks.schema[id]
    schema = T.StructType([*_PART, T.StructField("id", extra.dataType)])

    def task(row: dict) -> dict:
        return {**_repair_chunk(row), "id": row[extra.name]}

    short = chunks.filter("NOT long").mapInArrow(_each(task, schema), schema)
    long = chunks.filter("long")
    if long.isEmpty():
        parts = short
    else:
        parts = short.unionAll(_long_chunks(long).mapInArrow(_each(task, schema), schema))
    return durable(parts.withColumnRenamed("id", id))


def summary(parts: DataFrame, id: str = "conv_id") -> DataFrame:
    """One row per conversation: gaps, counts, cost, audit and the digest of ``role:text`` lines of the repaired turns."""
    counts = ("blank", "duplicate", "truncated", "illegal", "cost")
    body = F.array_join(F.transform("repaired", lambda t: F.concat(F.lit("\n"), t["role"], F.lit(":"), t["text"])), "")
    gaps = lambda low, high, n: F.coalesce(high - low + 1 - n, F.lit(0)).cast("bigint").alias("gaps")
    short = parts.filter("NOT long").select(
        id, gaps(F.col("low"), F.col("high"), F.col("n_turns")), *counts, "audit", F.sha2(F.substr(body, F.lit(2)), 256).alias("repaired_sha256"))
    if parts.filter("long").isEmpty():
        return short
    long = durable(parts.filter("long").withColumn("body", body).drop("repaired", "symbols"))
    audit = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("chunk", "audit"))), lambda x: x["audit"]), "")
    whole = long.groupBy("key", id).agg(
        gaps(F.min("low"), F.max("high"), F.sum("n_turns")), *[F.sum(c).alias(c) for c in counts], audit.alias("audit"))
    digest = sha256_in_order(long, ["body"], lead=1).withColumnRenamed("body", "repaired_sha256")
    return short.unionByName(whole.join(digest, "key").drop("key"))
