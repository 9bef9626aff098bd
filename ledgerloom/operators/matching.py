"""One-to-one record linkage: rows in order, each takes its best partner that is still free.

Rows that compete, directly or through others, form a connected component, and components don't influence each other. A
component of at most ``COMPONENT_ROWS`` rows and pairs is settled by the sequential rule itself, inside one task; all
components run in parallel. Where a column already tells rows apart that can't meet (a date, an amount), its values are blocks
of components, and only blocks beyond that size are taken apart.

For larger components the rule ("serial dictatorship") is computed in parallel rounds of proposals. Every row
proposes to its best partner that has not refused it; a partner keeps the earliest proposer and refuses the others;
refused rows move on to their next choice. Because all partners rank rows the same way (by order), the
stable outcome is unique and equals the sequential one, whatever the number of rounds. A round carries the refused rows and the
partners they touch only, and a row passes over all partners that earlier rows hold: they would refuse it for good.

Where very many different texts share a date and amount, not all pairs become rows. By edit similarity, the earliest rows are settled
first, from the best pairs of each, and the next ones with what is left. By matching blocks, pairs are made in bands of falling upper bounds
(letters that two texts have in common), and a row that has found a partner above its band needs no further ones. The outcome over
the pairs known so far is final for such rows; only rows left over, and those they displace, go on to the next band.

Copies are matched as classes. Rows that agree on everything the candidate test reads form one class,
candidate pairs exist between classes only, and a class of partners has a capacity. A class is consumed in
order, so the j-th row that ends up at a class gets its j-th member. The size of a group of copies
therefore never enters the number of candidate pairs.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.fixed_values import OWNER_PAYOUT_CATEGORY
from ledgerloom.functions.similarity import (
    EditDistances, blocks_bound, edit_bound, edit_similarity, letter_counts, matching_blocks_ratio, token_set_quick, token_set_ratio,
)
from ledgerloom.functions.text import vendor_key
from ledgerloom.scale import CHUNK_ROWS, chunk_of, components, computed_once, durable, group_rank, islands, join_unique, needs_spreading

_SEP = "\u0001"
COMPONENT_ROWS = 4_000_000
#: Rows and choices of a larger component that one task settles at a time.
EARLIEST_ROWS = 400_000
#: Rows and pairs of blocks that share a task, about.
BIN_ROWS = 50_000
#: Rounds whose tables are read side by side before they become one.
ROUNDS_KEPT = 16
ROW = ("root", "q_id", "q_ord", "list", "n_choices")
#: Pairs of different texts on one date that are scored without asking whether they are needed.
ALL_PAIRS = 4_000_000
#: Upper bounds of similarity at which bands of pairs begin.
BANDS = (0.9, 0.75, 0.6, 0.45, 0.0)
#: Offers of one date and amount that share a task while pairs are made, and seekers that are compared with them there.
PIECE_ROWS = 100_000
BLOCK_ROWS = 250
#: Best pairs of a seeker that are kept at first, and how many times more each time they were not enough.
BEST = 24
MORE = 64
#: Seekers of one date that are settled for good before the next ones are compared with what is left.
STEP_ROWS = 10_000


def class_key(*parts: Column) -> Column:
    """Text key of a class of interchangeable rows."""
    return F.concat_ws(_SEP, *[F.coalesce(p.cast("string"), F.lit("\u0000")) for p in parts])


def _ranked(df: DataFrame, group: list[str], order: str, stored: DataFrame) -> DataFrame:
    spread = needs_spreading(df, group, stored=stored)
    chunk = F.lit(0)
    if spread:
        # Orders may be sparse: a chunk spans as much of their range as holds about CHUNK_ROWS of the rows.
        low, high, n = stored.agg(F.min(order), F.max(order), F.count(F.lit(1))).first() if order in stored.columns else df.agg(F.min(order), F.max(order), F.count(F.lit(1))).first()
        chunk = chunk_of(F.col(order) - F.lit(low), max(1, (high - low + 1) * CHUNK_ROWS // max(n, 1)))
    return group_rank(df, group, chunk, [order], "place", spread=spread)


def _pair_exclusive(seekers: DataFrame, offers: DataFrame, edges: DataFrame) -> DataFrame:
    """Classes that only have each other: k-th to k-th."""
    q = _ranked(seekers.join(edges, "q_class"), ["q_class"], "q_ord", seekers)
    w = _ranked(offers.join(edges.select("q_class", "w_class"), "w_class"), ["w_class"], "w_ord", offers)
    return q.join(w.select("q_class", "place", "w_id"), ["q_class", "place"]).select("q_id", "w_id", "score")


def _propose(seekers: DataFrame, offers: DataFrame, edges: DataFrame) -> DataFrame:
    """Rounds of proposals between classes that compete."""
    # Classes that tie for some seeker are taken apart: ties go to the earliest single offer.
    several = edges.groupBy("q_class", "score").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    tied = (
        edges.join(several, ["q_class", "score"], "left_semi").select("w_class").distinct()
        .withColumn("tied", F.lit(True))
    )
    offers = durable(
        offers.join(edges.select("w_class").distinct(), "w_class", "left_semi").join(tied, "w_class", "left")
        .withColumn("slot", F.when(F.col("tied"), F.col("w_ord")).otherwise(F.lit(-1).cast("bigint")))
        .drop("tied")
    )
    slots = offers.groupBy("w_class", "slot").agg(
        F.count(F.lit(1)).alias("capacity"), F.min("w_ord").alias("head")
    )
    choice = Window.partitionBy("q_class").orderBy(F.desc("score"), "head")
    choices = durable(
        edges.join(slots, "w_class").withColumn("choice", F.row_number().over(choice)).select(
            "q_class", "choice", "w_class", "slot", "capacity", "score"
        )
    )
    # Classes with the same list in the same order are one.
    lists = choices.groupBy("q_class").agg(
        F.count(F.lit(1)).alias("n_choices"), F.sum(F.xxhash64("choice", "w_class", "slot", "score").cast("decimal(20,0)")).alias("mark"))
    same = durable(lists.join(lists.groupBy("n_choices", "mark").agg(F.min("q_class").alias("list")), ["n_choices", "mark"]).select("q_class", "list", "n_choices"))
    choices = durable(choices.join(same.select("list").distinct(), F.col("q_class") == F.col("list"), "left_semi").withColumnRenamed("q_class", "list"))
    # The j-th row of a list cannot get anything before the j-th place on it, so it begins there.
    places = choices.withColumn("upto", F.sum("capacity").over(Window.partitionBy("list").orderBy("choice"))).select(
        "list", "choice", (F.col("upto") - F.col("capacity")).alias("after"), "upto")
    inside = durable(seekers.join(same, "q_class"))
    state = (
        _ranked(inside, ["list"], "q_ord", inside).join(places, "list")
        .filter((F.col("place") > F.col("after")) & (F.col("place") <= F.col("upto")))
        .select(*ROW, "choice")
    )
    held = _frontier_rounds(durable(state), choices)
    ranked = _ranked(held, ["w_class", "slot"], "q_ord", held)
    members = _ranked(offers, ["w_class", "slot"], "w_ord", offers)
    return ranked.join(members, ["w_class", "slot", "place"]).select("q_id", "w_id", "score")


def _frontier_rounds(frontier: DataFrame, choices: DataFrame) -> DataFrame:
    """Rows and the slots that hold them in the end; a round reads and writes what its refused rows touch.

    ``frontier(root, q_id, q_ord, list, n_choices, choice)``; ``choices(list, choice, w_class, slot, capacity, score)``. A slot that is
    full has a last holder, and refuses all later rows. Acceptances and last holders are only added to: last holders only become
    earlier, and a slot holds the rows accepted so far that are not later than its last holder.

    Where rows push each other on in long chains, a round settles few of them. Then the earliest rows of every component are settled
    by the rule itself, as many as fit one task: nothing that comes later can change what they get.
    """
    slot, width, size = ["w_class", "slot"], 4, frontier.count()
    accepted: list[DataFrame] = []
    lasts: list[DataFrame] = []

    def now(parts: list[DataFrame]) -> DataFrame:
        return reduce(DataFrame.unionByName, parts)

    def holders() -> DataFrame:
        last = now(lasts).groupBy(*slot).agg(F.min("last").alias("last"))
        return now(accepted).join(last, slot, "left").filter("last IS NULL OR q_ord <= last").drop("last")

    def rank(rivals: DataFrame) -> DataFrame:
        """Settle who stays at the touched slots; the refused rows, one choice further."""
        rivals = durable(rivals)
        rivals = durable(_ranked(rivals, slot, "q_ord", rivals))
        accepted.append(rivals.filter("new AND place <= capacity").drop("place", "new"))
        lasts.append(rivals.filter("place = capacity").select(*slot, F.col("q_ord").alias("last")))
        return rivals.filter("place > capacity").select(*ROW, (F.col("choice") + 1).alias("choice"))

    while size:
        # The next few choices of every row, less the slots that would refuse it.
        ahead = frontier.withColumn(
            "choice", F.explode(F.sequence(F.col("choice"), F.least(F.col("choice") + width - 1, F.col("n_choices")))))
        ahead = ahead.join(choices, ["list", "choice"])
        if lasts:
            ahead = ahead.join(now(lasts).groupBy(*slot).agg(F.min("last").alias("last")), slot, "left").filter("last IS NULL OR q_ord < last").drop("last")
        best = F.min_by(F.struct("choice", *slot, "capacity", "score"), "choice").alias("b")
        proposed = durable(ahead.groupBy(*ROW).agg(best).select(*ROW, "b.*"))
        rivals = proposed.withColumn("new", F.lit(True))
        if accepted:
            touched = proposed.select(*slot).distinct()
            rivals = rivals.unionByName(holders().join(touched, slot, "left_semi").withColumn("new", F.lit(False)))
        refused = rank(rivals)
        passed = frontier.join(proposed.select("q_id"), "q_id", "left_anti").withColumn("choice", F.col("choice") + width)
        # Rows whose list is exhausted drop out.
        frontier = durable(refused.unionByName(passed).filter("choice <= n_choices"))
        before, size = size, frontier.count()
        width = min(2 * width, 256)
        if 2 * size > before:
            frontier = _settle_earliest(frontier, choices, holders(), rank)
            size = frontier.count()
        if len(accepted) >= ROUNDS_KEPT:
            accepted, lasts = [durable(holders())], [durable(now(lasts).groupBy(*slot).agg(F.min("last").alias("last")))]
    if not accepted:
        return frontier.join(choices, ["list", "choice"]).select("q_id", "q_ord", *slot, "score")
    return durable(holders().select("q_id", "q_ord", *slot, "score"))


def _settle_earliest(frontier: DataFrame, choices: DataFrame, holders: DataFrame, rank: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Settle the earliest unsettled rows of every component in one task each; the frontier that is left.

    Rows earlier than all of a component's frontier are final. From there on, rows are taken up to an order that leaves about
    ``EARLIEST_ROWS`` rows and choices to the task.
    """
    slot = ["w_class", "slot"]
    start = frontier.groupBy("root").agg(F.min("q_ord").alias("start"))
    holders = durable(holders.join(start, "root"))
    open_rows = holders.filter("q_ord >= start").select(*ROW).unionByName(frontier.select(*ROW))
    size = open_rows.groupBy("root", "list").agg(F.count(F.lit(1)).alias("n"), F.first("n_choices").alias("m")).groupBy("root").agg(F.sum(F.col("n") + F.col("m")).alias("size"))
    # Any border is right; the sketch only makes the share fit.
    share = F.least(F.lit(1.0), F.lit(max(min(COMPONENT_ROWS, EARLIEST_ROWS), 1)) / F.col("size"))
    sketch = open_rows.groupBy("root").agg(F.percentile_approx("q_ord", [k / 100 for k in range(101)], 10_000).alias("at"))
    border = durable(sketch.join(size, "root").join(start, "root").select("root", "start", F.greatest(F.col("start"), F.get("at", F.floor(share * 100).cast("int"))).alias("border")))
    taken = durable(open_rows.join(border, "root").filter("q_ord <= border").select(*ROW))
    full = holders.filter("q_ord < start").groupBy(*slot).agg(F.count(F.lit(1)).alias("gone"))
    lists = (
        choices.join(taken.select("root", "list").distinct(), "list").join(full, slot, "left")
        .withColumn("room", F.col("capacity") - F.coalesce("gone", F.lit(0))).filter("room > 0").drop("gone")
    )
    rows = taken.withColumn("room", F.lit(None).cast("long")).unionByName(lists, allowMissingColumns=True)
    schema = T.StructType([taken.schema["q_id"], *[choices.schema[c] for c in ("choice", *slot, "capacity", "score")]])
    outcome = taken.join(rows.groupBy("root").applyInArrow(_first_with_room, schema), "q_id")
    outcome = durable(outcome.join(holders.select("q_id", *[F.col(c).alias(f"h_{c}") for c in slot]), "q_id", "left").withColumn(
        "stays", (F.col("w_class") == F.col("h_w_class")) & (F.col("slot") == F.col("h_slot"))))
    moved = outcome.filter("stays IS NULL OR NOT stays").drop("stays", "h_w_class", "h_slot")
    others = holders.join(border.select("root", "border"), "root").join(outcome.select(*slot).distinct(), slot, "left_semi")
    # What the settled rows held before and no longer do is no rival.
    others = others.filter("q_ord < start OR q_ord > border").unionByName(
        others.filter("q_ord >= start AND q_ord <= border").join(outcome.filter("stays").select("q_id"), "q_id", "left_semi"))
    refused = rank(moved.withColumn("new", F.lit(True)).unionByName(others.drop("start", "border").withColumn("new", F.lit(False))))
    later = frontier.join(border, "root").filter("q_ord > border").select(*ROW, "choice")
    return durable(refused.unionByName(later).filter("choice <= n_choices"))


def _first_with_room(table: pa.Table) -> pa.Table:
    """Rows of one component in order, each takes the first slot on its list that has room."""
    lists: dict[str, list] = {}
    room: dict[tuple, int] = {}
    rows = []
    for row in table.to_pylist():
        if row["q_id"] is not None:
            rows.append((row["q_ord"], row["q_id"], row["list"]))
        else:
            lists.setdefault(row["list"], []).append((row["choice"], (row["w_class"], row["slot"]), row["capacity"], row["score"]))
            room[row["w_class"], row["slot"]] = row["room"]
    for choices in lists.values():
        choices.sort()
    begin = dict.fromkeys(lists, 0)  # slots before it are full for good
    out = []
    for _, q_id, name in sorted(rows):
        choices, k = lists.get(name, ()), begin.get(name, 0)
        while k < len(choices) and not room[choices[k][1]]:
            k += 1
        begin[name] = k
        if k < len(choices):
            choice, place, capacity, score = choices[k]
            room[place] -= 1
            out.append((q_id, choice, *place, capacity, score))
    names = ["q_id", "choice", "w_class", "slot", "capacity", "score"]
    types = [table.schema.field(c).type for c in names]
    return pa.table([pa.array(v, t) for v, t in zip(zip(*out) if out else [()] * len(names), types)], names)


def _settle(table: pa.Table) -> pa.Table:
    """The sequential rule on whole components: rows (seekers), offers and pairs of classes in one table."""
    seekers, offers, pairs = (table.filter(pc.equal(table["kind"], kind)) for kind in ("seeker", "offer", "pair"))
    row_q, pair_q = _codes(seekers["q_class"], pairs["q_class"])
    row_w, pair_w = _codes(offers["w_class"], pairs["w_class"])
    # Members of a class of offers stand together in order; a class is consumed from ``free`` to ``end``.
    w_ord, score = offers["w_ord"].to_numpy(), pairs["score"].to_numpy()
    members = np.lexsort((w_ord, row_w))
    n_w, n_q = (int(max(x.max(initial=-1), y.max(initial=-1))) + 1 for x, y in ((row_w, pair_w), (row_q, pair_q)))
    free, end = (np.searchsorted(row_w[members], np.arange(n_w), side) for side in ("left", "right"))
    orders = w_ord[members]
    kept = np.flatnonzero(free[pair_w] < end[pair_w])
    pair_q, pair_w, score = pair_q[kept], pair_w[kept], score[kept]
    head = orders[free[pair_w]]
    listed = np.lexsort((head, -score, pair_q))
    begin, stop = (np.searchsorted(pair_q[listed], np.arange(n_q), side) for side in ("left", "right"))
    w, score, head = (memoryview(np.ascontiguousarray(x[listed])) for x in (pair_w, score, head))
    free, end, orders, begin, stop = (memoryview(np.ascontiguousarray(x)) for x in (free, end, orders, begin, stop))
    q_rows, w_rows, scores = [], [], []
    for row in np.argsort(seekers["q_ord"].to_numpy(), kind="stable").tolist():
        q = int(row_q[row])
        i, last = begin[q], stop[q]
        while i < last and free[w[i]] == end[w[i]]:
            i += 1
        begin[q] = i  # what stands before it is used up for good
        if i == last:
            continue
        pick, best, j = i, orders[free[w[i]]], i + 1
        # Heads only move on, so an equal score further down counts while its first head is earlier.
        while j < last and score[j] == score[i] and head[j] < best:
            if free[w[j]] < end[w[j]] and orders[free[w[j]]] < best:
                pick, best = j, orders[free[w[j]]]
            j += 1
        q_rows.append(row)
        w_rows.append(members[free[w[pick]]])
        scores.append(score[pick])
        free[w[pick]] += 1
    at = lambda column, rows: column.take(pa.array(rows, pa.int64()))
    return pa.table({"q_id": at(seekers["q_id"], q_rows), "w_id": at(offers["w_id"], w_rows), "score": pa.array(scores, pa.float64())})


def _codes(*columns: pa.ChunkedArray) -> list[np.ndarray]:
    """Columns with numbers in place of their values, the same for equal values."""
    whole = pa.chunked_array([chunk for c in columns for chunk in c.chunks], columns[0].type).combine_chunks()
    whole = whole.combine_chunks() if isinstance(whole, pa.ChunkedArray) else whole
    codes = whole.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    return np.split(codes, np.cumsum([len(c) for c in columns])[:-1])


def _contested(seekers: DataFrame, offers: DataFrame, edges: DataFrame) -> DataFrame:
    """Small components by the rule itself, larger ones by rounds of proposals."""
    node = lambda side, c: F.xxhash64(F.lit(side), F.col(c))
    roots = components(edges.select(node("q", "q_class").alias("a"), node("w", "w_class").alias("b")))
    roots = durable(roots.union(roots.select(F.col("root"), "root")).distinct())
    pairs = durable(edges.join(roots.withColumnRenamed("node", "n"), node("q", "q_class") == F.col("n")).drop("n"))
    own = lambda rows, c: rows.join(pairs.select(c, "root").distinct(), c)
    q, w = durable(own(seekers, "q_class")), durable(own(offers, "w_class"))
    sizes = (
        pairs.select("root").unionAll(q.select("root")).unionAll(w.select("root"))
        .groupBy("root").agg(F.count(F.lit(1)).alias("n"))
    )
    large = durable(sizes.filter(F.col("n") > COMPONENT_ROWS).select("root"))
    rows = (
        q.withColumn("kind", F.lit("seeker"))
        .unionByName(w.withColumn("kind", F.lit("offer")), allowMissingColumns=True)
        .unionByName(pairs.withColumn("kind", F.lit("pair")), allowMissingColumns=True)
    )
    schema = T.StructType([seekers.schema["q_id"], offers.schema["w_id"], T.StructField("score", T.DoubleType())])
    settled = rows.join(large, "root", "left_anti").groupBy("root").applyInArrow(_settle, schema)
    if large.isEmpty():
        return settled
    rest = lambda df: df.join(large, "root", "left_semi")
    return settled.unionByName(_propose(durable(rest(q)), durable(rest(w).drop("root")), durable(rest(pairs).drop("root"))))


def assign_in_order(seekers: DataFrame, offers: DataFrame, edges: DataFrame) -> DataFrame:
    """Exact in-order assignment.

    ``seekers(q_id, q_ord, q_class)``, ``offers(w_id, w_ord, w_class)``, ``edges(q_class, w_class, score)`` with
    one row per pair of classes. Orders are unique integers; all three are read several times and should be stored tables. Returns ``(q_id, w_id, score)``:
    each seeker in order takes the free offer with the best score, the earliest offer on ties.

    All three may carry a ``block`` that no pair leaves. Blocks of at most ``COMPONENT_ROWS`` rows and pairs are then settled by the
    rule itself, many in one task, without looking for their components.
    """
    if "block" not in edges.columns:
        return _assign(seekers.drop("block"), offers.drop("block"), edges)
    seekers, offers = seekers.filter("block IS NOT NULL"), offers.filter("block IS NOT NULL")
    rows = (
        seekers.withColumn("kind", F.lit("seeker"))
        .unionByName(offers.withColumn("kind", F.lit("offer")), allowMissingColumns=True)
        .unionByName(edges.withColumn("kind", F.lit("pair")), allowMissingColumns=True)
    )
    bins = max(1, -(-rows.count() // BIN_ROWS))
    rows = rows.withColumn("bin", F.pmod(F.xxhash64("block"), F.lit(bins)))
    # Bins are few and counted first: only a full one can hold a large block, and its blocks go apart.
    n = F.count(F.lit(1)).alias("n")
    full = durable(rows.groupBy("bin").agg(n).filter(F.col("n") > COMPONENT_ROWS).select("bin"))
    schema = T.StructType([seekers.schema["q_id"], offers.schema["w_id"], T.StructField("score", T.DoubleType())])
    if full.isEmpty():
        return rows.drop("block").groupBy("bin").applyInArrow(_settle, schema)
    in_full = lambda df, how: df.join(full, "bin", how)
    large = durable(in_full(rows, "left_semi").groupBy("block").agg(n).filter(F.col("n") > COMPONENT_ROWS).select("block"))
    settled = in_full(rows, "left_anti").drop("block").groupBy("bin").applyInArrow(_settle, schema).unionByName(
        in_full(rows, "left_semi").drop("bin").join(large, "block", "left_anti").groupBy("block").applyInArrow(_settle, schema))
    if large.isEmpty():
        return settled
    return settled.unionByName(_assign(*[durable(df.join(large, "block", "left_semi").drop("block")) for df in (seekers, offers, edges)]))


def _assign(seekers: DataFrame, offers: DataFrame, edges: DataFrame) -> DataFrame:
    q_degree = edges.groupBy("q_class").agg(F.count(F.lit(1)).alias("q_degree"))
    w_degree = edges.groupBy("w_class").agg(F.count(F.lit(1)).alias("w_degree"))
    marked = durable(
        edges.join(q_degree, "q_class").join(w_degree, "w_class")
        .withColumn("exclusive", (F.col("q_degree") == 1) & (F.col("w_degree") == 1))
        .select("q_class", "w_class", "score", "exclusive")
    )
    columns = ["q_class", "w_class", "score"]
    paired = _pair_exclusive(seekers, offers, marked.filter("exclusive").select(*columns))
    contested = marked.filter("NOT exclusive").select(*columns)
    if contested.isEmpty():
        return paired
    return paired.unionByName(_contested(seekers, offers, contested))


def _cents(tolerance: float) -> Decimal:
    return Decimal(str(tolerance)).quantize(Decimal("0.01"))


def _bucket(money: Column, tolerance: float) -> Column:
    """Amounts within the tolerance fall into the same or into neighboring buckets; without one, equal amounts do."""
    tol = _cents(tolerance)
    return F.floor(money / F.lit(str(tol)).cast("decimal(18,2)")) if tol else money.cast("decimal(18,2)")


def _near_money(money: Column, tolerance: float) -> Column:
    bucket = _bucket(money, tolerance)
    return _near(bucket) if _cents(tolerance) else bucket


def _cell(money: Column, tolerance: float) -> Column:
    """Wide buckets: most amounts reach into one or two of them (see ``_cells_in_reach``)."""
    return _bucket(money, 4 * tolerance)


def _cells_in_reach(money: Column, tolerance: float) -> Column:
    tol = F.lit(str(_cents(tolerance))).cast("decimal(18,2)")
    return F.explode(F.sequence(*[_cell(x, tolerance).cast("bigint") for x in (money - tol, money + tol)])) if _cents(tolerance) else _cell(money, 0)


def _near(bucket: Column) -> Column:
    return F.explode(F.array(bucket - 1, bucket, bucket + 1))


def match_date_amount(
    queue: DataFrame,
    worksheet: DataFrame,
    *,
    tolerance: float = 0.50,
    similarity: str = "blocks",
    all_pairs: int = ALL_PAIRS,
) -> DataFrame:
    """Pair queue rows with worksheet rows of the same date and nearly the same amount.

    ``queue(q_id, q_ord, date, amount, description)``; ``worksheet(w_id, w_ord, date, cost, source)``. Bank
    amounts are compared by size. Similarity of texts only decides between several candidates, so it is
    computed for those alone. ``similarity``: 'blocks' (exact rule) or 'edit' (no Python on the executors). Dates with more than
    ``all_pairs`` pairs of different texts have their pairs made in bands; the outcome is the same.
    """
    tol = F.lit(str(tolerance)).cast("decimal(18,2)")
    # Both sides are parsed and keyed once; every later step reads the stored rows.
    q = durable(queue.filter("date IS NOT NULL AND amount IS NOT NULL").select(
        "q_id", "q_ord", "date", F.abs("amount").alias("size"), F.lower(F.coalesce("description", F.lit(""))).alias("a")))
    w = durable(worksheet.filter("date IS NOT NULL AND cost IS NOT NULL").select(
        "w_id", "w_ord", "date", "cost", F.lower(F.coalesce("source", F.lit(""))).alias("b")))
    q, qc = _numbered(q, ["date", "size", "a"], "q_class", "q_ord")
    w, wc = _numbered(w, ["date", "cost", "b"], "w_class", "w_ord")
    qc = qc.withColumn("bucket", _bucket(F.col("size"), tolerance))
    wc = wc.withColumn("bucket", _near_money(F.col("cost"), tolerance))
    crowded = durable(_crowded_dates(q, w, qc, wc, all_pairs))
    if crowded.isEmpty():
        return _match_all_pairs(q, w, qc, wc, tol, similarity)
    rest = lambda df: df.join(crowded, "date", "left_anti")
    hot = lambda df: durable(df.join(crowded, "date", "left_semi"))
    near = (hot(q), hot(w), hot(qc), hot(wc), tol)
    matched = _match_in_bands(*near, similarity) if similarity == "blocks" else _match_by_best(*near)
    return _match_all_pairs(durable(rest(q)), durable(rest(w)), rest(qc), rest(wc), tol, similarity).unionByName(matched)


def _numbered(rows: DataFrame, key: list[str], name: str, order: str) -> tuple[DataFrame, DataFrame]:
    """Rows with the number of their class (its first order, short on the way where texts are not), and the classes."""
    classes = durable(rows.groupBy(*key).agg(F.min(order).cast("long").alias(name)))
    return durable(rows.join(classes, key).drop(*[k for k in key if k != "date"])), classes


def _crowded_dates(q: DataFrame, w: DataFrame, qc: DataFrame, wc: DataFrame, all_pairs: int) -> DataFrame:
    """Dates whose classes make more than ``all_pairs`` pairs."""

    def products(left: DataFrame, right: DataFrame, *by: str) -> DataFrame:
        n = lambda df, name: df.groupBy(*by).agg(F.count(F.lit(1)).cast("double").alias(name))
        pairs = n(left, "n").join(n(right, "m"), list(by)).groupBy("date").agg(F.sum(F.col("n") * F.col("m")).alias("pairs"))
        return pairs.filter(F.col("pairs") > all_pairs).select("date")

    # Rows are counted first: where they make few pairs, their classes do, too.
    rows = durable(products(q, w, "date"))
    if rows.isEmpty():
        return rows
    some = lambda df: df.join(rows, "date", "left_semi")
    return products(some(qc), some(wc), "date", "bucket")


def _scored(pairs: DataFrame, similarity: str) -> DataFrame:
    """Pairs with a score in place of their texts ``a`` and ``b``."""
    if similarity == "blocks":
        # Equal texts need no comparison; only the rest goes to Python.
        equal = pairs.filter("a = b").withColumn("score", F.lit(1.0))
        pairs = equal.unionByName(pairs.filter("a <> b").withColumn("score", matching_blocks_ratio(F.col("a"), F.col("b"))))
    else:
        pairs = pairs.withColumn("score", edit_similarity(F.col("a"), F.col("b")))
    return pairs.drop("a", "b")


def _rows(q: DataFrame, w: DataFrame) -> tuple[DataFrame, DataFrame]:
    return q.select("q_id", "q_ord", "q_class", F.col("date").alias("block")), w.select("w_id", "w_ord", "w_class", F.col("date").alias("block"))


def _match_all_pairs(q: DataFrame, w: DataFrame, qc: DataFrame, wc: DataFrame, tol: Column, similarity: str) -> DataFrame:
    pairs = qc.join(wc, ["date", "bucket"]).filter(F.abs(F.col("size") - F.col("cost")) <= tol)
    pairs = pairs.select("q_class", "w_class", F.col("date").alias("block"), "a", "b")
    if similarity == "blocks":
        # Only rows with a choice need scores, which cost more than a second look at the pairs.
        pairs = durable(pairs)
        several = pairs.groupBy("q_class").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("q_class")
        single = pairs.join(several, "q_class", "left_anti").select("q_class", "w_class", "block", F.lit(0.0).alias("score"))
        edges = durable(_scored(pairs.join(several, "q_class", "left_semi"), similarity).unionByName(single))
    else:
        edges = durable(_scored(pairs, similarity))
    return assign_in_order(*_rows(q, w), edges).select("q_id", "w_id")


def _match_in_bands(q: DataFrame, w: DataFrame, qc: DataFrame, wc: DataFrame, tol: Column, similarity: str, bands: tuple[float, ...] = BANDS) -> DataFrame:
    """The rule for crowded dates, with pairs made band by band.

    A seeker's pairs are complete above the bound of its band. Rows without a partner go on to the next band; of its offers those
    that earlier rows hold are left out: an offer only ever passes to earlier rows.
    """
    pieces = wc.groupBy("date", "bucket").agg(F.ceil(F.count(F.lit(1)) / PIECE_ROWS).cast("int").alias("pieces"))
    offers = durable(wc.join(pieces, ["date", "bucket"]).select(
        "w_class", "date", "bucket", "cost", "b", F.length("b").alias("m"), letter_counts(F.col("b")).alias("y"),
        F.pmod(F.xxhash64("w_class"), F.col("pieces")).cast("int").alias("piece")))
    texts = durable(qc.join(pieces, ["date", "bucket"]).select(
        "q_class", "date", "bucket", "size", "a", F.length("a").alias("n"), letter_counts(F.col("a")).alias("x"),
        F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece")))
    bound = (blocks_bound if similarity == "blocks" else edit_bound)(F.col("n"), F.col("x"), F.col("m"), F.col("y"))
    edge = F.array(*[F.lit(x) for x in (2.0, *bands)])  # a class that has seen k bands knows all pairs above edge[k]
    level = durable(qc.select("q_class", F.lit(0).alias("seen")))
    going = level.withColumn("first", F.lit(-1).cast("long"))
    reach, known = None, None
    while True:
        # Pairs of the next band of every class that goes on, with offers that may still take one of its rows.
        pairs = texts.join(going, "q_class").join(offers, ["date", "bucket", "piece"]).filter(F.abs(F.col("size") - F.col("cost")) <= tol)
        if reach is not None:
            pairs = pairs.join(reach, "w_class").filter("reach IS NULL OR first < reach")
        fresh = pairs.withColumn("bound", bound + 1e-9).filter(  # a score may be rounded up
            (F.col("bound") < F.get(edge, F.col("seen"))) & (F.col("bound") >= F.get(edge, F.col("seen") + 1))).select("q_class", "w_class", "a", "b")
        fresh = _scored(durable(fresh), similarity)
        known = durable(fresh if known is None else known.unionByName(fresh))
        level = durable(level.join(going.select("q_class", F.lit(1).alias("more")), "q_class", "left").select(
            "q_class", (F.col("seen") + F.coalesce("more", F.lit(0))).alias("seen")))
        complete = durable(known.join(level, "q_class").filter(F.col("score") >= F.get(edge, F.col("seen"))).select("q_class", "w_class", "score"))
        found = durable(assign_in_order(*_rows(q, w), complete).select("q_id", "w_id"))
        # An earlier row of a class may lose its partner yet, so the class's first row decides which offers are out of reach.
        left = q.groupBy("q_class").agg(F.min("q_ord").alias("first")).join(q.join(found, "q_id", "left_anti"), "q_class", "left_semi")
        going = durable(left.join(level, "q_class").filter(F.col("seen") < len(bands)))
        if going.isEmpty():
            return found
        held = w.join(found, "w_id", "left").join(q.select("q_id", "q_ord"), "q_id", "left")
        # Null: a row of the class is free.
        reach = durable(held.groupBy("w_class").agg(F.when(F.count("q_ord") == F.count(F.lit(1)), F.max("q_ord")).alias("reach")))


def _match_by_best(q: DataFrame, w: DataFrame, qc: DataFrame, wc: DataFrame, tol: Column) -> DataFrame:
    """The rule for crowded dates by edit similarity: the earliest seekers of every date are settled, then the next ones with what is left.

    What earlier rows take is final, so a pair of texts is scored again only for the few rows whose best pairs were not enough.
    """
    q = durable(_ranked(q, ["date"], "q_ord", q).withColumn("step", F.floor((F.col("place") - 1) / STEP_ROWS)).drop("place"))
    matched, free = None, w
    for step in range(q.agg(F.max("step")).first()[0] + 1):
        found = _step_by_best(durable(q.filter(F.col("step") == step).drop("step")), free, qc, wc, tol)
        matched = found if matched is None else matched.unionByName(found)
        free = durable(free.join(found.select("w_id"), "w_id", "left_anti"))
    return matched


def _step_by_best(q: DataFrame, w: DataFrame, qc: DataFrame, wc: DataFrame, tol: Column) -> DataFrame:
    """Every pair is scored inside a task, only a seeker's best pairs become rows.

    A seeker's known pairs are the beginning of its whole list. Rows whose beginning is used up go on with the next part of it; offers
    that earlier rows hold are left out: an offer only ever passes to earlier rows.
    """
    by, k = ["date", "bucket"], BEST
    heads = durable(w.groupBy("w_class").agg(F.min("w_ord").cast("long").alias("head"), F.count(F.lit(1)).alias("n")))
    # Offers without copies are in full order, and a list may end between equal scores. Copies of one text are used at several places.
    single = heads.filter("n > 1").isEmpty()
    cents = lambda c: (c * 100).cast("long")
    spread = lambda key, n: F.pmod(F.xxhash64(key), F.col(n)).cast("int")
    free = wc.join(heads, "w_class")
    pieces = durable(free.groupBy(*by).agg(F.ceil(F.count(F.lit(1)) / PIECE_ROWS).cast("int").alias("pieces")))
    offers = durable(free.join(pieces, by).select("w_class", *by, cents(F.col("cost")).alias("money"), "b", "head", spread("w_class", "pieces").alias("piece")))
    first = durable(q.groupBy("q_class").agg(F.min("q_ord").cast("long").alias("first"), F.min("date").alias("day")))
    going = durable(first.select("q_class", "first", F.lit(None).cast("double").alias("end_score"), F.lit(None).cast("long").alias("end_head"), F.lit(k).cast("long").alias("most")))
    schema = T.StructType([qc.schema["q_class"], offers.schema["w_class"], *[T.StructField(c, t) for c, t in (
        ("score", T.DoubleType()), ("head", T.LongType()), ("most", T.LongType()), ("date", T.DateType()))]])
    reach, known = None, None
    while True:
        texts = qc.join(going, "q_class")
        blocks = durable(texts.groupBy(*by).agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("blocks")))
        texts = texts.join(blocks, by).join(pieces, by).select(
            "q_class", *by, cents(F.col("size")).alias("money"), "a", "first", "end_score", "end_head", "most", cents(tol).alias("tol"),
            spread("q_class", "blocks").alias("block"), F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece"))
        others = offers.withColumn("reach", F.lit(None).cast("long")) if reach is None else offers.join(reach, "w_class")
        others = others.join(blocks, by).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
        key = [*by, "block", "piece"]
        scored = texts.groupBy(*key).cogroup(others.groupBy(*key)).applyInArrow(_best_pairs(single), schema)
        order = [F.desc("score"), F.col("head")] if single else [F.desc("score")]
        fresh = durable(scored.withColumn("place", F.rank().over(Window.partitionBy("q_class").orderBy(*order))).filter("place <= most"))
        pairs = fresh.select("q_class", "w_class", "score", F.col("date").alias("block"))
        known = pairs if known is None else durable(known.unionByName(pairs))
        # Lists that came to their end have nothing more to give.
        ends = fresh.groupBy("q_class").agg(F.count(F.lit(1)).alias("n"), F.first("most").alias("most"), F.min("score").alias("end_score"), F.max_by("head", F.struct(-F.col("score"), "head")).alias("end_head"))
        open_ = ends.filter("n >= most").drop("n", "most")
        if reach is not None:
            open_ = open_.unionByName(waiting)
        wanted = durable(w.join(known.select("w_class").distinct(), "w_class", "left_semi"))
        found = durable(assign_in_order(*_rows(q, wanted), known).select("q_id", "w_id"))
        left = q.join(found, "q_id", "left_anti").select("q_class").distinct()
        open_ = durable(open_)
        # Of what is in reach, the rows that go on before a row take one more offer each, so its list need not be longer than their number.
        k *= MORE
        rank = F.row_number().over(Window.partitionBy("day").orderBy("first"))
        going = durable(open_.join(left, "q_class", "left_semi").join(first, "q_class").withColumn("most", F.least(F.lit(k), rank + BEST).cast("long")).drop("day"))
        if going.isEmpty():
            return found
        # Rows that hold a partner may lose it and go on later from where their lists end.
        waiting = open_.join(left, "q_class", "left_anti")
        held = w.join(found, "w_id", "left").join(q.select("q_id", "q_ord"), "q_id", "left")
        # Null: a row of the class is free.
        reach = durable(held.groupBy("w_class").agg(F.when(F.count("q_ord") == F.count(F.lit(1)), F.max("q_ord")).cast("long").alias("reach")))


def _best_pairs(single: bool) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The best ``most`` offers of every seeker of a block, after the place where its list ended, with all that tie where copies count."""

    def best(seekers: pa.Table, offers: pa.Table) -> pa.Table:
        names, day = ["q_class", "w_class", "score", "head", "most", "date"], seekers.schema.field("date").type
        out, classes = [], offers["w_class"].to_numpy()
        if seekers.num_rows and offers.num_rows:
            texts = EditDistances(offers["b"].to_pylist())
            money, head = offers["money"].to_numpy(), offers["head"].to_numpy()
            reach = offers["reach"].fill_null(np.iinfo(np.int64).max).to_numpy()
            near: dict[tuple, np.ndarray] = {}
            for row in seekers.to_pylist():
                amount = row["money"], row["tol"]
                if amount not in near:
                    near = {amount: np.abs(money - row["money"]) <= row["tol"]}
                fits = near[amount] & (row["first"] < reach)
                score = texts.similarities(row["a"])
                if row["end_score"] is not None:
                    fits &= (score < row["end_score"]) | (single & (score == row["end_score"]) & (head > row["end_head"]))
                at, k = np.flatnonzero(fits), row["most"]
                if len(at) > k:
                    found = score[at]
                    least = np.partition(found, len(at) - k)[len(at) - k]
                    at = at[found >= least]
                    if single:
                        at = at[np.lexsort((head[at], -score[at]))[:k]]
                out.append((np.full(len(at), row["q_class"]), classes[at], score[at], head[at], np.full(len(at), k)))
        types = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
        columns = [pa.array(np.concatenate(c), t) for c, t in zip(zip(*out), types)] if out else [pa.array([], t) for t in types]
        return pa.table([*columns, pa.repeat(seekers["date"][0], len(columns[0])) if out else pa.array([], day)], names)

    return best


def fuzzy_candidates(txns: DataFrame, filings: DataFrame, *, days: int = 3, threshold: float = 0.72) -> DataFrame:
    """Classes of transactions and filings with the same amount, close dates and similar normalized text."""
    t = txns.select("q_class", "date", "amount", "a").distinct().withColumn(
        "bucket", F.floor(F.unix_date("date") / F.lit(days + 1))
    )
    p = filings.select("w_class", F.col("date").alias("filed"), "amount", "b").distinct().withColumn(
        "bucket", _near(F.floor(F.unix_date("filed") / F.lit(days + 1)))
    )
    pairs = t.join(p, ["amount", "bucket"]).filter(F.abs(F.datediff("date", "filed")) <= days)
    pairs = durable(pairs.select("q_class", "w_class", F.col("amount").alias("block"), "a", "b"))
    # Vendor keys recur, so each pair of texts is scored once. Most are decided by their sets of words; only the rest goes to Python.
    texts = durable(pairs.select("a", "b").distinct().withColumn("quick", token_set_quick(F.col("a"), F.col("b"), threshold)))
    open_ = texts.filter("quick IS NULL").withColumn("score", token_set_ratio(F.col("a"), F.col("b")))
    scored = texts.filter("quick IS NOT NULL").withColumn("score", F.col("quick")).unionByName(open_)
    alike = scored.filter((F.col("score") >= threshold) & (F.col("score") > 0)).select("a", "b", "score")
    return join_unique(pairs, alike, ["a", "b"], "inner").select("q_class", "w_class", "block", "score")


def match_fuzzy(txns: DataFrame, filings: DataFrame, *, days: int = 3, threshold: float = 0.72) -> DataFrame:
    """Pair transactions with prior filings: equal amount, within ``days``, best text similarity first.

    ``txns(q_id, q_ord, date, amount, description)``; ``filings(w_id, w_ord, date, amount, description)``.
    """
    t = computed_once(txns, "q_id", "q_ord", "date", "amount", vendor_key(F.col("description")).alias("a"))
    t = durable(t.withColumn("q_class", class_key(F.col("date"), F.col("amount"), F.col("a"))))
    p = computed_once(filings, "w_id", "w_ord", "date", "amount", vendor_key(F.col("description")).alias("b"))
    p = durable(p.withColumn("w_class", class_key(F.col("date"), F.col("amount"), F.col("b"))))
    edges = durable(fuzzy_candidates(t, p, days=days, threshold=threshold))
    block = F.col("amount").alias("block")
    return assign_in_order(t.select("q_id", "q_ord", "q_class", block), p.select("w_id", "w_ord", "w_class", block), edges)


def payout_groups(pm_txns: DataFrame, *more: Column, category: str = OWNER_PAYOUT_CATEGORY) -> DataFrame:
    """Owner payouts per reference: sum (null counts as nothing), members, first position, and ``more`` aggregates."""
    return (
        pm_txns.filter((F.col("category") == category) & F.col("reference").isNotNull())
        .groupBy("reference")
        .agg(
            F.coalesce(F.sum("cash_out"), F.lit(0)).cast("decimal(18,2)").alias("group_sum"),
            F.count(F.lit(1)).alias("members"),
            F.min("ord").alias("first_ord"),
            *more,
        )
    )


def double_counts(
    deposits: DataFrame,
    pm_txns: DataFrame,
    *,
    payer: str,
    days: int = 5,
    tolerance: float = 0.50,
    category: str = OWNER_PAYOUT_CATEGORY,
) -> DataFrame:
    """Deposits that repeat a payout group: text names the payer, sum within tolerance, any member close in time.

    ``deposits(q_id, q_ord, date, amount, description)``; ``pm_txns(ord, reference, date, cash_out, category)``.
    Each group is used once; deposits go in order and take the first fitting group.
    """
    tol = F.lit(str(tolerance)).cast("decimal(18,2)")
    # Payouts with the same sum and the same days are interchangeable: one class, used in order.
    paid_on = F.array_sort(F.collect_set("date")).alias("paid_on")  # days of one payout: bounded by the calendar
    groups = durable(
        payout_groups(pm_txns, paid_on, category=category)
        .withColumn("w_class", class_key(F.col("group_sum"), F.array_join(F.transform("paid_on", lambda x: x.cast("string")), " ")))
        .withColumn("money", _bucket(F.col("group_sum"), tolerance))
    )
    q = durable(
        deposits.filter((F.col("amount") > 0) & F.lower("description").contains(payer.lower())).select(
            "q_id", "q_ord", "date", "amount", class_key(F.col("date"), F.col("amount")).alias("q_class"), _bucket(F.col("amount"), tolerance).alias("money")
        )
    )
    q, w = _blocks_of_sums(q, groups, tolerance)
    # A payout's days are in order, so of those close to a deposit only the first one's predecessor is not close: one row per pair.
    paid = F.inline(F.transform("paid_on", lambda x, i: F.struct(x.alias("paid"), F.get("paid_on", i - 1).alias("before"))))
    cell = 4 * (days or 1)
    qc = q.select("date", "amount", "block").distinct().withColumn("money", _cells_in_reach(F.col("amount"), tolerance)).withColumn(
        "span", F.explode(F.sequence(F.floor((F.unix_date("date") - days) / F.lit(cell)), F.floor((F.unix_date("date") + days) / F.lit(cell)))))
    g = groups.select("w_class", "group_sum", "paid_on").distinct().select("w_class", "group_sum", paid, _cell(F.col("group_sum"), tolerance).alias("money"))
    close = lambda day: F.coalesce(F.abs(F.datediff("date", day)) <= days, F.lit(False))
    edges = durable(
        qc.join(g.withColumn("span", F.floor(F.unix_date("paid") / F.lit(cell))), ["money", "span"])
        .filter((F.abs(F.col("amount") - F.col("group_sum")) <= tol) & close("paid") & ~close("before"))
        .select(class_key(F.col("date"), F.col("amount")).alias("q_class"), "w_class", "block", F.lit(0.0).alias("score"))
    )
    pairs = assign_in_order(q.select("q_id", "q_ord", "q_class", "block"), w, edges)
    return pairs.select("q_id", F.col("w_id").alias("reference")).join(groups.drop("w_class", "paid_on", "money"), "reference").select(
        "q_id", "reference", "group_sum", "members"
    )


def _blocks_of_sums(q: DataFrame, groups: DataFrame, tolerance: float) -> tuple[DataFrame, DataFrame]:
    """Deposits and payouts as offers with their block: sums whose buckets follow each other without a gap."""
    w = groups.select(F.col("reference").alias("w_id"), F.col("first_ord").alias("w_ord"), "w_class", "money")
    if not _cents(tolerance):
        return q.withColumn("block", F.col("money")).drop("money"), w.withColumnRenamed("money", "block")
    found = durable(islands(q.select("money").unionAll(w.select("money")), "money"))
    own = lambda df: durable(df.join(found, "money").drop("money"))
    return own(q), own(w)


def exclude_deposits(rows: DataFrame, deposits: DataFrame) -> DataFrame:
    """Drop every row that equals a double-counted deposit in date, description and amount."""
    key = ["date", "description", "amount"]
    return join_unique(rows, deposits.select(*key).distinct(), key, "left_anti")
