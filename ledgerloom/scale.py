"""Building blocks that keep ordered and keyed work spread out when one key is very large.

* ``durable``        cut lineage through a table in the shared checkpoint folder
* ``join_unique``    join to a one-row-per-key side: broadcast only after a size check, salt hot keys beyond it
* ``running_last``   last non-null value in order, per group, chunk by chunk when groups are large
* ``group_rank``     1-based position in order, per group, chunk by chunk when groups are large
* ``dense_index``    0-based position in a total order over the whole table
* ``islands``        runs of integers without a gap
* ``components``     connected components of a graph

A *chunk* is any column that never decreases along the order (a page number, a row number divided by
a constant). A window then only ever sorts one chunk; between chunks travels one summary row, so a group
that holds a third of all rows is handled by as many tasks as it has chunks.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20
HOT_KEY_ROWS = 1_000_000
SALTS = 64
CHUNK_ROWS = 65_536


_local_folder: str | None = None


def shared_folder(spark: SparkSession) -> str:
    """Folder named by the cluster in ``spark.checkpoint.dir``; a temporary one only in local mode."""
    global _local_folder
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    return _local_folder


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: survives lost executors, ends the lineage."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def computed_once(df: DataFrame, *columns: Column | str, keys: Sequence[str] = ()) -> DataFrame:
    """``df.select(*keys, *columns)`` with the columns behind a generator, so that each is evaluated a single time.

    Filters and projections further up refer to the values; the optimizer would otherwise copy the whole
    expression into each of them. ``keys`` pass by the generator: partitioning and order by them stay known, so
    later windows and groupings need no new exchange.
    """
    values = columns or tuple(c for c in df.columns if c not in keys)
    return df.select(*keys, F.inline(F.array(F.struct(*values))))


def chunk_of(order: Column | str, rows: int = CHUNK_ROWS) -> Column:
    """Chunk number of an integer order column."""
    order = F.col(order) if isinstance(order, str) else order
    return F.floor(order / F.lit(rows))


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Few rows and few bytes: long strings count too. Reading stops after ``max_rows`` rows."""
    wide = [c for c, t in df.dtypes if t == "string" or t.startswith(("array", "map", "struct", "binary"))]
    size = sum((F.coalesce(F.octet_length(F.col(c) if t in ("string", "binary") else F.to_json(F.struct(c))), F.lit(0)) for c, t in df.dtypes if c in wide), F.lit(8 * len(df.columns)))
    n, total = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.sum(size)).first()
    return n <= max_rows and (total or 0) <= max_bytes


def join_unique(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "left",
    *,
    max_rows: int = BROADCAST_ROWS,
    hot_rows: int = HOT_KEY_ROWS,
    salts: int = SALTS,
) -> DataFrame:
    """Join ``left`` to ``right``, which holds at most one row per key, whatever the sizes.

    The right side is counted first (the count stops at ``max_rows``). Small: broadcast, no shuffle.
    Its bytes count too. Large: keys with ``hot_rows`` or more rows on the left are found by a map-side count. There are at most
    rows / hot_rows of them, so that list is small; only those keys are salted, with the right row
    repeated once per salt.
    """
    on = list(on)
    right = durable(right)  # it is read for its size and for the join
    if fits_broadcast(right, max_rows):
        return left.join(F.broadcast(right), on, how)
    hot = (
        left.groupBy(*on).agg(F.count(F.lit(1)).alias("__n"))
        .filter(F.col("__n") >= hot_rows)
        .select(*on, F.lit(True).alias("__hot"))
    )
    hot = durable(hot)
    if hot.isEmpty():
        return left.join(right, on, how)
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in left.columns], F.monotonically_increasing_id()), F.lit(salts))
    hot_small = F.broadcast(hot) if fits_broadcast(hot, max_rows) else hot
    left_salted = (
        left.join(hot_small, on, "left")
        .withColumn("__salt", F.when(F.col("__hot"), spread).otherwise(F.lit(0).cast("bigint")))
        .drop("__hot")
    )
    right_salted = (
        right.join(hot_small, on, "left")
        .withColumn(
            "__salt",
            F.explode(
                F.when(F.col("__hot"), F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint")))
                .otherwise(F.array(F.lit(0).cast("bigint")))
            ),
        )
        .drop("__hot")
    )
    return left_salted.join(right_salted, [*on, "__salt"], how).drop("__salt")


def needs_spreading(
    df: DataFrame, group: Sequence[str], limit: int = HOT_KEY_ROWS, *, stored: DataFrame | None = None
) -> bool:
    """Does any group hold more than ``limit`` rows?

    ``stored``: a stored table with at least as many rows as ``df``. If it is small as a whole, its row count
    answers the question; otherwise the groups are counted, map-side first.
    """
    if stored is not None and stored.count() <= limit:
        return False
    largest = df.groupBy(*group).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
    return (largest or 0) > limit


def _staged(df: DataFrame, chunk: Column, extra: dict[str, Column]) -> DataFrame:
    # Stored once: the chunk summary and the detail rows both read it.
    return durable(df.withColumns({"__chunk": chunk.cast("bigint"), **extra}))


def _with_carry(staged: DataFrame, carry: DataFrame, keys: list[str]) -> DataFrame:
    renamed = carry
    for k in keys:
        renamed = renamed.withColumnRenamed(k, f"__k_{k}")
    cond = reduce(lambda x, y: x & y, [staged[k] == renamed[f"__k_{k}"] for k in keys])
    return staged.join(renamed, cond, "left").drop(*[f"__k_{k}" for k in keys])


def running_last(
    df: DataFrame,
    group: Sequence[str],
    chunk: Column,
    order: Sequence[str],
    values: dict[str, Column],
    *,
    spread: bool,
    inclusive: bool = True,
) -> DataFrame:
    """Add, per name in ``values``, the last non-null value at (or before) each row.

    ``spread=False`` is one window per group, right while groups are small (see ``needs_spreading``).
    """
    group, order = list(group), list(order)
    frame = (Window.unboundedPreceding, 0 if inclusive else -1)
    if not spread:
        w = Window.partitionBy(*group).orderBy(*order).rowsBetween(*frame)
        staged = df.withColumns({f"__v_{n}": v for n, v in values.items()})
        return staged.withColumns({n: F.last(f"__v_{n}", ignorenulls=True).over(w) for n in values}).drop(
            *[f"__v_{n}" for n in values]
        )
    staged = _staged(df, chunk, {f"__v_{n}": v for n, v in values.items()})
    key = F.struct(*order)
    summary = staged.groupBy(*group, "__chunk").agg(
        *[F.max_by(f"__v_{n}", F.when(F.col(f"__v_{n}").isNotNull(), key)).alias(f"__s_{n}") for n in values]
    )
    earlier = Window.partitionBy(*group).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    carry = summary.select(
        *group, "__chunk", *[F.last(f"__s_{n}", ignorenulls=True).over(earlier).alias(f"__c_{n}") for n in values]
    )
    local = Window.partitionBy(*group, "__chunk").orderBy(*order).rowsBetween(*frame)
    joined = _with_carry(staged, carry, [*group, "__chunk"])
    return joined.withColumns(
        {n: F.coalesce(F.last(f"__v_{n}", ignorenulls=True).over(local), F.col(f"__c_{n}")) for n in values}
    ).drop("__chunk", *[f"__v_{n}" for n in values], *[f"__c_{n}" for n in values])


def group_rank(
    df: DataFrame,
    group: Sequence[str],
    chunk: Column,
    order: Sequence[str],
    name: str = "position",
    *,
    spread: bool,
) -> DataFrame:
    """Add the 1-based position of each row in its group."""
    group, order = list(group), list(order)
    if not spread:
        return df.withColumn(name, F.row_number().over(Window.partitionBy(*group).orderBy(*order)).cast("bigint"))
    staged = _staged(df, chunk, {})
    summary = staged.groupBy(*group, "__chunk").agg(F.count(F.lit(1)).alias("__s"))
    earlier = Window.partitionBy(*group).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    carry = summary.select(*group, "__chunk", F.sum("__s").over(earlier).alias("__c"))
    local = Window.partitionBy(*group, "__chunk").orderBy(*order)
    joined = _with_carry(staged, carry, [*group, "__chunk"])
    return joined.withColumn(name, F.row_number().over(local) + F.coalesce(F.col("__c"), F.lit(0))).drop("__chunk", "__c")


def dense_index(df: DataFrame, order: Sequence[Column | str], name: str = "position") -> DataFrame:
    """Add the 0-based position of each row in a total order, without a single-partition window.

    Rows are range-partitioned and sorted; each partition numbers its own rows and adds the size of the
    partitions before it. The sorted table is made durable first, so that both passes see the same split.
    End ``order`` with a unique column: equal keys would all land in one partition.
    """
    order = [F.col(o) if isinstance(o, str) else o for o in order]
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = durable(
        df.repartitionByRange(partitions, *order)
        .sortWithinPartitions(*order)
        .withColumn("__mono", F.monotonically_increasing_id())
        .withColumn("__part", F.shiftright("__mono", 33))
    )
    # One row per partition: bounded by spark.sql.shuffle.partitions.
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
        .select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    )
    return (
        placed.join(F.broadcast(offsets), "__part")
        .withColumn(name, F.col("__off") + F.col("__mono").bitwiseAND((1 << 33) - 1))
        .drop("__part", "__mono", "__off")
    )


def islands(numbers: DataFrame, column: str) -> DataFrame:
    """(``column``, block) for the distinct integers of a column: those of a run without a gap share their first number as block."""
    n = F.col(column).cast("bigint")
    marks = numbers.select(F.inline(F.array(
        F.struct(n.alias(column), F.lit(True).alias("own")), F.struct((n + 1).alias(column), F.lit(False).alias("own")))))
    # A number begins a run when its predecessor has not marked it.
    seen = marks.groupBy(column).agg(F.max("own").alias("own"), F.min("own").alias("begins")).filter("own").select(
        column, F.when(F.col("begins"), F.col(column)).alias("first"), F.lit(0).alias("__all"))
    placed = dense_index(seen, [column])
    return running_last(placed, ["__all"], chunk_of("position"), ["position"], {"block": F.col("first")}, spread=True).select(column, "block")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for all nodes of an undirected graph (a, b) but the roots, the least node of each component.

    Alternating contraction to stars, about log(nodes) rounds; edges never gather in one row.
    """
    known = durable(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while True:
        both = known.union(known.select("b", "a"))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
        known = durable(small.filter("a <> b").distinct())
        # Done when all are stars: each node has one edge, and no root is a node of another star.
        nodes = known.select(F.col("a").alias("n"), F.lit(1).alias("as_node"), F.lit(0).alias("as_root")).unionAll(
            known.select(F.col("b").alias("n"), F.lit(0), F.lit(1)))
        each = nodes.groupBy("n").agg(F.sum("as_node").alias("as_node"), F.max("as_root").alias("as_root"))
        if each.filter("as_node > 1 OR as_node = 1 AND as_root = 1").isEmpty():
            return known.select(F.col("a").alias("node"), F.col("b").alias("root"))
