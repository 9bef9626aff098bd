"""Review tables for people, prefills, and the way back from decisions to the ledger."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.fixed_values import REVIEW_TRANSACTION_HEADERS, REVIEW_VENDOR_HEADERS
from ledgerloom.functions.text import strip, vendor_key
from ledgerloom.operators.worksheet import Rules, expense_type, type_category
from ledgerloom.scale import dense_index, durable, join_unique

PREFILL = ("category", "property", "expense_type")
NO_VENDOR = "(unknown)"


def with_review_vendor(queue: DataFrame) -> DataFrame:
    """Add the display key; a key from categorization is used as it is."""
    key = F.col("vendor") if "vendor" in queue.columns else vendor_key(F.col("description"))
    return queue.withColumn("vendor", F.coalesce(F.nullif(key, F.lit("")), F.lit(NO_VENDOR)))


def group_by_vendor(queue: DataFrame) -> DataFrame:
    """One row per vendor: count, total of absolute amounts, first row as sample, distinct accounts.

    ``queue(ord, date, description, amount, account)``; order the result by ``count`` descending, then
    ``first_ord``. Accounts are made distinct before they are gathered.
    """
    keyed = with_review_vendor(queue)
    by_account = keyed.groupBy("vendor", "account").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.abs("amount")).alias("total"),
        F.min("ord").alias("first_ord"),
        F.min_by(F.struct("description", "amount"), "ord").alias("sample"),
    )
    return by_account.groupBy("vendor").agg(
        F.sum("n").alias("count"),
        F.sum("total").cast("decimal(28,2)").alias("total_amount"),
        F.min_by("sample", "first_ord").alias("sample"),
        F.array_join(F.array_sort(F.collect_set("account")), ", ").alias("accounts"),
        F.min("first_ord").alias("first_ord"),
    ).select(
        "vendor", "count", "total_amount", F.col("sample.description").alias("sample_description"),
        F.col("sample.amount").alias("sample_amount"), "accounts", "first_ord",
    )


def prefill_consensus(queue: DataFrame, prefills: DataFrame) -> DataFrame:
    """Prefill per vendor where all its prefilled rows agree on category, property and expense type.

    ``prefills(ord, category, property, expense_type)``, keyed by the queue row.
    """
    rows = with_review_vendor(queue).select("ord", "vendor").join(
        prefills.select("ord", *[F.coalesce(c, F.lit("")).alias(c) for c in PREFILL]), "ord"
    )
    agree = F.lit(True)
    for c in PREFILL:
        agree = agree & (F.min(c) == F.max(c))
    return (
        rows.groupBy("vendor").agg(*[F.min(c).alias(c) for c in PREFILL], agree.alias("agree"))
        .filter("agree").drop("agree")
    )


def _prefilled(df: DataFrame, prefills: DataFrame | None, on: str) -> DataFrame:
    if prefills is None:
        return df.withColumns({c: F.lit("") for c in PREFILL})
    joined = join_unique(df, prefills.select(on, *PREFILL), [on], "left")
    return joined.withColumns({c: F.coalesce(c, F.lit("")) for c in PREFILL})


def vendor_table(queue: DataFrame, prefills: DataFrame | None = None) -> DataFrame:
    """Vendor-level review table; ``vendor_ord`` is the display position."""
    groups = group_by_vendor(queue)
    consensus = None if prefills is None else durable(prefill_consensus(queue, prefills))
    table = _prefilled(groups, consensus, "vendor")
    return dense_index(table, [F.desc("count"), "first_ord"], "vendor_ord").withColumn("notes", F.lit(""))


def transaction_table(queue: DataFrame, *, year: int, prefills: DataFrame | None = None) -> DataFrame:
    """Transaction-level review table: vendors by size, then date; row ids ``YYYY-NNNN``.

    The id is assigned once here and written with the row; decisions come back by this id, so they cannot land on
    another row.
    """
    groups = durable(
        group_by_vendor(queue).select("vendor", F.col("count").alias("vendor_count"), F.col("first_ord").alias("vendor_first"))
    )
    rows = with_review_vendor(queue)
    rows = join_unique(rows, groups, ["vendor"], "left")
    rows = rows.drop(*[c for c in PREFILL if c in rows.columns])
    rows = _prefilled(rows, prefills, "ord")
    placed = dense_index(rows, [F.desc("vendor_count"), "vendor_first", "date", "ord"], "row_index")
    return placed.withColumns(
        {"row_id": F.format_string("%d-%04d", F.lit(year), F.col("row_index") + 1), "notes": F.lit("")}
    ).drop("vendor_count", "vendor_first")


def prefill_count(table: DataFrame) -> DataFrame:
    """Rows of a review table and how many carry any prefill."""
    some = F.lit(False)
    for c in PREFILL:
        some = some | (F.col(c) != "")
    return table.agg(F.count(F.lit(1)).alias("txn_count"), F.count_if(some).alias("prefilled"))


def vendor_sheet(table: DataFrame) -> DataFrame:
    """The ten printed columns of the vendor table."""
    columns = ["vendor", "count", "total_amount", "sample_description", "sample_amount", "accounts", *PREFILL, "notes"]
    return table.select(*[F.col(c).alias(h) for c, h in zip(columns, REVIEW_VENDOR_HEADERS)])


def transaction_sheet(table: DataFrame) -> DataFrame:
    """The ten printed columns of the transaction table."""
    columns = ["row_id", "date", "vendor", "description", "amount", "account", *PREFILL, "notes"]
    return table.select(*[F.col(c).alias(h) for c, h in zip(columns, REVIEW_TRANSACTION_HEADERS)])


def _decisions(rows: DataFrame, key: str, extra: list[str]) -> DataFrame:
    # The last row of a key wins; rows without key or category were not decided.
    trimmed = rows.withColumns({c: strip(F.coalesce(F.col(c), F.lit(""))) for c in (key, *PREFILL)})
    decided = trimmed.filter((F.col(key) != "") & (F.col("category") != ""))
    kept = [*PREFILL, *extra]
    return decided.groupBy(key).agg(F.max_by(F.struct(*kept), "row_no").alias("d")).select(
        key, *[F.col(f"d.{c}").alias(c) for c in kept]
    )


def vendor_decisions(rows: DataFrame) -> DataFrame:
    """``rows(row_no, vendor, count, category, property, expense_type)`` as typed by people."""
    return _decisions(rows, "vendor", ["count"])


def row_overrides(rows: DataFrame) -> DataFrame:
    """``rows(row_no, row_id, category, property, expense_type)`` as typed by people."""
    return _decisions(rows, "row_id", [])


def resolve(queue: DataFrame, by_vendor: DataFrame, by_row: DataFrame) -> DataFrame:
    """Apply decisions to ``queue(row_id, description, ...)``: the row's own, else its vendor's, else drop it."""
    rows = with_review_vendor(queue).drop(*PREFILL, "confidence", "source").withColumn(
        "__vendor", F.nullif("vendor", F.lit(NO_VENDOR))
    )
    own = by_row.select("row_id", F.struct(*PREFILL).alias("__own"))
    shared = by_vendor.select(F.col("vendor").alias("__vendor"), F.struct(*PREFILL).alias("__shared"))
    rows = join_unique(join_unique(rows, own, ["row_id"], "left"), shared, ["__vendor"], "left")
    decision = F.coalesce("__own", "__shared")
    return (
        rows.filter(decision.isNotNull())
        .withColumns({c: F.coalesce(decision[c], F.lit("")) for c in PREFILL})
        .withColumns(
            {
                "confidence": F.lit(1.0),
                "source": F.when(F.col("__own").isNotNull(), "review_override").otherwise("review_vendor"),
            }
        )
        .drop("__own", "__shared", "__vendor")
    )


def prefills_from_pairs(pairs: DataFrame, worksheet: DataFrame, rules: Rules) -> DataFrame:
    """Prefill labels of matched queue rows: ``pairs(q_id, w_id)``, ``worksheet(w_id, type, description)``."""
    category, prop = type_category(F.col("type"), rules)
    return join_unique(pairs, worksheet.select("w_id", "type", "description"), ["w_id"], "inner").select(
        F.col("q_id").alias("ord"),
        F.coalesce(category, F.lit("")).alias("category"),
        F.coalesce(prop, F.lit("")).alias("property"),
        F.coalesce(expense_type(F.col("description"), rules), F.lit("")).alias("expense_type"),
    )

