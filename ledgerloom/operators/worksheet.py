"""Bookkeeper worksheet: all-text rows -> P&L items."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.dates import worksheet_date
from ledgerloom.functions.money import SHARE, parse_money, share
from ledgerloom.functions.text import first_rule, lookup, strip
from ledgerloom.scale import computed_once

SPLIT = "STR - Split"


@dataclass(frozen=True)
class Rules:
    """A bookkeeper's words, all lower case.

    ``property_of``: type -> property. ``skipped`` and ``split``: types that are left out of reconciliation or belong to all
    properties. ``fixed``: type -> (category, expense type) where the worksheet itself is booked. ``expense_types``: description ->
    expense type; an exact entry first, then the first contained one in this order.
    """

    property_of: Mapping[str, str] = field(default_factory=dict)
    skipped: Sequence[str] = ()
    split: Sequence[str] = ()
    fixed: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    expense_types: Sequence[tuple[str, str]] = ()


def _key(c: Column) -> Column:
    return strip(F.lower(F.coalesce(c, F.lit(""))))


def type_category(type_: Column, rules: Rules) -> tuple[Column, Column]:
    """(category, property) of a worksheet type; both null when the type is unknown."""
    key = _key(type_)
    prop = lookup(key, dict(rules.property_of))
    category = (
        F.when(key.isin(*rules.skipped), "Skip")
        .when(key.isin(*rules.split), SPLIT)
        .when(prop.isNotNull(), "STR")
    )
    return category, F.when(category == "STR", prop)


def expense_type(description: Column, rules: Rules) -> Column:
    """Expense type of a worksheet description: exact entry, else first contained pattern; null if none."""
    key = _key(description)
    if not rules.expense_types:
        return F.lit(None).cast("string")
    return F.coalesce(lookup(key, dict(rules.expense_types)), first_rule(key, rules.expense_types))


def parse(rows: DataFrame) -> DataFrame:
    """Add ``txn_date`` and ``amount`` to the text columns ``date, cost, source, type, description``."""
    return computed_once(
        rows, *rows.columns, worksheet_date(F.col("date")).alias("txn_date"), parse_money(F.col("cost")).alias("amount")
    )


def classify(rows: DataFrame, *, year: int, rules: Rules) -> DataFrame:
    """Outcome per row: ``status`` is 'skipped', 'no_amount' or 'item'; undated rows stay in the year.

    Types with a prescribed outcome come first; a type that is neither one property nor a split is skipped.
    """
    parsed = parse(rows)
    key = _key(F.col("type"))
    fixed_category = lookup(key, {k: c for k, (c, _) in rules.fixed.items()})
    fixed_expense = lookup(key, {k: e for k, (_, e) in rules.fixed.items()})
    category, prop = type_category(F.col("type"), rules)
    found = expense_type(F.col("description"), rules)
    fixed = fixed_category.isNotNull()
    in_year = F.col("txn_date").isNull() | (F.year("txn_date") == year)
    known = fixed | F.coalesce(category != "Skip", F.lit(False))
    return computed_once(parsed.withColumns(
        {
            "category": F.coalesce(fixed_category, category),
            "property": F.when(~fixed, prop),
            "expense_type": F.coalesce(fixed_expense, found, F.lit("other")),
            "unmapped": ~fixed & found.isNull(),
            "status": F.when(~in_year, "skipped").when(F.col("amount").isNull(), "no_amount").when(~known, "skipped")
            .otherwise("item"),
        }
    ))


def to_items(classified: DataFrame, split_properties: Sequence[str]) -> DataFrame:
    """P&L items; a split row becomes one equal share per property, inside the row (no join)."""
    is_split = F.col("category") == SPLIT
    targets = F.when(is_split, F.array(*[F.lit(p) for p in split_properties])).otherwise(F.array("property"))
    amount = F.when(is_split, share(F.col("amount"), len(split_properties))).otherwise(F.col("amount").cast(SHARE))
    return classified.filter("status = 'item'").select(
        F.explode(targets).alias("property"), F.col("expense_type").alias("template_category"), amount.alias("amount")
    )


def unmapped_descriptions(classified: DataFrame) -> DataFrame:
    """Descriptions booked as 'other' and how often."""
    return (
        classified.filter("status = 'item' AND unmapped")
        .groupBy(F.coalesce("description", F.lit("")).alias("description"))
        .agg(F.count(F.lit(1)).alias("occurrences"))
    )


def counters(classified: DataFrame) -> DataFrame:
    """Rows read, skipped and split."""
    return classified.agg(
        F.count(F.lit(1)).alias("rows_read"),
        F.count_if(F.col("status") == "skipped").alias("skipped"),
        F.count_if((F.col("status") == "item") & (F.col("category") == SPLIT)).alias("split_rows"),
    )
