"""Property P&L: item sources, even splits, rollup and output tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.fixed_values import DETAIL_HEADERS, NOT_BUILT
from ledgerloom.functions.money import SHARE, cash_amount, display_amount, share
from ledgerloom.functions.text import blank_to_null, lookup, map_status

INTEREST = "Interest expense"
REVENUE = "Sales revenue"


def with_alias(name: Column, aliases: Mapping[str, str]) -> Column:
    """Canonical property name; a name without an alias stays."""
    return F.coalesce(lookup(name, aliases), name)


def mapped_label(category: Column, labels: Mapping[str, str | None]) -> tuple[Column, Column]:
    """(P&L label or null, 'mapped' | 'excluded' | 'unknown')."""
    return lookup(category, labels), map_status(category, labels)


def tagged_union(auto: DataFrame, resolved: DataFrame) -> DataFrame:
    """Auto-tagged rows and resolved reviews, without the outcomes that are never booked."""
    usable = blank_to_null(F.col("category")).isNotNull() & ~F.col("category").isin(*NOT_BUILT)
    return auto.unionByName(resolved.filter(usable), allowMissingColumns=True)


def split_targets(
    category: Column, prop: Column, amount: Column, groups: Mapping[str, Sequence[str]]
) -> tuple[Column, Column]:
    """(array of target properties, amount per target). ``groups`` maps a split category to its properties."""
    targets, each = None, None
    for name, members in groups.items():
        here = category == name
        values = F.array(*[F.lit(m) for m in members])
        targets = F.when(here, values) if targets is None else targets.when(here, values)
        part = share(amount, len(members))
        each = F.when(here, part) if each is None else each.when(here, part)
    single = F.array(prop)
    if targets is None or each is None:
        return single, amount.cast(SHARE)
    return targets.otherwise(single), each.otherwise(amount.cast(SHARE))


def tagged_items(tagged: DataFrame, side: str, members: Sequence[str]) -> DataFrame:
    """Items of one side ('STR' or 'LTR') from the tagged ledger: single-property rows and even splits.

    A blank expense type is booked as 'other'; a row without property is left to ``dropped_items``.
    """
    split = f"{side} - Split"
    targets, each = split_targets(F.col("category"), blank_to_null(F.col("property")), F.col("amount"), {split: members})
    return tagged.filter(F.col("category").isin(side, split)).select(
        F.explode(targets).alias("property"),
        F.coalesce(blank_to_null(F.col("expense_type")), F.lit("other")).alias("template_category"),
        each.alias("amount"),
    )


def cashflow_items(summaries: DataFrame, *, year: int, labels: Mapping[str, str | None], aliases: Mapping[str, str]) -> DataFrame:
    """Items from annual cash-flow summaries of exactly Jan to Dec of the year; expenses are negative."""
    label = lookup(F.col("category"), labels)
    return (
        summaries.filter(F.col("period") == f"Jan {year} to Dec {year}")
        .select(
            with_alias(F.col("property"), aliases).alias("property"),
            label.alias("template_category"),
            F.when(F.col("side") == "expense", -F.col("amount")).otherwise(F.col("amount")).cast(SHARE).alias("amount"),
        )
        .filter("template_category IS NOT NULL")
    )


def interest_items(interest: DataFrame, *, year: int, members: Sequence[str]) -> DataFrame:
    """``interest(year, property, amount)`` -> negative items of the properties of one side."""
    return interest.filter((F.col("year") == year) & F.col("property").isin(*members)).select(
        "property", F.lit(INTEREST).alias("template_category"), (-F.col("amount")).cast(SHARE).alias("amount")
    )


def earning_items(payouts: DataFrame) -> DataFrame:
    """``payouts(property, net_payout)`` -> revenue items."""
    return payouts.select(
        "property", F.lit(REVENUE).alias("template_category"), F.col("net_payout").cast(SHARE).alias("amount")
    )


def net_payout_by_property(earnings: DataFrame) -> DataFrame:
    return earnings.groupBy("property").agg(F.sum("net_payout").alias("net_payout"))


def _complete() -> Column:
    return (
        blank_to_null(F.col("property")).isNotNull()
        & blank_to_null(F.col("template_category")).isNotNull()
        & F.col("amount").isNotNull()
    )


def rollup(items: DataFrame, *, sign: str = "abs") -> DataFrame:
    """Total per (property, template category). ``sign='abs'`` adds each item as positive, 'net' lets refunds reduce."""
    amount = display_amount(F.col("amount"), sign)
    return items.filter(_complete()).groupBy("property", "template_category").agg(F.sum(amount).alias("amount"))


def dropped_items(items: DataFrame) -> DataFrame:
    """Items the rollup leaves out: no property, no category or no amount."""
    return items.filter(~_complete())


def on_fixed_layout(totals: DataFrame, layout: Mapping[str, int]) -> DataFrame:
    """``(property, row_no, label, amount)`` on a fixed label layout; zero cells are left out."""
    pairs = [x for label, row in layout.items() for x in (F.lit(label), F.lit(row))]
    row_no = F.try_element_at(F.create_map(*pairs), F.col("template_category"))
    return (
        totals.select("property", row_no.alias("row_no"), F.col("template_category").alias("label"), "amount")
        .filter("row_no IS NOT NULL AND amount <> 0")
    )


def on_scanned_layout(totals: DataFrame, layout: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(cells, unmatched) on a layout that differs per sheet: ``layout(sheet, row_no, label)``.

    Labels match ignoring case; the first row of a repeated label is used. Sheets that the layout does not
    contain are skipped; categories without a row on their sheet come back as ``unmatched``.
    """
    keyed = (
        layout.withColumn("__label", F.lower(F.trim("label")))
        .groupBy(F.col("sheet").alias("property"), "__label")
        .agg(F.min_by(F.struct("row_no", "label"), "row_no").alias("__at"))
    )
    sheets = layout.select(F.col("sheet").alias("property")).distinct()
    nonzero = totals.filter("amount <> 0").join(sheets, "property", "left_semi").withColumn(
        "__label", F.lower("template_category")
    )
    joined = nonzero.join(keyed, ["property", "__label"], "left")
    cells = joined.filter("__at IS NOT NULL").select(
        "property", F.col("__at.row_no").alias("row_no"), F.col("__at.label").alias("label"), "amount"
    )
    return cells, joined.filter("__at IS NULL").select("property", "template_category", "amount")


def wide(cells: DataFrame, properties: Sequence[str]) -> DataFrame:
    """One row per label, one column per property of the given list."""
    return cells.groupBy("row_no", "label").pivot("property", list(properties)).agg(F.sum("amount"))


def cleared_template(cells: DataFrame, *, value_columns: Sequence[str] = ("D",)) -> DataFrame:
    """``cells(sheet, row_no, col, value)`` with value cells emptied; labels and formulas stay."""
    is_value = F.col("col").isin(*value_columns) & ~F.coalesce(F.col("value").startswith("="), F.lit(False))
    return cells.withColumn("value", F.when(~is_value, F.col("value")))


def pm_detail(txns: DataFrame, *, year: int, labels: Mapping[str, str | None], aliases: Mapping[str, str]) -> DataFrame:
    """Audit rows behind the P&L: ``txns(property, date, payee, description, cash_in, cash_out, category)``."""
    rows = txns.filter(F.year("date") == year).select(
        with_alias(F.col("property"), aliases).alias("property"),
        F.col("date").cast("string").alias("date"),
        F.lit("pm").alias("source"),
        "description",
        cash_amount(F.col("cash_in"), F.col("cash_out")).alias("amount"),
        lookup(F.col("category"), labels).alias("template_category"),
        F.concat(F.lit("payee="), F.coalesce("payee", F.lit(""))).alias("notes"),
    )
    return rows.filter("template_category IS NOT NULL").select("property", *DETAIL_HEADERS)


def pm_totals(txns: DataFrame, *, year: int, labels: Mapping[str, str | None]) -> DataFrame:
    """Parsed total per (property, template category), signed as printed."""
    amount = cash_amount(F.col("cash_in"), F.col("cash_out"))
    return (
        txns.filter(F.year("date") == year)
        .select("property", lookup(F.col("category"), labels).alias("template_category"), amount.alias("amount"))
        .filter("template_category IS NOT NULL")
        .groupBy("property", "template_category").agg(F.sum("amount").alias("parsed"))
    )


def flatten_reports(reports: DataFrame, *, year: int, aliases: Mapping[str, str]) -> DataFrame:
    """Nested reports -> one row per transaction of the year.

    ``reports(doc_id, period_start, properties ARRAY<STRUCT<name, transactions ARRAY<STRUCT<...>>>>)``;
    reports that start in another year are left out, undated ones are kept.
    """
    return (
        reports.filter(F.col("period_start").isNull() | (F.year("period_start") == year))
        .select("doc_id", F.explode("properties").alias("p"))
        .select("doc_id", with_alias(F.col("p.name"), aliases).alias("property"), F.explode("p.transactions").alias("t"))
        .select("doc_id", "property", "t.*")
        .filter(F.year("date") == year)
    )
