"""The commands of the bookkeeping cycle as functions from tables to tables.

``ingest`` -> ``tag`` -> ``review_tables`` -> people -> ``apply_review`` -> ``build`` -> ``check_filing``. Nothing here
starts a job by itself except the size checks of the operators; write results with ``ledgerloom.sources.sinks``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.fixed_values import STR_LAYOUT
from ledgerloom.operators import categorize, guards, learning, matching, review, rollup, verify, worksheet
from ledgerloom.operators.card import CardStatements
from ledgerloom.operators.cashflow import CashFlowPages
from ledgerloom.operators.checking import CheckingStatements
from ledgerloom.operators.layout import OwnerStatements
from ledgerloom.scale import durable
from ledgerloom.sources.sinks import write_stage
from ledgerloom.sources.tables import stage_path


@dataclass(frozen=True)
class Business:
    """Everything that belongs to one business: properties, cards, payers, patterns, maps, thresholds."""

    str_properties: Sequence[str]
    ltr_properties: Sequence[str]
    cards: Sequence[str] = ()
    pm_payer: str = ""
    payout_patterns: Sequence[str] = ()
    card_patterns: Sequence[str] = ("payment thank you",)
    worksheet_rules: worksheet.Rules = worksheet.Rules()
    aliases: Mapping[str, str] = field(default_factory=dict)
    pm_labels: Mapping[str, str | None] = field(default_factory=dict)
    cashflow_labels: Mapping[str, str | None] = field(default_factory=dict)
    min_confidence: float = 0.80
    card_sign: int = 1
    property_rules: Sequence[tuple[str, str]] = ()
    property_header: str = ""


@dataclass(frozen=True)
class OwnerReports:
    """What owner statements hold: rows, property sections and document totals."""

    transactions: DataFrame
    properties: DataFrame
    reports: DataFrame


@dataclass(frozen=True)
class Year:
    """Tables of a built year."""

    str_totals: DataFrame
    ltr_totals: DataFrame
    detail: DataFrame
    double_counts: DataFrame


def ingest(checking_docs: DataFrame, card_docs: DataFrame, business: Business, *, strict: bool = True) -> DataFrame:
    """Statement texts -> one ledger ``(txn_id, date, description, amount, raw_amount, account, kind, section)``.

    With ``strict`` unreadable documents and failed section checks raise. ``card_sign=-1`` turns card purchases
    negative like withdrawals.
    """
    checking = CheckingStatements(checking_docs, stored=strict)
    card = CardStatements(card_docs, business.cards, stored=strict)
    if strict:
        guards.enforce_empty(checking.errors().unionByName(card.errors()))
        guards.enforce(guards.section_checks(checking.statements(), checking.transactions()))
    rows = categorize.union_sources(
        [
            (checking.transactions().withColumn("position", F.struct("section_no", "record_no")), "checking", 1),
            (
                card.transactions().withColumn(
                    "position", F.struct(F.col("block_no").alias("section_no"), F.col("row_no").alias("record_no"))
                ),
                "card", business.card_sign,
            ),
        ]
    )
    # The id names the place in the documents, so reading them again gives the same ids.
    txn_id = F.concat_ws(":", "kind", "doc_id", "position.section_no", "position.record_no")
    return rows.select(
        txn_id.alias("txn_id"), "doc_id", "date", "description", "amount", "raw_amount", "account", "kind", "section",
        "cardholder",
    )


def ingest_owner_statements(words: DataFrame, business: Business, *, strict: bool = True) -> OwnerReports:
    """Word boxes -> owner reports. With ``strict`` unreadable documents and failed report checks raise.

    The words are walked once; rows, sections and totals come from the stored walk.
    """
    parsed = OwnerStatements(words, business.property_rules, business.property_header, stored=True)
    # A section is named by the place of its heading.
    section = F.concat_ws(":", "property_page", "property_y").alias("property_id")
    out = OwnerReports(parsed.transactions().select("*", section), parsed.properties().select("*", section), parsed.reports())
    if strict:
        guards.enforce_empty(parsed.errors())
        guards.enforce(guards.pm_report_checks(
            out.reports, out.properties, out.transactions.select("doc_id", "property_id", "cash_in", "cash_out")))
    return out


def tag(ledger: DataFrame, vendor_map: DataFrame, business: Business) -> tuple[DataFrame, DataFrame]:
    """(tagged rows, rows skipped because their money is counted elsewhere)."""
    skip = categorize.skip_rule(
        F.col("amount"), F.col("description"), F.col("kind") == "card", business.payout_patterns, business.card_patterns
    )
    tagged = categorize.categorize(ledger.filter(~skip), vendor_map, min_confidence=business.min_confidence)
    return tagged, ledger.filter(skip)


def review_tables(
    queue: DataFrame, business: Business, *, year: int, worksheet_rows: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """(vendor table, transaction table) for people, prefilled from the bookkeeper's worksheet when given.

    ``queue`` needs a unique integer ``ord``; ``worksheet_rows(w_id, w_ord, date, cost, source, type, description)``.
    """
    prefills = None
    if worksheet_rows is not None:
        parsed = worksheet.parse(worksheet_rows)
        pairs = matching.match_date_amount(
            queue.select(F.col("ord").alias("q_id"), F.col("ord").alias("q_ord"), "date", "amount", "description"),
            parsed.select("w_id", "w_ord", F.col("txn_date").alias("date"), F.col("amount").alias("cost"), "source"),
        )
        prefills = durable(review.prefills_from_pairs(pairs, parsed, business.worksheet_rules))
    return review.vendor_table(queue, prefills), review.transaction_table(queue, year=year, prefills=prefills)


def apply_review(
    transaction_table: DataFrame, vendor_map: DataFrame, typed_vendors: DataFrame, typed_rows: DataFrame, *, year: int
) -> tuple[DataFrame, DataFrame]:
    """(resolved rows, next vendor map) from what people typed into the two tables."""
    by_vendor = durable(review.vendor_decisions(typed_vendors))
    resolved = review.resolve(transaction_table, by_vendor, review.row_overrides(typed_rows))
    return resolved, learning.learn_from_vendor_decisions(vendor_map, by_vendor, year=year)


def build(
    auto: DataFrame,
    resolved: DataFrame,
    business: Business,
    *,
    year: int,
    earnings: DataFrame,
    interest: DataFrame,
    cashflow: DataFrame,
    double_counted: DataFrame | None = None,
    sign: str = "abs",
) -> tuple[DataFrame, DataFrame]:
    """(short-term totals, long-term totals) per property and label."""
    booked = rollup.tagged_union(auto, resolved)
    long_term = booked if double_counted is None else matching.exclude_deposits(booked, double_counted)
    str_items = (
        rollup.earning_items(rollup.net_payout_by_property(earnings))
        .unionByName(rollup.tagged_items(booked, "STR", business.str_properties))
        .unionByName(rollup.interest_items(interest, year=year, members=business.str_properties))
    )
    ltr_items = (
        rollup.cashflow_items(cashflow, year=year, labels=business.cashflow_labels, aliases=business.aliases)
        .unionByName(rollup.interest_items(interest, year=year, members=business.ltr_properties))
        .unionByName(rollup.tagged_items(long_term, "LTR", business.ltr_properties))
    )
    return rollup.rollup(str_items, sign=sign), rollup.rollup(ltr_items, sign=sign)


def build_year(
    auto: DataFrame,
    resolved: DataFrame,
    business: Business,
    *,
    year: int,
    earnings: DataFrame,
    interest: DataFrame,
    deposits: DataFrame,
    pm_txns: DataFrame,
    cashflow_pages: DataFrame,
    strict: bool = False,
    sign: str = "abs",
) -> Year:
    """The whole build: double counts are found and left out, cash-flow pages are parsed, the audit detail is kept.

    ``deposits(q_id, q_ord, date, amount, description)`` are the bank's incoming rows,
    ``pm_txns(ord, reference, property, date, payee, description, cash_in, cash_out, category)`` the property manager's.
    With ``strict`` any double count raises.
    """
    found = durable(matching.double_counts(deposits, pm_txns, payer=business.pm_payer))
    if strict:
        guards.enforce_empty(found)
    double_counted = durable(deposits.join(found.select("q_id"), "q_id", "left_semi").select("date", "description", "amount"))
    cashflow = CashFlowPages(cashflow_pages, (business.pm_payer,), stored=True).summaries()
    str_totals, ltr_totals = build(
        auto, resolved, business, year=year, earnings=earnings, interest=interest, cashflow=cashflow,
        double_counted=double_counted, sign=sign,
    )
    detail = rollup.pm_detail(pm_txns, year=year, labels=business.pm_labels, aliases=business.aliases)
    return Year(str_totals, ltr_totals, detail, found)


def build_from_worksheet(
    worksheet_rows: DataFrame, business: Business, *, year: int, earnings: DataFrame, interest: DataFrame
) -> DataFrame:
    """Short-term totals straight from the bookkeeper's worksheet, without review."""
    classified = worksheet.classify(worksheet_rows, year=year, rules=business.worksheet_rules)
    items = (
        worksheet.to_items(classified, business.str_properties)
        .unionByName(rollup.earning_items(rollup.net_payout_by_property(earnings)))
        .unionByName(rollup.interest_items(interest, year=year, members=business.str_properties))
    )
    return rollup.rollup(items)


def check_filing(filed_cells: DataFrame, totals: DataFrame, layout: Mapping[str, int] = STR_LAYOUT) -> DataFrame:
    """Filed cells against generated totals on the fixed layout."""
    generated = rollup.on_fixed_layout(totals, layout).select(
        F.col("property").alias("sheet"), "row_no", F.round("amount", 2).cast("double").alias("generated")
    )
    return verify.compare(verify.filed_cells(filed_cells), generated)


def bootstrap(vendor_map: DataFrame, pm_txns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(next vendor map, one-row report) learned from property-manager transactions."""
    return learning.learn_from_pm(vendor_map, pm_txns), learning.pm_learning_report(vendor_map, pm_txns)


def store_year(root: str, year: int, **stages: DataFrame) -> None:
    """Write the stage tables of one year; running a year again replaces them."""
    for name, df in stages.items():
        write_stage(df, stage_path(root, name, year))
