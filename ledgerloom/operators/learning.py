"""Learn the vendor map from review decisions, PM transactions and matched prior filings.

Every variant is one ordered fold per vendor, written as one aggregation over the prior map (as entries that
come before everything else) united with the new observations: partial aggregation runs before the single
shuffle, so a vendor with a third of all rows costs no more than any other. The result is a pure function of its
inputs: running a year again gives the same map.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.fixed_values import NOT_LEARNED
from ledgerloom.functions.text import vendor_key
from ledgerloom.scale import computed_once
from ledgerloom.schemas import VENDOR_MAP


def empty_map(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame([], VENDOR_MAP)


def _text(c: str) -> Column:
    return F.nullif(F.col(c), F.lit(""))


def _keyed(rows: DataFrame, source: str) -> DataFrame:
    others = [c for c in rows.columns if c != "vendor"]
    return computed_once(rows, *others, vendor_key(F.col(source)).alias("vendor"))


def fold(prior: DataFrame, observations: DataFrame) -> DataFrame:
    """Merge ``observations(vendor, category, year, occurrences, confidence, property, expense_type, source, seq)``.

    The first category stays; another category sets ``ambiguous`` for good; occurrences add up; the last
    non-blank property and expense type win. ``seq`` orders the observations.
    """
    common = ["vendor", "category", "confidence", "occurrences", "property", "expense_type", "source"]
    old = prior.select(
        *common, F.col("learned_from").alias("years"), F.coalesce("ambiguous", F.lit(False)).alias("ambiguous"),
        F.lit(-1).cast("bigint").alias("seq"),
    )
    new = observations.select(
        *common,
        F.array_compact(F.array(F.col("year").cast("int"))).alias("years"),
        F.lit(False).alias("ambiguous"), F.col("seq").cast("bigint").alias("seq"),
    )
    rows = old.unionByName(new)
    category = _text("category")
    last = {
        n: F.max_by(n, F.when(_text(n).isNotNull(), F.col("seq"))) for n in ("property", "expense_type")
    }
    # Years are few: the set of year lists per vendor stays small.
    merged = rows.groupBy("vendor").agg(
        F.min_by(category, F.when(category.isNotNull(), F.col("seq"))).alias("category"),
        F.min_by("confidence", "seq").alias("confidence"),
        F.sum("occurrences").cast("bigint").alias("occurrences"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("years")))).alias("learned_from"),
        (F.max("ambiguous") | F.coalesce(F.min(category) != F.max(category), F.lit(False))).alias("ambiguous"),
        F.coalesce(last["property"], F.lit("")).alias("property"),
        F.coalesce(last["expense_type"], F.lit("")).alias("expense_type"),
        F.min_by("source", "seq").alias("source"),
    )
    return merged.select(
        "vendor", F.coalesce("category", F.lit("")).alias("category"), "confidence", "occurrences", "learned_from",
        "ambiguous", "property", "expense_type", "source",
    )


def learn_from_reviews(
    prior: DataFrame,
    decisions: DataFrame,
    *,
    confidence: float = 0.9,
    not_learned: Sequence[str] = NOT_LEARNED,
) -> DataFrame:
    """``decisions(description, category, property, expense_type, year, seq)``, one row per reviewed transaction."""
    rows = (
        _keyed(decisions.filter(F.coalesce("category", F.lit("")) != ""), "description")
        .filter((F.col("vendor") != "") & ~F.col("category").isin(*not_learned))
    )
    return fold(prior, rows.withColumns(
        {"occurrences": F.lit(1), "confidence": F.lit(confidence), "source": F.lit("review")}))


def learn_from_vendor_decisions(
    prior: DataFrame,
    decisions: DataFrame,
    *,
    year: int,
    confidence: float = 0.9,
    not_learned: Sequence[str] = NOT_LEARNED,
) -> DataFrame:
    """``decisions(vendor, category, property, expense_type, count)``, one row per vendor of the review table."""
    rows = decisions.filter(~F.col("category").isin(*not_learned)).withColumns(
        {
            "year": F.lit(year), "occurrences": F.coalesce(F.col("count"), F.lit(1)), "confidence": F.lit(confidence),
            "source": F.lit("review"), "seq": F.lit(0),
        }
    )
    return fold(prior, rows)


def pm_observations(txns: DataFrame, *, confidence: float = 0.95) -> DataFrame:
    """``txns(payee, category, year, seq)`` keyed by payee."""
    return (
        _keyed(txns.filter(F.coalesce("category", F.lit("")) != ""), "payee")
        .filter("vendor <> ''")
        .withColumns(
            {
                "occurrences": F.lit(1), "confidence": F.lit(confidence), "property": F.lit(""),
                "expense_type": F.lit(""), "source": F.lit("pm_bootstrap"),
            }
        )
    )


def learn_from_pm(prior: DataFrame, txns: DataFrame, *, confidence: float = 0.95) -> DataFrame:
    return fold(prior, pm_observations(txns, confidence=confidence))


def pm_learning_report(prior: DataFrame, txns: DataFrame) -> DataFrame:
    """One row: transactions, categories seen, vendors learned for the first time."""
    observed = pm_observations(txns).select("vendor").distinct()
    learned = observed.join(prior.select("vendor"), "vendor", "left_anti").agg(
        F.count(F.lit(1)).alias("vendors_learned")
    )
    seen = txns.agg(
        F.count(F.lit(1)).alias("total_transactions"),
        F.count_distinct(F.nullif("category", F.lit(""))).alias("categories_seen"),
    )
    return seen.join(learned, F.lit(True))


def learn_from_matches(prior: DataFrame, matched: DataFrame, *, year: int, confidence: float = 0.9) -> DataFrame:
    """``matched(description, category, seq)``: transactions paired with a prior filing's category."""
    rows = _keyed(matched, "description").filter("vendor <> ''").withColumns(
        {
            "year": F.lit(year), "occurrences": F.lit(1), "confidence": F.lit(confidence), "property": F.lit(""),
            "expense_type": F.lit(""), "source": F.lit("prior_filing"),
        }
    )
    return fold(prior, rows)


def match_report(prior: DataFrame, after: DataFrame, txns: DataFrame, filings: DataFrame, pairs: DataFrame) -> DataFrame:
    """One row: matched, unmatched on both sides, new vendors, vendors that became ambiguous."""
    old = prior.select("vendor", F.col("ambiguous").alias("was_ambiguous"))
    vendors = after.join(old, "vendor", "left").agg(
        F.count_if(F.col("was_ambiguous").isNull()).alias("new_vendors_learned"),
        F.count_if(F.col("ambiguous") & ~F.coalesce("was_ambiguous", F.lit(False))).alias("ambiguous"),
    )
    counts = (
        txns.agg(F.count(F.lit(1)).alias("n_txns"))
        .join(filings.agg(F.count(F.lit(1)).alias("n_filings")), F.lit(True))
        .join(pairs.agg(F.count(F.lit(1)).alias("matched")), F.lit(True))
    )
    return counts.join(vendors, F.lit(True)).select(
        "matched",
        (F.col("n_txns") - F.col("matched")).alias("unmatched_bank"),
        (F.col("n_filings") - F.col("matched")).alias("unmatched_prior"),
        "new_vendors_learned", "ambiguous",
    )
