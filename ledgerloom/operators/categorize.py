"""Tag transactions from the vendor map and queue the rest for review."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.text import blank_to_null, contains_any, vendor_key
from ledgerloom.scale import computed_once, join_unique

SOURCES = ("auto", "ambiguous", "unknown")


def skip_rule(
    amount: Column, description: Column, is_card: Column, payout_patterns: Sequence[str], card_patterns: Sequence[str]
) -> Column:
    """Rows already counted elsewhere: known payouts into checking, and payments of the card itself."""
    lower = F.lower(description)
    return F.when(is_card, contains_any(lower, card_patterns)).otherwise(
        (amount > 0) & contains_any(lower, payout_patterns)
    )


def union_sources(sources: Sequence[tuple[DataFrame, str, int]]) -> DataFrame:
    """Union of ``(transactions, kind, sign)``: ``amount`` times ``sign`` is the common sign, ``raw_amount`` stays.

    Card purchases are printed positive and checking withdrawals negative; pass -1 for cards to align them.
    """
    parts = [
        df.withColumns(
            {"raw_amount": F.col("amount"), "amount": (F.col("amount") * sign).cast("decimal(18,2)"), "kind": F.lit(kind)}
        )
        for df, kind, sign in sources
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def categorize(
    txns: DataFrame,
    vendor_map: DataFrame,
    *,
    min_confidence: float = 0.80,
    description: str = "description",
    strip_leading_date: bool = False,
) -> DataFrame:
    """Add ``vendor, category, confidence, property, expense_type, source``.

    ``source`` is 'unknown' without a map entry, 'ambiguous' when the entry is flagged, not confident enough
    or has no category, else 'auto'. Property and expense type travel with the tag.
    """
    others = [c for c in txns.columns if c != "vendor"]
    key = vendor_key(F.col(description), strip_leading_date=strip_leading_date)
    keyed = computed_once(txns, *others, key.alias("vendor"))
    entries = vendor_map.select(
        "vendor",
        F.col("category").alias("__category"),
        F.coalesce("confidence", F.lit(0.0)).alias("__confidence"),
        F.coalesce("ambiguous", F.lit(False)).alias("__ambiguous"),
        F.col("property").alias("__property"),
        F.col("expense_type").alias("__expense_type"),
    )
    joined = join_unique(keyed, entries, ["vendor"], "left")
    doubtful = (
        F.col("__ambiguous") | (F.col("__confidence") < min_confidence) | blank_to_null(F.col("__category")).isNull()
    )
    source = F.when(F.col("__confidence").isNull(), "unknown").when(doubtful, "ambiguous").otherwise("auto")
    return joined.withColumns(
        {
            "source": source,
            "category": F.coalesce("__category", F.lit("")),
            "confidence": F.coalesce("__confidence", F.lit(0.0)),
            "property": F.coalesce("__property", F.lit("")),
            "expense_type": F.coalesce("__expense_type", F.lit("")),
        }
    ).drop("__category", "__confidence", "__ambiguous", "__property", "__expense_type")


def review_queue(tagged: DataFrame) -> DataFrame:
    """Ambiguous rows, then unknown rows (``queue_part`` 0 and 1)."""
    return tagged.filter(F.col("source").isin("ambiguous", "unknown")).withColumn(
        "queue_part", (F.col("source") == "unknown").cast("int")
    )


def bucket_counts(tagged: DataFrame) -> DataFrame:
    """Rows per source bucket; buckets without rows are kept."""
    counts = tagged.groupBy("source").agg(F.count(F.lit(1)).alias("rows"))
    spark = tagged.sparkSession
    return spark.createDataFrame([(s,) for s in SOURCES], "source STRING").join(counts, "source", "left").fillna(
        {"rows": 0}
    )
