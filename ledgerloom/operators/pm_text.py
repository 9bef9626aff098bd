"""Plain-text property-manager reports: ``MM/DD/YYYY description category amount`` lines and three totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.fixed_values import PM_TEXT_CATEGORIES
from ledgerloom.functions.dates import build_date
from ledgerloom.functions.money import parse_money
from ledgerloom.functions.text import lines, strip
from ledgerloom.operators.statement import find_money
from ledgerloom.scale import computed_once

# Printed forms, with and without preserved column gaps.
_DATE = r"(?U)^\s*(0?[1-9]|1[0-2])/(0?[1-9]|[12][0-9]|3[01])/([0-9]{4})\s+"
_AMOUNT = r"(-?\$?[0-9,]+\.[0-9]{2})\s*\z"
STRICT = _DATE + r"(.+?)\s{2,}([A-Za-z][A-Za-z0-9 ()%/&\-]*?)\s{2,}" + _AMOUNT
LOOSE = _DATE + r"(.+?)\s+" + _AMOUNT
TOTALS = {"total_income": "Total Income", "total_expenses": "Total Expenses", "net_to_owner": "Net to Owner"}


def totals(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "property_id", *[find_money(F.col("text"), v).alias(k) for k, v in TOTALS.items()])


def split_category(middle: Column, categories: Sequence[str]) -> Column:
    """Struct (description, category): the longest category at the end that leaves some description."""
    ordered = sorted(categories, key=len, reverse=True)

    def before(c: Column) -> Column:
        head = F.substring(middle, F.lit(1), F.length(middle) - F.length(c))
        return strip(F.regexp_replace(strip(head), r"-+\z", ""))

    options = F.transform(
        F.array(*[F.lit(c) for c in ordered]),
        lambda c: F.struct(
            F.when(F.lower(middle).endswith(F.lower(c)), before(c)).alias("description"), c.alias("category")
        ),
    )
    fits = F.filter(options, lambda o: o["description"].isNotNull() & (o["description"] != ""))
    return F.try_element_at(fits, F.lit(1))


def entries(docs: DataFrame, categories: Sequence[str] = PM_TEXT_CATEGORIES) -> DataFrame:
    """``docs(doc_id, property_id, text)`` -> report lines; rows without a readable category are left out."""
    rows = docs.select("doc_id", "property_id", F.posexplode(lines(F.col("text"))).alias("ord", "line"))
    rows = rows.filter(F.col("line").rlike(LOOSE))
    rows = computed_once(
        rows,
        *rows.columns,
        F.when(
            F.col("line").rlike(STRICT),
            F.struct(
                strip(F.regexp_extract("line", STRICT, 4)).alias("description"),
                strip(F.regexp_extract("line", STRICT, 5)).alias("category"),
            ),
        ).otherwise(split_category(strip(F.regexp_extract("line", LOOSE, 4)), categories)).alias("parts"),
    )
    part = [F.regexp_extract("line", LOOSE, i).cast("int") for i in (1, 2, 3)]
    return computed_once(
        rows,
        "doc_id", "ord",
        build_date(part[2], part[0], part[1]).alias("date"),
        F.col("parts.description").alias("description"),
        F.col("parts.category").alias("pm_category"),
        parse_money(F.regexp_extract("line", LOOSE, 5)).alias("amount"),
        "property_id",
    ).filter("date IS NOT NULL AND pm_category IS NOT NULL")
