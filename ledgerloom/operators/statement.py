"""Generic bank statements: ``MM/DD description amount [balance]`` lines plus labelled header totals.

A statement is one row with its text in one cell, so everything here is a projection: lines are split,
matched and exploded inside the row and nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.dates import build_date
from ledgerloom.functions.money import parse_money
from ledgerloom.functions.text import lines, nonempty_group, strip
from ledgerloom.scale import computed_once

# Fixed value: the printed form of a transaction line.
ROW = (
    r"(?U)^\s*(0?[1-9]|1[0-2])/(0?[1-9]|[12][0-9]|3[01])\s+(.+?)\s+"
    r"(-?\$?[0-9,]+\.[0-9]{2})(?:\s+(-?\$?[0-9,]+\.[0-9]{2}))?\s*\z"
)
HEADER_TOTALS = {
    "beginning": "Beginning Balance",
    "ending": "Ending Balance",
    "total_deposits": "Total Deposits",
    "total_withdrawals": "Total Withdrawals",
}


def find_money(text: Column, label: str) -> Column:
    """Amount printed after the first occurrence of a label, ignoring case; null when absent."""
    return parse_money(nonempty_group(text, rf"(?i)(?U:{label}\s*:?\s*)\$?(-?[0-9,]+\.[0-9]{{2}})", 1))


def header_totals(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, account, text)`` -> one row of printed totals per document."""
    return docs.select("doc_id", "account", *[find_money(F.col("text"), v).alias(k) for k, v in HEADER_TOTALS.items()])


def transactions(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, account, statement_year, text)`` -> transactions in document order.

    A row whose month is earlier than the first row's month belongs to the next year.
    """
    rows = F.filter(lines(F.col("text")), lambda line: line.rlike(ROW))
    first_month = F.regexp_extract(F.try_element_at("rows", F.lit(1)), ROW, 1).try_cast("int")
    month = F.regexp_extract("line", ROW, 1).cast("int")
    day = F.regexp_extract("line", ROW, 2).cast("int")
    year = F.col("statement_year") + (F.col("month") < F.col("first_month")).cast("int")
    found = computed_once(docs, "doc_id", "account", "statement_year", rows.alias("rows"))
    return (
        found.select("doc_id", "account", "statement_year", first_month.alias("first_month"),
                     F.posexplode("rows").alias("ord", "line"))
        .withColumns({"month": month, "day": day})
        .select(
            "doc_id",
            "ord",
            build_date(year, F.col("month"), F.col("day")).alias("date"),
            F.regexp_replace(strip(F.regexp_extract("line", ROW, 3)), r"(?U)\s{2,}", " ").alias("description"),
            parse_money(F.regexp_extract("line", ROW, 4)).alias("amount"),
            parse_money(F.regexp_extract("line", ROW, 5)).alias("balance"),
            "account",
        )
        .filter(F.col("date").isNotNull())
    )
