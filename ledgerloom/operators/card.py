"""Card statements: account summary, per-cardholder blocks, cycle subtotals.

Cardholder state is positional: the text is split at the subtotal lines inside the row, and block ``i``
belongs to the card after the one named in subtotal ``i``. No window and no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.fixed_values import CARD_NOISE_SUBSTRINGS, CARD_NOISE_YEAR, CARD_SUMMARY_LABELS
from ledgerloom.functions.dates import build_date, year_in_period
from ledgerloom.functions.money import parse_money
from ledgerloom.functions.text import contains_any, lookup, nonempty_group, strip
from ledgerloom.operators.cleaning import clean_lines
from ledgerloom.scale import computed_once, durable

# Printed forms.
ROW = r"(?U)^([0-9]{2}/[0-9]{2})\s+(.+?)\s+(-?[0-9,]*\.[0-9]{2})\s*\z"
PERIOD = (
    r"(?U)Opening/Closing Date\s+([0-9]{2})/([0-9]{2})/([0-9]{2})\s*-\s*([0-9]{2})/([0-9]{2})/([0-9]{2})"
)
SUBTOTAL = r"TRANSACTIONS THIS CYCLE \(CARD ([0-9]{4})\)[^\S\n]*\$?([0-9,]+\.[0-9]{2})(-)?"


def summary_amount(text: Column, label: str) -> Column:
    """Printed ``+$``, ``-$`` or ``$`` amount after a label."""
    pattern = rf"(?U:{label}\s+)([+-]?)\$(-?[0-9,]+\.[0-9]{{2}})"
    value = parse_money(nonempty_group(text, pattern, 2))
    return F.when(F.regexp_extract(text, pattern, 1) == "-", -value).otherwise(value)


@dataclass(frozen=True)
class CardStatements:
    """Parsed view of ``docs(doc_id, account, text)``; ``cards`` lists the card numbers in print order.

    ``stored`` keeps the prepared documents in a table: set it when more than one output is read.
    """

    docs: DataFrame
    cards: Sequence[str]
    stored: bool = False

    @cached_property
    def _headers(self) -> DataFrame:
        p = {i: F.regexp_extract("text", PERIOD, i).try_cast("int") for i in range(1, 7)}
        cleaned = F.array_join(clean_lines(F.col("text"), undouble=True), "\n")
        base = computed_once(
            self.docs,
            "doc_id", "account",
            build_date(p[3] + 2000, p[1], p[2]).alias("period_start"),
            build_date(p[6] + 2000, p[4], p[5]).alias("period_end"),
            cleaned.alias("cleaned"),
        )
        base = base.withColumns({c: summary_amount(F.col("cleaned"), label) for c, label in CARD_SUMMARY_LABELS.items()})
        pattern = F.lit(SUBTOTAL)
        raw = F.regexp_extract_all("cleaned", pattern, F.lit(2))
        sign = F.regexp_extract_all("cleaned", pattern, F.lit(3))
        subs = F.zip_with(
            F.regexp_extract_all("cleaned", pattern, F.lit(1)),
            F.zip_with(raw, sign, lambda a, s: F.when(s == "-", -parse_money(a)).otherwise(parse_money(a))),
            lambda card, amount: F.struct(card.alias("card"), amount.alias("amount")),
        )
        headers = computed_once(base.withColumn("subtotals", subs)).withColumn(
            "error",
            F.when(F.coalesce(*CARD_SUMMARY_LABELS).isNull(), "no account summary").when(
                F.col("period_start").isNull() | F.col("period_end").isNull(), "no opening/closing date"
            ),
        )
        return durable(headers) if self.stored else headers

    def statements(self) -> DataFrame:
        def last_amount(card: str) -> Column:
            own = F.filter("subtotals", lambda s: s["card"] == card)
            return F.try_element_at(own, F.lit(-1))["amount"]

        cycle = F.create_map(*[x for c in self.cards for x in (F.lit(c), last_amount(c))])
        return self._headers.filter("error IS NULL").select(
            "doc_id", "account", "period_start", "period_end", *CARD_SUMMARY_LABELS, cycle.alias("cycle_totals")
        )

    def errors(self) -> DataFrame:
        return self._headers.filter("error IS NOT NULL").select("doc_id", "account", "error")

    @cached_property
    def _rows(self) -> DataFrame:
        # A line that holds a subtotal of a listed card ends a block; lines of other cards change nothing.
        known = "|".join(self.cards)
        boundary = (
            rf"(?md)^.*TRANSACTIONS THIS CYCLE \(CARD (?:{known})\)[^\S\n]*\$?[0-9,]+\.[0-9]{{2}}.*$"
        )
        ended = F.filter("subtotals", lambda s: s["card"].isin(*self.cards))
        after = {c: n for c, n in zip(self.cards, [*self.cards[1:], None])}
        blocks = (
            self._headers.filter("error IS NULL")
            .select("doc_id", "account", "period_start", "period_end", ended.alias("ended"),
                    F.posexplode(F.split("cleaned", boundary)).alias("block_no", "block"))
            .withColumn(
                "cardholder",
                F.when(F.col("block_no") == 0, F.lit(self.cards[0])).otherwise(
                    lookup(F.try_element_at("ended", F.greatest("block_no", F.lit(1)))["card"], after)
                ),
            )
        )
        keep = F.filter(
            F.transform(F.split("block", "\n"), strip),
            lambda x: x.rlike(ROW) & ~contains_any(x, CARD_NOISE_SUBSTRINGS) & ~x.rlike(CARD_NOISE_YEAR),
        )
        rows = blocks.select("doc_id", "account", "period_start", "period_end", "cardholder", "block_no",
                             F.posexplode(keep).alias("row_no", "line"))
        month = F.substring("line", 1, 2).cast("int")
        day = F.substring("line", 4, 2).cast("int")
        date = build_date(year_in_period(month, F.col("period_start"), F.col("period_end")), month, day)
        return computed_once(
            rows,
            "doc_id", "account", "cardholder", "block_no", "row_no", "line", date.alias("date"),
            strip(F.regexp_extract("line", ROW, 2)).alias("description"),
            parse_money(F.regexp_extract("line", ROW, 3)).alias("amount"),
        ).withColumn(
            "reason",
            F.when(F.col("cardholder").isNull(), "no active cardholder").when(F.col("date").isNull(), "invalid date"),
        )

    def transactions(self) -> DataFrame:
        return self._rows.filter("reason IS NULL").select(
            "doc_id", "block_no", "row_no", "date", "description", "amount", "cardholder", "account"
        )

    def warnings(self) -> DataFrame:
        return self._rows.filter("reason IS NOT NULL").select("doc_id", "block_no", "row_no", "reason", "line")
