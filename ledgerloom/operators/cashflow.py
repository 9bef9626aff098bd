"""Annual cash-flow appendix pages: ``pages(doc_id, page_no, text)`` -> category totals per property."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.fixed_values import CASHFLOW_SKIPPED_STARTS
from ledgerloom.functions.money import TOTAL
from ledgerloom.functions.text import starts_with_any, strip
from ledgerloom.scale import computed_once, durable, needs_spreading, running_last

AMOUNT = "-?[0-9,]+\\.[0-9]{2}"
PAGES_PER_CHUNK = 64
PAGES_IN_ONE_WALK = 20_000


def is_cashflow_page(text: Column) -> Column:
    return text.contains("Cash Flow") & text.contains("12 Month")


def last_amount(line: Column) -> Column:
    """Last amount on a line: the annual total, a sum."""
    found = F.regexp_extract_all(line, F.lit(f"({AMOUNT})"), F.lit(1))
    return F.regexp_replace(F.try_element_at(found, F.lit(-1)), ",", "").try_cast(TOTAL)


@dataclass(frozen=True)
class CashFlowPages:
    """``skipped_starts``: further line starts to ignore, such as the property manager's name.

    ``stored``: keep the chosen pages in a table, for more than one output. ``spread``: walk pages and lines chunk by chunk, for documents with very many pages; looked up when None.
    """

    pages: DataFrame
    skipped_starts: Sequence[str] = ()
    spread: bool | None = None
    stored: bool = False

    @cached_property
    def _spread(self) -> bool:
        return needs_spreading(self.pages, ["doc_id"], PAGES_IN_ONE_WALK, stored=self.pages) if self.spread is None else self.spread

    @cached_property
    def groups(self) -> DataFrame:
        """Cash-flow pages with ``group_page``, the first page of the property they belong to."""
        text = F.coalesce("text", F.lit(""))
        pages = self.pages.select("doc_id", "page_no", text.alias("text"), is_cashflow_page(text).alias("is_cf"))
        chunk = F.floor(F.col("page_no") / PAGES_PER_CHUNK)
        pages = running_last(
            pages, ["doc_id"], chunk, ["page_no"], {"previous_cf": F.col("is_cf")}, inclusive=False, spread=self._spread
        )
        starts = F.col("is_cf") & (
            F.col("text").contains("Properties:") | ~F.coalesce("previous_cf", F.lit(False))
        )
        pages = running_last(
            pages, ["doc_id"], chunk, ["page_no"], {"group_page": F.when(starts, F.col("page_no"))}, spread=self._spread
        )
        pages = pages.filter("is_cf").select("doc_id", "group_page", "page_no", "text")
        return durable(pages) if self.stored else pages

    @cached_property
    def _lines(self) -> DataFrame:
        """Non-blank lines with what they do to the section and to the label being wrapped."""
        rows = self.groups.select(
            "doc_id", "group_page", "page_no", F.posexplode(F.split("text", "\n")).alias("line_no", "line")
        )
        rows = rows.withColumn("s", strip(F.col("line")))
        s = F.col("s")
        kind = (
            F.when(s == "", "blank")
            .when(starts_with_any(s, [*CASHFLOW_SKIPPED_STARTS, *self.skipped_starts]), "reset")
            .when(s == "Income", "income")
            .when(s == "Expense", "expense")
            .when(s == "Other Items", "other")
            .when(s.startswith("Total Operating"), "operating_total")
            .when(s.startswith("NOI - Net"), "reset")
            .when(s.startswith("Total Income"), "income_total")
            .when(s.startswith("Total Expense"), "expense_total")
            .when(s.startswith("Net Income"), "net_total")
            .when(s.startswith("Net Other Items"), "reset")
            .otherwise("body")
        )
        place = ["doc_id", "group_page", "page_no", "line_no"]
        rows = computed_once(rows, "s", keys=place)
        rows = computed_once(rows, "s", kind.alias("kind"), keys=place)
        section = (
            F.when(F.col("kind").isin("income", "expense", "other"), F.col("kind"))
            .when(F.col("kind").isin("income_total", "expense_total", "net_total"), "none")
        )
        rows = running_last(
            rows, ["doc_id", "group_page"], F.col("page_no"), ["page_no", "line_no"], {"section": section},
            spread=self._spread,
        )
        inside = (F.col("kind") == "body") & F.coalesce(F.col("section") != "none", F.lit(False))
        has_amount = F.col("s").rlike(AMOUNT)
        name = strip(F.regexp_extract("s", f"^(.*?)(?:{AMOUNT})", 1))
        rows = computed_once(
            rows, "s", "kind", "section", inside.alias("inside"), has_amount.alias("has_amount"),
            F.when(inside & has_amount, name).alias("name"), keys=place,
        )
        inside = F.col("inside")
        item = (F.col("name") != "") & ~F.lower("name").startswith("total ")
        fragment = inside & ~F.col("has_amount") & ~F.col("s").isin("Income", "Expense", "Operating")
        event = (
            F.when(F.coalesce(item, F.lit(False)), "item")
            .when(fragment, "wrap")
            .when((F.col("kind") == "blank") | ((F.col("kind") == "body") & ~inside), F.lit(None))
            .otherwise("reset")
        )
        rows = rows.withColumn("event", event)
        at = F.struct("page_no", "line_no")
        return running_last(
            rows, ["doc_id", "group_page"], F.col("page_no"), ["page_no", "line_no"],
            {"owner": F.when(F.col("event").isin("item", "reset"),
                             F.struct(at.alias("at"), (F.col("event") == "item").alias("is_item")))},
            spread=self._spread,
        )

    @cached_property
    def metadata(self) -> DataFrame:
        """Property name and period of each group: the first line that states them."""
        at = F.struct("page_no", "line_no")
        line = F.col("line")
        stated = strip(F.regexp_extract("line", r"(?s)^Properties:(.*)\z", 1))
        after_dash = F.regexp_extract(stated, r"(?s)^.*? - (.*)\z", 1)
        name = F.when(stated.contains(" - "), strip(after_dash)).otherwise(stated)
        period = strip(F.regexp_extract("line", r"(?s)Period Range:(.*)\z", 1))
        is_name, is_period = line.startswith("Properties:"), line.contains("Period Range:")
        rows = self.groups.select(
            "doc_id", "group_page", "page_no", F.posexplode(F.split("text", "\n")).alias("line_no", "line")
        )
        return rows.filter(is_name | is_period).groupBy("doc_id", "group_page").agg(
            F.coalesce(F.min_by(name, F.when(is_name, at)), F.lit("")).alias("property"),
            F.coalesce(F.min_by(period, F.when(is_period, at)), F.lit("")).alias("period"),
        )

    def items(self) -> DataFrame:
        """``(doc_id, group_page, side, category, amount)`` with wrapped labels repaired.

        A category printed again replaces the earlier value, also when its label only matches for a
        moment while a wrapped label is being completed.
        """
        rows = self._lines.filter("owner.is_item AND section IN ('income', 'expense')")
        rows = rows.filter("event IN ('item', 'wrap')")
        order = F.struct("page_no", "line_no")
        # One printed label owns its own line and the few lines it wraps to.
        labels = rows.groupBy("doc_id", "group_page", F.col("owner.at").alias("at"), F.col("section").alias("side")).agg(
            F.array_sort(
                F.collect_list(F.struct("page_no", "line_no", F.coalesce("name", "s").alias("part")))
            ).alias("parts"),
            F.max(F.when(F.col("event") == "item", last_amount(F.col("s")))).alias("amount"),
        )
        texts = F.transform("parts", lambda p: p["part"])
        steps = F.transform(
            F.sequence(F.lit(1), F.size(texts)), lambda n: F.array_join(F.slice(texts, F.lit(1), n), " ")
        )
        key = ["doc_id", "group_page", "side"]
        names = computed_once(labels, *key, "at", "amount", steps.alias("steps")).select(
            *key, "at", "amount", F.size("steps").alias("n"), F.posexplode("steps").alias("i", "category")
        )
        # The latest label that ever reads like this; it stays if that is its complete form.
        latest = names.groupBy(*key, "category").agg(
            F.max_by(F.struct((F.col("i") == F.col("n") - 1).alias("final"), "amount"), "at").alias("last")
        )
        return latest.filter("last.final").select(*key, "category", F.col("last.amount").alias("amount"))

    def totals(self) -> DataFrame:
        """Printed totals per group: the last statement of each wins."""
        at = F.struct("page_no", "line_no")
        kind, section = F.col("kind"), F.col("section")
        rows = self._totals_rows()
        what = (
            F.when((kind == "income_total") | ((kind == "operating_total") & (section == "income")), "income")
            .when((kind == "expense_total") | ((kind == "operating_total") & (section == "expense")), "expense")
            .when(kind == "net_total", "net")
        )
        rows = rows.select("doc_id", "group_page", at.alias("at"), what.alias("what"), last_amount(F.col("s")).alias("v"))
        rows = rows.filter("what IS NOT NULL AND v IS NOT NULL")
        return rows.groupBy("doc_id", "group_page").agg(
            *[
                F.max_by(F.when(F.col("what") == w, F.col("v")), F.when(F.col("what") == w, F.col("at"))).alias(n)
                for w, n in (("income", "total_income"), ("expense", "total_expense"), ("net", "net_income"))
            ]
        )

    def _totals_rows(self) -> DataFrame:
        return self._lines.filter(F.col("kind").isin("income_total", "expense_total", "net_total", "operating_total"))

    def summaries(self) -> DataFrame:
        """Items with property and period: the input of the P&L rollup."""
        return self.items().join(self.metadata, ["doc_id", "group_page"]).select(
            "doc_id", "group_page", "property", "period", "side", "category", "amount"
        )
