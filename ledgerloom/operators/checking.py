"""Checking statements: control totals, four transaction sections, multi-line records.

Sections are array slices between heading positions and records are a split before each date, both inside
the document's row. The only row-multiplying steps are ``explode``; there is no shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.fixed_values import (
    CHECKING_NOISE_LINES,
    CHECKING_NOISE_STARTS,
    CHECKING_SECTIONS,
    CHECKING_SUMMARY_LABELS,
)
from ledgerloom.functions.dates import build_date, month_name_date, year_in_period
from ledgerloom.functions.money import parse_money
from ledgerloom.functions.text import nonempty_group, starts_with_any, strip
from ledgerloom.operators.cleaning import clean_lines
from ledgerloom.scale import computed_once, durable

# Printed forms.
PERIOD = (
    r"(?U)([A-Z][a-z]+)\s+([0-9]{1,2}),\s*([0-9]{4})through([A-Z][a-z]+)\s+([0-9]{1,2}),\s*([0-9]{4})"
)
AMOUNT = r"\$?([0-9,]+\.[0-9]{2})"
RECORD_START = r"(?U)^[0-9]{2}/[0-9]{2}\s"
RECORD = rf"(?U)^([0-9]{{2}}/[0-9]{{2}})\s+(.+?)\s+(?:-)?{AMOUNT}\s*\z"
CHECK = rf"(?U)^([0-9]{{3,6}})\s+(?:\*?\^\s+)?([0-9]{{2}}/[0-9]{{2}})\s+{AMOUNT}\s*\z"
CHECK_WITHOUT_NUMBER = rf"(?U)^\*?\^\s+([0-9]{{2}}/[0-9]{{2}})\s+{AMOUNT}\s*\z"
SECTION_TOTAL = (
    r"(?U)^\s*Total\s+(?:Deposits and Additions|Checks Paid|Electronic Withdrawals|Fees)\s+"
    r"\$?[0-9,]+\.[0-9]{2}\s*\z"
)

# section -> (heading, summary label, amounts are negative)
SECTIONS = {
    "deposits": ("DEPOSITS AND ADDITIONS", "Deposits and Additions", False),
    "checks_paid": ("CHECKS PAID", "Checks Paid", True),
    "electronic_withdrawals": ("ELECTRONIC WITHDRAWALS", "Electronic Withdrawals", True),
    "fees": ("FEES", "Fees", True),
}


def section_body(text_lines: Column, positions: Column, start: Column) -> Column:
    """Lines after a heading up to the next heading; null when the heading is absent."""
    following = F.array_min(F.filter(positions, lambda p: p > start))
    end = F.coalesce(following, F.size(text_lines) + 1)
    return F.when(start > 0, F.slice(text_lines, (start + 1).cast("int"), (end - start - 1).cast("int")))


def _keep(line: Column) -> Column:
    return ~(
        (line == "")
        | line.isin(*CHECKING_NOISE_LINES)
        | line.rlike(SECTION_TOTAL)
        | starts_with_any(line, CHECKING_NOISE_STARTS)
    )


def transaction_lines(body: Column) -> Column:
    return F.filter(F.transform(body, strip), _keep)


def summary_row(body: Column, label: str) -> tuple[Column, Column]:
    """(count, amount) of the last summary row with this label."""
    pattern = rf"(?U)^\s*{label}(?:\s+([0-9]+))?\s+(-)?{AMOUNT}\s*\z"
    row = F.try_element_at(F.filter(body, lambda line: line.rlike(pattern)), F.lit(-1))
    value = parse_money(nonempty_group(row, pattern, 3))
    amount = F.when(F.regexp_extract(row, pattern, 2) == "-", -value).otherwise(value)
    return nonempty_group(row, pattern, 1).try_cast("int"), amount


@dataclass(frozen=True)
class CheckingStatements:
    """Parsed view of ``docs(doc_id, account, text)``.

    ``year_rule``: 'end' stamps every row with the year of the period's end; 'period' lets a row of a
    statement that spans two years keep the start year. ``stored`` keeps the prepared documents in a table: set it when
    more than one output is read, else each parses the texts again.
    """

    docs: DataFrame
    year_rule: str = "end"
    keep_plain_check_rows: bool = False
    stored: bool = False

    @cached_property
    def _prepared(self) -> DataFrame:
        parts = {f"p{i}": F.regexp_extract("text", PERIOD, i) for i in range(1, 7)}
        text_lines = clean_lines(F.col("text"), keep_plain_check_rows=self.keep_plain_check_rows)
        base = computed_once(
            self.docs,
            "doc_id",
            "account",
            month_name_date(parts["p1"], parts["p2"], parts["p3"]).alias("period_start"),
            month_name_date(parts["p4"], parts["p5"], parts["p6"]).alias("period_end"),
            text_lines.alias("lines"),
        )
        keep = ["doc_id", "account", "period_start", "period_end", "lines"]
        base = computed_once(base, *keep, F.transform("lines", strip).alias("stripped"))
        at = F.array(*[F.array_position("stripped", h) for h in CHECKING_SECTIONS])
        base = computed_once(base, *keep, at.alias("at"))
        bodies = {"summary": "CHECKING SUMMARY", **{s: h for s, (h, _, _) in SECTIONS.items()}}
        return computed_once(
            base,
            *keep[:-1],
            *[
                section_body(F.col("lines"), F.col("at"), F.col("at")[CHECKING_SECTIONS.index(h)]).alias(f"body_{n}")
                for n, h in bodies.items()
            ],
        )

    @cached_property
    def _headers(self) -> DataFrame:
        rows = {label: summary_row(F.col("body_summary"), label) for label in CHECKING_SUMMARY_LABELS}
        label_of = {s: label for s, (_, label, _) in SECTIONS.items()}
        headers = self._prepared.withColumns(
            {
                "beginning": rows["Beginning Balance"][1],
                "ending": rows["Ending Balance"][1],
                "count_total": rows["Ending Balance"][0],
                **{f"total_{s}": rows[label][1] for s, label in label_of.items()},
                **{f"count_{s}": rows[label][0] for s, label in label_of.items()},
            }
        )
        headers = computed_once(headers).withColumn(
            "error",
            F.when(F.col("period_end").isNull(), "no statement period").when(
                F.coalesce("beginning", "total_deposits", "total_checks_paid",
                           "total_electronic_withdrawals", "ending").isNull(),
                "no checking summary",
            ),
        )
        return durable(headers) if self.stored else headers

    def statements(self) -> DataFrame:
        """One row per readable document: period, balances, section totals, instance counts."""
        return self._headers.filter("error IS NULL").select(
            "doc_id", "account", "period_start", "period_end", "beginning", "ending",
            *[f"total_{s}" for s in SECTIONS],
            F.create_map(
                *[x for s in SECTIONS for x in (F.lit(s), F.col(f"count_{s}"))], F.lit("total"), F.col("count_total")
            ).alias("instance_counts"),
        )

    def errors(self) -> DataFrame:
        """Documents without a period or without a control block."""
        return self._headers.filter("error IS NOT NULL").select("doc_id", "account", "error")

    @cached_property
    def _records(self) -> DataFrame:
        """All candidate records, rejected ones included (``reason``)."""
        good = self._headers.filter("error IS NULL").select(
            "doc_id", "account", "period_start", "period_end", *[f"body_{s}" for s in SECTIONS]
        )

        def folded(section: str) -> Column:
            text = F.array_join(transaction_lines(F.col(f"body_{section}")), "\n")
            return F.filter(
                F.split(text, r"\n(?=[0-9]{2}/[0-9]{2}[^\S\n])"), lambda r: r.rlike(RECORD_START)
            )

        def single(section: str) -> Column:
            return F.filter(
                transaction_lines(F.col(f"body_{section}")),
                lambda r: r.rlike(CHECK) | r.rlike(CHECK_WITHOUT_NUMBER),
            )

        sections = F.array(
            *[
                F.struct(
                    F.lit(i).alias("section_no"),
                    F.lit(s).alias("section"),
                    F.lit(negative).alias("negative"),
                    F.coalesce(single(s) if s == "checks_paid" else folded(s), F.array().cast("array<string>"))
                    .alias("records"),
                )
                for i, (s, (_, _, negative)) in enumerate(SECTIONS.items())
            ]
        )
        rows = (
            good.select("doc_id", "account", "period_start", "period_end", F.inline(sections))
            .select("doc_id", "account", "period_start", "period_end", "section_no", "section", "negative",
                    F.posexplode("records").alias("record_no", "record"))
        )
        is_check = F.col("section") == "checks_paid"
        head = F.substring_index("record", "\n", 1)
        more = F.substring(F.col("record"), F.length(head) + 2, F.length("record"))
        rows = computed_once(rows, *rows.columns, head.alias("head"), F.translate(more, "\n", " ").alias("more"))
        number = nonempty_group(F.col("head"), CHECK, 1)
        month_day = F.when(
            is_check,
            F.coalesce(nonempty_group(F.col("head"), CHECK, 2), nonempty_group(F.col("head"), CHECK_WITHOUT_NUMBER, 1)),
        ).otherwise(nonempty_group(F.col("head"), RECORD, 1))
        raw_amount = F.when(
            is_check,
            F.coalesce(nonempty_group(F.col("head"), CHECK, 3), nonempty_group(F.col("head"), CHECK_WITHOUT_NUMBER, 2)),
        ).otherwise(nonempty_group(F.col("head"), RECORD, 3))
        own = F.when(is_check, F.concat(F.lit("Check #"), F.coalesce(number, F.lit("(unknown)")))).otherwise(
            strip(F.regexp_extract("head", RECORD, 2))
        )
        rows = computed_once(
            rows,
            *[c for c in rows.columns if c not in ("head", "more")],
            month_day.alias("month_day"),
            parse_money(raw_amount).alias("value"),
            F.when(is_check, number).alias("check_number"),
            F.when(F.col("more") == "", own).otherwise(F.concat_ws(" ", own, F.col("more"))).alias("description"),
        )
        month = F.substring("month_day", 1, 2).try_cast("int")
        day = F.substring("month_day", 4, 2).try_cast("int")
        year = (
            F.year("period_end")
            if self.year_rule == "end"
            else year_in_period(month, F.col("period_start"), F.col("period_end"))
        )
        return rows.withColumn("date", build_date(year, month, day)).withColumn(
            "reason",
            F.when(F.col("month_day").isNull(), "unreadable first line").when(F.col("date").isNull(), "invalid date"),
        )

    def transactions(self) -> DataFrame:
        """Transactions of all sections in document order; deposits positive, the rest negative."""
        return self._records.filter("reason IS NULL").select(
            "doc_id", "section_no", "record_no", "date", "description",
            F.when(F.col("negative"), -F.col("value")).otherwise(F.col("value")).alias("amount"),
            "account", "section", "check_number",
        )

    def warnings(self) -> DataFrame:
        """Rejected records (with their continuation lines) and check rows that lost their number."""
        missing = (F.col("section") == "checks_paid") & F.col("check_number").isNull()
        return self._records.filter(F.col("reason").isNotNull() | missing).select(
            "doc_id", "section", "record_no", F.coalesce("reason", F.lit("check number missing")).alias("warning"),
            "record",
        )
