"""Owner statements as word boxes: ``words(doc_id, page, word_no, text, x0, top)`` -> properties and rows.

Words are clustered into physical lines, lines are walked in (page, y) order by three scans, and wrapped lines
are given to the nearest date row with windows that never leave a page. The scans are windows over a document;
when some document is very long they run page by page instead, so that it spreads over its pages, and over the few lines that change
the state; all other lines take the state of the last of these before them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.fixed_values import (
    APPENDIX_MARKER,
    CONSOLIDATED_LABELS,
    CONSOLIDATED_MARKER,
    CONTEXT_NOISE_STARTS,
    CONTEXT_REACH_POINTS,
    DEFAULT_COLUMN_LIMITS,
    PM_CATEGORIES,
    PROPERTY_SUMMARY_LABELS,
    RENT_ROLL_MARKER,
    TABLE_HEADER_START,
)
from ledgerloom.functions.dates import month_day_year, us_date
from ledgerloom.functions.money import MONEY
from ledgerloom.functions.text import first_rule, nonempty_group, quote, starts_with_any, strip
from ledgerloom.scale import computed_once, durable, needs_spreading, running_last

COLUMNS = ("date", "payee", "type", "ref", "desc", "cash_in", "cash_out", "balance")
_PERIOD = r"(?U)([A-Z][a-z]{2}\s+[0-9]{1,2},\s+[0-9]{4})\s*-\s*([A-Z][a-z]{2}\s+[0-9]{1,2},\s+[0-9]{4})"
_UNIT = r"(?iU)^([0-9]{3,4}|1/2\s+upper|1/2\s+lower|upper|lower)\s*-\s*(.+)\z"
_TRANSFER = r"(?iU)^Transfer\s+(?:to|from)\b"


def word_amount(text: Column) -> Column:
    """Number in one word box; commas and dollar signs are dropped."""
    return F.regexp_replace(text, "[,$]", "").try_cast(MONEY)


def words_to_lines(words: DataFrame) -> DataFrame:
    """One row per physical line: words with the same rounded y (half to even), ordered by x."""
    y = F.bround("top", 0).cast("int")
    ordered = F.array_sort(F.collect_list(F.struct("x0", "word_no", "text")))
    return (
        words.groupBy("doc_id", "page", y.alias("y"))
        .agg(ordered.alias("words"))
        .withColumn("line", F.array_join(F.transform("words", lambda w: w["text"]), " "))
    )


def unit_and_category(description: Column, categories: Sequence[str] = PM_CATEGORIES) -> tuple[Column, Column]:
    """(unit, category) of ``unit - category - details``; transfers have neither."""
    bare = strip(description)
    raw_unit = nonempty_group(bare, _UNIT, 1)
    rest = F.coalesce(strip(nonempty_group(bare, _UNIT, 2)), bare)
    usable = (description != "") & ~description.rlike(_TRANSFER)
    unit = F.regexp_replace(F.lower(raw_unit), r"(?U)\s+", " ")
    longest_first = sorted(categories, key=len, reverse=True)
    # One alternation, longest first, then the canonical spelling of what was found.
    pattern = r"(?iu)^(" + "|".join(quote(c) for c in longest_first) + r")(?:\z|[ -])"
    found = F.lower(F.regexp_extract(rest, pattern, 1))
    category = first_match(found, {c.lower(): c for c in longest_first})
    return F.when(usable, unit), F.when(usable, category)


def first_match(c: Column, values: Mapping[str, str]) -> Column:
    pairs = [x for k, v in values.items() for x in (F.lit(k), F.lit(v))]
    return F.try_element_at(F.create_map(*pairs), c)


def column_limits(words: Column) -> Column:
    """Column limits learned from a table header line; the defaults when a heading is missing."""

    def at(text: str, nth: int = 1) -> Column:
        return F.try_element_at(F.filter(words, lambda w: w["text"] == text), F.lit(nth))["x0"]

    cashes = F.filter(words, lambda w: w["text"] == "Cash")
    x = {
        "date": at("Date"), "payee": at("Payee"), "type": at("Type"), "ref": at("Reference"),
        "desc": at("Description"), "cash_in": at("Cash"),
        "cash_out": F.when(F.size(cashes) > 1, F.try_element_at(cashes, F.lit(-1))["x0"]),
        "balance": at("Balance", -1),
    }

    def middle(a: str, b: str) -> Column:
        return (x[a] + x[b]) / 2

    learned = F.struct(
        middle("date", "payee").alias("date"),
        middle("payee", "type").alias("payee"),
        middle("type", "ref").alias("type"),
        middle("ref", "desc").alias("ref"),
        # Descriptions reach far to the right; amounts are right-aligned near their heading.
        (x["desc"] + (x["cash_in"] - x["desc"]) * 0.9).alias("desc"),
        middle("cash_in", "cash_out").alias("cash_in"),
        middle("cash_out", "balance").alias("cash_out"),
    )
    default = F.struct(*[F.lit(v).alias(k) for k, v in DEFAULT_COLUMN_LIMITS.items()])
    complete = reduce(lambda a, b: a & b, [v.isNotNull() for v in x.values()])
    return F.when(complete, learned).otherwise(default)


def column_of(x0: Column, limits: Column) -> Column:
    expr = None
    for name in COLUMNS[:-1]:
        hit = x0 < limits[name]
        expr = F.when(hit, name) if expr is None else expr.when(hit, name)
    return expr.otherwise(COLUMNS[-1])


@dataclass(frozen=True)
class OwnerStatements:
    """Parsed view of word boxes.

    ``header_start`` and ``property_rules`` recognize a property heading: the line starts with the first and
    contains the needle of a rule ``(needle, canonical name)``; the first rule wins. ``spread`` decides how long
    documents are walked; by default the longest one is looked up first, so pass stored words. ``stored``
    keeps the walked lines in a table: set it when more than one output is read, else each walks the words again.
    """

    words: DataFrame
    property_rules: Sequence[tuple[str, str]]
    header_start: str
    categories: Sequence[str] = field(default=PM_CATEGORIES)
    spread: bool | None = None
    stored: bool = False

    @cached_property
    def _spread(self) -> bool:
        return needs_spreading(self.words, ["doc_id"], stored=self.words) if self.spread is None else self.spread

    @cached_property
    def _walked(self) -> DataFrame:
        """Lines outside and inside transaction blocks, with property, block and summary state."""
        # One exchange by document serves the line grouping, the scans and the page windows alike.
        words = self.words if self._spread else self.words.repartition("doc_id")
        lines = words_to_lines(words)
        text = F.col("line")
        first = F.col("words")[0]
        lower_rules = [(needle.lower(), name) for needle, name in self.property_rules]
        name = F.when(text.startswith(self.header_start), first_rule(F.lower(text), lower_rules))
        is_header = text.startswith(TABLE_HEADER_START)
        lines = lines.withColumns(
            {
                "header_name": name,
                "is_appendix": text.contains(APPENDIX_MARKER),
                "is_rent_roll": text.startswith(RENT_ROLL_MARKER),
                "limits_here": F.when(is_header, column_limits(F.col("words"))),
                "row_date": F.when(first["x0"] < DEFAULT_COLUMN_LIMITS["date"], us_date(first["text"])),
            }
        )
        lines = computed_once(lines, keys=["doc_id", "page", "y"])
        if not self._spread:
            lines = self._scanned(lines, spread=False)
        else:
            # Few lines change the state. Only they are walked from page to page; the others take the state of the last one before them.
            lines = durable(lines)
            tells = F.coalesce(
                F.col("header_name").isNotNull() | F.col("is_appendix") | F.col("is_rent_roll") | F.col("limits_here").isNotNull()
                | F.col("line").contains(CONSOLIDATED_MARKER) | (F.col("words")[0]["text"] == "Total"), F.lit(False))
            lines = self._carried(lines.filter(~tells), durable(self._scanned(lines.filter(tells), spread=True)))
        return durable(lines) if self.stored else lines

    @staticmethod
    def _carried(quiet: DataFrame, told: DataFrame) -> DataFrame:
        """All lines with their state; ``told`` are the lines that may change it, with theirs. Lines move once, to their page."""
        states = [c for c in told.columns if c not in quiet.columns]
        told = told.select(*quiet.columns, F.struct(*states).alias("own"))
        here = told.groupBy("doc_id", "page").agg(F.max_by("own", "y").alias("here"))
        pages = quiet.select("doc_id", "page").unionAll(told.select("doc_id", "page")).distinct()
        earlier = Window.partitionBy("doc_id").orderBy("page").rowsBetween(Window.unboundedPreceding, -1)
        carry = pages.join(here, ["doc_id", "page"], "left").select("doc_id", "page", F.last("here", ignorenulls=True).over(earlier).alias("carry"))
        lines = quiet.unionByName(told, allowMissingColumns=True).join(carry, ["doc_id", "page"], "left")
        page = Window.partitionBy("doc_id", "page").orderBy("y").rowsBetween(Window.unboundedPreceding, 0)
        lines = lines.withColumn("now", F.coalesce(F.last("own", ignorenulls=True).over(page), "carry"))
        before = F.coalesce("now.event", "now.before")
        other = {
            "is_total": F.lit(False), "event": F.lit(None).cast("string"), "before": before, "opens": F.lit(False), "latch": F.lit(False),
            "outside": F.coalesce(before, F.lit("end")) == "end", "ended": F.coalesce("now.ended", F.lit(False)),
        }
        return lines.select(*quiet.columns, *[
            F.when(F.col("own").isNotNull(), F.col(f"now.{c}")).otherwise(other[c] if c in other else F.col(f"now.{c}")).alias(c) for c in states])

    @staticmethod
    def _scanned(lines: DataFrame, spread: bool) -> DataFrame:
        """Lines with property, block and summary state, by three scans."""
        first = F.col("words")[0]
        pos = F.struct("page", "y")
        scan = {"group": ["doc_id"], "chunk": F.col("page"), "order": ["page", "y"], "spread": spread}
        # 1. Current property and the limits of the latest table header.
        lines = running_last(
            lines,
            values={
                "property": F.when(F.col("header_name").isNotNull(),
                                   F.struct(F.col("header_name").alias("name"), pos.alias("at"))),
                "latest": F.col("limits_here"),
            },
            **scan,
        )
        # 2. Start and end events of transaction blocks; the state before each line.
        is_total = (
            (first["text"] == "Total") & (F.size("words") >= 2)
            & (first["x0"] < F.coalesce("latest.date", F.lit(DEFAULT_COLUMN_LIMITS["date"])))
        )
        starts = F.col("limits_here").isNotNull() & F.col("property").isNotNull()
        ends = F.col("is_appendix") | F.col("header_name").isNotNull() | is_total
        event = F.when(ends, "end").when(starts, "start")
        lines = computed_once(lines.withColumns({"is_total": is_total, "event": event}), keys=["doc_id", "page", "y"])
        lines = running_last(lines, values={"before": F.col("event")}, inclusive=False, **scan)
        # 3. The block each line is in, the consolidated state, and where the appendix begins.
        opens = (F.col("event") == "start") & (F.coalesce("before", F.lit("end")) == "end")
        outside = (F.coalesce("before", F.lit("end")) == "end") & ~F.coalesce(opens, F.lit(False))
        latch = F.col("is_appendix") | (outside & F.col("is_rent_roll"))
        lines = lines.withColumns({"outside": outside, "opens": F.coalesce(opens, F.lit(False)), "latch": latch})
        consolidated = F.when(F.col("header_name").isNotNull(), False).when(
            F.col("outside") & F.col("line").contains(CONSOLIDATED_MARKER), True
        )
        lines = running_last(
            lines,
            values={
                "block": F.when(F.col("opens"), F.struct(pos.alias("at"), F.col("limits_here").alias("limits"))),
                "consolidated": consolidated,
                "ended": F.when(F.col("latch"), F.lit(True)),
            },
            **scan,
        )
        return lines.withColumn("ended", F.coalesce("ended", F.lit(False)))

    @cached_property
    def _outside(self) -> DataFrame:
        """Summary lines: ``label amount`` outside blocks and before the appendix."""
        amount = word_amount(F.element_at("words", -1)["text"])
        label = F.lower(
            F.array_join(
                F.transform(F.slice("words", F.lit(1), F.size("words") - 1), lambda w: w["text"]), " "
            )
        )
        return (
            self._walked.filter(F.col("outside") & ~F.col("ended") & F.col("header_name").isNull())
            .filter(~F.col("line").contains(CONSOLIDATED_MARKER))
            .select("doc_id", "page", "y", "property", F.coalesce("consolidated", F.lit(False)).alias("consolidated"),
                    strip(label).alias("label"), amount.alias("amount"))
            .filter("amount IS NOT NULL AND label <> ''")
        )

    def reports(self) -> DataFrame:
        """One row per document: period and consolidated totals (the last printed value of each label)."""
        order = F.struct("page", "y")
        last = self._outside.filter("consolidated").groupBy("doc_id").agg(
            *[
                F.max_by(F.when(F.col("label") == label, F.col("amount")), F.when(F.col("label") == label, order))
                .alias(f"consolidated_{c}")
                for label, c in CONSOLIDATED_LABELS.items()
            ]
        )
        head = self._walked.filter(F.col("line").rlike(_PERIOD)).groupBy("doc_id").agg(F.min_by("line", order).alias("line"))
        periods = head.select(
            "doc_id",
            month_day_year(F.regexp_extract("line", _PERIOD, 1)).alias("period_start"),
            month_day_year(F.regexp_extract("line", _PERIOD, 2)).alias("period_end"),
        )
        docs = self.words.select("doc_id").distinct()
        return docs.join(periods, "doc_id", "left").join(last, "doc_id", "left")

    def properties(self) -> DataFrame:
        """One row per property section: summary amounts and the two printed totals."""
        order = F.struct("page", "y")
        key = ["doc_id", "property_page", "property_y"]

        def keyed(df: DataFrame) -> DataFrame:
            return df.withColumns(
                {"property_page": F.col("property.at.page"), "property_y": F.col("property.at.y"),
                 "name": F.col("property.name")}
            )

        headers = keyed(self._walked.filter(F.col("header_name").isNotNull() & ~F.col("ended"))).select(*key, "name")
        summary = keyed(self._outside.filter("property IS NOT NULL AND NOT consolidated")).groupBy(*key).agg(
            *[
                F.max_by(F.when(F.col("label") == label, F.col("amount")), F.when(F.col("label") == label, order))
                .alias(c)
                for label, c in PROPERTY_SUMMARY_LABELS.items()
            ]
        )
        amounts = F.filter(
            F.transform(F.slice("words", F.lit(2), F.size("words")), lambda w: word_amount(w["text"])),
            lambda a: a.isNotNull(),
        )
        totals = F.struct(F.try_element_at("amounts", F.lit(1)).alias("i"), F.try_element_at("amounts", F.lit(2)).alias("o"))
        inside = (F.col("before") == "start") & F.col("header_name").isNull() & ~F.col("is_appendix")
        closes = F.coalesce(inside & F.col("is_total"), F.lit(False))
        # The last event of a property counts: a block that begins after a printed total and prints none leaves none.
        printed = (
            keyed(self._walked.filter(~F.col("ended") & (closes | F.col("opens"))))
            .withColumn("amounts", F.when(closes & (F.size(amounts) >= 2), amounts))
            .groupBy(*key).agg(F.max_by(F.when(F.col("amounts").isNotNull(), totals), order).alias("t"))
            .select(*key, F.col("t.i").alias("total_cash_in_printed"), F.col("t.o").alias("total_cash_out_printed"))
        )
        return headers.join(summary, key, "left").join(printed, key, "left")

    @cached_property
    def _in_blocks(self) -> DataFrame:
        """Lines of transaction blocks, the closing Total line included, the header line excluded."""
        inside = (F.col("before") == "start") & F.col("header_name").isNull() & ~F.col("is_appendix")
        return self._walked.filter(inside & ~F.col("ended")).withColumns(
            {"block_page": F.col("block.at.page"), "block_y": F.col("block.at.y"), "limits": F.col("block.limits")}
        )

    @cached_property
    def _assembled(self) -> DataFrame:
        lines = self._in_blocks.select(
            "doc_id", "page", "y", "words", "line", "row_date", "property", "block_page", "block_y", "limits", "is_total"
        )
        # Context reaches 30 points at most, so it never crosses a page: windows stay inside one page.
        page = Window.partitionBy("doc_id", "page", "block_page", "block_y").orderBy("y")
        anchor = F.when(F.col("row_date").isNotNull() & ~F.col("is_total"), F.col("y"))
        lines = lines.withColumn("anchor_y", anchor).withColumns(
            {
                "above": F.last("anchor_y", ignorenulls=True).over(page.rowsBetween(Window.unboundedPreceding, -1)),
                "below": F.first("anchor_y", ignorenulls=True).over(page.rowsBetween(1, Window.unboundedFollowing)),
            }
        )
        up, down = F.col("y") - F.col("above"), F.col("below") - F.col("y")
        noise = starts_with_any(F.col("line"), CONTEXT_NOISE_STARTS)
        far = F.lit(CONTEXT_REACH_POINTS + 1)
        near_up = (up <= CONTEXT_REACH_POINTS) & (up <= F.coalesce(down, far))
        near_down = (down <= CONTEXT_REACH_POINTS) & (down <= F.coalesce(up, far))
        # A line as near to the row above as to the row below belongs to both.
        owners = F.when(F.col("anchor_y").isNotNull(), F.array("anchor_y")).when(noise, F.array().cast("array<int>")) \
            .otherwise(
                F.array_compact(F.array(F.when(near_up, F.col("above")), F.when(near_down, F.col("below"))))
            )
        owned = lines.withColumn("owner_y", F.explode(owners)).withColumn(
            "is_context", F.col("anchor_y").isNull().cast("int")
        )
        tagged = F.transform(
            "words", lambda w: F.struct(column_of(w["x0"], F.col("limits")).alias("col"), w["text"].alias("text"))
        )
        per_row = owned.groupBy("doc_id", "page", "block_page", "block_y", "owner_y").agg(
            F.max("row_date").alias("date"),
            F.first("property").alias("property"),
            # Own words first, then the wrapped lines from top to bottom. One row owns at most a few lines.
            F.array_sort(F.collect_list(F.struct("is_context", "y", tagged.alias("words")))).alias("parts"),
        )
        flat = F.flatten(F.transform("parts", lambda p: p["words"]))
        rows = per_row.withColumn("tokens", flat)

        def texts(name: str) -> Column:
            return F.transform(F.filter("tokens", lambda t: t["col"] == name), lambda t: t["text"])

        def joined(name: str) -> Column:
            return strip(F.array_join(texts(name), " "))

        def last_amount(name: str) -> Column:
            readable = F.filter(F.transform(texts(name), word_amount), lambda a: a.isNotNull())
            return F.try_element_at(readable, F.lit(-1))

        rows = computed_once(rows).select(
            "doc_id", "page", F.col("owner_y").alias("y"),
            F.col("property.name").alias("property"),
            F.col("property.at.page").alias("property_page"),
            F.col("property.at.y").alias("property_y"),
            "date",
            joined("payee").alias("payee"),
            joined("type").alias("txn_type"),
            F.nullif(joined("ref"), F.lit("")).alias("reference"),
            joined("desc").alias("description"),
            last_amount("cash_in").alias("cash_in"),
            last_amount("cash_out").alias("cash_out"),
            last_amount("balance").alias("balance"),
        )
        rows = computed_once(rows)
        unit, category = unit_and_category(F.col("description"), self.categories)
        return rows.withColumns({"unit": unit, "category": category})

    def transactions(self) -> DataFrame:
        return self._assembled.filter("cash_in IS NOT NULL OR cash_out IS NOT NULL")

    def warnings(self) -> DataFrame:
        """Rows dropped because neither cash column holds an amount."""
        return self._assembled.filter("cash_in IS NULL AND cash_out IS NULL").select(
            "doc_id", "page", "y", "date", "description"
        )

    def errors(self, docs: DataFrame | None = None) -> DataFrame:
        """Documents without any property section; with a list ``docs(doc_id)`` also those without any text."""
        with_text = self.words.select("doc_id").distinct()
        found = self._walked.filter(F.col("header_name").isNotNull() & ~F.col("ended")).select("doc_id").distinct()
        out = with_text.join(found, "doc_id", "left_anti").withColumn("error", F.lit("no property sections"))
        if docs is None:
            return out
        empty = docs.select("doc_id").distinct().join(with_text, "doc_id", "left_anti")
        return out.unionByName(empty.withColumn("error", F.lit("no extractable text")))
