"""Compare generated P&L cells with filed ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.fixed_values import REPORT_HEADER, REPORT_RULE, REPORT_SUMMARY
from ledgerloom.functions.money import tolerance
from ledgerloom.functions.text import blank_to_null, strip


def cell_number(raw: Column) -> Column:
    """Number of a value cell; formulas, blanks and text without digits give null."""
    return F.when(~raw.startswith("=") & raw.rlike("[0-9]"), strip(raw).try_cast("double"))


def filed_cells(cells: DataFrame) -> DataFrame:
    """``cells(sheet, row_no, label, raw)`` -> numeric cells with a label."""
    label = F.coalesce(blank_to_null(F.col("label")), F.concat(F.lit("Row "), F.col("row_no").cast("string")))
    return cells.select("sheet", "row_no", label.alias("label"), cell_number(F.col("raw")).alias("filed")).filter(
        "filed IS NOT NULL"
    )


def compare(filed: DataFrame, generated: DataFrame, **tolerances: float) -> DataFrame:
    """``filed(sheet, row_no, label, filed)`` against ``generated(sheet, row_no, generated)``; missing counts as 0."""
    both = filed.join(generated.select("sheet", "row_no", "generated"), ["sheet", "row_no"], "left")
    both = both.withColumn("generated", F.coalesce(F.col("generated").cast("double"), F.lit(0.0)))
    delta = F.col("generated") - F.col("filed")
    return both.withColumn("delta", delta).withColumn(
        "within_tolerance", F.abs("delta") <= tolerance(F.col("row_no"), F.col("filed"), **tolerances)
    )


def summary(compared: DataFrame) -> DataFrame:
    """Cells within tolerance, all cells, percent (0 when there are none)."""
    return compared.agg(
        F.count_if("within_tolerance").alias("matched"), F.count(F.lit(1)).alias("total")
    ).withColumn("percent", F.coalesce(F.try_divide(F.col("matched") * 100.0, F.col("total")), F.lit(0.0)))


def _money(c: str, plus: bool = False) -> Column:
    text = F.format_number(F.abs(F.round(c, 2)), 2)
    negative = F.round(c, 2) < 0
    return F.concat(F.when(negative, "-").otherwise("+" if plus else ""), text)


def report_lines(compared: DataFrame) -> DataFrame:
    """The comparison as markdown table lines ``(section, sheet, row_no, line)``, one row per line.

    Order by section (0 head, 1 cells, 2 summary after an empty line), sheet and row_no when writing the report.
    """
    ok = F.when(F.col("within_tolerance"), "YES").otherwise("**NO**")
    cell = F.concat(
        F.lit("| "),
        F.concat_ws(" | ", "sheet", F.col("row_no").cast("string"), "label", _money("filed"), _money("generated"),
                    _money("delta", plus=True), ok),
        F.lit(" |"),
    )
    body = compared.select(F.lit(1).alias("section"), "sheet", "row_no", cell.alias("line"))
    spark = compared.sparkSession
    head = spark.createDataFrame(
        [(0, None, 1, REPORT_HEADER), (0, None, 2, REPORT_RULE), (2, None, 0, "")],
        "section INT, sheet STRING, row_no INT, line STRING",
    )
    tail = summary(compared).select(
        F.lit(2).alias("section"), F.lit(None).cast("string").alias("sheet"), F.lit(1).alias("row_no"),
        F.format_string(REPORT_SUMMARY, "matched", "total", "percent").alias("line"),
    )
    return head.unionByName(body).unionByName(tail)


def parsed_vs_filed(parsed: DataFrame, filed: DataFrame) -> DataFrame:
    """``parsed(property, template_category, parsed)`` against ``filed(property, label, filed)``, ignoring case.

    The first filed row of a repeated label counts; a missing sheet, label or value counts as 0.
    """
    keyed = filed.withColumn("__label", F.lower(strip(F.col("label")))).groupBy("property", "__label").agg(
        F.min_by("filed", "row_no").alias("filed")
    )
    both = parsed.withColumn("__label", F.lower("template_category")).join(keyed, ["property", "__label"], "left")
    both = both.withColumn("filed", F.coalesce("filed", F.lit(0)))
    return both.select("property", "template_category", "parsed", "filed", (F.col("parsed") - F.col("filed")).alias("delta"))
