"""Document sources: routing by file name, page text, scanned-document routing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.text import strip

UNKNOWN = "unknown"
MIN_TEXT_CHARS = 10
#: Page numbers of a document that become one text first.
PAGES_TOGETHER = 256


def classify_name(name: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """Document type of a file name: the first rule ``(pattern, type)`` that is found wins, ignoring case."""
    expr: Column | None = None
    for pattern, doc_type in rules:
        hit = name.rlike(f"(?i){pattern}")
        expr = F.when(hit, doc_type) if expr is None else expr.when(hit, doc_type)
    return F.lit(UNKNOWN) if expr is None else expr.otherwise(UNKNOWN)


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def route_files(files: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """Add ``name`` and ``doc_type`` to a table of paths (for example ``_metadata.file_path``)."""
    name = file_name(F.col("path"))
    return files.withColumn("name", name).withColumn("doc_type", classify_name(F.col("name"), rules))


def count_by_type(files: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """Number of files and first and last name per type; types without files are kept with zero.

    The names of one type, sorted, are ``route_files(...).orderBy("doc_type", "name")``: a type may hold a
    third of all files, so they stay rows instead of one list.
    """
    types = list(dict.fromkeys([t for _, t in rules] + [UNKNOWN]))
    counts = route_files(files, rules).groupBy("doc_type").agg(
        F.count(F.lit(1)).alias("files"), F.min("name").alias("first_name"), F.max("name").alias("last_name")
    )
    all_types = files.sparkSession.createDataFrame([(t,) for t in types], "doc_type STRING")
    return all_types.join(counts, "doc_type", "left").fillna({"files": 0})


def full_text(pages: DataFrame, keys: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Text of each document: its pages in order, joined by a line break.

    Runs of ``PAGES_TOGETHER`` page numbers become one text each before a document's runs meet, so a task never lists
    a long document page by page.
    """
    def joined(order: str) -> Column:
        ordered = F.array_sort(F.collect_list(F.struct(order, "text")))
        return F.array_join(F.transform(ordered, lambda p: F.coalesce(p["text"], F.lit(""))), "\n").alias("text")

    runs = pages.groupBy(*keys, F.floor(F.col("page_no") / PAGES_TOGETHER).alias("__run")).agg(joined("page_no"))
    return runs.groupBy(*keys).agg(joined("__run"))


def page_lines(pages: DataFrame, keys: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Lines of paged documents, one row per line, ordered by (page_no, line_no)."""
    return pages.select(*keys, "page_no", F.posexplode(F.split(F.col("text"), "\n")).alias("line_no", "line"))


def text_or_scanned(docs: DataFrame, pages: DataFrame) -> DataFrame:
    """``method`` per document: 'ocr' when its pages hold fewer than ten characters in all, else 'text'."""
    chars = pages.groupBy("doc_id").agg(F.sum(F.length(strip(F.coalesce("text", F.lit(""))))).alias("chars"))
    return docs.select("doc_id").join(chars, "doc_id", "left").select(
        "doc_id",
        F.coalesce("chars", F.lit(0)).alias("chars"),
        F.when(F.coalesce("chars", F.lit(0)) < MIN_TEXT_CHARS, "ocr").otherwise("text").alias("method"),
    )


def needs_ocr(docs: DataFrame, pages: DataFrame) -> DataFrame:
    return text_or_scanned(docs, pages).filter("method = 'ocr'").select("doc_id", "chars")


def pick_tab(tabs: DataFrame, year: int) -> DataFrame:
    """Sheet tab of a year per property: exact candidates in order, then ignoring case and outer blanks.

    ``tabs(property, position, title)``; properties without a match come back with a null title.
    """
    yy, yyyy = f"{year % 100:02d}", str(year)
    candidates = [f"'{yy} earnings", f"'{yy} Earnings", f"{yyyy} earnings", f"{yyyy} Earnings"]
    exact = F.array_position(F.array(*[F.lit(c) for c in candidates]), F.col("title"))
    loose = F.lower(strip(F.col("title"))).isin([c.lower() for c in candidates])
    rank = F.when(exact > 0, exact).when(loose, len(candidates) + 1 + F.col("position"))
    return (
        tabs.withColumn("__rank", rank)
        .groupBy("property")
        .agg(F.min_by("title", "__rank").alias("title"))
    )


__all__ = [
    "classify_name", "count_by_type", "file_name", "full_text", "needs_ocr", "page_lines", "pick_tab",
    "route_files", "text_or_scanned",
]
