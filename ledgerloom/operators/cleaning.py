"""Clean-up of statement text before parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions.text import lines, strip

# Artifacts of the text layer and lines repeated on every page.
ANCHOR = r"\*(?:start|end)\*[a-z0-9][a-z0-9 ]*"
LEAKED_BEFORE_DATE = r"(?mdi)^[a-z0-9 /]*?([0-9]{2}/[0-9]{2}(?U:\s))"
PLAIN_CHECK_ROW = r"(?![0-9]{3,6}(?U:\s)+[0-9]{2}/[0-9]{2}(?U:\s)+\$?[0-9,]+\.[0-9]{2}[ \t]*$)"
PAGE_FOOTER = r"(?md)^Page of(?U:\s*)\n(?U:\s*)[0-9]+(?U:\s)+[0-9]+(?U:\s*)$"
ACCOUNT_HEADER = r"(?md)^Account Number:(?U:\s*)\n(?U:\s*)[0-9]{10,}(?U:\s*)$"
PERIOD_HEADER = r"(?md)^[A-Z][a-z]+ [0-9]{1,2}, [0-9]{4}through[A-Z][a-z]+ [0-9]{1,2}, [0-9]{4}(?U:\s*)$"


def clean_text(text: Column, *, keep_plain_check_rows: bool = False) -> Column:
    """Remove anchors, glyphs leaked in front of a date, page footers and repeated headers; idempotent.

    The leaked-glyph rule also eats a bare check number in front of a date. ``keep_plain_check_rows``
    protects such rows; the default follows the established behavior.
    """
    leaked = LEAKED_BEFORE_DATE
    if keep_plain_check_rows:
        leaked = leaked.replace("^[a-z", f"^{PLAIN_CHECK_ROW}[a-z", 1)
    out = F.regexp_replace(text, ANCHOR, "")
    out = F.regexp_replace(out, leaked, "$1")
    for artifact in (PAGE_FOOTER, ACCOUNT_HEADER, PERIOD_HEADER):
        out = F.regexp_replace(out, artifact, "")
    return F.concat(strip(F.regexp_replace(out, r"\n{3,}", "\n\n")), F.lit("\n"))


def _is_doubled_heading(line: Column) -> Column:
    words = F.filter(
        F.transform(F.split(line, " +"), lambda w: F.regexp_replace(w, "[^A-Z]", "")), lambda core: core != ""
    )
    return (
        line.rlike(r"^[A-Z \-()]{4,}\z")
        & line.rlike(r"([A-Z])\1")
        & F.forall(words, lambda core: F.regexp_replace(core, r"(.)\1", "") == "")
    )


def undouble_headings(text_lines: Column) -> Column:
    """Repair headings whose letters are all printed twice; other lines stay as they are."""

    def repair(line: Column) -> Column:
        bare = strip(line)
        lead = F.regexp_extract(line, r"(?U)^\s*", 0)
        once = F.regexp_replace(F.regexp_replace(bare, r"([A-Z])\1", "$1"), " +", " ")
        return F.when(_is_doubled_heading(bare), F.concat(lead, once)).otherwise(line)

    return F.transform(text_lines, repair)


def clean_lines(text: Column, *, undouble: bool = False, keep_plain_check_rows: bool = False) -> Column:
    out = lines(clean_text(text, keep_plain_check_rows=keep_plain_check_rows))
    return undouble_headings(out) if undouble else out
