"""Text helpers as Column expressions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.fixed_values import BANK_PREFIXES

LINE_BREAK = r"\r\n|[\n\r\x0B\x0C\x1C-\x1E\x85\u2028\u2029]"
_PREFIX = "^(?:" + "|".join(BANK_PREFIXES) + ")"
# All white space characters, Unicode included.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip(c: Column) -> Column:
    """Remove all leading and trailing white space (Spark's trim only removes blanks)."""
    return F.trim(c, F.lit(WHITE_SPACE))


def blank_to_null(c: Column) -> Column:
    return F.nullif(strip(c), F.lit(""))


def quote(text: str) -> str:
    """A literal inside a Java regular expression."""
    return "\\Q" + text + "\\E"


def vendor_key(description: Column, *, strip_leading_date: bool = False) -> Column:
    """Stable vendor key of a bank description; null gives the empty string."""
    s = strip(F.lower(description))
    if strip_leading_date:
        s = F.regexp_replace(s, r"^\d{1,2}/\d{1,2}(?U:\s)+", "")
    s = strip(F.regexp_replace(s, _PREFIX, ""))
    s = F.regexp_replace(s, r"(?U)#\s*\w+", "")
    s = F.regexp_replace(s, r"(?U)\*\s*\w+", "")
    s = F.regexp_replace(s, r"(?U)\s+\d+\b", "")
    s = F.translate(s, ".,;:!?", "")
    s = F.regexp_replace(s, r"(?U)\s+", " ")
    return F.coalesce(F.trim(s), F.lit(""))


def lines(text: Column) -> Column:
    """Array of the lines of a text; a final line break does not open another line."""
    parts = F.split(text, LINE_BREAK)
    return F.when(
        F.element_at(parts, -1) == "", F.slice(parts, F.lit(1), F.size(parts) - 1)
    ).otherwise(parts)


def nonempty_group(c: Column, pattern: str, group: int) -> Column:
    """Regex group, null where the pattern or the group does not match."""
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def starts_with_any(c: Column, starts: Iterable[str]) -> Column:
    test = F.lit(False)
    for s in starts:
        test = test | c.startswith(s)
    return test


def contains_any(c: Column, parts: Iterable[str]) -> Column:
    test = F.lit(False)
    for p in parts:
        test = test | c.contains(p)
    return test


def lookup(c: Column, mapping: Mapping[str, str | None]) -> Column:
    """Value of a parameter map (a literal in the plan, so no join); null when unknown or mapped to null."""
    known = {k: v for k, v in mapping.items() if v is not None}
    if not known:
        return F.lit(None).cast("string")
    pairs: list[Column] = []
    for k, v in known.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.try_element_at(F.create_map(*pairs), c)


def map_status(c: Column, mapping: Mapping[str, str | None]) -> Column:
    """'mapped', 'excluded' (known, deliberately without a label) or 'unknown'."""
    excluded = [k for k, v in mapping.items() if v is None]
    mapped = [k for k, v in mapping.items() if v is not None]
    return (
        F.when(c.isin(mapped), "mapped").when(c.isin(excluded), "excluded").otherwise("unknown")
        if excluded
        else F.when(c.isin(mapped), "mapped").otherwise("unknown")
    )


def first_rule(text: Column, rules: Iterable[tuple[str, str]]) -> Column:
    """Value of the first rule whose pattern is contained in ``text``, in declared order; else null."""
    expr = None
    for needle, value in rules:
        expr = F.when(text.contains(needle), value) if expr is None else expr.when(text.contains(needle), value)
    return F.lit(None).cast("string") if expr is None else expr
