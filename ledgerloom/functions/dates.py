"""Date parsing; every function returns null instead of failing on invalid input."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.fixed_values import MONTH_ABBREVIATIONS, MONTH_NAMES
from ledgerloom.functions.text import nonempty_group, strip


def build_date(year: Column, month: Column, day: Column) -> Column:
    """Date from integer parts, null when any part is missing or out of range."""
    return F.concat(
        F.lpad(year.cast("string"), 4, "0"), F.lit("-"), month.cast("string"), F.lit("-"), day.cast("string")
    ).try_cast("date")


def _int(c: Column) -> Column:
    return c.try_cast("int")


def _full_year(y: Column) -> Column:
    return F.when(y < 100, y + 2000).otherwise(y)


def worksheet_date(raw: Column) -> Column:
    """M/D/YY or M/D/YYYY; years below 100 are in the 2000s."""
    parts = F.split(raw, "/")
    m, d, y = (_int(strip(F.get(parts, F.lit(i)))) for i in range(3))
    return F.when(F.size(parts) == 3, build_date(_full_year(y), m, d))


def flexible_date(raw: Column, year: int | Column) -> Column:
    """M/D/YYYY, M/D/YY (2000s) or M/D in the given year."""
    s = strip(raw)
    full = r"^([0-9]{1,2})/([0-9]{1,2})/([0-9]{4}|[0-9]{2})\z"
    short = r"^([0-9]{1,2})/([0-9]{1,2})\z"
    m, d, y = (_int(nonempty_group(s, full, i)) for i in (1, 2, 3))
    m2, d2 = (_int(nonempty_group(s, short, i)) for i in (1, 2))
    given = F.lit(year) if isinstance(year, int) else year
    return F.coalesce(build_date(_full_year(y), m, d), build_date(given, m2, d2))


def _month_number(name: Column, names: tuple[str, ...]) -> Column:
    return F.nullif(F.array_position(F.array(*[F.lit(n) for n in names]), name), F.lit(0)).cast("int")


def month_name_date(month: Column, day: Column, year: Column, *, short: bool = False) -> Column:
    """Date from a month name and day and year strings."""
    names = MONTH_ABBREVIATIONS if short else MONTH_NAMES
    return build_date(_int(year), _month_number(month, names), _int(day))


def month_day_year(s: Column) -> Column:
    """'Jan 5, 2024'."""
    pattern = r"(?U)^\s*([A-Z][a-z]{2})\s+([0-9]{1,2}),\s+([0-9]{4})\s*\z"
    m, d, y = (nonempty_group(s, pattern, i) for i in (1, 2, 3))
    return month_name_date(m, d, y, short=True)


def us_date(s: Column) -> Column:
    """'MM/DD/YYYY' only."""
    pattern = r"^([0-9]{2})/([0-9]{2})/([0-9]{4})\z"
    m, d, y = (_int(nonempty_group(s, pattern, i)) for i in (1, 2, 3))
    return build_date(y, m, d)


def cell_date(s: Column) -> Column:
    """A true date cell (ISO form), anything else null."""
    return F.when(s.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"), F.substring(s, 1, 10).try_cast("date"))


def year_in_period(month: Column, start: Column, end: Column) -> Column:
    """Year of a month/day inside a billing period that may span two years."""
    return (
        F.when(F.year(start) == F.year(end), F.year(end))
        .when(month >= F.month(start), F.year(start))
        .otherwise(F.year(end))
    )
