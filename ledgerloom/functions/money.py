"""Money parsing and sign rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions.text import strip

MONEY = "decimal(18,2)"
#: sums of many amounts have more digits than one amount
TOTAL = "decimal(38,2)"
SHARE = "decimal(38,10)"


def parse_money(c: Column) -> Column:
    """'$1,234.50' -> 1234.50; blank or unparsable -> null."""
    return F.nullif(strip(F.translate(c, "$,", "")), F.lit("")).try_cast(MONEY)


def signed(amount: Column, negative: Column | bool) -> Column:
    return F.when(F.lit(negative) if isinstance(negative, bool) else negative, -amount).otherwise(amount)


def cash_amount(cash_in: Column, cash_out: Column) -> Column:
    """Cash in, else cash out, else zero; a zero counts as missing."""
    zero = F.lit(0).cast(MONEY)
    return F.coalesce(F.nullif(cash_in, zero), F.nullif(cash_out, zero), zero)


def display_amount(amount: Column, sign: str = "abs") -> Column:
    """Amount as it enters a P&L cell: 'abs' (each item positive) or 'net' (refunds reduce)."""
    if sign == "abs":
        return F.abs(amount)
    if sign == "net":
        return amount
    raise ValueError(f"sign must be 'abs' or 'net', got {sign!r}")


def share(amount: Column, n: int) -> Column:
    """One of ``n`` equal shares, kept at ten decimals."""
    return (amount.cast(SHARE) / F.lit(n)).cast(SHARE)


def tolerance(
    row_no: Column,
    filed: Column,
    *,
    revenue_rows_to: int = 10,
    revenue: float = 1.0,
    expense_abs: float = 5.0,
    expense_pct: float = 0.02,
) -> Column:
    return F.when(row_no <= revenue_rows_to, F.lit(revenue)).otherwise(
        F.greatest(F.lit(expense_abs), F.abs(filed) * F.lit(expense_pct))
    )
