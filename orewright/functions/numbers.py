"""Money, safe arithmetic and rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RETAIL_MONEY = "decimal(12,2)"
LEDGER_MONEY = "decimal(18,2)"


def money(col: Column) -> Column:
    return col.try_cast(RETAIL_MONEY)


def ledger_money(col: Column) -> Column:
    return col.try_cast(LEDGER_MONEY)


def whole(col: Column) -> Column:
    return col.try_cast("int")


def safe_divide(top: Column, bottom: Column, otherwise: float | None = None) -> Column:
    """Quotient as a double; NULL (or ``otherwise``) where the divisor is zero."""
    ratio = F.try_divide(top.cast("double"), bottom.cast("double"))
    return ratio if otherwise is None else F.coalesce(ratio, F.lit(float(otherwise)))


def exact_ratio(top: Column, bottom: Column, otherwise: int | None = None) -> Column:
    """Decimal quotient of two ledger sums; NULL (or ``otherwise``) where the divisor is zero.

    Wide enough for sums over any number of postings, which decimal(18,4) is not.
    """
    ratio = F.try_divide(top.cast("decimal(28,4)"), bottom.cast("decimal(28,4)"))
    return ratio if otherwise is None else F.coalesce(ratio, F.lit(otherwise))


def half_even(col: Column, digits: int = 0) -> Column:
    """Banker's rounding: the one place where that choice is made."""
    return F.bround(col, digits)


def fix_negative(col: Column, mode: str = "as_coded") -> Column:
    """Negative amounts: kept by default (the rule multiplies by +1), flipped with ``abs``."""
    if mode == "as_coded":
        return col
    if mode == "abs":
        return F.abs(col)
    raise ValueError(f"unknown mode {mode!r}")


def stable_round(col: Column, digits: int) -> Column:
    """Round a computed double, snapped to eight digits first.

    Partial sums arrive in any order, so the last bits of a mean differ between runs; the
    snap keeps a value that is a tie in exact arithmetic from falling either way.
    """
    return F.round(col.cast("decimal(38,8)"), digits).cast("double")
