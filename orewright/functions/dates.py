"""Dates, clocks, bins and tenure."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from orewright.functions.numbers import half_even


def stamp(col: Column) -> Column:
    return col.try_cast("timestamp")


def day(col: Column) -> Column:
    return col.try_cast("date")


def batch_id(now: Column) -> Column:
    return F.date_format(now, "yyyyMMddHHmmss")


def instant(value: datetime | str | Column) -> Column:
    """A clock reading handed in from outside; nothing below reads the wall clock."""
    return value if isinstance(value, Column) else F.lit(value).cast("timestamp")


def ago(as_of: datetime | str | Column, interval: str) -> Column:
    return instant(as_of) - F.expr(f"INTERVAL {interval}")


def bin_start(col: Column, width: str) -> Column:
    return F.window(col, width).start


def tenure_years(hired: Column, as_of: date | str) -> Column:
    """Whole years served: days / 365.25 to two digits, then to an integer, both half-even."""
    days = F.date_diff(F.lit(as_of).cast("date"), hired)
    return half_even(half_even(days / F.lit(365.25), 2), 0).cast("long")


def fiscal_quarter(month: Column) -> Column:
    return F.when(month.between(1, 12), F.concat(F.lit("Q"), F.ceil(month / 3).cast("string")))


def effective_time(event_time: Column, ingested_at: Column) -> Column:
    """The event clock, or the ingestion clock where the event clock is missing."""
    return F.coalesce(event_time, ingested_at)
