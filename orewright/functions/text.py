"""Text cleaning, formatting and labels."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def trimmed(col: Column) -> Column:
    return F.trim(col)


def lowered(col: Column) -> Column:
    return F.lower(F.trim(col))


def uppered(col: Column) -> Column:
    return F.upper(F.trim(col))


def titled(col: Column) -> Column:
    return F.initcap(F.trim(col))


def without_controls(col: Column) -> Column:
    """Trim white space of any kind, then strip control characters (in that order, so inner ones leave no gap)."""
    return F.regexp_replace(F.regexp_replace(col, r"(?U)\A\s+|\s+\z", ""), r"\p{Cntrl}", "")


def joined(*cols: Column, sep: str = " ") -> Column:
    """Join the parts that are not NULL."""
    return F.concat_ws(sep, *cols)


def pieces(*parts: Column | str | int) -> Column:
    """Concatenate columns and literals as text; any NULL column makes the text NULL."""
    return F.concat(
        *[p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    )


def as_millions(col: Column) -> Column:
    """12,600,000 -> '13M'."""
    return F.concat(F.round(col / 1_000_000, 0).cast("long").cast("string"), F.lit("M"))


def with_thousands(col: Column) -> Column:
    """1234567.6 -> '1,234,568'."""
    return F.format_number(F.round(col, 0), 0)


def looked_up(col: Column, labels: Mapping[str, Column | str]) -> Column:
    """Value of ``labels`` at ``col``; NULL where there is no entry."""
    chain = None
    for value, label in labels.items():
        out = label if isinstance(label, Column) else F.lit(label)
        chain = F.when(col == value, out) if chain is None else chain.when(col == value, out)
    return chain


def truth_flag(col: Column) -> Column:
    """'TRUE' in any case -> 1, everything else (NULL too) -> 0."""
    return F.when(F.upper(col) == "TRUE", 1).otherwise(0)


def fixed_width(col: Column, size: int) -> Column:
    """Text cut to ``size`` characters, as a cast to varchar(n) would."""
    return F.substring(col.cast("string"), 1, size)
