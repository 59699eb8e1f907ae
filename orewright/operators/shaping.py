"""Projections, filters and sorts that any workload can use."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orewright.functions.dates import ago

Rule = Callable[[Column], Column]


def conform(df: DataFrame, rules: Mapping[str, Rule]) -> DataFrame:
    """Apply one cleaning rule per named column, in one projection."""
    return df.withColumns({name: rule(F.col(name)) for name, rule in rules.items()})


def select_dim(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns)


def exclude_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Drop rows holding a listed value; a NULL is not in the list and stays."""
    col = F.col(column)
    return df.filter(col.isNull() | ~col.isin(*values))


def before(df: DataFrame, column: str, limit: date | str) -> DataFrame:
    return df.filter(F.col(column) < F.lit(limit).cast("date"))


def reshape(
    df: DataFrame,
    order: Sequence[str] | None = None,
    drop: Sequence[str] = (),
    rename: Mapping[str, str] | None = None,
) -> DataFrame:
    """Put columns in order, drop some, rename some; in that order."""
    shaped = df.select(*order) if order else df
    return shaped.drop(*drop).withColumnsRenamed(dict(rename or {}))


def since(df: DataFrame, clock: str, interval: str, as_of: datetime | str | Column) -> DataFrame:
    """Rows whose clock lies within ``interval`` before ``as_of``."""
    return df.filter(F.col(clock) > ago(as_of, interval))


def between_range(
    df: DataFrame, clock: str, begin: datetime | str | Column, end: datetime | str | Column
) -> DataFrame:
    lower, upper = (b if isinstance(b, Column) else F.lit(b) for b in (begin, end))
    return df.filter(F.col(clock).between(lower.cast("timestamp"), upper.cast("timestamp")))


def last_hour(df: DataFrame, clock: str, end: datetime | str | Column) -> DataFrame:
    """The range used when the caller sets none: the hour up to ``end``."""
    return between_range(df, clock, ago(end, "1 hour"), end)


def project_as(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Keep the mapped columns under their display names."""
    return df.select(*[F.col(source).alias(shown) for source, shown in mapping.items()])


def slice_rows(
    df: DataFrame,
    not_null: Sequence[str] = (),
    below: Mapping[str, object] | None = None,
    one_of: Mapping[str, Sequence] | None = None,
) -> DataFrame:
    """Report filters: categories that must be present, upper bounds, picked values."""
    tests = [F.col(c).isNotNull() for c in not_null]
    tests += [F.col(c) < F.lit(limit) for c, limit in (below or {}).items()]
    tests += [F.col(c).isin(*values) for c, values in (one_of or {}).items()]
    return df.filter(reduce(lambda a, b: a & b, tests)) if tests else df


def top(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """First ``k`` rows of a total order; each task keeps only its own best ``k``."""
    return df.orderBy(*order).limit(k)


def head(df: DataFrame, n: int) -> DataFrame:
    return df.limit(n)
