"""Keep-latest deduplication."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _best_row(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    # A bare row_number() = 1 lets Spark cut each key to one row per map task before the
    # exchange, so a key holding a third of the rows does not pile up in one reducer.
    ranked = df.withColumn(
        "_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    )
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def dedupe_latest(
    df: DataFrame,
    keys: str | Sequence[str],
    latest_by: str | Sequence[str],
    ties: Sequence[str] = (),
    nulls: str = "group",
) -> DataFrame:
    """One row per key: the latest, with ``ties`` making the order total.

    ``nulls="keep"`` lets every row with a NULL key through. Those rows take their own
    branch, so they are neither shuffled nor gathered under one NULL key.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    latest_by = [latest_by] if isinstance(latest_by, str) else list(latest_by)
    order = [F.col(c).desc_nulls_last() for c in [*latest_by, *ties]]
    if nulls == "group":
        return _best_row(df, keys, order)
    if nulls != "keep":
        raise ValueError(f"unknown nulls {nulls!r}")
    incomplete = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return _best_row(df.filter(~incomplete), keys, order).unionByName(df.filter(incomplete))
