"""Quantiles of any period from rows stored by day: exact from counts of values, or within a stated error from sketches.

Counts suit columns with few distinct values; a day is then at most as many rows as it has values. A sketch suits any
column: a day is one row of some kilobytes, and the rank of a merged quantile is off by at most about 1.3 % of the rows, as
Spark documents it for its default size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def value_counts(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """(by, value, n) to be stored; NULLs count for nothing."""
    return df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))


def median_of_counts(counts: DataFrame, value: str, by: Sequence[str], name: str) -> DataFrame:
    """The exact median per group of stored counts, the mean of the two middle values where there are two."""
    merged = counts.groupBy(*by, value).agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*by)
    placed = merged.withColumns({"_upto": F.sum("n").over(group.orderBy(value)), "_all": F.sum("n").over(group)})

    def at(place):
        return F.max(F.when((F.col("_upto") >= place) & (F.col("_upto") - F.col("n") < place), F.col(value)))

    low, high = F.floor((F.col("_all") + 1) / 2), F.floor(F.col("_all") / 2) + 1
    return placed.groupBy(*by).agg(((at(low) + at(high)).cast("double") / 2).alias(name))


def value_sketches(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """(by, sketch) to be stored."""
    return df.groupBy(*by).agg(F.kll_sketch_agg_double(F.col(value).cast("double")).alias("sketch"))


def quantile_of_sketches(sketches: DataFrame, by: Sequence[str], q: float, name: str) -> DataFrame:
    merged = sketches.groupBy(*by).agg(F.kll_merge_agg_double("sketch").alias("sketch"))
    return merged.select(*by, F.kll_sketch_get_quantile_double("sketch", F.lit(q)).alias(name))
