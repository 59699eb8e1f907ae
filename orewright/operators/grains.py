"""Joins and totals across grains."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def assign_period(
    df: DataFrame,
    periods: DataFrame,
    date_col: str,
    start: str = "period_start_date",
    end: str = "period_end_date",
) -> DataFrame:
    """Inner join of dates to the periods holding them, both ends included.

    Each period becomes its days, so the range test is an equality and runs as a hash
    join. A period that ends before it starts holds no day. The day table is as long as the calendar; Spark broadcasts it while it is below
    the broadcast threshold and sorts-merges it above.
    """
    days = periods.filter(F.col(start) <= F.col(end)).withColumn("_day", F.explode(F.sequence(F.col(start), F.col(end)))).drop(start, end)
    return df.join(days, df[date_col] == days["_day"]).drop("_day")


def within_spans(df: DataFrame, at: str, spans: DataFrame, start: str, end: str) -> DataFrame:
    """Inner join of times to the spans that hold them, both ends included; spans of any length, with times of day, may overlap.

    Time is cut into granules, as long as the shortest span but a second at least, and those into blocks of 1, 2, 4 …
    granules. A span is the least set of blocks that covers it, at most two of each size, and a time lies in one
    block of each size; so the join is one on equal blocks, and the ends are compared exactly after it. Only sizes that
    occur among the spans are looked up. A span that lacks an end, or ends before it starts, holds nothing.
    """
    micros = {name: F.unix_micros(F.col(name).cast("timestamp")) for name in (start, end)}
    held = spans.withColumns({"_from": micros[start], "_to": micros[end]}).filter("_from <= _to")
    shortest = held.agg(F.min(F.col("_to") - F.col("_from"))).first()[0]
    granule = max(1_000_000, shortest or 0)
    cut = held.withColumns(
        {"_a": F.floor(F.col("_from") / granule).cast("long"), "_b": F.floor(F.col("_to") / granule).cast("long") + 1}
    )
    # Of each size the first block that starts in [_a, _b) and the end of the last one, in blocks; odd ones are not part of a larger block.
    edges = F.expr(
        "transform(sequence(0, CAST(ceil(log2(_b - _a)) AS INT)), l -> named_struct("
        "'_size', l, 'lo', shiftright(_a + shiftleft(1L, l) - 1, l), 'hi', shiftright(_b, l)))"
    )
    chosen = F.flatten(F.transform(F.filter(edges, lambda e: e["lo"] < e["hi"]), lambda e: F.filter(
        F.array(
            F.when(e["lo"] % 2 != 0, F.struct(e["_size"].alias("_size"), e["lo"].alias("_block"))),
            F.when(e["hi"] % 2 != 0, F.struct(e["_size"].alias("_size"), (e["hi"] - 1).alias("_block"))),
        ),
        lambda b: b.isNotNull(),
    )))
    blocks = cut.withColumn("_in", F.explode(chosen)).select("*", "_in.*").drop("_in", "_a", "_b")
    sizes = sorted(r[0] for r in blocks.select("_size").distinct().collect())  # at most one for each bit
    time = F.unix_micros(F.col(at).cast("timestamp"))
    placed = df.withColumn("_at", time).withColumn("_granule", F.floor(F.col("_at") / granule).cast("long"))
    looked = F.array(*[F.struct(F.lit(s).alias("_size"), F.shiftright("_granule", s).alias("_block")) for s in sizes])
    looked = placed.withColumn("_in", F.explode(looked.cast("array<struct<_size:int,_block:bigint>>"))).select("*", "_in.*").drop("_in", "_granule")
    inside = looked.join(blocks, ["_size", "_block"]).filter("_at >= _from AND _at <= _to")
    return inside.drop("_size", "_block", "_at", "_from", "_to")


def related(fact: DataFrame, dim: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Look columns up through a many-to-one relationship; NULL where the key is unknown."""
    return fact.join(dim.select(key, *columns), key, "left")


def fk_orphans(
    child: DataFrame, parent: DataFrame, child_key: str, parent_key: str
) -> DataFrame:
    """Child rows whose key is set but unknown to the parent."""
    known = parent.select(F.col(parent_key).alias("_known"))
    return child.filter(F.col(child_key).isNotNull()).join(
        known, F.col(child_key) == F.col("_known"), "left_anti"
    )


def at_grain(df: DataFrame, keys: Sequence[str], measures: Mapping[str, Column]) -> DataFrame:
    """Attach aggregates of a coarser grain to each row.

    Aggregated first and joined back, not windowed: partial sums leave each task, so a
    hot key is never gathered in one place and its rows stay where they are.
    """
    coarse = df.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(
        *[m.alias(name) for name, m in measures.items()]
    )
    match = None
    for k in keys:
        test = F.col(k).eqNullSafe(F.col(f"_{k}"))
        match = test if match is None else match & test
    return df.join(coarse, match, "left").drop(*[f"_{k}" for k in keys])


def pct_of_total(
    df: DataFrame, measure: str, dim: str, others: Sequence[str] = (), name: str = "pct_of_total"
) -> DataFrame:
    """Share of an additive measure in the total over ``dim``, within the other dimensions.

    ``df`` is an aggregate already: one row per ``dim`` and ``others``.
    """
    total = F.sum(measure)
    if others:
        held = at_grain(df, others, {"_total": total})
    else:
        held = df.withColumn("_total", df.agg(total.alias("_total")).scalar())
    share = F.try_divide(F.col(measure).cast("double"), F.col("_total").cast("double"))
    return held.withColumn(name, share).drop("_total")


def distributed_rank(
    df: DataFrame, value: str, low: float, high: float, steps: int, name: str
) -> DataFrame:
    """``rank()`` over all rows, highest first, ties sharing and skipping ranks.

    Values are expected in [low, high], which is cut into ``steps`` bands; those beyond
    belong to the outer bands. A row's rank is the number of rows in higher bands plus its
    rank inside its own band. The only unpartitioned step runs over at most ``steps + 2``
    band totals. NULLs have a band of their own and come last.
    """
    width = (high - low) / steps
    clamped = F.least(F.greatest(F.col(value), F.lit(low)), F.lit(high))
    place = F.floor((clamped - low) / width).cast("int")
    band = F.when(F.col(value).isNull(), -1).otherwise(place)
    banded = df.withColumn("_band", band)
    totals = banded.groupBy("_band").agg(F.count(F.lit(1)).alias("_n"))
    ahead = totals.select(
        F.col("_band"),
        F.coalesce(
            F.sum("_n").over(
                Window.orderBy(F.col("_band").desc()).rowsBetween(Window.unboundedPreceding, -1)
            ),
            F.lit(0),
        ).alias("_ahead"),
    )
    inside = F.rank().over(Window.partitionBy("_band").orderBy(F.col(value).desc_nulls_last()))
    return (
        banded.join(ahead, "_band")
        .withColumn(name, (F.col("_ahead") + inside).cast("int"))
        .drop("_band", "_ahead")
    )
