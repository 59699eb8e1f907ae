"""Stored rollups of additive measures, and the choice of the smallest one that can answer a request.

A measure is a sum or a count over fact rows. Sums add up over any dimension; a count of distinct orders adds up over what an
order has one of, such as its day and channel, and not over the categories of its lines, so a rollup answers it
only where those are asked for or not part of the rollup. A metric is an expression over measures. What no rollup can answer
is computed from the fact.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Measure:
    """How fact rows give a value, and the dimensions it cannot be summed over."""

    over: Callable[[], Column]
    fixed: frozenset[str] = frozenset()


@dataclass(frozen=True)
class Cube:
    """The measures and metrics of a fact; a metric names its measures and combines their columns."""

    measures: Mapping[str, Measure]
    metrics: Mapping[str, tuple[Sequence[str], Callable[..., Column]]]

    def needed(self, names: Sequence[str]) -> list[str]:
        """The measures that metrics or measures of these names are made of."""
        found = [m for n in names for m in (self.metrics[n][0] if n in self.metrics else [n])]
        return list(dict.fromkeys(found))

    def shown(self, names: Sequence[str]) -> list[Column]:
        return [
            (self.metrics[n][1](*[F.col(m) for m in self.metrics[n][0]]) if n in self.metrics else F.col(n)).alias(n) for n in names
        ]


@dataclass(frozen=True)
class Rollup:
    """A stored table: a row for each combination of its dimensions, with as many rows as its writer counted."""

    table: DataFrame
    dims: tuple[str, ...]
    measures: tuple[str, ...]
    rows: int


def roll_up(cube: Cube, fact: DataFrame, dims: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """The table of a rollup."""
    return fact.groupBy(*dims).agg(*[cube.measures[m].over().alias(m) for m in measures])


def coarser(cube: Cube, rollup: Rollup, dims: Sequence[str]) -> DataFrame:
    """A rollup's table summed to fewer dimensions.

    A measure that cannot be summed over one that goes is summed from its column ``…_once``, in which the writer
    counted a key in one row of that dimension only.
    """
    gone = {*rollup.dims} - {*dims}
    sums = [F.sum(f"{m}_once" if cube.measures[m].fixed & gone else m).alias(m) for m in rollup.measures]
    return rollup.table.groupBy(*dims).agg(*sums)


def _answers(cube: Cube, rollup: Rollup, measures: Sequence[str], by: Sequence[str], tested: Sequence[str]) -> bool:
    if not {*by, *tested} <= {*rollup.dims} or not {*measures} <= {*rollup.measures}:
        return False
    gone = {*rollup.dims} - {*by}
    return all(not (cube.measures[m].fixed & gone) for m in measures)


def pick(cube: Cube, rollups: Sequence[Rollup], names: Sequence[str], by: Sequence[str], tested: Sequence[str] = ()) -> Rollup | None:
    """The smallest rollup that holds what is asked for; None if none does."""
    fit = [r for r in rollups if _answers(cube, r, cube.needed(names), by, tested)]
    return min(fit, key=lambda r: r.rows, default=None)


def answer(
    cube: Cube, rollups: Sequence[Rollup], names: Sequence[str], by: Sequence[str], fact: Callable[[], DataFrame],
    where: Mapping[str, Callable[[Column], Column]] | None = None,
) -> DataFrame:
    """Metrics or measures by dimensions, under tests of dimensions; the fact is built only where no rollup will do."""
    where = where or {}
    measures = cube.needed(names)
    rollup = pick(cube, rollups, names, by, list(where))
    rows = fact() if rollup is None else rollup.table
    for dim, test in where.items():
        rows = rows.filter(test(F.col(dim)))
    if rollup is None:
        summed = roll_up(cube, rows, by, measures)
    else:
        summed = rows.groupBy(*by).agg(*[F.sum(m).alias(m) for m in measures])
    return summed.select(*by, *cube.shown(names))
