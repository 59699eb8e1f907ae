"""Registration of queries: a builder over the given tables, the inventory lines it covers, its check SQL."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orewright.functions.numbers import stable_round
from orewright.plans.checks import over
from orewright.session import spread, tune
from orewright.sources import folders
from orewright.sources.adapters import Given

RATIO_DIGITS = 6


@dataclass(frozen=True)
class Query:
    name: str
    ids: tuple[str, ...]
    build: Callable[[Given], DataFrame]
    sql: str | None
    ratios: tuple[str, ...]

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        spread(tune(spark), folders.signature(spark, folder)[0])
        return portable(self.build(Given(spark, folder)), self.ratios)


REGISTRY: dict[str, Query] = {}


def query(
    *ids: str,
    sql: str | None = None,
    text: Sequence[str] = (),
    real: Sequence[str] = (),
    ratios: Sequence[str] = (),
):
    """Register a builder under its own name.

    ``text``, ``real`` and ``ratios`` name the columns the check SQL turns into text,
    doubles and rounded doubles, as ``portable`` does by type on the Spark side.
    """

    def keep(build: Callable[[Given], DataFrame]) -> Callable[[Given], DataFrame]:
        name = build.__name__
        if name in REGISTRY:
            raise ValueError(f"query {name} registered twice")
        check = None if sql is None else over(sql, text, real, ratios, RATIO_DIGITS)
        REGISTRY[name] = Query(name, ids, build, check, tuple(ratios))
        return build

    return keep


def portable(df: DataFrame, ratios: Sequence[str] = ()) -> DataFrame:
    """Result columns in types every engine prints alike; operators keep decimals and dates."""
    shown = []
    for f in df.schema.fields:
        col = F.col(f"`{f.name}`")
        if f.name in ratios:
            col = stable_round(col, RATIO_DIGITS)
        elif isinstance(f.dataType, T.DecimalType):
            col = col.cast("double")
        elif isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            col = col.cast("string")
        shown.append(col.alias(f.name))
    return df.select(*shown)
