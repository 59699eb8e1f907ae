"""Rows stored by the day of their clock, for reads of the last hour or day that open the last hour's or day's files.

Rows often have a second clock that is computed from the stored one, such as an arrival a few seconds later; a filter
on it cannot be pushed into the files. So the writer keeps facts of every write: the newest value of each clock, and
by how much it runs ahead of the stored clock at most. From a bound on the second clock a reader concludes one on
the first, which prunes days and is pushed to the files' row groups; the exact test still runs on what is left.
The newest value is also what "now" means to a report, which needs no scan to learn it.

A write has its own folder and counts once its facts are there, so one that broke off is not seen and one that is repeated
overwrites itself. Retention removes whole days.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orewright.functions.dates import ago, instant
from orewright.sources import folders

DAY = "_day"
FACTS = "clock string, newest long, ahead long, unclocked long"


def write_timed(rows: DataFrame, path: str, clock: str, clocks: Mapping[str, Column] | None = None, write: str = "0") -> None:
    """Store rows in folders by the UTC day of their clock, then the facts of all clocks, read from what was written.

    ``clocks`` names further clocks as expressions over the rows. Ranges of the clock are tasks, so a day with most
    of the rows is many files, and their rows lie in its order.
    """
    all_clocks = {clock: F.col(clock), **(clocks or {})}
    told = {}
    for k, at in enumerate(all_clocks.values()):
        ahead = F.unix_micros(at) - F.unix_micros(F.col(clock))
        unclocked = F.count_if(at.isNotNull() & F.col(clock).isNull())
        told |= {f"newest_{k}": F.max(F.unix_micros(at)), f"ahead_{k}": F.max(ahead), f"unclocked_{k}": unclocked}
    spark, to = rows.sparkSession, f"{path}/rows/write={write}"
    placed = rows.withColumn(DAY, F.to_date(clock)).repartitionByRange(F.col(clock)).sortWithinPartitions(clock)
    placed.write.mode("overwrite").partitionBy(DAY).parquet(to)
    seen = spark.read.schema(rows.schema).parquet(to).agg(*[what.alias(name) for name, what in told.items()]).first()
    facts = [(name, *(seen[f"{what}_{k}"] for what in ("newest", "ahead", "unclocked"))) for k, name in enumerate(all_clocks)]
    spark.createDataFrame(facts, FACTS).coalesce(1).write.mode("overwrite").parquet(f"{path}/facts/write={write}")


@dataclass(frozen=True)
class Timed:
    """A stored table of timed rows as far as its facts tell; ``facts`` has a (newest, ahead, unclocked) for each clock."""

    spark: SparkSession
    path: str
    schema: T.StructType
    clock: str
    writes: tuple[str, ...]
    facts: dict[str, tuple]

    def rows(self) -> DataFrame:
        """All rows, with the day they are stored under."""
        wide = T.StructType([*self.schema.fields, T.StructField(DAY, T.DateType())])
        if not self.writes:
            return self.spark.createDataFrame([], wide)
        paths = [f"{self.path}/rows/write={w}" for w in self.writes]
        return self.spark.read.schema(wide).option("basePath", f"{self.path}/rows").parquet(*paths).select(*wide.names)

    def as_of(self, name: str) -> Column:
        """The newest value of a clock, as a constant."""
        return F.timestamp_micros(F.lit(self.facts.get(name, (None,))[0]).cast("long"))

    def after(self, name: str, bound: Column, upto: Column | None = None) -> DataFrame:
        """Rows among which are all whose clock ``name`` lies behind a constant bound, and not behind ``upto``.

        Without ``upto`` only the lower bound is used. Rows of other times may come along, of a few days or row groups.
        """
        _, ahead, unclocked = self.facts.get(name, (None, None, 0))
        low = bound - F.make_dt_interval(secs=F.lit((ahead or 0) / 1e6).cast("decimal(18,6)"))
        kept = (F.col(DAY) >= F.to_date(low)) & (F.col(self.clock) >= low)
        if upto is not None and name == self.clock:
            kept &= (F.col(DAY) <= F.to_date(upto)) & (F.col(self.clock) <= upto)
        if unclocked:  # rows that have this clock only
            kept |= F.col(DAY).isNull()
        return self.rows().filter(kept).drop(DAY)

    def since(self, name: str, interval: str, as_of: Column | None = None) -> DataFrame:
        return self.after(name, ago(self.as_of(name) if as_of is None else as_of, interval))

    def expire(self, name: str, keep: str, as_of: Column | None = None) -> int:
        """Remove the days whose rows are all older than ``keep`` before ``as_of``; how many folders went."""
        _, ahead, _ = self.facts.get(name, (None, 0, 0))
        now = self.as_of(name) if as_of is None else instant(as_of)
        low = ago(now, keep) - F.make_dt_interval(secs=F.lit((ahead or 0) / 1e6).cast("decimal(18,6)"))
        first = self.spark.range(1).select(F.to_date(low).cast("string")).first()[0]
        gone = 0
        for write in self.writes if first else ():
            folder = f"{self.path}/rows/write={write}"
            for day in folders.names(self.spark, folder):
                if day.startswith(f"{DAY}=") and day[len(DAY) + 1 :] < first:
                    folders.remove(self.spark, f"{folder}/{day}")
                    gone += 1
        return gone


def open_timed(spark: SparkSession, path: str, schema: T.StructType, clock: str) -> Timed:
    """The table at a path; schema is that of the rows that were written. The facts of all writes are brought together."""
    writes = [n.partition("=")[2] for n in folders.names(spark, f"{path}/facts")]
    writes = tuple(w for w in writes if folders.complete(spark, f"{path}/facts/write={w}"))
    if not writes:
        return Timed(spark, path, schema, clock, (), {})
    told = spark.read.schema(FACTS).parquet(*[f"{path}/facts/write={w}" for w in writes])
    told = told.groupBy("clock").agg(F.max("newest"), F.max("ahead"), F.sum("unclocked")).collect()
    return Timed(spark, path, schema, clock, writes, {r[0]: tuple(r)[1:] for r in told})
