"""Batches kept in folders that are merged by twos, so a reader opens few of them however long a stream has run.

Every batch writes a folder of its own, named by the batches it covers. Like a binary counter, a batch whose number plus one is
a multiple of 2, 4, 8 … then merges that many last batches into one folder: after n batches a reader opens at most
log2(n) + 1 folders, and a row is rewritten at most log2(n) times. ``merge`` says what becomes of rows that meet, such as partial
sums of a window, or states of a key of which the newest stays.

Retention needs a clock among the columns. Each folder is marked with its newest value; rows that are ``keep`` behind the newest
value of all folders are dropped where folders merge and not shown before, and a folder with nothing younger is not opened and goes.

Safe against failures at every step: a folder counts once Spark has marked its write as complete, larger folders win over those
they cover, a batch that runs again overwrites its own folder and finds its merge done or does it again, and what was merged is
removed at a later batch only, so that a reader that began before still finds it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orewright.functions.dates import ago
from orewright.sources import folders

NEWEST, UNCLOCKED = "_newest-", "_unclocked"


@dataclass(frozen=True)
class Span:
    """The folder of batches first to last; newest is the marked value of the clock in microseconds, timeless
    whether there are rows without one."""

    first: int
    last: int
    gone: bool = False
    newest: int | None = None
    timeless: bool = False

    @property
    def name(self) -> str:
        return f"{'gone' if self.gone else 'span'}-{self.first}-{self.last}"


def same(rows: DataFrame) -> DataFrame:
    return rows


@dataclass(frozen=True)
class Levels:
    """A table of merged batches under a path."""

    spark: SparkSession
    path: str
    schema: T.StructType
    merge: Callable[[DataFrame], DataFrame] = same
    clock: str | None = None
    keep: str | None = None

    # --- what there is -----------------------------------------------------------------------------------

    def _all(self) -> list[Span]:
        found = []
        for name in folders.names(self.spark, self.path):
            kind, *ends = name.split("-")
            if kind == "gone":
                found.append(Span(int(ends[0]), int(ends[1]), True))
            elif kind == "span":
                held = folders.names(self.spark, f"{self.path}/{name}")
                if "_SUCCESS" in held and (not self.clock or any(h.startswith(NEWEST) for h in held)):
                    marks = [int(h[len(NEWEST) :]) for h in held if h.startswith(NEWEST) and h != f"{NEWEST}none"]
                    found.append(Span(int(ends[0]), int(ends[1]), False, max(marks, default=None), UNCLOCKED in held))
        return found

    def _cover(self) -> list[Span]:
        """The folders that hold the batches now, each batch in one of them, and the marks of those dropped whole."""
        found, at = [], -1
        for s in sorted(self._all(), key=lambda s: (s.first, -s.last, not s.gone)):
            if s.first > at:
                found.append(s)
                at = s.last
        return found

    def spans(self) -> list[Span]:
        """The folders a reader opens."""
        return [s for s in self._cover() if not s.gone]

    def _bound(self, spans: list[Span]):
        """The value of the clock at which rows are too old, as a constant; None without one."""
        newest = [s.newest for s in spans if s.newest is not None]
        return ago(F.timestamp_micros(F.lit(max(newest)).cast("long")), self.keep) if self.keep and newest else None

    def _young(self, rows: DataFrame, bound) -> DataFrame:
        """Without rows past the limit; a row without a clock is never too old."""
        return rows if bound is None else rows.filter(F.col(self.clock).isNull() | (F.col(self.clock) > bound))

    def _expired(self, spans: list[Span], bound) -> list[Span]:
        if bound is None:
            return []
        limit = self.spark.range(1).select(F.unix_micros(bound)).first()[0]
        return [s for s in spans if s.newest is not None and s.newest <= limit and not s.timeless]

    def rows_of(self, spans: list[Span]) -> DataFrame:
        if not spans:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{s.name}" for s in spans])

    def read(self) -> DataFrame:
        """All rows within the limit, as the folders hold them: rows of different folders have yet to be merged."""
        spans = self.spans()
        bound = self._bound(spans)
        expired = self._expired(spans, bound)
        return self._young(self.rows_of([s for s in spans if s not in expired]), bound)

    def merged(self) -> DataFrame:
        return self.merge(self.read())

    # --- batches -----------------------------------------------------------------------------------------

    def _write(self, rows: DataFrame, span: Span) -> None:
        to = f"{self.path}/{span.name}"
        rows.write.mode("overwrite").parquet(to)
        if self.clock:
            at = F.col(self.clock)
            written = self.spark.read.schema(self.schema).parquet(to)
            newest, unclocked = written.agg(F.max(F.unix_micros(at)), F.count_if(at.isNull())).first()
            if unclocked:
                folders.mark(self.spark, f"{to}/{UNCLOCKED}")
            folders.mark(self.spark, f"{to}/{NEWEST}{'none' if newest is None else newest}")

    def append(self, rows: DataFrame, batch: int) -> None:
        """Store a batch, merge what it completes, and drop what is past the limit."""
        kept = {s.name for s in self._cover()}
        for s in self._all():  # merged or dropped at an earlier batch
            if s.name not in kept and s.last < batch:
                folders.remove(self.spark, f"{self.path}/{s.name}")
        self._write(self.merge(rows), Span(batch, batch))
        run = (batch + 1) & -(batch + 1)  # the largest power of two that divides it
        whole = Span(batch + 1 - run, batch)
        live = self.spans()
        if run > 1 and (whole.first, whole.last) not in {(s.first, s.last) for s in live}:
            parts = [s for s in live if s.first >= whole.first and s.last <= batch]
            self._write(self._young(self.merge(self.rows_of(parts)), self._bound(live)), whole)
            live = self.spans()
        for s in self._expired(live, self._bound(live)):
            folders.mark(self.spark, f"{self.path}/{Span(s.first, s.last, True).name}")
