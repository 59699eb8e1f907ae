"""Running balances kept as blocks of periods, so a new or late posting is summed from its own block on.

Stored are the activity of every account and period, and for each block of periods the balance every account closes it with.
The balances of a block are the closing row before it plus a window over the block's periods; an update
reads one closing row an account, and the activity of the blocks from the first one it changes.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orewright.sources import folders

PERIODS = 12  # a block, by default a year of months


class Balances:
    """Activity and closings under a path. Periods are whole numbers in order; accounts are ``keys``.

    Every update writes a version of the blocks it changes and is marked as done at the end; a block's newest version of a
    done update counts. So one that breaks off is not seen, and one that is repeated starts from what was there before it.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], amount: T.DataType, periods: int = PERIODS):
        self.spark, self.path, self.keys, self.periods = spark, path, list(keys), periods
        key_fields = [T.StructField(k, T.StringType()) for k in self.keys]
        self.activity_schema = T.StructType([*key_fields, T.StructField("period", T.LongType()), T.StructField("amount", amount)])
        self.closing_schema = T.StructType([*key_fields, T.StructField("closing", amount)])

    def _versions(self) -> dict[int, int]:
        """Each block with the newest done update that wrote it."""
        done = [int(n.partition("-")[2]) for n in folders.names(self.spark, self.path) if n.startswith("done-")]
        held: dict[int, int] = {}
        for update in sorted(done):
            held |= dict.fromkeys(self._written(update), update)
        return held

    def _written(self, update: int) -> list[int]:
        names = folders.names(self.spark, f"{self.path}/update-{update}/closing")
        return [int(n.partition("=")[2]) for n in names if n.startswith("block=")]

    def _read(self, kind: str, blocks: Sequence[int], held: dict[int, int]) -> DataFrame:
        """What is stored of some blocks."""
        schema = self.activity_schema if kind == "activity" else self.closing_schema
        paths = [f"{self.path}/update-{held[b]}/{kind}/block={b}" for b in blocks if b in held]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _summed(self, rows: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
        return rows.groupBy(*keys).agg(F.sum(name).cast(self.activity_schema["amount"].dataType).alias(name))

    def blocks(self) -> list[int]:
        return sorted(self._versions())

    def add(self, postings: DataFrame, update: int) -> list[int]:
        """Add postings (keys, period, amount), new or late, as update number so and so; the blocks written, in order."""
        if f"done-{update}" in folders.names(self.spark, self.path):
            return []
        held, to = self._versions(), f"{self.path}/update-{update}"
        # The postings are summed once, into a folder for each block they are of.
        came = self._summed(postings, [*self.keys, "period"], "amount").withColumn("block", self._block())
        came.write.mode("overwrite").partitionBy("block").parquet(f"{to}/postings")
        touched = sorted(int(n.partition("=")[2]) for n in folders.names(self.spark, f"{to}/postings") if n.startswith("block="))
        if not touched:
            return []
        todo = sorted({*touched, *(b for b in held if b > touched[0])})
        new = self._folder(f"{to}/postings")
        rows = self._summed(self._read("activity", todo, held).unionByName(new), [*self.keys, "period"], "amount")
        rows.withColumn("block", self._block()).write.mode("overwrite").partitionBy("block").parquet(f"{to}/activity")

        # Closings of all blocks from the first one on: the balance before it and an account's sums, a row a block.
        moved = self._folder(f"{to}/activity").groupBy(*self.keys, self._block().alias("block")).agg(
            F.sum("amount").alias("moved")
        )
        before = max((b for b in held if b < todo[0]), default=None)
        opening = self._read("closing", [] if before is None else [before], held).select(
            *self.keys, F.lit(todo[0]).cast("long").alias("block"), F.col("closing").alias("moved")
        )
        # Every account has a closing in every block from its first one on.
        known = opening.unionByName(moved).groupBy(*self.keys).agg(F.min("block").alias("first"))
        each = known.withColumn("block", F.explode(F.array(*[F.lit(b).cast("long") for b in todo]))).filter("block >= first").drop("first")
        rows = opening.unionByName(moved).unionByName(each.withColumn("moved", F.lit(0)))
        so_far = Window.partitionBy(*self.keys).orderBy("block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        sums = rows.groupBy(*self.keys, "block").agg(F.sum("moved").alias("moved"))
        closing = sums.select(*self.keys, "block", F.sum("moved").over(so_far).cast(self.closing_schema["closing"].dataType).alias("closing"))
        closing.write.mode("overwrite").partitionBy("block").parquet(f"{to}/closing")
        folders.mark(self.spark, f"{self.path}/done-{update}")
        folders.remove(self.spark, f"{to}/postings")
        return todo

    def _folder(self, path: str) -> DataFrame:
        """All blocks under a folder."""
        return self.spark.read.schema(self.activity_schema).parquet(path).select(*self.activity_schema.names)

    def _block(self):
        return F.floor(F.col("period") / self.periods).cast("long")

    def of(self, blocks: Sequence[int]) -> DataFrame:
        """keys, period, amount and balance of some blocks' periods: their activity and an opening row for each account and block."""
        held = self._versions()
        before = {b: max((x for x in held if x < b), default=None) for b in blocks if b in held}
        opened = [
            self._read("closing", [a], held).withColumn("_block", F.lit(b).cast("long")) for b, a in before.items() if a is not None
        ]
        opening = reduce(DataFrame.unionByName, opened) if opened else self._read("closing", [], held).withColumn("_block", F.lit(0).cast("long"))
        rows = self._read("activity", list(before), held).withColumn("_block", self._block()).join(opening, [*self.keys, "_block"], "left")
        so_far = Window.partitionBy(*self.keys, "_block").orderBy("period").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        balance = F.sum("amount").over(so_far) + F.coalesce("closing", F.lit(0))
        return rows.select(*self.keys, "period", "amount", balance.cast(self.activity_schema["amount"].dataType).alias("balance"))

    def all(self) -> DataFrame:
        """The balances of all blocks, each from its own opening: no account's whole history meets in one window."""
        return self.of(self.blocks())
