"""What several corpus operators share: tables cut from their lineage, components of links, fixed-size filters."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orewright.session import tune, work_folder

# Words are runs of anything but blank, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
BATCH_ROWS, BATCH_BYTES = 1000, 4 << 20
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The same rows written to the shared folder and read again: no recomputation, no lineage."""
    spark = df.sparkSession
    path = work_folder(spark, purpose)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def prepared(spark: SparkSession) -> SparkSession:
    """A session with the runtime settings whose executors can import this package: Spark sends it to them once.

    Batches to Python are bounded in rows and in bytes, as rows here carry whole texts, on joins two of them: both sides
    hold some batches in memory outside the heap, which is not given back.
    """
    context = tune(spark).sparkContext
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    if not any(f.endswith("/orewright.zip") for f in context.listFiles):
        package = Path(__file__).resolve().parents[1]
        archive = Path(tempfile.mkdtemp()) / "orewright.zip"
        with zipfile.ZipFile(archive, "w") as z:
            for source in sorted(package.rglob("*.py")):
                z.write(source, source.relative_to(package.parent))
        context.addPyFile(str(archive))
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def folded(text: Column) -> Column:
    """A-Z in lower case, nothing else; a missing text is empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def crc_of_id(doc_id: Column) -> Column:
    """CRC-32 of the id as decimal text."""
    return F.crc32(F.encode(doc_id.cast("string"), "UTF-8"))


def components(links: DataFrame, rounds: int = 40) -> DataFrame:
    """(id, component) of every id on a link (a, b); component is the smallest id reachable.

    Alternates the large-star and small-star steps: every step keeps connectivity, and the
    neighbourhoods are only ever reduced to their minimum, so a hub with millions of links
    is a partial aggregate and a join that adaptive execution can split. It ends as soon as the links
    are stars, also before the first step: that is looked at in one aggregate, no step is made to see that nothing moves.
    """
    edges = links.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("m")).filter("v <> m").distinct()
    edges = stored(edges, "links")
    for _ in range(rounds):
        if _are_stars(edges):
            break
        edges = stored(_small_star(_large_star(edges)), "links")
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return (
        edges.select(F.col("v").alias("id"), F.col("m").alias("component"))
        .unionAll(edges.select(F.col("m").alias("id"), F.col("m").alias("component")).distinct())
    )


def _are_stars(edges: DataFrame) -> bool:
    """Whether every v of distinct edges (v, m), m < v, has one m, and no m is a v: then m is the smallest of its component."""
    ends = edges.select(F.col("v").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.unionAll(edges.select("m", F.lit(0), F.lit(1))).groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return ends.filter("up > 1 or up = 1 and down = 1").isEmpty()


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the node's smallest neighbour (or itself)."""
    both = edges.unionAll(edges.select(F.col("m").alias("v"), F.col("v").alias("m"))).toDF("u", "w")
    low = both.groupBy("u").agg(F.min("w").alias("low")).select("u", F.least("low", "u").alias("low"))
    return both.join(low, "u").filter("w > u").select(F.col("w").alias("v"), F.col("low").alias("m")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of them."""
    low = edges.groupBy("v").agg(F.min("m").alias("low"))
    moved = edges.join(low, "v").select(F.col("m").alias("v"), F.col("low").alias("m")).filter("v <> m")
    return moved.unionAll(low.toDF("v", "m")).distinct()


# --- what Python workers keep ------------------------------------------------------------------------------

_kept: dict[str, object] = {}


def kept_by_worker(owner: str, make: Callable[[], object] | None = None) -> object:
    """What an operator keeps in a Python worker from one task to the next; called where its tasks begin.

    Workers outlive stages, so whatever another operator kept there goes first, and its memory back to the system.
    """
    if any(o != owner for o in _kept):
        _kept.clear()
        gc.collect()
        with contextlib.suppress(AttributeError, OSError):  # only some C libraries have it
            ctypes.CDLL(None).malloc_trim(0)
    if owner not in _kept:
        _kept[owner] = make() if make else None
    return _kept[owner]


# --- a filter of fixed size over ids: no id is lost, some others pass -------------------------------------

FILTER_BITS = 1 << 24
_MIXERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


def _filter_slots(ids: np.ndarray) -> Iterator[np.ndarray]:
    x = ids.astype(np.int64).view(np.uint64)
    for k in _MIXERS:
        h = (x ^ (x >> np.uint64(31))) * np.uint64(k)
        yield (h >> np.uint64(40)).astype(np.int64)  # 24 bits


def id_filter(ids: DataFrame, column: str):
    """A broadcast bit set of two megabytes, whatever the number of ids, and a column function that tests it.

    Bits are gathered by an aggregate over words of 64 bits, at most 262,144 rows.
    """
    spark = ids.sparkSession

    def words(batches):
        bits = np.zeros(FILTER_BITS, np.bool_)
        for b in batches:
            got = b.column(0).to_numpy(zero_copy_only=False)
            for s in _filter_slots(got):
                bits[s] = True
        packed = np.packbits(bits, bitorder="little").view(np.int64)
        at = np.flatnonzero(packed)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(packed[at])], ["word", "bits"])

    rows = (
        ids.select(F.col(column).cast("long").alias("id")).mapInArrow(words, "word long, bits long")
        .groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()  # columns, no object for each row
    )
    packed = np.zeros(FILTER_BITS // 64, np.int64)
    packed[rows["word"].to_numpy()] = rows["bits"].to_numpy()
    del rows
    shared = spark.sparkContext.broadcast(packed)

    def has(x: np.ndarray) -> np.ndarray:
        found = np.ones(len(x), bool)
        for s in _filter_slots(x):
            found &= (shared.value.view(np.uint64)[s >> 6] >> (s & 63).astype(np.uint64)) & np.uint64(1) == 1
        return found

    @F.pandas_udf(T.BooleanType())
    def test(x: pd.Series) -> pd.Series:
        return pd.Series(has(x.to_numpy()))

    return has, test
