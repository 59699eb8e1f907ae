"""Distinct counts that add up: sets of integer ids stored at a fine grain and merged to any coarser one, exactly.

A set is cut into blocks of 32,768 ids. A block with few of them is a short list of places, one with many a bitmap of
4 kB, so a fine grain over scattered ids stays near the size of its ids, and a coarse one near a bit each. Merging reads
stored blocks only, never the rows they came from.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NO_BITS = bytes(4096)
FEW = 256  # places of two bytes up to which a list is the smaller form


def id_sets(rows: DataFrame, ids: str, by: Sequence[str]) -> DataFrame:
    """The distinct ids per group as blocks: ``by``, ``block``, and ``places`` or ``bits``. NULL ids are left out.

    Duplicates go before the exchange that brings a block together, which then takes 32,768 rows at most
    for each block, however often its ids occur.
    """
    where = rows.filter(F.col(ids).isNotNull()).select(
        *by, F.bitmap_bucket_number(ids).alias("block"), F.bitmap_bit_position(ids).cast("smallint").alias("place")
    )
    # Dealt out by block first: else every map task would send a bitmap for each block it meets.
    return _blocks(where.distinct().repartition(*by, "block"), by)


def _blocks(places: DataFrame, by: Sequence[str]) -> DataFrame:
    """Sets of distinct places that lie together by block."""
    keys = [*by, "block"]
    held = places.groupBy(*keys).agg(
        F.sort_array(F.collect_list("place")).alias("places"), F.bitmap_construct_agg(F.col("place").cast("long")).alias("bits")
    )
    few = F.size("places") <= FEW
    return held.select(*keys, F.when(few, F.col("places")).alias("places"), F.when(~few, F.col("bits")).alias("bits"))


def merged_sets(sets: DataFrame, by: Sequence[str]) -> DataFrame:
    """The union of sets per coarser group, in the same form.

    Lists meet as places, bitmaps by OR; where both occur in one block, the list is written as a bitmap too. Lists
    travel as they are, once, and are spelled out where they meet: a block gets ``FEW`` places at most from each group.
    """
    keys = [*by, "block"]
    lists = sets.filter("places is not null").select(*keys, "places").repartition(*keys)
    lists = _blocks(lists.select(*keys, F.explode("places").alias("place")).distinct(), by)
    maps = sets.filter("bits is not null").select(*keys, F.lit(None).cast("array<smallint>").alias("places"), "bits")
    together = lists.unionByName(maps).groupBy(*keys).agg(
        F.count("bits").alias("maps"), F.max("places").alias("places"), F.bitmap_or_agg(F.coalesce("bits", F.lit(NO_BITS))).alias("bits")
    )
    alone = together.filter("maps = 0").select(*keys, "places", F.lit(None).cast("binary").alias("bits"))
    mixed = together.filter("maps > 0 and places is not null")
    spelled = mixed.select(*keys, F.explode("places").alias("place")).repartition(*keys).groupBy(*keys).agg(
        F.bitmap_construct_agg(F.col("place").cast("long")).alias("bits")
    )
    full = together.filter("maps > 0").select(*keys, "bits").unionByName(spelled).groupBy(*keys).agg(F.bitmap_or_agg("bits").alias("bits"))
    return alone.unionByName(full.select(*keys, F.lit(None).cast("array<smallint>").alias("places"), "bits"))


def size() -> Column:
    """Number of ids in a stored block."""
    return F.coalesce(F.when(F.col("places").isNotNull(), F.size("places")).cast("long"), F.bitmap_count("bits"))


def set_sizes(sets: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """Number of distinct ids per group of stored sets."""
    return merged_sets(sets, by).groupBy(*by).agg(F.sum(size()).alias(name))


def not_in_set(rows: DataFrame, ids: str, sets: DataFrame) -> DataFrame:
    """Rows whose id is set but not in the stored set (of no group): an exact anti join on blocks.

    The set is a bit an id where ids are dense, so its table is some thousandth of its keys and Spark broadcasts it long after the
    keys themselves are too many; the rows then stay where they are and only those that are found move on.
    """
    held = sets.select(F.col("block").alias("_block"), F.col("places").alias("_places"), F.col("bits").alias("_bits"))
    known = rows.filter(F.col(ids).isNotNull()).withColumns(
        {"_at": F.bitmap_bucket_number(ids), "_place": F.bitmap_bit_position(ids)}
    )
    byte = F.conv(F.hex(F.substring("_bits", (F.col("_place") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    in_bits = F.coalesce(F.getbit(byte, F.col("_place") % 8) == 1, F.lit(False))
    in_list = F.coalesce(F.array_contains("_places", F.col("_place").cast("smallint")), F.lit(False))
    looked = known.join(held, F.col("_at") == F.col("_block"), "left").filter(~in_bits & ~in_list)
    return looked.drop("_at", "_place", "_block", "_places", "_bits")
