"""Windowed and keyed aggregates that run on a stream or on a stored table alike."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


WINDOW_KEYS = ["device_id", "zone", "Window_End_Time"]


def tumbling_partials(df: DataFrame, width: str = "30 seconds", clock: str = "event_time") -> DataFrame:
    """Sum, count and highest values per device, zone and window, which add up further.

    Windows are [start, end) from the epoch. A row without a clock has no window.
    """
    return df.groupBy(F.window(clock, width), "device_id", "zone").agg(
        F.sum("temperature_celsius").alias("_sum"), F.count("temperature_celsius").alias("_n"),
        F.max("vibration_mms").alias("_vibration"),
    ).select("device_id", "zone", F.col("window.end").alias("Window_End_Time"), "_sum", "_n", "_vibration")


def merged_partials(partials: DataFrame) -> DataFrame:
    """One partial row per window from any number of them."""
    return partials.groupBy(*WINDOW_KEYS).agg(
        F.sum("_sum").alias("_sum"), F.sum("_n").alias("_n"), F.max("_vibration").alias("_vibration")
    )


def merged_stats(partials: DataFrame) -> DataFrame:
    """Average temperature and highest vibration per window from any number of partial rows of it."""
    return merged_partials(partials).select(
        "*", F.try_divide("_sum", "_n").alias("AVG_temperature_celsius"), F.col("_vibration").alias("MAX_vibration_mms")
    ).select("device_id", "zone", "AVG_temperature_celsius", "MAX_vibration_mms", "Window_End_Time")


def tumbling_stats(df: DataFrame, width: str = "30 seconds", clock: str = "event_time") -> DataFrame:
    """The windows of a stored table."""
    return merged_stats(tumbling_partials(df, width, clock))


def latest_state(df: DataFrame, key: str = "device_id", clock: str = "event_time",
                 tie: str = "reading_id") -> DataFrame:
    """Latest full row per key; one row per key is kept as state."""
    rest = [c for c in df.columns if c != key]
    newest = F.max_by(F.struct(*rest), F.struct(F.col(clock), F.col(tie)))
    return df.groupBy(key).agg(newest.alias("_row")).select(key, "_row.*")
