"""Streaming queries: bounded runs over the given tables, read back as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orewright.operators import sensors as op
from orewright.plans import integrate
from orewright.plans.registry import query
from orewright.session import work_folder
from orewright.sources import adapters as given
from orewright.sources.adapters import Given
from orewright.streaming import sinks, windows

STATS_SQL = """
    SELECT device_id, zone, avg(temperature_celsius) AS "AVG_temperature_celsius", max(vibration_mms) AS "MAX_vibration_mms",
      time_bucket(INTERVAL 30 SECOND, event_time) + INTERVAL 30 SECOND AS "Window_End_Time"
    FROM s_readings WHERE temperature_celsius > 50 GROUP BY ALL"""


def stream(g: Given, table: str) -> DataFrame:
    return sinks.read_files(g.spark, g.pattern(table), g.table(table).schema)


def readings(g: Given) -> DataFrame:
    return given.sensor_readings(stream(g, "events"))


def hot_partials(rows: DataFrame) -> DataFrame:
    return windows.tumbling_partials(op.filter_temp(rows))


def read_stats(g: Given, path: str, rows: DataFrame) -> DataFrame:
    return windows.merged_stats(sinks.read_partials(g.spark, path, hot_partials(rows).schema))


@query("T-01", "P-18", sql="SELECT reading_id, device_id, temperature_celsius FROM s_readings WHERE temperature_celsius > 50")
def stream_filter_temp(g: Given) -> DataFrame:
    root = work_folder(g.spark, "filter")
    hot = op.filter_temp(readings(g)).select("reading_id", "device_id", "temperature_celsius")
    sinks.finish(sinks.raw_sink(hot, f"{root}/out", f"{root}/checkpoint", once=True))
    return g.spark.read.schema(hot.schema).parquet(f"{root}/out")


@query("T-02", sql=STATS_SQL, text=["Window_End_Time"], ratios=["AVG_temperature_celsius"])
def stream_tumbling_stats(g: Given) -> DataFrame:
    root = work_folder(g.spark, "stats")
    rows = readings(g)
    sinks.finish(sinks.partial_sink(rows, hot_partials, f"{root}/out", f"{root}/checkpoint", once=True, merge=windows.merged_partials))
    return read_stats(g, f"{root}/out", rows)


@query("T-03", sql="SELECT * FROM s_readings", text=["event_time", "_ingested_at"])
def stream_raw_sink(g: Given) -> DataFrame:
    root = work_folder(g.spark, "raw")
    rows = readings(g)
    sinks.finish(sinks.raw_sink(rows, f"{root}/out", f"{root}/checkpoint", once=True))
    return g.spark.read.schema(rows.schema).parquet(f"{root}/out")


@query("S-13", "T-04", sql=f"""
    SELECT 'raw' AS branch, zone, count(*) AS n, max(temperature_celsius) AS hottest FROM s_readings GROUP BY zone
    UNION ALL SELECT 'aggregate', zone, count(*), max("AVG_temperature_celsius") FROM ({STATS_SQL}) GROUP BY zone""",
       ratios=["hottest"])
def stream_route(g: Given) -> DataFrame:
    """Both branches of the fan-out, summed up by zone."""
    root = work_folder(g.spark, "route")
    rows = readings(g)
    sinks.finish(*sinks.route(rows, hot_partials, f"{root}/raw", f"{root}/agg", f"{root}/checkpoint", once=True, merge=windows.merged_partials))
    raw = g.spark.read.schema(rows.schema).parquet(f"{root}/raw")
    agg = read_stats(g, f"{root}/agg", rows)

    def by_zone(df: DataFrame, branch: str, value: str) -> DataFrame:
        return df.groupBy(F.lit(branch).alias("branch"), "zone").agg(
            F.count(F.lit(1)).alias("n"), F.max(value).alias("hottest")
        )

    return by_zone(raw, "raw", "temperature_celsius").unionByName(
        by_zone(agg, "aggregate", "AVG_temperature_celsius")
    )


@query("T-05", "S-11", sql=integrate.MIRROR_SQL)
def stream_upsert(g: Given) -> DataFrame:
    root, keys, order = work_folder(g.spark, "mirror"), ["customer_id"], ["_at", "_seq"]
    target, feed = integrate.mirror_target(g), integrate.mirror_feed(stream(g, "orders"))
    sinks.start_mirror(target, f"{root}/table", keys)
    sinks.finish(sinks.follow_changes(feed, f"{root}/table", f"{root}/checkpoint", keys, order, once=True))
    sinks.fold_mirror(g.spark, f"{root}/table", feed.schema, keys, order)
    return sinks.read_mirror(g.spark, f"{root}/table", target.schema, feed.schema, keys, order)


@query("T-06", sql="""
    SELECT device_id, reading_id, event_time, zone, temperature_celsius FROM s_readings
    QUALIFY row_number() OVER (PARTITION BY device_id ORDER BY event_time DESC, reading_id DESC) = 1""",
       text=["event_time"])
def stream_latest_state(g: Given) -> DataFrame:
    root = work_folder(g.spark, "latest")
    rows = readings(g).select("device_id", "reading_id", "event_time", "zone", "temperature_celsius")
    state = windows.latest_state(rows)
    sinks.finish(sinks.update_sink(state, f"{root}/out", f"{root}/checkpoint", ["device_id"], once=True))
    return sinks.read_updates(g.spark, f"{root}/out", state.schema, ["device_id"])
