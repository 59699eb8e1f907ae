"""Sensor queries over stored readings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orewright.functions.dates import ago
from orewright.functions.dates import effective_time as either_clock
from orewright.operators import sensors as op
from orewright.operators import shaping
from orewright.plans.checks import BREACH3, BREACH4, rounded
from orewright.plans.registry import query
from orewright.session import work_folder
from orewright.sources import adapters as given
from orewright.sources import events as parsing
from orewright.sources.adapters import Given, shared
from orewright.streaming import windows


@shared
def readings(g: Given) -> DataFrame:
    return given.sensor_readings(g.table("events"))


def recent(g: Given, clock: str, interval: str):
    """The stored readings that can lie within the interval up to the newest ingestion, and that time."""
    events = given.events_by_day(g)
    as_of = events.as_of("_ingested_at")
    return given.sensor_readings(events.since("ts" if clock == "event_time" else clock, interval, as_of)), as_of


@query(
    "S-12", "F-24",
    sql="""
    SELECT reading_id, CASE WHEN zone <> 'error' THEN event_time END AS event_time,
      CASE WHEN zone <> 'error' THEN device_id END AS device_id, CASE WHEN zone <> 'error' THEN zone END AS zone,
      CASE WHEN zone <> 'error' THEN equipment_type END AS equipment_type,
      CASE WHEN zone <> 'error' THEN temperature_celsius END AS temperature_celsius,
      CASE WHEN zone <> 'error' THEN pressure_psi END AS pressure_psi,
      CASE WHEN zone <> 'error' THEN vibration_mms END AS vibration_mms,
      CASE WHEN zone <> 'error' THEN humidity_percent END AS humidity_percent,
      CASE WHEN zone <> 'error' THEN is_anomaly END AS is_anomaly, zone = 'error' AS is_corrupt
    FROM s_readings""",
    text=["event_time"],
)
def parse_events(g: Given) -> DataFrame:
    read = parsing.parse_events(given.sensor_bodies(g))
    return read.withColumn("is_corrupt", F.col("_corrupt_record").isNotNull()).drop("_corrupt_record")


@query("P-17", sql=f"SELECT reading_id, device_id, zone FROM s_readings WHERE {BREACH4}")
def breach(g: Given) -> DataFrame:
    return op.breaches(readings(g)).select("reading_id", "device_id", "zone")


@query("P-17", sql=f"SELECT reading_id, device_id, zone FROM s_readings WHERE {BREACH3}")
def breach_without_humidity(g: Given) -> DataFrame:
    return op.breaches(readings(g), hum=None).select("reading_id", "device_id", "zone")


@query(
    "F-25",
    sql="""
    SELECT reading_id,
      CASE WHEN temperature_celsius > 100 THEN 'critical' WHEN temperature_celsius > 90 THEN 'warning' ELSE 'normal' END AS temperature_celsius_severity,
      CASE WHEN pressure_psi > 42 THEN 'critical' WHEN pressure_psi > 38 THEN 'warning' ELSE 'normal' END AS pressure_psi_severity,
      CASE WHEN vibration_mms > 5.5 THEN 'critical' WHEN vibration_mms > 4 THEN 'warning' ELSE 'normal' END AS vibration_mms_severity,
      CASE WHEN humidity_percent > 75 THEN 'critical' WHEN humidity_percent > 65 THEN 'warning' ELSE 'normal' END AS humidity_percent_severity
    FROM s_readings""",
)
def severity(g: Given) -> DataFrame:
    graded = op.with_severity(readings(g))
    return graded.select("reading_id", *[c for c in graded.columns if c.endswith("_severity")])


@query("P-18", sql="SELECT reading_id, temperature_celsius FROM s_readings WHERE temperature_celsius > 50")
def filter_temp(g: Given) -> DataFrame:
    return op.filter_temp(readings(g)).select("reading_id", "temperature_celsius")


@query("P-19", "F-22", sql="SELECT reading_id, _ingested_at FROM s_day", text=["_ingested_at"])
def since(g: Given) -> DataFrame:
    rows, as_of = recent(g, "_ingested_at", "24 hours")
    return shaping.since(rows, "_ingested_at", "24 hours", as_of).select("reading_id", "_ingested_at")


@query(
    "P-20",
    sql="""
    SELECT reading_id, event_time FROM s_readings, s_now
    WHERE event_time BETWEEN as_of - INTERVAL 1 HOUR AND as_of""",
    text=["event_time"],
)
def between_range(g: Given) -> DataFrame:
    """No range given: the last hour."""
    events = given.events_by_day(g)
    as_of = events.as_of("_ingested_at")
    rows = given.sensor_readings(events.after("ts", ago(as_of, "1 hour"), as_of))
    return shaping.last_hour(rows, "event_time", as_of).select("reading_id", "event_time")


@query("P-21", sql="""
    SELECT _ingested_at AS "Time", device_id AS "Device", zone AS "Zone", temperature_celsius AS "Temp",
      pressure_psi AS "Pressure", vibration_mms AS "Vibration" FROM s_readings""", text=["Time"])
def project_as(g: Given) -> DataFrame:
    return shaping.project_as(readings(g), op.ALERT_NAMES)


@query(
    "A-18",
    sql=f"""
    SELECT device_id, {rounded('avg(temperature_celsius)', 2)} AS avg_temp, {rounded('avg(pressure_psi)', 2)} AS avg_pressure,
      {rounded('avg(vibration_mms)', 2)} AS avg_vibration, {rounded('avg(humidity_percent)', 2)} AS avg_humidity
    FROM s_day GROUP BY device_id""",
)
def sensor_averages(g: Given) -> DataFrame:
    return op.sensor_averages(*recent(g, "_ingested_at", "24 hours")).orderBy("device_id")


@query(
    "A-19", "F-21",
    sql=f"""
    SELECT zone, time_bucket(INTERVAL 5 MINUTE, _ingested_at) AS bin, {rounded('avg(temperature_celsius)', 1)} AS avg_temp,
      {rounded('max(temperature_celsius)', 1)} AS max_temp, count(*) FILTER ({BREACH3}) AS alert_count
    FROM s_readings, s_now WHERE _ingested_at > as_of - INTERVAL 1 HOUR GROUP BY ALL""",
    text=["bin"],
)
def zone_bins(g: Given) -> DataFrame:
    return op.zone_bins(*recent(g, "_ingested_at", "1 hour")).orderBy(F.col("bin").desc(), "zone")


@query(
    "A-20", "F-21", "V-08",
    sql=f"""
    SELECT time_bucket(INTERVAL 30 SECOND, event_time) AS event_time, {rounded('avg(temperature_celsius)', 2)} AS avg_temp
    FROM s_readings GROUP BY 1""",
    text=["event_time"],
)
def temp_trend(g: Given) -> DataFrame:
    return op.temp_trend(readings(g)).orderBy("event_time")


@query(
    "A-21", "F-04", "V-08",
    sql=f"""
    SELECT 'Avg: ' || {rounded('avg(vibration_mms)', 2)} || ' mm/s  |  Max: ' || {rounded('max(vibration_mms)', 2)} || ' mm/s' AS vibration
    FROM s_day""",
)
def vibration_card(g: Given) -> DataFrame:
    return op.vibration_card(*recent(g, "_ingested_at", "24 hours"))


@query("A-22", "V-08",
       sql="SELECT zone, count(*) FILTER (is_anomaly) AS anomalies FROM s_day GROUP BY zone")
def anomalies_by_zone(g: Given) -> DataFrame:
    return op.anomalies_by_zone(*recent(g, "_ingested_at", "24 hours")).orderBy(F.col("anomalies").desc(), "zone")


@query(
    "A-23", "P-21", "V-08",
    sql="""
    SELECT device_id AS "Device", zone AS "Zone", equipment_type AS "Equipment", temperature_celsius AS "Temp (°C)",
      pressure_psi AS "Pressure (PSI)", vibration_mms AS "Vibration (mm/s)", event_time AS "Last Reading"
    FROM s_readings
    QUALIFY row_number() OVER (PARTITION BY device_id ORDER BY event_time DESC, reading_id DESC) = 1""",
    text=["Last Reading"],
)
def latest_per_device(g: Given) -> DataFrame:
    return op.latest_per_device(readings(g)).orderBy("Device")


@query(
    "O-02", "V-08",
    sql=f"""
    SELECT _ingested_at AS "Time", device_id AS "Device", zone AS "Zone", temperature_celsius AS "Temp",
      pressure_psi AS "Pressure", vibration_mms AS "Vibration"
    FROM s_readings WHERE {BREACH4} ORDER BY _ingested_at DESC, reading_id DESC LIMIT 20""",
    text=["Time"],
)
def critical_alerts(g: Given) -> DataFrame:
    return op.critical_alerts(readings(g))


@query(
    "T-08",
    sql="""
    SELECT reading_id, CASE WHEN zone = 'error' THEN _ingested_at ELSE event_time END AS effective_time FROM s_readings""",
    text=["effective_time"],
)
def effective_time(g: Given) -> DataFrame:
    """One kind of event lost its clock; the ingestion clock stands in."""
    clocked = F.when(F.col("zone") != "error", F.col("event_time"))
    return readings(g).select(
        "reading_id", either_clock(clocked, F.col("_ingested_at")).alias("effective_time")
    )


@query("T-07", sql="SELECT reading_id, event_time FROM s_day", text=["event_time"])
def retain(g: Given) -> DataFrame:
    """A store of its own whose days past the limit are removed; the rest of the first day is cut by the filter."""
    path = work_folder(g.spark, "retained")
    given.write_events(g, path)
    events = given.events_by_day(g, path)
    events.expire("_ingested_at", "1 day")
    as_of = events.as_of("_ingested_at")
    rows = given.sensor_readings(events.since("_ingested_at", "1 day"))
    return op.retain(rows, "_ingested_at", as_of).select("reading_id", "event_time")


@query(
    "T-02",
    sql="""
    SELECT device_id, zone, avg(temperature_celsius) AS "AVG_temperature_celsius", max(vibration_mms) AS "MAX_vibration_mms",
      time_bucket(INTERVAL 30 SECOND, event_time) + INTERVAL 30 SECOND AS "Window_End_Time"
    FROM s_readings WHERE temperature_celsius > 50 GROUP BY ALL""",
    text=["Window_End_Time"], ratios=["AVG_temperature_celsius"],
)
def tumbling_stats(g: Given) -> DataFrame:
    """The stream's aggregate computed over the stored readings."""
    return windows.tumbling_stats(op.filter_temp(readings(g)))


@query(
    "V-12",
    sql=f"""
    SELECT device_id, time_bucket(INTERVAL 5 MINUTE, event_time) AS bin, {rounded('avg(temperature_celsius)', 2)} AS avg_temp
    FROM s_readings, s_now WHERE event_time > as_of - INTERVAL 1 HOUR GROUP BY ALL""",
    text=["bin"],
)
def report_device_temperature(g: Given) -> DataFrame:
    return op.device_temperature(*recent(g, "event_time", "1 hour"))
