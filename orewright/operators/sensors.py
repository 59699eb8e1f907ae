"""Sensor readings: thresholds, bins, latest state and alerts."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orewright.functions.bands import SEVERITY_LIMITS, severity
from orewright.functions.dates import bin_start
from orewright.functions.numbers import stable_round
from orewright.functions.text import pieces
from orewright.operators.dedupe import dedupe_latest
from orewright.operators.shaping import project_as, since, top

Clock = datetime | str | Column

# Display names of the status and alert tables.
STATUS_NAMES = {
    "device_id": "Device",
    "zone": "Zone",
    "equipment_type": "Equipment",
    "temperature_celsius": "Temp (°C)",
    "pressure_psi": "Pressure (PSI)",
    "vibration_mms": "Vibration (mm/s)",
    "event_time": "Last Reading",
}
ALERT_NAMES = {
    "_ingested_at": "Time",
    "device_id": "Device",
    "zone": "Zone",
    "temperature_celsius": "Temp",
    "pressure_psi": "Pressure",
    "vibration_mms": "Vibration",
}


def breach(
    temp: float | None = 100, psi: float | None = 42, vib: float | None = 5.5, hum: float | None = 75
) -> Column:
    """True where any metric exceeds its limit; ``None`` leaves a metric out."""
    limits = {
        "temperature_celsius": temp, "pressure_psi": psi, "vibration_mms": vib, "humidity_percent": hum,
    }
    tests = [F.col(c) > limit for c, limit in limits.items() if limit is not None]
    any_of = tests[0]
    for test in tests[1:]:
        any_of = any_of | test
    return any_of


def breaches(df: DataFrame, **limits) -> DataFrame:
    return df.filter(breach(**limits))


def filter_temp(df: DataFrame, above: float = 50.0) -> DataFrame:
    """Readings hotter than ``above``; works on batch and stream alike."""
    return df.filter(F.col("temperature_celsius") > above)


def with_severity(df: DataFrame) -> DataFrame:
    return df.withColumns({f"{metric}_severity": severity(metric) for metric in SEVERITY_LIMITS})


def sensor_averages(df: DataFrame, as_of: Clock, interval: str = "24 hours") -> DataFrame:
    named = {
        "avg_temp": "temperature_celsius", "avg_pressure": "pressure_psi",
        "avg_vibration": "vibration_mms", "avg_humidity": "humidity_percent",
    }
    recent = since(df, "_ingested_at", interval, as_of)
    averages = [stable_round(F.avg(c), 2).alias(n) for n, c in named.items()]
    return recent.groupBy("device_id").agg(*averages)


def zone_bins(df: DataFrame, as_of: Clock, interval: str = "1 hour", width: str = "5 minutes") -> DataFrame:
    """Per zone and bin of the ingestion clock; the alert test leaves humidity out."""
    temp = F.col("temperature_celsius")
    recent = since(df, "_ingested_at", interval, as_of)
    return recent.groupBy("zone", bin_start(F.col("_ingested_at"), width).alias("bin")).agg(
        stable_round(F.avg(temp), 1).alias("avg_temp"),
        stable_round(F.max(temp), 1).alias("max_temp"),
        F.count_if(breach(hum=None)).alias("alert_count"),
    )


def temp_trend(df: DataFrame, width: str = "30 seconds") -> DataFrame:
    return df.groupBy(bin_start(F.col("event_time"), width).alias("event_time")).agg(
        stable_round(F.avg("temperature_celsius"), 2).alias("avg_temp")
    )


def vibration_card(df: DataFrame, as_of: Clock, interval: str = "24 hours") -> DataFrame:
    """One text cell with the average and the highest vibration."""
    shown = [stable_round(f("vibration_mms"), 2) for f in (F.avg, F.max)]
    recent = since(df, "_ingested_at", interval, as_of)
    return recent.agg(
        pieces("Avg: ", shown[0], " mm/s  |  Max: ", shown[1], " mm/s").alias("vibration")
    )


def anomalies_by_zone(df: DataFrame, as_of: Clock, interval: str = "24 hours") -> DataFrame:
    """Anomalous readings per zone; a zone with readings but no anomaly shows 0."""
    recent = since(df, "_ingested_at", interval, as_of)
    return recent.groupBy("zone").agg(F.count_if("is_anomaly").alias("anomalies"))


def latest_per_device(df: DataFrame, tie: str = "reading_id") -> DataFrame:
    latest = dedupe_latest(df, "device_id", "event_time", ties=[tie])
    return project_as(latest, STATUS_NAMES)


def critical_alerts(df: DataFrame, k: int = 20, tie: str = "reading_id") -> DataFrame:
    """The ``k`` newest breaches: a top-k, so each task passes on at most ``k`` rows."""
    newest = top(breaches(df), k, F.desc_nulls_last("_ingested_at"), F.desc(tie))
    return project_as(newest, ALERT_NAMES)


def device_temperature(
    df: DataFrame, as_of: Clock, interval: str = "1 hour", width: str = "5 minutes"
) -> DataFrame:
    recent = since(df, "event_time", interval, as_of)
    return recent.groupBy("device_id", bin_start(F.col("event_time"), width).alias("bin")).agg(
        stable_round(F.avg("temperature_celsius"), 2).alias("avg_temp")
    )


def retain(df: DataFrame, clock: str, as_of: Clock, keep: str = "1 day") -> DataFrame:
    """Rows young enough to stay."""
    return since(df, clock, keep, as_of)
