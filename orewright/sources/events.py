"""Sensor events: JSON text to typed readings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orewright.functions.payload import CORRUPT, decoded

# Fields of one sensor event; the event time arrives as text, the flag as text or a truth value.
EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_time", T.StringType()),
        T.StructField("device_id", T.StringType()),
        T.StructField("zone", T.StringType()),
        T.StructField("equipment_type", T.StringType()),
        T.StructField("temperature_celsius", T.DoubleType()),
        T.StructField("pressure_psi", T.DoubleType()),
        T.StructField("vibration_mms", T.DoubleType()),
        T.StructField("humidity_percent", T.DoubleType()),
        T.StructField("is_anomaly", T.StringType()),
    ]
)


def parse_events(df: DataFrame, body: str = "body", schema: T.StructType = EVENT_SCHEMA) -> DataFrame:
    """Typed readings beside the other columns; text that does not parse keeps its row."""
    rest = [c for c in df.columns if c != body]
    event = df.select(*rest, decoded(F.col(body), schema).alias("_e"))
    typed = {"event_time": "timestamp", "is_anomaly": "boolean"}
    fields = [
        F.col(f"_e.{f.name}").try_cast(typed.get(f.name, f.dataType)).alias(f.name) for f in schema.fields
    ]
    return event.select(*rest, *fields, F.col(f"_e.{CORRUPT}").alias(CORRUPT))
