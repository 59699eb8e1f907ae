"""The audit log."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AUDIT_SCHEMA = (
    "pipeline_name string, pipeline_run_id string, run_date string, layer string, status string, "
    "error_message string, duration_seconds int, logged_at string"
)
REQUIRED = ("pipeline_name", "pipeline_run_id", "run_date", "layer", "status")


def audit_rows(spark: SparkSession, entries: Iterable[Mapping], logged_at: str) -> DataFrame:
    """Audit rows; required fields must be there, empty error and duration become NULL."""
    rows = []
    for e in entries:
        missing = [f for f in REQUIRED if not e.get(f)]
        if missing:
            raise ValueError(f"audit row without {', '.join(missing)}")
        seconds = e.get("duration_seconds")
        rows.append(
            (*[e[f] for f in REQUIRED], e.get("error_message") or None,
             int(seconds) if seconds not in (None, "") else None, logged_at)
        )
    return spark.createDataFrame(rows, AUDIT_SCHEMA)


def audit_log(runs: DataFrame) -> DataFrame:
    """Audit rows from a frame of runs: the same rules, for any number of runs."""
    return runs.select(
        *REQUIRED,
        F.nullif(F.col("error_message"), F.lit("")).alias("error_message"),
        F.col("duration_seconds").try_cast("int").alias("duration_seconds"),
        F.col("logged_at").cast("string").alias("logged_at"),
    )


def append_audit(rows: DataFrame, path: str) -> DataFrame:
    rows.write.mode("append").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
