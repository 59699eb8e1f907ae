"""Stored tables: scans, writes, references and counts."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orewright.functions.dates import batch_id, instant
from orewright.operators.integrate import DATA_SOURCES, source_counts


def table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def write_bucketed(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """Overwrite a managed table in buckets of a key, sorted by it.

    Tables in as many buckets of the same key join and aggregate on it without an exchange. Rows are dealt out
    by the buckets' own hash first, so a bucket is one file. Meant for keys like an order's: a bucket
    is read by one task, which adaptive execution cannot split.
    """
    placed = df.repartition(buckets, key)
    placed.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    return df.sparkSession.table(name)


def write_path(
    df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()
) -> DataFrame:
    """Write a Parquet table at a path, in the partitions the plan already has."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.option("mergeSchema", mode == "append").parquet(path)


def write_table(
    df: DataFrame, name: str, mode: str = "overwrite", merge_schema: bool = False,
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """Overwrite or append a managed table, in folders by the partition columns if there are any.

    An append keeps the table's own partition columns.

    An append with new columns adds them to the table, whose old files stay as they are and
    read as NULL there; columns that the rows lack are NULL in the new files.
    """
    spark = df.sparkSession
    if version := _pointed_at(spark, name):  # a rebuilt table: its newest version takes the rows, or a new one does
        if mode == "overwrite":
            return replace_table(spark, name, df)
        write_table(df, version, mode, merge_schema)
        _point(spark, name, version)
        return spark.table(name)
    if mode == "append" and spark.catalog.tableExists(name):
        held = spark.table(name)
        if set(df.columns) != set(held.columns):
            if not merge_schema:
                raise ValueError(f"columns of {name} differ; pass merge_schema=True")
            new = [f for f in df.schema.fields if f.name not in held.columns]
            if new:
                added = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
                spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({added})")
            held = spark.table(name)
            df = held.limit(0).unionByName(df, allowMissingColumns=True)
        df, partition_by = df.select(*held.columns), _partition_columns(spark, name)
    writer = df.write.mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(name)
    return spark.table(name)


def _partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


VERSION = "__version_"


def replace_table(spark: SparkSession, name: str, df: DataFrame) -> DataFrame:
    """Rebuild a derived table; running it again gives the same table.

    Each rebuild is written as a table of its own, a version, as the old one may be among its sources. The name
    is a view of the newest version and is moved by one statement, so a reader finds the old rows or the new ones and never
    nothing. The version before stays for readers that began with it. A run that broke off at any step
    left the name as it was, or moved; the next run removes what it wrote in vain.
    """
    version = f"{name}{VERSION}{uuid.uuid4().hex}"
    before = _pointed_at(spark, name)
    _write_version(df, version)
    _point(spark, name, version)
    _drop_versions(spark, name, keep={version, before})
    return spark.table(name)


def _write_version(df: DataFrame, version: str) -> None:
    df.write.saveAsTable(version)


def _point(spark: SparkSession, name: str, version: str) -> None:
    """One statement in the catalog. Only a name that is a plain table from elsewhere is renamed to a version first."""
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        spark.sql(f"ALTER TABLE {name} RENAME TO {name}{VERSION}{uuid.uuid4().hex}")
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {version}")


def _versions(spark: SparkSession, name: str) -> list[str]:
    database, _, table_name = name.rpartition(".")
    held = spark.catalog.listTables(database or None, f"{table_name}{VERSION}*")
    return [f"{database}.{t.name}" if database else t.name for t in held if not t.isTemporary]


def _pointed_at(spark: SparkSession, name: str) -> str | None:
    """The version that the name shows now."""
    if not spark.catalog.tableExists(name) or spark.catalog.getTable(name).tableType != "VIEW":
        return None
    shown = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'View Text'").first()
    return shown["data_type"].rpartition(" FROM ")[2].strip() if shown else None


def _drop_versions(spark: SparkSession, name: str, keep: set) -> None:
    for version in _versions(spark, name):
        if version not in keep:
            spark.sql(f"DROP TABLE IF EXISTS {version}")


def register_refs(spark: SparkSession, paths: Mapping[str, str]) -> dict[str, DataFrame]:
    """Name tables that live elsewhere; nothing is copied."""
    refs = {}
    for name, path in paths.items():
        refs[name] = spark.read.parquet(path)
        refs[name].createOrReplaceTempView(name)
    return refs


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    return source_counts(tables).withColumnRenamed("source", "table_name")


def source_map(spark: SparkSession) -> DataFrame:
    """The inline table of data sources."""
    rows = [r[:3] for r in DATA_SOURCES]
    return spark.createDataFrame(rows, "data_source string, integration_type string, unified_table string")


def add_meta(df: DataFrame, source: str, run_date: str, now) -> DataFrame:
    """Stamp rows with when, from where and in which batch they came; ``now`` is handed in."""
    clock = instant(now)
    return df.withColumns(
        {
            "_ingested_at": clock,
            "_source_file": F.lit(source),
            "_batch_id": batch_id(clock),
            "_run_date": F.lit(run_date),
        }
    )
