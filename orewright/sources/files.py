"""Delimited files: columns are found by the header's names; with a schema no scan is spent on inference."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def by_header(spark: SparkSession, path: str, columns: Sequence[str], **options) -> DataFrame:
    """The named columns as text, found by the header's names in whatever order the file has them.

    A column that is missing or not expected is an error, before any row is read.
    """
    rows = spark.read.options(header=True, inferSchema=False, **options).csv(path)
    if sorted(rows.columns) != sorted(columns):
        raise ValueError(f"{path} has columns {rows.columns}, not {list(columns)}")
    return rows.select(*[F.col(f"`{c}`") for c in columns])


def read_csv(spark: SparkSession, base: str, name: str, schema: T.StructType | str | None = None) -> DataFrame:
    """``base/name.csv`` with a header. Types are inferred only when no schema is given."""
    path = f"{base}/{name}.csv"
    if schema is None:
        return spark.read.options(header=True, inferSchema=True).csv(path)
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    rows = by_header(spark, path, schema.names)
    return rows.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema.fields])


def read_typed_csv(
    spark: SparkSession, path: str, schema: T.StructType, quoting: bool = False
) -> DataFrame:
    """Fixed columns, read as text and typed after; a value that does not fit becomes NULL.

    Without quoting, a quote character is ordinary text.
    """
    rows = by_header(spark, path, schema.names, **({} if quoting else {"quote": ""}))
    return rows.select(
        *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields]
    )


def land_raw(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """All columns as text, quoted with ``"`` and escaped with a backslash."""
    return by_header(spark, path, columns, quote='"', escape="\\")


def load_seed(
    spark: SparkSession, path: str, columns: Sequence[str], types: dict[str, str] | None = None
) -> DataFrame:
    """Reference data: text columns, with types named for some of them.

    No broadcast hint is given: Spark measures the file and broadcasts it while it is small.
    """
    raw = by_header(spark, path, columns)
    return raw.withColumns({c: F.col(c).try_cast(t) for c, t in (types or {}).items()})


# --- files whose lines may be broken ------------------------------------------------------------------------

BROKEN = "_broken"


@dataclass(frozen=True)
class Landing:
    """The lines of delimited files: ``rows`` as the columns asked for, and ``rejected`` lines as they stand there.

    ``rejected`` has ``file``, ``line`` and ``reason``: ``width`` for too many or too few fields, ``value`` for a field that is
    not of its type. Every line but the headers is in one of the two.
    """

    rows: DataFrame
    rejected: DataFrame


def land(
    spark: SparkSession, path: str, columns: Sequence[str], types: Mapping[str, str] | None = None, delimiter: str = ",", **options
) -> Landing:
    """Read files by their header, with the lines that do not fit it set aside instead of cut, padded or blanked.

    Columns come in the order asked for, those named in ``types`` typed, the others as text. Each of the two
    frames is one pass over the files. A header other than the first file's is an error.
    """
    found = spark.read.options(header=True, inferSchema=False, delimiter=delimiter, **options).csv(path).columns
    if sorted(found) != sorted(columns):
        raise ValueError(f"{path} has columns {found}, not {list(columns)}")
    wide = T.StructType([T.StructField(c, T.StringType()) for c in [*found, BROKEN]])
    # Whole lines are parsed whatever columns a query needs: else a line's width would go unnoticed.
    reader = spark.read.schema(wide).options(
        header=True, enforceSchema=False, columnNameOfCorruptRecord=BROKEN, mode="PERMISSIVE", columnPruning=False,
        delimiter=delimiter, **options,
    )
    lines = reader.csv(path)
    types = dict(types or {})
    odd = F.lit(False)
    for c, t in types.items():
        odd = odd | (F.col(c).isNotNull() & F.col(c).try_cast(t).isNull())
    wrong_width = F.col(BROKEN).isNotNull()
    rows = lines.filter(~wrong_width & ~odd).select(
        *[F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c) for c in columns]
    )
    written = F.array_join(F.array(*[F.coalesce(_as_written(F.col(c), delimiter), F.lit("")) for c in found]), delimiter)
    rejected = lines.filter(wrong_width | odd).select(
        F.col("_metadata.file_path").alias("file"), F.coalesce(BROKEN, written).alias("line"),
        F.when(wrong_width, "width").otherwise("value").alias("reason"),
    )
    return Landing(rows, rejected)


def _as_written(value: Column, delimiter: str) -> Column:
    """A field as a file may hold it: in quotes where it needs them."""
    needs = value.contains(delimiter) | value.contains('"') | value.contains("\n")
    return F.when(needs, F.concat(F.lit('"'), F.replace(value, F.lit('"'), F.lit('\\"')), F.lit('"'))).otherwise(value)
