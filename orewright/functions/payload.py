"""JSON payloads."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def decoded(col: Column, schema: T.StructType) -> Column:
    """Struct from JSON text; text that does not parse is kept in ``_corrupt_record``."""
    wide = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return F.from_json(col, wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
