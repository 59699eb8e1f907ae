"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATOR = "-"
MISSING = "_null_"


def surrogate_key(*cols: Column) -> Column:
    """MD5 over the natural key; a NULL part hashes as a sentinel so keys stay distinct."""
    return F.md5(
        F.concat_ws(SEPARATOR, *[F.coalesce(c.cast("string"), F.lit(MISSING)) for c in cols])
    )
