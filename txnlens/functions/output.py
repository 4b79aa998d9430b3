"""Shaping of checked results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PLACES = 6


def rounded(df: DataFrame, places: int = PLACES) -> DataFrame:
    """Doubles rounded, whole numbers as long, dates as text: comparable across engines."""
    cols = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c, places)
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("long")
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType)):
            c = F.unix_timestamp(c)
        cols.append(c.alias(f.name))
    return df.select(*cols)
