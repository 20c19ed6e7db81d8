"""Typing projection shared by batch reads and streams (never raises on bad text)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import TIMESTAMP_FORMAT


def parse_time(c: Column | str, fmt: str = TIMESTAMP_FORMAT) -> Column:
    """Text -> timestamp; unparsable text gives NULL instead of failing the job.

    A column that already holds timestamps is returned unchanged.
    """
    col = F.col(c) if isinstance(c, str) else c
    return F.try_to_timestamp(col.cast("string"), F.lit(fmt))


def parse_int(c: Column | str) -> Column:
    """Text -> int; bad text gives NULL (ANSI-safe)."""
    col = F.col(c) if isinstance(c, str) else c
    return col.try_cast(T.IntegerType())


def type_touch_columns(
    df: DataFrame, time_col: str = "time", conversion_col: str = "conversion",
    fmt: str = TIMESTAMP_FORMAT,
) -> DataFrame:
    """Replace the time and conversion columns by their typed values.

    Timestamp columns stay as they are; text is parsed with ``fmt``.
    """
    fields = {f.name: f.dataType for f in df.schema.fields}
    replace = {}
    if time_col in fields:
        if isinstance(fields[time_col], (T.TimestampType, T.TimestampNTZType)):
            replace[time_col] = F.col(time_col)
        else:
            replace[time_col] = parse_time(time_col, fmt)
    if conversion_col in fields:
        replace[conversion_col] = parse_int(conversion_col)
    return df.withColumns(replace) if replace else df
