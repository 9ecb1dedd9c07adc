"""Timestamps without a zone are UTC here, whatever the session's zone is."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def instant(df: DataFrame, name: str) -> Column:
    """The column as a timestamp; one without a zone is read as UTC."""
    c = F.col(name)
    if isinstance(df.schema[name].dataType, T.TimestampNTZType):
        return F.convert_timezone(F.lit("UTC"), F.current_timezone(), c).cast("timestamp")
    return c.cast("timestamp")


def bound(df: DataFrame, name: str, ms: int) -> Column:
    """A literal of the column's own type, so that comparisons reach the scan."""
    if isinstance(df.schema[name].dataType, T.TimestampNTZType):
        text = datetime.fromtimestamp(ms / 1000, timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")
        return F.expr(f"TIMESTAMP_NTZ'{text}'")
    return F.timestamp_millis(F.lit(ms))
