"""Transforms of event tables for consumers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..options import Format


def is_cell(kind: T.DataType) -> bool:
    return isinstance(kind, T.StructType) and kind.names == ["value"]


def _unwrapped(image: Column, kind: T.StructType) -> Column:
    fields = [(image[f.name]["value"] if is_cell(f.dataType) else image[f.name]).alias(f.name) for f in kind.fields]
    return F.when(image.isNotNull(), F.struct(*fields))


def new_record_state(events: DataFrame, fmt: Format | str = Format.LEGACY, drop_deletes: bool = False) -> DataFrame:
    """The row after each change instead of `before` and `after`, cells unwrapped; a delete has nulls, or goes."""
    fmt = Format.parse(fmt) if isinstance(fmt, str) and not isinstance(fmt, Format) else fmt
    kind = events.schema["after"].dataType
    after = F.col("after") if fmt is Format.ADVANCED else _unwrapped(F.col("after"), kind)
    others = [c for c in events.columns if c not in ("before", "after")]
    rows = events.where(F.col("op") != "d") if drop_deletes else events
    out = rows.select(*others, after.alias("_after"))
    return out.select(*[c for c in others if c not in kind.names], *[F.col(f"_after.{n}").alias(n) for n in kind.names])


def flatten_columns(events: DataFrame) -> DataFrame:
    """Inside before and after, every struct with the one field `value` becomes that value; the envelope stays."""
    out = {}
    for side in ("before", "after"):
        kind = events.schema[side].dataType if side in events.columns else None
        if isinstance(kind, T.StructType):
            out[side] = _unwrapped(F.col(side), kind)
    return events.withColumns(out) if out else events


def latest_state(events: DataFrame, key: tuple[str, ...], order: tuple[str, ...]) -> DataFrame:
    """Consumer: the last event of each key; rows whose last event is a delete are gone."""
    last = events.groupBy(*key).agg(F.max_by(F.struct("op", "after"), F.struct(*order)).alias("_e"))
    return last.where(F.col("_e.op") != "d").select(*key, F.col("_e.after").alias("after"))


def make_optional(df: DataFrame) -> DataFrame:
    """The same rows with every scalar column nullable; complex ones keep what they declare."""
    complex_ = (T.ArrayType, T.MapType, T.StructType)
    return df.select(*[F.col(f.name) if isinstance(f.dataType, complex_) else F.nullif(F.col(f.name), F.lit(None)).alias(f.name) for f in df.schema.fields])
