"""Reading a log in time windows: slices, freshness, lookback, resuming."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.instants import bound, instant
from ..options import CaptureOptions


@dataclass(frozen=True)
class ReadWindow:
    """Half-open [start, end) in milliseconds."""

    start: int
    end: int


def first_window(o: CaptureOptions, now_ms: int) -> ReadWindow:
    """Without a saved offset and with a lookback: from now - lookback, one window long, never past now."""
    start = now_ms - o.lookback
    return ReadWindow(start, min(start + o.query_window, now_ms))


def next_window(o: CaptureOptions, window: ReadWindow, now_ms: int) -> ReadWindow | None:
    """The following window; None while it would reach past now - confidence."""
    end = window.end + o.query_window
    return ReadWindow(window.end, end) if end <= now_ms - o.confidence_window else None


def read(log: DataFrame, window: ReadWindow, ts: str = "change_ts") -> DataFrame:
    """The window's records, by comparisons with literals that Parquet readers can prune by."""
    return log.where((F.col(ts) >= bound(log, ts, window.start)) & (F.col(ts) < bound(log, ts, window.end)))


def confident(log: DataFrame, o: CaptureOptions, now_ms: int, ts: str = "change_ts") -> DataFrame:
    return log.where(F.col(ts) < bound(log, ts, now_ms - o.confidence_window))


def slices(log: DataFrame, o: CaptureOptions, ts: str = "change_ts") -> DataFrame:
    """window_start_ms of each record's read window."""
    ms = F.unix_millis(instant(log, ts))
    return log.withColumn("window_start_ms", ms - F.pmod(ms, F.lit(o.query_window)))


def resume(log: DataFrame, offsets: DataFrame, task: tuple[str, ...], position: tuple[str, ...]) -> DataFrame:
    """Records after each task's saved position; tasks without one are read from the start.

    offsets: task columns and `last`, a struct of the position columns.
    """
    saved = offsets.select(*[F.col(c).alias(f"_t{i}") for i, c in enumerate(task)], F.col("last").alias("_last"))
    on = [F.col(c).eqNullSafe(F.col(f"_t{i}")) for i, c in enumerate(task)]
    joined = log.join(saved, on, "left")
    return joined.where(F.col("_last").isNull() | (F.struct(*position) > F.col("_last"))).select(*log.columns)
