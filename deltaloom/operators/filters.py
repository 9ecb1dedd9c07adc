"""Which log records matter, and how far the log has been read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..model import OPERATION, Op, TableSpec


def changes(log: DataFrame, spec: TableSpec) -> DataFrame:
    return log.where(F.col(OPERATION).isin([int(x) for x in spec.change_operations()]))


def relevant(log: DataFrame, spec: TableSpec, pre: bool, post: bool) -> DataFrame:
    """Changes, and the images that the options ask for; a literal list, so it is pushed to the scan."""
    wanted = [*spec.change_operations(), *([Op.PRE_IMAGE] if pre else []), *([Op.POST_IMAGE] if post else [])]
    return log.where(F.col(OPERATION).isin([int(x) for x in wanted]))


def modified(c: str, available: Sequence[str], prefix: str = "") -> Column:
    """A change touches a column if it has a value for it, sets it to null, or removes elements of it."""
    out = F.col(f"{prefix}{c}").isNotNull()
    if f"cdc_deleted_{c}" in available:
        out = out | F.coalesce(F.col(f"{prefix}cdc_deleted_{c}"), F.lit(False))
    if f"cdc_deleted_elements_{c}" in available:
        out = out | F.col(f"{prefix}cdc_deleted_elements_{c}").isNotNull()
    return out


def tables(log: DataFrame, names: set[tuple[str, str]] | frozenset[tuple[str, str]], keyspace: str = "ks", table: str = "tbl") -> DataFrame:
    return log.where(F.concat_ws(".", keyspace, table).isin(sorted(".".join(x) for x in names)))


def progress(log: DataFrame, task: Sequence[str], order: Sequence[str], change_id: Sequence[str]) -> DataFrame:
    """Per task the last record's id, over all records, also those that make no event."""
    last = F.max_by(F.struct(*change_id), F.struct(*order))
    return log.groupBy(*task).agg(last.alias("last"), F.count("*").alias("records"))


def drained(offsets: DataFrame, until_ms: int, window_start_ms: str = "window_start_ms") -> DataFrame:
    """One row, drained: whether every task has passed `until_ms`; a task without offset has not."""
    return offsets.agg(F.coalesce(F.bool_and(F.coalesce(F.col(window_start_ms) > until_ms, F.lit(False))), F.lit(True)).alias("drained"))


def merge_tasks(first: DataFrame, *others: DataFrame, key: Sequence[str]) -> DataFrame:
    """Union of task maps; of several entries for a task that of the first map stays."""
    frames = [f.withColumn("_rank", F.lit(i)) for i, f in enumerate((first, *others))]
    every = frames[0]
    for f in frames[1:]:
        every = every.unionByName(f)
    values = [c for c in first.columns if c not in key]
    best = every.groupBy(*key).agg(F.min_by(F.struct(*values), "_rank").alias("_v"))
    return best.select(*key, *[F.col(f"_v.{c}").alias(c) for c in values])


def heartbeats(offsets: DataFrame, task: Sequence[str], now_ms: int, interval_ms: int, last_beat_ms: str = "last_beat_ms") -> DataFrame:
    """A record per task whose last beat is an interval ago or more, or that has none."""
    due = F.col(last_beat_ms).isNull() | (F.lit(now_ms) - F.col(last_beat_ms) >= interval_ms)
    return offsets.where(due).select(*task, F.lit(now_ms).cast("long").alias("ts_ms"))


def current_generation(log: DataFrame, offsets: DataFrame, generation: str = "generation_start", window_start_ms: str = "window_start_ms") -> DataFrame:
    """Records of the generations that may be read: one opens when every task of all older ones has passed its start.

    offsets: generation and window_start_ms of each task. Generations are few, so their table is a bounded side.
    """
    starts = offsets.groupBy(F.col(generation).alias("_g")).agg(F.min(F.coalesce(window_start_ms, F.lit(-1))).alias("_least"))
    pairs = starts.alias("a").join(starts.alias("b"), F.col("b._g") < F.col("a._g"), "left")
    is_open = pairs.groupBy(F.col("a._g").alias("_g")).agg(F.bool_and(F.coalesce(F.col("b._least") > F.col("a._g"), F.lit(True))).alias("_open"))
    return log.join(is_open.where("_open").select("_g"), F.col(generation) == F.col("_g"), "left_semi")
