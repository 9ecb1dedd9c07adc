"""Correlation in a stream: keyed state, event-time eviction, incomplete changes as an output of their own.

Row keys are dealt by hash to BUCKETS groups. Records go to their group in Arrow messages of many rows, so any type comes
back as it went in and no record is handled by itself but by its operation; a group's state are the slots of its keys that
are open, as one such message. Records that come in one batch are put in order before they are fed. A change that is
overwritten by another one of its row, or older than the timeout by the records' own times or by the watermark, comes out
as incomplete, with a reason, instead of vanishing: complete and incomplete changes together are all changes, however the
log is cut into batches. The watermark stays back as far as the confidence window reaches; records that come later still
are fed like others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema, to_arrow_type
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.instants import instant
from ..model import OPERATION, TableSpec
from ..operators.correlate import CHANGE, POST, PRE, Slots, record, unpacked
from ..operators.filters import relevant
from ..options import CaptureOptions
from ..ship import ship

BUCKETS = 1024
#: Records that are dealt to the groups at once, and results in a message.
DEALT, TOLD = 50_000, 100_000
STATE = "open binary"
OPEN = "still open"
OUTPUT = "m binary"
_KEY = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "ignoreNullFields": "false"}
_SLOTS = (PRE, CHANGE, POST)


def _scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose first column is a group to one message for each group, of the other columns."""
    held, size = [], 0

    def dealt() -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        group = rows.column(0).to_numpy(zero_copy_only=False)
        order = np.argsort(group, kind="stable")
        rows, group = rows.take(pa.array(order)), group[order]
        body = pa.RecordBatch.from_arrays(rows.columns[1:], names=rows.schema.names[1:])
        at = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        packed = [body.slice(a, n).serialize().to_pybytes() for a, n in zip(at.tolist(), np.diff(np.append(at, len(group))).tolist())]
        return pa.record_batch([pa.array(group[at]), pa.array(packed, pa.binary())], names=["bucket_", "m"])

    for b in batches:
        if b.num_rows:
            held.append(b)
            size += b.num_rows
        if size >= DEALT:
            yield dealt()
            held, size = [], 0
    if held:
        yield dealt()


def _unpack(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for m in b.column(0):
                yield pa.ipc.read_record_batch(m.as_buffer(), schema)

    return run


def _state_schema(kind: pa.DataType) -> pa.Schema:
    return pa.schema([("key_", pa.string()), *[(s, kind) for s in _SLOTS], ("op", pa.int32()), ("since", pa.int64())])


def _unpack_open(kind: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _unpack(_state_schema(kind))(batches):
            yield pa.RecordBatch.from_arrays([*b.columns[1:4], pa.array([OPEN] * b.num_rows, pa.string())], names=[*_SLOTS, "reason"])

    return run


class _Correlator(StatefulProcessor):
    """The open slots of a group's keys; records are known by their place in an Arrow array."""

    def __init__(self, o: CaptureOptions, rows: pa.Schema, order: list[str]):
        self.o, self.rows, self.order = o, rows, order
        self.kind = rows.field("r_").type

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("slots", STATE)

    def _load(self) -> tuple[pa.Array, dict[str, Slots]]:
        if not self.state.exists():
            return pa.array([], self.kind), {}
        b = pa.ipc.read_record_batch(pa.py_buffer(bytes(self.state.get()[0])), _state_schema(self.kind))
        held: dict[str, Slots] = {}
        there = [b.column(s).is_valid().to_pylist() for s in _SLOTS]
        for i, (key, op, since) in enumerate(zip(*(b.column(c).to_pylist() for c in ("key_", "op", "since")))):
            s = held[key] = Slots(self.o)
            s.pre, s.change, s.post = (k * b.num_rows + i if there[k][i] else None for k in range(3))
            s.op, s.since = op, since
        return pa.concat_arrays([b.column(s) for s in _SLOTS]), held

    def _save(self, body: pa.Array, held: dict[str, Slots]) -> None:
        """Keeps the slots that are open, and has itself called when the first of them has waited too long."""
        some = [(k, s) for k, s in held.items() if not s.empty]
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        if not some:
            self.state.clear()
            return
        places = zip(*[(s.pre, s.change, s.post) for _, s in some])
        b = pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in some], pa.string()), *[body.take(pa.array(x, pa.int64())) for x in places],
             pa.array([s.op for _, s in some], pa.int32()), pa.array([s.since for _, s in some], pa.int64())], schema=_state_schema(self.kind))
        self.state.update((b.serialize().to_pybytes(),))
        self.handle.registerTimer(min(s.since for _, s in some) + self.o.incomplete_timeout)

    def _told(self, body: pa.Array, out: list[tuple]) -> pd.DataFrame:
        packed = []
        for i in range(0, len(out), TOLD):
            *places, reason = zip(*out[i : i + TOLD])
            columns = [*[body.take(pa.array(x, pa.int64())) for x in places], pa.array(reason, pa.string())]
            packed.append(pa.RecordBatch.from_arrays(columns, names=[*_SLOTS, "reason"]).serialize().to_pybytes())
        return pd.DataFrame({"m": pd.Series(packed, dtype=object)})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        body, held = self._load()
        every = pa.Table.from_batches([pa.ipc.read_record_batch(pa.py_buffer(m), self.rows) for r in rows for m in r["m"]])
        every = every.take(pc.sort_indices(every, sort_keys=[(c, "ascending") for c in self.order])).combine_chunks()
        first, body = len(body), pa.concat_arrays([body, *every.column("r_").chunks])
        keys = every.column("key_").combine_chunks().dictionary_encode()
        slots = [held.setdefault(k, Slots(self.o)) for k in keys.dictionary.to_pylist()]
        out: list[tuple] = []
        for i, (k, op, ms) in enumerate(zip(keys.indices.to_pylist(), every.column("op_").to_pylist(), every.column("ms_").to_pylist()), first):
            s = slots[k]
            if (hit := s.feed(op, i, ms)) is not None:
                out.append((*hit, None))
            if s.lost:
                out += s.lost
                s.lost = []
        self._save(body, held)
        yield self._told(body, out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        body, held = self._load()
        out: list[tuple] = []
        for s in held.values():
            if s.since + self.o.incomplete_timeout <= max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs()):
                s.give_up()
                out += s.lost
        self._save(body, held)
        yield self._told(body, out)

    def close(self) -> None:
        pass


def correlate_stream(log: DataFrame, spec: TableSpec, o: CaptureOptions, change_id: tuple[str, ...], order: tuple[str, ...], ts: str = "change_ts") -> DataFrame:
    """A streaming log -> pre, chg, post, change id and reason (null for complete changes).

    Needs the RocksDB state store. The columns of `order` must be of types that Arrow sorts: timestamps, numbers, text, bytes; nulls come last.
    """
    ship(log.sparkSession)
    ordering = {f"o{i}_": instant(log, c) if isinstance(log.schema[c].dataType, T.TimestampNTZType) else F.col(c) for i, c in enumerate(order)}
    rows = relevant(log, spec, o.needs_pre, o.needs_post).select(
        F.to_json(F.struct(*spec.key), _KEY).alias("key_"), F.col(OPERATION).cast("int").alias("op_"), *[c.alias(n) for n, c in ordering.items()],
        F.unix_millis(F.col(ts)).alias("ms_"), record(log, spec, change_id).alias("r_"), F.col(ts).alias("ts_"))
    rows = rows.withWatermark("ts_", f"{o.confidence_window} milliseconds").drop("ts_")
    group = F.pmod(F.xxhash64("key_"), F.lit(BUCKETS)).cast("int").alias("bucket_")
    packed = rows.select(group, "*").mapInArrow(_scatter, "bucket_ int, m binary")
    held = packed.groupBy("bucket_").transformWithStateInPandas(
        statefulProcessor=_Correlator(o, to_arrow_schema(rows.schema), list(ordering)), outputStructType=OUTPUT, outputMode="Append", timeMode="EventTime")
    kind, out = _kinds(log, spec, change_id)
    return unpacked(held.mapInArrow(_unpack(to_arrow_schema(out)), out), spec, change_id)


def _kinds(log: DataFrame, spec: TableSpec, change_id: tuple[str, ...]) -> tuple[pa.DataType, T.StructType]:
    """The type of a record, and the columns of three records and a reason."""
    kind = log.select(record(log, spec, change_id).alias("b")).schema["b"].dataType
    return to_arrow_type(kind), T.StructType([T.StructField(s, kind) for s in _SLOTS] + [T.StructField("reason", T.StringType())])


def open_slots(log: DataFrame, spec: TableSpec, change_id: tuple[str, ...], checkpoint: str) -> DataFrame:
    """What a stream that is not running holds in its state, as correlate_stream gives it; the reason is OPEN."""
    spark = ship(log.sparkSession)
    kind, out = _kinds(log, spec, change_id)
    state = spark.read.format("statestore").option("stateVarName", "slots").load(checkpoint)
    return unpacked(state.select("value.open").mapInArrow(_unpack_open(kind), out), spec, change_id)
