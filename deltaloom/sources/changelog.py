"""A streaming source that reads a change log in time windows.

    spark.dataSource.register(ChangeLogSource)
    spark.readStream.format("changelog").schema(log_schema).option("path", folder).load()

Options: path (a folder of Parquet files), time (the timestamp column, default change_ts), window_ms, confidence_ms,
start_ms, minimal_wait_ms (default 0), windows_per_batch (default 120), now_ms (a fixed present, for tests and replays).
The offset is the end of the last window; a batch is never newer than now - confidence, and at most `windows_per_batch`
windows long, so a restart catches up in bounded steps. With a minimal wait a window is read no sooner than that after the
one before it. A batch's partitions are the files whose statistics overlap it.
"""

from __future__ import annotations

import time
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition


#: Timestamps in the older 96-bit form are read as microseconds, like all others.
FORMAT = ds.ParquetFileFormat(read_options=ds.ParquetReadOptions(coerce_int96_timestamp_unit="us"))


class _Slice(InputPartition):
    def __init__(self, path: str, start: int, end: int):
        self.path, self.start, self.end = path, start, end


class ChangeLogReader(DataSourceStreamReader):
    def __init__(self, schema, options):
        self.columns = schema.fieldNames()
        self.instants = [f.name for f in schema.fields if isinstance(f.dataType, T.TimestampType)]
        self.path, self.time = options["path"], options.get("time", "change_ts")
        self.window, self.confidence = int(options.get("window_ms", 30_000)), int(options.get("confidence_ms", 30_000))
        self.start, self.now = int(options.get("start_ms", 0)), options.get("now_ms")
        self.most, self.wait = int(options.get("windows_per_batch", 120)), int(options.get("minimal_wait_ms", 0))
        self.reached, self.moved = self.start, None

    def initialOffset(self) -> dict:
        return {"end": self.start}

    def latestOffset(self) -> dict:
        until = (int(self.now) if self.now else int(time.time() * 1000)) - self.confidence
        windows = min(max(0, until - self.reached) // self.window, self.most)
        if self.wait:
            now = self._clock_ms()
            windows = min(windows, 1 if self.moved is None else int(now - self.moved) // self.wait)
            if windows:
                self.moved = now
        self.reached += windows * self.window
        return {"end": self.reached}

    def _clock_ms(self) -> float:
        return time.monotonic() * 1000

    def _bounds(self, a: int, b: int, kind: pa.DataType):
        return tuple(pa.scalar(x * 1000, pa.timestamp("us")).cast(pa.timestamp("us", kind.tz)) for x in (a, b))

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        if start["end"] >= end["end"]:
            return []
        self.reached = max(self.reached, end["end"])
        data = ds.dataset(self.path, format=FORMAT)
        lo, hi = self._bounds(start["end"], end["end"], data.schema.field(self.time).type)
        on = (pc.field(self.time) >= lo) & (pc.field(self.time) < hi)
        found = [f.path for f in data.get_fragments(on) if f.subset(on).row_groups]
        return [_Slice(p, start["end"], end["end"]) for p in found]

    def read(self, partition: _Slice) -> Iterator[pa.RecordBatch]:
        data = ds.dataset(partition.path, format=FORMAT)
        lo, hi = self._bounds(partition.start, partition.end, data.schema.field(self.time).type)
        on = (pc.field(self.time) >= lo) & (pc.field(self.time) < hi)
        for batch in data.to_batches(columns=self.columns, filter=on):
            kinds = [pa.timestamp("us", "UTC") if n in self.instants else c.type for n, c in zip(batch.schema.names, batch.columns)]
            yield pa.RecordBatch.from_arrays([c.cast(k) for c, k in zip(batch.columns, kinds)], names=batch.schema.names)

    def commit(self, end: dict) -> None:
        pass


class ChangeLogSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "changelog"

    def streamReader(self, schema) -> ChangeLogReader:
        return ChangeLogReader(schema, self.options)
