"""Encodings and writers of events."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.wire import schema_name

JSON = {"ignoreNullFields": "false"}
#: Names of scalar types in a JSON schema (fixed values).
SCHEMA_TYPES = {T.ByteType: "int8", T.ShortType: "int16", T.IntegerType: "int32", T.LongType: "int64", T.FloatType: "float", T.DoubleType: "double",
                T.BooleanType: "boolean", T.BinaryType: "bytes"}


def json_schema(kind: T.DataType, prefix: str = "", optional: bool = True) -> dict:
    """The schema of a value, as JSON converters send it along; nested structs are named, with a prefix."""
    if isinstance(kind, T.StructType):
        fields = [{"field": f.name, **json_schema(f.dataType, prefix, f.nullable)} for f in kind.fields]
        return {"type": "struct", "fields": fields, "optional": optional, "name": prefix + schema_name(kind)}
    if isinstance(kind, T.ArrayType):
        return {"type": "array", "items": json_schema(kind.elementType, prefix, kind.containsNull), "optional": optional}
    if isinstance(kind, T.MapType):
        return {"type": "map", "keys": json_schema(kind.keyType, prefix, False), "values": json_schema(kind.valueType, prefix, kind.valueContainsNull), "optional": optional}
    return {"type": SCHEMA_TYPES.get(type(kind), "string"), "optional": optional}


def as_json(events: DataFrame, schemas: bool = False, prefix: str = "") -> DataFrame:
    """key and value as JSON text; a null stays null, a tombstone's value too. schemas: each with its schema beside it."""
    out = {}
    for c in ("key", "value"):
        if c in events.columns:
            text = F.to_json(c, JSON)
            if schemas:
                head = json.dumps(json_schema(events.schema[c].dataType, prefix), separators=(",", ":"))
                text = F.concat(F.lit(f'{{"schema":{head},"payload":'), text, F.lit("}"))
            out[c] = text
    return events.withColumns(out)


def write_parquet(events: DataFrame, path: str) -> None:
    events.write.partitionBy("topic").mode("append").parquet(path)


def to_kafka(events: DataFrame, servers: str):
    """A writer for the Kafka sink; needs Spark's Kafka package on the class path."""
    return as_json(events).write.format("kafka").option("kafka.bootstrap.servers", servers).option("includeHeaders", "true")


def upsert(key: tuple[str, ...], read: Callable[[], DataFrame | None], write: Callable[[DataFrame], None], order: tuple[str, ...]) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that keeps the last event of every key; a batch that comes again changes nothing."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        old = read()
        every = batch if old is None else old.unionByName(batch, allowMissingColumns=True)
        values = [c for c in every.columns if c not in key]
        last = every.groupBy(*key).agg(F.max_by(F.struct(*values), F.struct(*order)).alias("_v"))
        write(last.select(*key, *[F.col(f"_v.{c}").alias(c) for c in values]))

    return apply


class KeyedTable:
    """A table of the last event of every key, in parts by key hash; a batch touches only the parts that its keys are in.

    Folder: data/<batch>/_part=<n> for the parts a batch wrote, and manifests/<batch> with the current batch of every part. A
    manifest that is whole makes a batch take effect at once; a batch that comes again changes nothing. Files of batches that
    no part needs any more stay until `vacuum`. One writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str, key: Sequence[str], order: Sequence[str], parts: int = 64):
        self.spark, self.path, self.key, self.order, self.parts = spark, path.rstrip("/"), tuple(key), tuple(order), parts

    def _names(self, folder: str) -> list[str]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{folder}")
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []

    def _done(self) -> list[str]:
        return [n for n in self._names("manifests") if "_SUCCESS" in self._names(f"manifests/{n}")]

    def _current(self) -> dict[int, str]:
        """Part -> the batch whose files it has; at most `parts` rows."""
        done = self._done()
        return {r.part: r.batch for r in self.spark.read.schema("part int, batch string").json(f"{self.path}/manifests/{done[-1]}").collect()} if done else {}

    def _read(self, current: dict[int, str]) -> DataFrame | None:
        paths = [f"{self.path}/data/{batch}/_part={part}" for part, batch in sorted(current.items())]
        return self.spark.read.parquet(*paths) if paths else None

    def read(self) -> DataFrame | None:
        """All keys' last events; None before the first batch."""
        return self._read(self._current())

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        """For foreachBatch."""
        name = f"{batch_id:020d}"
        if name in self._done():
            return
        part = F.pmod(F.xxhash64(*self.key), F.lit(self.parts)).cast("int")
        batch = batch.withColumn("_part", part)
        touched = {r._part for r in batch.select("_part").distinct().collect()}  # at most `parts`
        current = self._current()
        old = self._read({p: b for p, b in current.items() if p in touched})
        every = batch if old is None else old.withColumn("_part", part).unionByName(batch, allowMissingColumns=True)
        values = [c for c in every.columns if c not in (*self.key, "_part")]
        last = every.groupBy("_part", *self.key).agg(F.max_by(F.struct(*values), F.struct(*self.order)).alias("_v"))
        last = last.select("_part", *self.key, *[F.col(f"_v.{c}").alias(c) for c in values])
        last.write.mode("overwrite").partitionBy("_part").parquet(f"{self.path}/data/{name}")
        now = current | {p: name for p in touched}
        self.spark.createDataFrame(sorted(now.items()), "part int, batch string").coalesce(1).write.mode("overwrite").json(f"{self.path}/manifests/{name}")

    def vacuum(self) -> list[str]:
        """Delete what no part needs: data of older batches, and all manifests but the last. The batches that went."""
        needed, done, gone = set(self._current().values()), self._done(), []
        for folder, keep in (("data", needed), ("manifests", set(done[-1:]))):
            for n in self._names(folder):
                if n not in keep:
                    path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{folder}/{n}")
                    path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
                    gone += [n] if folder == "data" else []
        return gone
