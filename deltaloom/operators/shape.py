"""Events from correlated slots: operation, before, after, key, headers, source, topic, tombstones.

Input: a DataFrame with the row key, the structs `pre`, `chg` and `post`, and the change id. Everything is a column
expression; what the options leave out is not in the plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.wire import as_text
from ..model import Op, TableSpec
from ..options import CaptureOptions, Image, Place
from .filters import modified

#: Event codes of the operations (fixed values).
CODES = {Op.ROW_INSERT: "c", Op.ROW_UPDATE: "u", Op.ROW_DELETE: "d", Op.PARTITION_DELETE: "d"}
VERSION, CONNECTOR = "1.0", "deltaloom"


def op_code(op: Column) -> Column:
    out = F
    for kind, code in CODES.items():
        out = out.when(op == int(kind), F.lit(code))
    return out.otherwise(F.raise_error(F.concat(F.lit("not a change: operation "), op.cast("string"))))


class Shaper:
    """Column expressions for one table and one set of options."""

    def __init__(self, df: DataFrame, spec: TableSpec, o: CaptureOptions):
        self.df, self.spec, self.o = df, spec, o
        self.available = [f.name for f in df.schema["chg"].dataType.fields]
        self.op = F.col("chg._op")

    def _mod(self, c: str) -> Column:
        return modified(c, self.available, "chg.")

    def _keys(self, image: str, place: Place) -> list[Column]:
        return [F.col(f"{image}.{c}").alias(c) for c in self.spec.key] if place in self.o.places else []

    def full(self, image: str, place: Place) -> Column:
        return F.when(F.col(image).isNotNull(), F.struct(*self._keys(image, place), *[F.col(f"{image}.{c}").alias(c) for c in self.spec.columns]))

    def updated(self, image: str, place: Place) -> Column:
        """Only what the change touched; other columns stay, as null."""
        cells = [F.when(self._mod(c), F.col(f"{image}.{c}")).alias(c) for c in self.spec.columns]
        return F.when(F.col(image).isNotNull(), F.struct(*self._keys(image, place), *cells))

    def merged(self) -> Column:
        """Before an update: touched columns as they were, others as they are now."""
        place = Place.PAYLOAD_BEFORE
        cells = [F.when(self._mod(c), F.col(f"pre.{c}")).otherwise(F.col(f"post.{c}")).alias(c) for c in self.spec.columns]
        both = F.struct(*self._keys("post", place), *cells)
        return F.when(F.col("pre").isNotNull(), F.when(F.col("post").isNotNull(), both).otherwise(self.full("pre", place)))

    def before(self) -> Column:
        full = self.full("pre", Place.PAYLOAD_BEFORE)
        none = F.when(F.lit(False), full)
        if self.o.before is Image.NONE:
            return none
        if self.o.before is Image.ONLY_UPDATED:
            update = self.updated("pre", Place.PAYLOAD_BEFORE)
        else:
            update = full if self.o.after is Image.NONE else self.merged()
        return F.when(self.op == int(Op.ROW_UPDATE), update).otherwise(full)

    def after(self) -> Column:
        full = self.full("post", Place.PAYLOAD_AFTER)
        none = F.when(F.lit(False), full)
        if self.o.after is Image.NONE:
            return none
        update = self.updated("post", Place.PAYLOAD_AFTER) if self.o.after is Image.ONLY_UPDATED else full
        return F.when(self.op == int(Op.ROW_UPDATE), update).when(self.op == int(Op.ROW_INSERT), full).otherwise(none)

    def key_struct(self) -> Column:
        return F.struct(*[F.coalesce(F.col(f"post.{c}"), F.col(f"pre.{c}"), F.col(f"chg.{c}")).alias(c) for c in self.spec.key])

    def key(self) -> Column:
        made = self.key_struct()
        return made if Place.KAFKA_KEY in self.o.places else F.when(F.lit(False), made)

    def headers(self) -> Column:
        """`pk.<column>` and `ck.<column>` with text values; nulls are left out."""
        types = {f.name: f.dataType for f in self.df.schema["chg"].dataType.fields}
        cells = []
        for kind, names in (("pk", self.spec.pk), ("ck", self.spec.ck)):
            for c in names:
                value = as_text(F.coalesce(F.col(f"post.{c}"), F.col(f"pre.{c}"), F.col(f"chg.{c}")), types[c])
                cells.append(F.struct(F.lit(f"{kind}.{c}").alias("key"), value.cast("binary").alias("value")))
        made = F.filter(F.array(*cells), lambda h: h["value"].isNotNull())
        return made if Place.KAFKA_HEADERS in self.o.places else F.when(F.lit(False), made)

    def source(self, time_us: Column) -> Column:
        return F.struct(
            F.lit(VERSION).alias("version"), F.lit(CONNECTOR).alias("connector"), F.lit(self.o.logical_name).alias("name"),
            F.floor(time_us / 1000).cast("long").alias("ts_ms"), F.lit("false").alias("snapshot"), F.lit(self.spec.keyspace).alias("db"),
            F.lit(self.spec.keyspace).alias("keyspace_name"), F.lit(self.spec.name).alias("table_name"), time_us.alias("ts_us"))


def images(df: DataFrame, spec: TableSpec, o: CaptureOptions, keep: tuple[str, ...] = ()) -> DataFrame:
    """op, before and after beside the columns in `keep`; the shortest way to an event."""
    s = Shaper(df, spec, o)
    return df.select(*keep, op_code(s.op).alias("op"), s.before().alias("before"), s.after().alias("after"))


def topic(spec: TableSpec, o: CaptureOptions) -> Column:
    return F.lit(".".join(x for x in (o.logical_name.strip(), spec.keyspace, spec.name) if x))


def envelope(df: DataFrame, spec: TableSpec, o: CaptureOptions, time_us: Column, now_ms: Column | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """topic, key, headers and value of each event."""
    s = Shaper(df, spec, o)
    payload_key = [s.key_struct().alias(o.payload_key_name)] if Place.PAYLOAD_KEY in o.places else []
    value = F.struct(
        s.source(time_us).alias("source"), s.before().alias("before"), s.after().alias("after"), *payload_key, op_code(s.op).alias("op"),
        (now_ms if now_ms is not None else F.unix_millis(F.current_timestamp())).alias("ts_ms"),
        F.lit(None).cast("struct<id:string,total_order:bigint,data_collection_order:bigint>").alias("transaction"),
        F.lit(None).cast("long").alias("ts_us"), F.lit(None).cast("long").alias("ts_ns"))
    return df.select(*keep, topic(spec, o).alias("topic"), s.key().alias("key"), s.headers().alias("headers"), value.alias("value"))


def with_tombstones(events: DataFrame, value: str = "value") -> DataFrame:
    """After each delete one more record with the same key and a null value; `part` tells their order."""
    v = F.col(value)
    both = F.when(v["op"] == "d", F.array(v, F.when(F.lit(False), v))).otherwise(F.array(v))
    others = [c for c in events.columns if c != value]
    return events.select(*others, F.posexplode(both).alias("part", value))


# the older format: cells, and images taken as they come

def cell(c: str, image: str, available: list[str]) -> Column:
    """{value}: the value, or null where the change deleted it; no cell where it is untouched.

    The deletion mark is that of the change, also while filling from the before image.
    """
    out = F.col(f"{image}.{c}")
    on = out.isNotNull()
    if f"cdc_deleted_{c}" in available:
        on = on | F.coalesce(F.col(f"chg.cdc_deleted_{c}"), F.lit(False))
    return F.when(on, F.struct(out.alias("value")))


def legacy_columns(df: DataFrame, spec: TableSpec) -> list[str]:
    """The older format drops collections and user types."""
    kinds = {f.name: f.dataType for f in df.schema["chg"].dataType.fields}
    return [c for c in spec.columns if not isinstance(kinds[c], (T.ArrayType, T.MapType, T.StructType))]


def legacy(df: DataFrame, spec: TableSpec, keep: tuple[str, ...] = ()) -> DataFrame:
    """op, key, before and after in the older format; input as of `with_last_preimage`."""
    available = [f.name for f in df.schema["chg"].dataType.fields]
    columns = legacy_columns(df, spec)

    def row(image: str) -> Column:
        return F.struct(*[F.col(f"{image}.{c}").alias(c) for c in spec.key], *[cell(c, image, available).alias(c) for c in columns])

    deleted = F.col("chg._op").isin(int(Op.ROW_DELETE), int(Op.PARTITION_DELETE))
    has_pre = F.col("pre").isNotNull()
    before = F.when(has_pre, row("pre")).when(deleted, row("chg"))
    key = F.struct(*[F.when(deleted & has_pre, F.col(f"pre.{c}")).otherwise(F.col(f"chg.{c}")).alias(c) for c in spec.key])
    return df.select(*keep, op_code(F.col("chg._op")).alias("op"), key.alias("key"), before.alias("before"), F.when(~deleted, row("chg")).alias("after"))
