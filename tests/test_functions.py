import uuid
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deltaloom.functions import tasks, timeuuid, wire
from deltaloom.operators import filters, transforms
from deltaloom.options import CaptureOptions, Format
from deltaloom.sources import retry, validate, windows
from deltaloom.sources.windows import ReadWindow


def test_timeuuid(spark):
    u = "81d4a030-4632-11f0-9484-409dd8f36eba"
    us = (uuid.UUID(u).time - 0x01B21DD213814000) // 10
    assert spark.range(1).select(timeuuid.micros(F.lit(u))).first()[0] == us
    back = spark.range(1).select(timeuuid.from_micros(F.lit(us), F.lit(7))).first()[0]
    assert uuid.UUID(back).version == 1 and (uuid.UUID(back).time - 0x01B21DD213814000) // 10 == us


def test_orders(spark):
    ids = ["80000000-0000-1000-8000-000000000001", "7fffffff-0000-1000-8000-000000000001", "00000000-0000-1001-8000-000000000001"]
    df = spark.createDataFrame([(i,) for i in ids], "u string")
    assert [r.u for r in df.orderBy(timeuuid.signed_order("u")).collect()] == [ids[0], ids[2], ids[1]]
    assert [r.u for r in df.orderBy(timeuuid.chronological_order("u")).collect()] == [ids[1], ids[0], ids[2]]


def test_wire_values(spark):
    row = spark.createDataFrame([(datetime(2024, 6, 10, 12, 34, 56, 789000, tzinfo=timezone.utc),)], "t timestamp").select(
        wire.scalar(F.col("t"), "timestamp"), wire.scalar(F.to_date("t"), "date"), F.base64(F.lit(b"\xca\xfe\xba\xbe"))).first()
    assert tuple(row) == (1718022896789, 19884, "yv66vg==")
    with pytest.raises(ValueError):
        wire.scalar(F.col("t"), "graph")


def test_collections_and_udts(spark):
    kind = T.StructType.fromDDL("a int, b string, inner struct<x:int>, l array<int>")
    df = spark.createDataFrame([(1, (None, None, (None,), [])), (2, (None, None, (3,), [])), (3, None), (4, (None, None, None, [1]))], T.StructType().add("i", T.IntegerType()).add("u", kind))
    got = {r.i: r.u for r in df.select("i", wire.collapse_udt(F.col("u"), kind).alias("u")).collect()}
    assert got[1] is None and got[3] is None and got[2].inner.x == 3 and got[4].l == [1] and got[4].inner is None
    t = spark.range(1).select(wire.tuple_struct(F.lit(None).cast("int"), F.lit("a")).alias("t")).first().t
    assert t.field_0 is None and t.field_1 == "a"
    assert wire.schema_name(T.MapType(T.StringType(), T.IntegerType())) == "Map_string_int"


def test_types_of_any_depth(spark):
    """Golden values of every scalar type alone, and inside lists, maps, tuples and user types."""
    from decimal import Decimal

    at = datetime(2024, 6, 10, 12, 34, 56, 789000, tzinfo=timezone.utc)
    golden = {  # source value, Spark type it comes as, wire value
        "ascii": ("ascii", "string", "ascii"), "text": ("some text", "string", "some text"), "varchar": ("varchar text", "string", "varchar text"),
        "bigint": (1234567890123, "bigint", 1234567890123), "counter": (5, "bigint", 5), "int": (42, "int", 42), "smallint": (7, "smallint", 7), "tinyint": (5, "tinyint", 5),
        "float": (2.5, "float", 2.5), "double": (3.14159, "double", 3.14159), "boolean": (True, "boolean", True), "blob": (b"\xca\xfe\xba\xbe", "binary", b"\xca\xfe\xba\xbe"),
        "date": (at.date(), "date", 19884), "time": (45296789000000, "bigint", 45296789000000), "timestamp": (at, "timestamp", 1718022896789),
        "decimal": (Decimal("12345.67"), "decimal(7,2)", "12345.67"), "varint": (Decimal(999999999), "decimal(38,0)", "999999999"),
        "uuid": ("453662fa-db4b-4938-9033-d8523c0a371c", "string", "453662fa-db4b-4938-9033-d8523c0a371c"),
        "timeuuid": ("81d4a030-4632-11f0-9484-409dd8f36eba", "string", "81d4a030-4632-11f0-9484-409dd8f36eba"), "inet": ("127.0.0.1", "string", "127.0.0.1"),
        "duration": ("1d12h30m", "string", "1d12h30m"),
    }
    assert set(golden) == set(wire.SCALARS)
    users = {f"u_{t}": {"v": t, "l": f"frozen<list<{t}>>"} for t in golden}
    for t, (source, kind, want) in golden.items():
        ddl = f"s {kind}, l array<{kind}>, m map<int,array<{kind}>>, k map<{kind},string>, p struct<field_0:{kind},field_1:int>, u struct<v:{kind},l:array<{kind}>>"
        full = (source, [source, None], {1: [source], 2: []}, {source: "x"}, (source, None), (source, []))
        df = spark.createDataFrame([full, (None, [], {}, {}, (None, None), (None, [])), (None,) * 6], ddl)
        types = {"s": t, "l": f"list<{t}>", "m": f"map<int, frozen<list<{t}>>>", "k": f"frozen<map<{t}, text>>", "p": f"tuple<{t}, int>", "u": f"u_{t}"}
        rows = [r.asDict(recursive=True) for r in df.select(*[wire.value(F.col(c), wire.parse_type(x, users)).alias(c) for c, x in types.items()]).collect()]
        assert rows[0] == {"s": want, "l": [want, None], "m": [{"key": 1, "value": [want]}, {"key": 2, "value": []}], "k": [{"key": want, "value": "x"}],
                           "p": {"field_0": want, "field_1": None}, "u": {"v": want, "l": []}}, t
        assert rows[1] == {"s": None, "l": [], "m": [], "k": [], "p": {"field_0": None, "field_1": None}, "u": None}, t
        assert rows[2] == dict.fromkeys(types), t


def test_type_texts():
    assert wire.parse_type("frozen<map<frozen<tuple<int, text>>, list<date>>>") == wire.Kind("map", (wire.Kind("tuple", (wire.Kind("int"), wire.Kind("text"))), wire.Kind("list", (wire.Kind("date"),))))
    for bad in ("", "list", "list<int, int>", "map<int>", "int<text>", "graph", "list<int", "int>"):
        with pytest.raises(ValueError):
            wire.parse_type(bad)


def test_lists_kept_as_maps(spark):
    m = F.create_map(F.lit("00000002-0000-1000-8000-000000000001"), F.lit(10), F.lit("00000001-0000-1000-8000-000000000001"), F.lit(20))
    kind, base = wire.parse_type("map<timeuuid, int>"), wire.parse_type("list<int>")
    r = spark.range(1).select(wire.value(m, kind, base).alias("l"), wire.value(m, kind).alias("m")).first()
    assert r.l == [20, 10] and [tuple(e) for e in r.m] == [("00000002-0000-1000-8000-000000000001", 10), ("00000001-0000-1000-8000-000000000001", 20)]
    wrapped = F.struct(F.struct(F.lit(1).alias("a")).alias("elements"))
    users = {"inner": {"a": "int"}, "outer": {"elements": "frozen<inner>"}}
    assert spark.range(1).select(wire.value(wrapped, wire.parse_type("outer", users)).alias("u")).first().u.a == 1


def test_flatten_and_unwrap(spark):
    schema = "op string, before struct<pk:int,v:struct<value:string>,u:struct<value:int>>, after struct<pk:int,v:struct<value:string>,u:struct<value:int>>"
    df = spark.createDataFrame([("u", (1, ("a",), None), (1, (None,), (5,))), ("d", (1, ("b",), None), None)], schema)
    f = transforms.flatten_columns(df).collect()
    assert (f[0].before.v, f[0].after.v, f[0].after.u, f[1].after) == ("a", None, 5, None)
    n = transforms.new_record_state(df, " Legacy").collect()
    assert (n[0].pk, n[0].v, n[0].u) == (1, None, 5) and n[1].pk is None
    assert transforms.new_record_state(df, Format.LEGACY, drop_deletes=True).count() == 1
    assert transforms.new_record_state(df, Format.ADVANCED).first().u.value == 5


def test_windows():
    o = CaptureOptions(lookback=100, query_window=30, confidence_window=20)
    assert windows.first_window(o, 1000) == ReadWindow(900, 930)
    assert windows.first_window(o.with_(lookback=10), 1000) == ReadWindow(990, 1000)
    assert windows.next_window(o, ReadWindow(900, 930), 980) == ReadWindow(930, 960)
    assert windows.next_window(o, ReadWindow(900, 930), 979) is None


def test_window_reads_prune(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    plan = windows.read(e, ReadWindow(1705000000000, 1705100000000), "ts")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan


def test_retry():
    o = CaptureOptions(retry_base=10, retry_cap=35, retry_jitter=0, retry_attempts=4)
    it = retry.delays(o)
    assert [next(it) for _ in range(4)] == [10, 20, 35, 35]
    assert next(retry.delays(o.with_(retry_jitter=50), lambda: 1.0)) == 5
    slept, tries = [], []

    def f():
        tries.append(1)
        raise RuntimeError("wrapped") from retry.NoHost([ValueError(), TimeoutError()])

    with pytest.raises(RuntimeError):
        retry.call(f, o, slept.append)
    assert len(tries) == 4 and slept == [0.01, 0.02, 0.035]
    try:
        try:
            raise TimeoutError
        except TimeoutError:
            raise ValueError  # while a transient one is handled, which is no cause
    except ValueError as e:
        assert not retry.is_transient(e)
    assert not retry.is_transient(ValueError()) and not retry.is_transient(retry.NoHost([ValueError()])) and retry.is_transient(retry.SourceBusy())
    with pytest.raises(ValueError):
        retry.call(lambda: int("x"), o, slept.append)


@pytest.mark.parametrize("text,ok", [("2026.1.0", True), ("2025.4.9", False), ("v2026.1.0-rc1", True), ("2026.10.0", True), ("none", False), (None, False), ("6.2", False)])
def test_version(spark, text, ok):
    assert spark.range(1).select(validate.at_least(F.lit(text).cast("string"), (2026, 1, 0))).first()[0] is ok


def test_progress_and_tasks(spark):
    assert filters.drained(spark.createDataFrame([(1, None)], "t int, window_start_ms long"), 5).first()[0] is False
    assert filters.drained(spark.createDataFrame([(1, 6), (2, 5)], "t int, window_start_ms long"), 5).first()[0] is False
    assert filters.drained(spark.createDataFrame([(1, 6)], "t int, window_start_ms long"), 5).first()[0] is True
    df = spark.createDataFrame([(f"t{i:02d}",) for i in range(10)], "task string")
    packed = sorted((r.task, r.worker) for r in tasks.pack(df, "task", 4).collect())
    assert [w for _, w in packed] == [0, 0, 0, 1, 1, 1, 2, 2, 2, 3]
    assert tasks.pack(df.limit(0), "task", 4).count() == 0
    s = df.limit(1).select(tasks.serialise(F.lit(5), F.lit(2), F.lit("k"), F.lit("t"), F.array(F.lit(b"\xbb"), F.lit(b"\xaa"))).alias("s"))
    assert s.first().s == "5;2;k;t;aa,bb"
    p = s.select(tasks.parse(F.col("s")).alias("p")).first().p
    assert (p.generation, p.vnode, p.keyspace, bytes(p.stream_ids[0])) == (5, 2, "k", b"\xaa")
