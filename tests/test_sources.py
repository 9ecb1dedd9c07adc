import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deltaloom.operators import filters, transforms
from deltaloom.plans.fixtures import events_log
from deltaloom.sources.changelog import ChangeLogReader, ChangeLogSource
from deltaloom.sources import sinks
from deltaloom.sources.sessions import SharedSessions


def test_shared_sessions():
    opened, closed = [], []

    def connect(s):
        if s.get("hosts") == "bad":
            raise ConnectionError
        opened.append(s)
        return object()

    shared = SharedSessions(connect, closed.append)
    a = shared.acquire({"hosts": "x:1, y:2", "ciphers": "p,q"})
    assert shared.acquire({"hosts": "y:2,x:1", "ciphers": "p,q"}) is a
    assert shared.acquire({"hosts": "x:1,y:2", "ciphers": "q,p"}) is not a
    assert len(opened) == 2 and shared.count({"hosts": "y:2,x:1", "ciphers": "p,q"}) == 2
    shared.release({"hosts": "x:1,y:2", "ciphers": "p,q"})
    assert not closed
    shared.release({"hosts": "x:1,y:2", "ciphers": "p,q"})
    assert closed == [a]
    shared.release({"hosts": "nobody"})
    with pytest.raises(ConnectionError):
        shared.acquire({"hosts": "bad"})
    assert shared.count({"hosts": "bad"}) == 0


def test_log_stream_in_windows(spark, sf_dir, tmp_path):
    log = events_log(spark, sf_dir)
    log.repartitionByRange(4, "change_ts").write.parquet(str(tmp_path / "log"))
    ms = log.agg(F.min(F.unix_millis("change_ts")), F.max(F.unix_millis("change_ts"))).first()
    day = 86_400_000
    start, now = ms[0] - ms[0] % day, ms[1] - 5 * day
    options = {"path": str(tmp_path / "log"), "window_ms": str(day), "confidence_ms": str(2 * day), "start_ms": str(start), "now_ms": str(now)}
    spark.dataSource.register(ChangeLogSource)
    stream = spark.readStream.format("changelog").schema(log.schema)
    for k, v in options.items():
        stream = stream.option(k, v)
    q = stream.load().writeStream.format("memory").queryName("windows").option("checkpointLocation", str(tmp_path / "c")).start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    end = start + (now - 2 * day - start) // day * day
    want = log.where((F.unix_millis("change_ts") >= start) & (F.unix_millis("change_ts") < end))
    got = spark.table("windows")
    assert got.count() == want.count() > 0 and got.exceptAll(want).count() == 0


def test_reader_offsets():
    r = ChangeLogReader(T.StructType([]), {"path": "x", "window_ms": "10", "confidence_ms": "5", "start_ms": "100", "now_ms": "139", "windows_per_batch": "2"})
    assert r.initialOffset() == {"end": 100} and r.latestOffset() == {"end": 120} and r.latestOffset() == {"end": 130} and r.latestOffset() == {"end": 130}
    assert r.partitions({"end": 130}, {"end": 130}) == []


def test_reader_waits_between_windows():
    r = ChangeLogReader(T.StructType([]), {"path": "x", "window_ms": "10", "confidence_ms": "5", "start_ms": "100", "now_ms": "205", "minimal_wait_ms": "50"})
    clock = [1000]
    r._clock_ms = lambda: clock[0]
    ends = []
    for step in (0, 10, 39, 1, 49, 1, 100):
        clock[0] += step
        ends.append(r.latestOffset()["end"])
    assert ends == [110, 110, 110, 120, 120, 130, 150]
    assert ChangeLogReader(T.StructType([]), {"path": "x"}).most == 120


def test_table_by_key(spark, tmp_path):
    t = sinks.KeyedTable(spark, str(tmp_path / "t"), ("k",), ("at",), parts=4)
    assert t.read() is None

    def batch(*rows):
        return spark.createDataFrame(rows, "k int, at int, v string")

    t.apply(batch(*[(k, 1, f"a{k}") for k in range(20)]), 0)
    t.apply(batch((3, 2, "b3"), (20, 1, "b20")), 1)
    files = {f for f in (tmp_path / "t" / "data" / f"{1:020d}").glob("_part=*")}
    assert 0 < len(files) <= 2  # only the parts of its two keys
    t.apply(batch((3, 9, "lost")), 1)  # the same batch number again
    t.apply(batch((3, 0, "older")), 2)
    want = {k: f"a{k}" for k in range(20)} | {3: "b3", 20: "b20"}
    assert {r.k: r.v for r in t.read().collect()} == want and t.read().columns == ["k", "at", "v"]
    t.vacuum()
    assert {r.k: r.v for r in t.read().collect()} == want


def test_json_with_schemas(spark):
    import json

    e = spark.createDataFrame([((1,), ("u", {"a": 1}, [b"x"], None)), ((2,), None)], "key struct<pk:int>, value struct<op:string,m:map<string,bigint>,l:array<binary>,s:struct<field_0:double>>")
    got = sinks.as_json(e, schemas=True, prefix="p.").collect()
    v = json.loads(got[0].value)
    assert v["payload"] == {"op": "u", "m": {"a": 1}, "l": ["eA=="], "s": None} and got[1].value is None
    kinds = {f["field"]: f for f in v["schema"]["fields"]}
    assert v["schema"]["type"] == "struct" and kinds["op"]["type"] == "string" and kinds["m"]["values"]["type"] == "int64" and kinds["l"]["items"]["type"] == "bytes"
    assert kinds["s"]["name"].startswith("p.Tuple_") and json.loads(got[0].key)["payload"] == {"pk": 1}


def test_heartbeats_and_generations(spark):
    o = spark.createDataFrame([(1, 100), (2, 60), (3, None)], "task int, last_beat_ms long")
    assert {r.task for r in filters.heartbeats(o, ["task"], 130, 70).collect()} == {2, 3}
    log = spark.createDataFrame([(10, "a"), (20, "b"), (30, "c")], "generation_start long, x string")
    offsets = spark.createDataFrame([(10, 25), (10, 21), (20, 22), (30, 31)], "generation_start long, window_start_ms long")
    assert {r.x for r in filters.current_generation(log, offsets).collect()} == {"a", "b"}
    late = offsets.union(spark.createDataFrame([(10, None)], offsets.schema))
    assert {r.x for r in filters.current_generation(log, late).collect()} == {"a"}


def test_sinks(spark, tmp_path):
    e = spark.createDataFrame([("t.a", (1,), ("u", None)), ("t.b", (2,), None)], "topic string, key struct<pk:int>, value struct<op:string,before:string>")
    j = {r.topic: r for r in sinks.as_json(e).collect()}
    assert j["t.a"].value == '{"op":"u","before":null}' and j["t.b"].value is None and j["t.b"].key == '{"pk":2}'
    sinks.write_parquet(e, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).where("topic = 't.b'").count() == 1
    store = {}
    apply = sinks.upsert(("k",), lambda: store.get("df"), lambda df: store.update(df=spark.createDataFrame(df.collect(), df.schema)), ("t",))
    for _ in range(2):  # the same batch twice
        apply(spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], "k int, t int, v string"), 0)
    apply(spark.createDataFrame([(1, 3, "d")], "k int, t int, v string"), 1)
    assert {(r.k, r.v) for r in store["df"].collect()} == {(1, "d"), (2, "c")}


def test_merge_and_optional(spark):
    a = spark.createDataFrame([(1, "a")], "id int, o string")
    b = spark.createDataFrame([(1, "b"), (2, "b")], "id int, o string")
    assert {(r.id, r.o) for r in filters.merge_tasks(a, b, key=["id"]).collect()} == {(1, "a"), (2, "b")}
    d = spark.range(1).withColumn("l", F.array(F.lit(1)))
    assert transforms.make_optional(d).schema["id"].nullable and not d.schema["id"].nullable
