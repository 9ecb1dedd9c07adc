"""Every registered query against its SQL, on the smallest tables."""

import pytest

from deltaloom import registry
from deltaloom.plans.catalog import CHANGE_ID, EVENTS, FULL, ORDER
from deltaloom.plans.fixtures import events_log


def rows(columns, records):
    import math

    def plain(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return "-"
        return repr(float(v)) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)

    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in records)


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_against_sql(spark, duck, sf_dir, name):
    df = registry.QUERIES[name](spark, sf_dir)
    want = duck.sql(registry.SQL[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert rows(df.columns, df.collect()) == rows(want.columns, want.fetchall())


def test_stream_equals_batch(spark, sf_dir):
    from deltaloom.operators.correlate import by_change

    got = registry.QUERIES["cdc_stream_correlate"](spark, sf_dir).collect()
    want = by_change(events_log(spark, sf_dir), EVENTS, FULL, CHANGE_ID, ORDER).collect()
    done = {(r.user_id, r.event_type, r.event_id, r.pre_value, r.post_value) for r in got if r.reason is None}
    assert done == {(r.user_id, r.event_type, r.event_id, r.pre.value if r.pre else None, r.post.value if r.post else None) for r in want}
    assert all(r.reason is None for r in got) and len(got) == len(want)


def test_incomplete_changes_come_out_of_the_stream(spark, sf_dir):
    from pyspark.sql import functions as F

    from deltaloom.streaming.run import correlate_files

    log = events_log(spark, sf_dir).where(~((F.col("cdc_batch_seq_no") == 2) & (F.col("event_id") % 5 == 0) & (F.col("n") == 1)))
    got = correlate_files(spark, log, EVENTS, FULL.with_(confidence_window=1), CHANGE_ID, ORDER)
    assert got.where("reason is not null").count() > 0


@pytest.mark.parametrize("files", [1, 3, 6])
def test_stream_loses_no_change(spark, sf_dir, files):
    from pyspark.sql import functions as F

    from deltaloom.streaming.run import correlate_files

    log = events_log(spark, sf_dir).where(~((F.col("cdc_batch_seq_no") == 2) & (F.col("event_id") % 5 == 0)))
    changes = {r.event_id for r in log.where("cdc_operation in (1, 2, 3)").select("event_id").collect()}
    got = correlate_files(spark, log, EVENTS, FULL, CHANGE_ID, ORDER, files=files).where("op is not null").collect()
    assert len(got) == len(changes) and {r.event_id for r in got} == changes
    assert {r.reason is None for r in got} == {True, False}


def test_stream_of_a_large_log_has_more_steps(spark, sf_dir, monkeypatch):
    """Files and steps are bounded, there is no time limit, and keys go by groups: a call for each key took too long."""
    import inspect

    import pyarrow as pa

    from deltaloom.streaming import correlate, run

    monkeypatch.setattr(run, "FILE_ROWS", 100)
    got = run.correlate_files(spark, events_log(spark, sf_dir), EVENTS, FULL, CHANGE_ID, ORDER).collect()
    assert len(got) == 1000 and all(r.reason is None for r in got)
    assert inspect.signature(run.correlate_files).parameters["timeout_s"].default is None
    rows = pa.record_batch([pa.array([i % correlate.BUCKETS for i in range(20_000)], pa.int32()), pa.array(range(20_000))], names=["bucket_", "x"])
    dealt = list(correlate._scatter(iter([rows.slice(0, 7000), rows.slice(7000)])))
    assert sum(b.num_rows for b in dealt) == correlate.BUCKETS
    back = [x for b in dealt for m in correlate._unpack(pa.schema([("x", pa.int64())]))([b.select(["m"])]) for x in m.column(0).to_pylist()]
    assert sorted(back) == list(range(20_000))


def test_late_change_is_not_lost(spark, sf_dir, tmp_path):
    """What comes later than the watermark is fed like other records; workers beside the driver know the package."""
    import os

    from deltaloom.streaming.correlate import correlate_stream
    from deltaloom.streaming.run import ROCKSDB, STORE

    log = events_log(spark, sf_dir)
    spark.conf.set(STORE, ROCKSDB)
    try:
        for part in (log.where("event_id between 900 and 950"), log.where("event_id = 10")):
            part.coalesce(1).write.mode("append").parquet(str(tmp_path / "log"))
            out = correlate_stream(spark.readStream.schema(log.schema).parquet(str(tmp_path / "log")), EVENTS, FULL.with_(confidence_window=1), CHANGE_ID, ORDER)
            q = out.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start(str(tmp_path / "out"))
            assert q.awaitTermination(200)
    finally:
        spark.conf.unset(STORE)
    got = spark.read.schema(out.schema).parquet(str(tmp_path / "out"))
    assert got.where("event_id = 10 and reason is null").count() == 1
    assert os.path.dirname(os.path.dirname(os.path.abspath(__file__))) in spark.sparkContext.environment["PYTHONPATH"].split(os.pathsep)


def test_restart_with_open_slots(spark, sf_dir, tmp_path):
    """A stream that stops between a change and its images goes on where it was."""
    from deltaloom.operators.correlate import by_change
    from deltaloom.streaming.correlate import correlate_stream
    from deltaloom.streaming.run import ROCKSDB, STORE

    log = events_log(spark, sf_dir)
    half = log.selectExpr("percentile_approx(event_id, 0.5)").first()[0]
    first = f"event_id < {half} or (event_id = {half} and cdc_batch_seq_no < 2) or (event_id = {half + 1} and cdc_batch_seq_no = 0)"
    late = FULL.with_(confidence_window=10 * 86_400_000, incomplete_timeout=10 * 86_400_000)
    spark.conf.set(STORE, ROCKSDB)
    counts = []
    try:
        for part in (log.where(first), log.where(f"not ({first})")):
            part.coalesce(1).write.mode("append").parquet(str(tmp_path / "log"))
            out = correlate_stream(spark.readStream.schema(log.schema).parquet(str(tmp_path / "log")), EVENTS, late, CHANGE_ID, ORDER)
            q = out.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start(str(tmp_path / "out"))
            assert q.awaitTermination(200)
            counts.append(spark.read.parquet(str(tmp_path / "out")).count())
    finally:
        spark.conf.unset(STORE)
    want = by_change(log, EVENTS, FULL, CHANGE_ID, ORDER)
    got = spark.read.schema(out.schema).parquet(str(tmp_path / "out"))
    assert 0 < counts[0] < counts[1] == want.count()
    assert got.where("reason is not null").count() == 0
    assert sorted(map(str, got.drop("reason").collect())) == sorted(map(str, want.select(*got.drop("reason").columns).collect()))


def test_shuffled_input_gives_the_same(spark, sf_dir):
    from pyspark.sql import functions as F

    from deltaloom.operators.correlate import by_change, by_order

    log = events_log(spark, sf_dir)
    for how in (by_change, by_order):
        a = how(log, EVENTS, FULL, CHANGE_ID, ORDER)
        b = how(log.repartition(7, F.hash("event_id", "cdc_operation")), EVENTS, FULL, CHANGE_ID, ORDER)
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_entry():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
