"""The decision tables, the state machine, and shapes, on rows typed by hand."""

from itertools import permutations, product

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from deltaloom.model import Op, TableSpec
from deltaloom.operators import correlate, shape
from deltaloom.operators.correlate import Slots, wants
from deltaloom.options import CaptureOptions, Image, Place

N, F_, U = Image.NONE, Image.FULL, Image.ONLY_UPDATED
SPEC = TableSpec("ks", "t", ("pk",), ("ck",), ("v", "w"))
SCHEMA = "pk int, ck int, t int, cdc_batch_seq_no int, cdc_operation int, v string, w string, cdc_deleted_v boolean, cdc_deleted_w boolean"

#: (before, after) asked for -> operations and what each waits for, as text: p before image, c change, q after image.
TABLE = {
    (N, N): {"i": "c", "u": "c", "d": "c", "P": "c", "W": "c"},
    (F_, N): {"i": "c", "u": "pc", "d": "pc", "P": "c", "W": "pc"},
    (N, F_): {"i": "cq", "u": "cq", "d": "c", "P": "c", "W": "c"},
    (F_, F_): {"i": "cq", "u": "pcq", "d": "pc", "P": "c", "W": "pc"},
}
OPS = {"i": Op.ROW_INSERT, "u": Op.ROW_UPDATE, "d": Op.ROW_DELETE, "P": Op.PARTITION_DELETE, "W": Op.PARTITION_DELETE}


@pytest.mark.parametrize("modes", TABLE)
@pytest.mark.parametrize("op", OPS)
def test_completion(modes, op):
    for before, after in product({modes[0], U if modes[0] is F_ else N}, {modes[1], U if modes[1] is F_ else N}):
        o = CaptureOptions(before=before, after=after, wait_preimage_for_partition_delete=op == "W")
        need = TABLE[modes][op]
        assert wants(OPS[op], o) == ("p" in need, "q" in need)
        for order in permutations(need):
            s, events = Slots(o), []
            for x in order:
                events.append(s.feed({"p": Op.PRE_IMAGE, "q": Op.POST_IMAGE, "c": OPS[op]}[x], x))
            assert events[:-1] == [None] * (len(need) - 1) and events[-1] is not None and s.empty


def test_leftovers_pair_with_a_later_change():
    s = Slots(CaptureOptions(before=F_))
    assert s.feed(Op.PRE_IMAGE, "old") is None
    assert s.feed(Op.PRE_IMAGE, "new") is None
    assert s.feed(Op.ROW_UPDATE, "x") == ("new", "x", None)
    assert s.feed(Op.POST_IMAGE, "q") is None and s.empty  # an image nobody asked for fills no slot
    assert s.feed(Op.ROW_UPDATE, "y") is None
    assert s.feed(Op.PRE_IMAGE, "late") == ("late", "y", None)


@given(st.lists(st.sampled_from([0, 1, 2, 3, 9]), max_size=30))
@settings(max_examples=200, deadline=None)
def test_every_event_has_what_it_waits_for(ops):
    o = CaptureOptions(before=F_, after=F_)
    s = Slots(o)
    for i, op in enumerate(ops):
        if (hit := s.feed(op, (op, i))) is not None:
            pre, post = wants(hit[1][0], o)
            assert (not pre or hit[0] is not None) and (not post or hit[2] is not None)


def log(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


ROWS = [
    (1, 1, 1, 1, 2, "a", "b", False, False), (1, 1, 1, 2, 9, "a", "b", False, False),
    (1, 1, 2, 0, 0, "a", "b", False, False), (1, 1, 2, 1, 1, "c", None, False, False), (1, 1, 2, 2, 9, "c", "b", False, False),
    (1, 1, 3, 0, 0, "c", "b", False, False), (1, 1, 3, 1, 1, None, None, False, True), (1, 1, 3, 2, 9, "c", None, False, False),
    (1, 1, 4, 0, 0, "c", None, False, False), (1, 1, 4, 1, 3, None, None, False, False),
]
#: before and after as (v, w), by change, for every pair of modes.
EXPECTED = {
    (N, N): [(None, None)] * 4,
    (F_, N): [(None, None), (("a", "b"), None), (("c", "b"), None), (("c", None), None)],
    (U, N): [(None, None), (("a", None), None), ((None, "b"), None), (("c", None), None)],
    (N, F_): [(None, ("a", "b")), (None, ("c", "b")), (None, ("c", None)), (None, None)],
    (N, U): [(None, ("a", "b")), (None, ("c", None)), (None, (None, None)), (None, None)],
    (F_, F_): [(None, ("a", "b")), (("a", "b"), ("c", "b")), (("c", "b"), ("c", None)), (("c", None), None)],
    (F_, U): [(None, ("a", "b")), (("a", "b"), ("c", None)), (("c", "b"), (None, None)), (("c", None), None)],
    (U, F_): [(None, ("a", "b")), (("a", None), ("c", "b")), ((None, "b"), ("c", None)), (("c", None), None)],
    (U, U): [(None, ("a", "b")), (("a", None), ("c", None)), ((None, "b"), (None, None)), (("c", None), None)],
}


@pytest.mark.parametrize("how", [correlate.by_change, correlate.by_order])
def test_modes(spark, how):
    df = log(spark, ROWS).repartition(3).cache()
    for (before, after), want in EXPECTED.items():
        o = CaptureOptions(before=before, after=after)
        e = shape.images(how(df, SPEC, o, ("t",), ("t", "cdc_batch_seq_no")), SPEC, o, ("t",)).orderBy("t").collect()
        assert [r.op for r in e] == ["c", "u", "u", "d"]
        got = [tuple(None if x is None else (x.v, x.w) for x in (r.before, r.after)) for r in e]
        assert got == want, (before, after)
    df.unpersist()


def test_no_image_no_shuffle(spark):
    o = CaptureOptions()
    plan = correlate.by_change(log(spark, ROWS), SPEC, o, ("t",), ("t",))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_one_shuffle_and_pushdown(spark, tmp_path):
    log(spark, ROWS).write.parquet(str(tmp_path / "log"))
    o = CaptureOptions(before=F_)
    e = shape.images(correlate.by_change(spark.read.parquet(str(tmp_path / "log")), SPEC, o, ("t",), ("t", "cdc_batch_seq_no")), SPEC, o, ("t",))
    plan = e._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "In(cdc_operation, [0,1,2,3])" in plan


def test_batch_of_two_rows_pairs_by_row(spark):
    rows = []
    for seq, op in ((0, 0), (1, 1), (2, 9)):
        for ck in (1, 2):
            rows.append((1, ck, 1, 2 * seq + ck, op, f"{op}-{ck}", None, False, False))
    o = CaptureOptions(before=F_, after=F_)
    for how in (correlate.by_change, correlate.by_order):
        e = shape.images(how(log(spark, rows), SPEC, o, ("t",), ("cdc_batch_seq_no",)), SPEC, o, ("ck",)).orderBy("ck").collect()
        assert [(r.before.v, r.after.v) for r in e] == [("0-1", "9-1"), ("0-2", "9-2")]


def test_keys_headers_tombstones(spark):
    o = CaptureOptions(before=F_, after=F_, places=frozenset(Place), payload_key_name="id", logical_name="p")
    slots = correlate.by_change(log(spark, ROWS), SPEC, o, ("t",), ("t", "cdc_batch_seq_no"))
    from pyspark.sql import functions as F

    e = shape.with_tombstones(shape.envelope(slots, SPEC, o, F.lit(1_500_001).cast("long"), F.lit(7).cast("long"), ("t",))).orderBy("t", "part").collect()
    assert [(r.t, r.part) for r in e] == [(1, 0), (2, 0), (3, 0), (4, 0), (4, 1)]
    assert e[4].value is None and e[4].key.pk == 1 and e[4].topic == "p.ks.t"
    assert {h.key: bytes(h.value) for h in e[0].headers} == {"pk.pk": b"1", "ck.ck": b"1"}
    v = e[1].value
    assert v.id.ck == 1 and v.before.pk == 1 and v.source.ts_ms == 1500 and v.source.ts_us == 1500001 and v.transaction is None and v.ts_ms == 7
    none = CaptureOptions(places=frozenset({Place.PAYLOAD_KEY}), after=F_)
    x = shape.envelope(correlate.by_change(log(spark, ROWS), SPEC, none, ("t",), ("t", "cdc_batch_seq_no")), SPEC, none, F.lit(0).cast("long")).first()
    assert x.key is None and x.headers is None and "pk" not in x.value.after and x.value.key.pk == 1


def test_unknown_operation_is_an_error(spark):
    from pyspark.sql import functions as F

    with pytest.raises(Exception, match="not a change"):
        spark.range(1).select(shape.op_code(F.lit(5))).collect()


def test_older_format(spark):
    df = log(spark, ROWS + [(1, 1, 5, 1, 3, None, None, False, False)])
    e = shape.legacy(correlate.with_last_preimage(df, SPEC, ("t",), ("t", "cdc_batch_seq_no")), SPEC, ("t",)).orderBy("t").collect()
    assert e[0].before is None and e[0].after.v.value == "a"
    assert e[1].before.w.value == "b" and e[1].after.w is None
    assert e[2].after.w is not None and e[2].after.w.value is None and e[2].after.v is None
    assert e[3].after is None and e[3].before.v.value == "c"
    assert e[4].before.pk == 1 and e[4].before.v is None  # no before image: the change itself


def test_state_machine_keeps_types(spark):
    """Records come through with maps of any keys, zone-less timestamps and nested values as they are."""
    from datetime import datetime
    from decimal import Decimal

    spec = TableSpec("ks", "t", ("pk",), (), ("m", "n", "d", "b", "s"))
    schema = ("pk timestamp_ntz, t int, seq int, cdc_operation int, m map<int,string>, n timestamp_ntz, d decimal(38,10), b binary, "
              "s struct<a:array<map<bigint,date>>,z:timestamp>")
    at = datetime(2024, 5, 6, 7, 8, 9, 123456)
    keys = [at, at.replace(microsecond=123457), None]
    rows = []
    for pk in keys:
        for t in range(4):
            for seq, op in ((0, 0), (1, 1), (2, 9)):
                rows.append((pk, t, seq, op, {t: f"{seq}", -1: None}, at.replace(microsecond=t), Decimal(f"{t}.0000000001"), bytes([t, seq]), ([{7: at.date()}], at) if seq else None))
    df = spark.createDataFrame(rows, schema).repartition(3)
    o = CaptureOptions(before=F_, after=F_)
    a, b = (sorted(map(str, how(df, spec, o, ("t",), ("t", "seq")).collect())) for how in (correlate.by_change, correlate.by_order))
    assert a == b and len(a) == 12


def test_no_change_vanishes(spark):
    """What the state machine never completes comes out with a reason; with the events these are all changes."""
    rows = [
        (1, 1, 1, 1, 1, "a", None, False, False),  # its images never come; the next change overwrites it
        (1, 1, 2, 0, 0, "b", None, False, False), (1, 1, 2, 1, 1, "c", None, False, False), (1, 1, 2, 2, 9, "d", None, False, False),
        (1, 2, 1, 1, 1, "e", None, False, False),  # left over at the end
        (1, 3, 1, 0, 0, "f", None, False, False),  # an image without a change
    ]
    o = CaptureOptions(before=F_, after=F_)
    got = {(r.ck, r.t): (r.reason, r.pre.v if r.pre else None, r.chg.v if r.chg else None, r.post.v if r.post else None)
           for r in correlate.state_machine(log(spark, rows), SPEC, o, ("t",), ("t", "cdc_batch_seq_no")).collect()}
    assert got == {(1, 1): (correlate.OVERWRITTEN, "b", "a", None), (1, 2): (None, "b", "c", "d"), (2, 1): (correlate.NO_IMAGE, None, "e", None), (3, 1): (correlate.NO_CHANGE, "f", None, None)}


def test_machine_across_batches(spark):
    """The same from Arrow batches of any size."""
    o = CaptureOptions(before=F_, after=F_)
    df = log(spark, [(i % 3, i % 2, *r[2:]) for i in range(20) for r in ROWS[2:5]])
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    out = []
    try:
        for n in ("1", "2", "7", "10000"):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", n)
            rows = correlate.state_machine(df, SPEC, o, ("t",), ("t", "cdc_batch_seq_no")).collect()
            out.append(sorted((r.pk, r.ck, r.reason or "", str(r.chg)) for r in rows))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert out[0] == out[1] == out[2] == out[3]


def test_slots_time_out():
    s = Slots(CaptureOptions(before=F_, incomplete_timeout=10))
    assert s.feed(Op.ROW_UPDATE, "x", 100) is None and s.feed(Op.PRE_IMAGE, "p", 110) == ("p", "x", None)
    assert s.feed(Op.ROW_UPDATE, "y", 200) is None and s.feed(Op.PRE_IMAGE, "q", 211) is None
    assert s.lost == [(None, "y", None, correlate.TIMED_OUT)] and s.pre == "q"


def test_by_change_plan(spark, tmp_path):
    """One exchange and one sort, and no aggregation that would sort once more."""
    log(spark, ROWS).write.parquet(str(tmp_path / "log"))
    o = CaptureOptions(before=F_, after=F_)
    plan = correlate.by_change(spark.read.parquet(str(tmp_path / "log")), SPEC, o, ("t",), ("t", "cdc_batch_seq_no"))._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and plan.count("Sort [") == 1 and plan.count("Exchange ") == 1
