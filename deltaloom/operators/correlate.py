"""Correlation of changes with the images of their row before and after.

`by_change` takes a change's records together by row key and change id: one shuffle and one sort, and neither where the
options need no image. It is exact where a change's images carry its own change id, which logs written with images do.

`by_order` is the state machine itself: per row key, in log order, each slot (before image, change, after image)
keeps the last record; when the slots that the change needs are filled, an event goes out and the slots are emptied.
Images that are left over pair with a later change. Rows of a key are streamed through in order, sorted within partitions,
so a key of any size takes constant memory. Only operations pass through Python one by one; records are taken by their
place in Arrow batches, whatever their types. `state_machine` also gives the changes that never complete, with a reason.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..model import OPERATION, Op, TableSpec
from ..options import CaptureOptions
from ..ship import ship
from .filters import changes, relevant

PRE, CHANGE, POST = "pre", "chg", "post"
#: Why a change or an image comes out without an event.
OVERWRITTEN, NO_IMAGE, NO_CHANGE, TIMED_OUT = "another change of the row came first", "an image is missing", "no change", "timed out"


def wants(op: int, o: CaptureOptions) -> tuple[bool, bool]:
    """Whether a change of this kind waits for a before and for an after image."""
    pre = o.needs_pre and (op in (Op.ROW_UPDATE, Op.ROW_DELETE) or (op == Op.PARTITION_DELETE and o.wait_preimage_for_partition_delete))
    return pre, o.needs_post and op in (Op.ROW_INSERT, Op.ROW_UPDATE)


def complete(op: Column, has_pre: Column, has_post: Column, o: CaptureOptions) -> Column:
    out = op.isNotNull()
    for kind in (Op.ROW_UPDATE, Op.ROW_INSERT, Op.ROW_DELETE, Op.PARTITION_DELETE):
        pre, post = wants(kind, o)
        if pre or post:
            out = out & ((op != int(kind)) | ((has_pre if pre else F.lit(True)) & (has_post if post else F.lit(True))))
    return out


def _slots(log: DataFrame, spec: TableSpec, o: CaptureOptions, change_id: Sequence[str], order: Sequence[str]) -> DataFrame:
    image, op = spec.image(log.columns), F.col(OPERATION)
    pick = {PRE: op == int(Op.PRE_IMAGE), CHANGE: op.isin([int(x) for x in spec.change_operations()]), POST: op == int(Op.POST_IMAGE)}
    kept = [s for s in (PRE, CHANGE, POST) if s == CHANGE or (s == PRE and o.needs_pre) or (s == POST and o.needs_post)]
    keys = [*spec.key, *[c for c in change_id if c not in spec.key]]
    # windows of one order share an exchange and a sort; aggregates of structs would sort on both sides of the exchange
    w = Window.partitionBy(*keys).orderBy(*order)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    last = [F.last(F.when(pick[s], image), ignorenulls=True).over(whole).alias(s) for s in kept]
    made = relevant(log, spec, o.needs_pre, o.needs_post).select(*keys, *last, F.row_number().over(w).alias("_place")).where("_place = 1").drop("_place")
    absent = F.when(F.lit(False), F.col(CHANGE))
    return made.withColumns({s: absent for s in (PRE, POST) if s not in kept})


def by_change(log: DataFrame, spec: TableSpec, o: CaptureOptions, change_id: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Key, change id and the structs pre, chg, post of every complete change."""
    if not o.needs_pre and not o.needs_post:
        image = spec.image(log.columns)
        out = changes(log, spec).select(*spec.key, *[c for c in change_id if c not in spec.key], image.alias(CHANGE))
        return out.withColumns({s: F.when(F.lit(False), F.col(CHANGE)) for s in (PRE, POST)})
    slots = _slots(log, spec, o, change_id, order)
    return slots.where(complete(F.col(f"{CHANGE}._op"), F.col(PRE).isNotNull(), F.col(POST).isNotNull(), o))


def incomplete(log: DataFrame, spec: TableSpec, o: CaptureOptions, change_id: Sequence[str], order: Sequence[str]) -> DataFrame:
    """What by_change leaves: changes that lack an image and images without a change, with what they have."""
    slots = _slots(log, spec, o, change_id, order)
    done = complete(F.col(f"{CHANGE}._op"), F.col(PRE).isNotNull(), F.col(POST).isNotNull(), o)
    return slots.where(~F.coalesce(done, F.lit(False))).select(
        *spec.key, *[c for c in change_id if c not in spec.key], F.col(PRE).isNotNull().alias("has_pre"), F.col(CHANGE).isNotNull().alias("has_change"), F.col(POST).isNotNull().alias("has_post"))


class Slots:
    """The state machine of one row key. What will never make an event is added to `lost`: the slots, and a reason."""

    def __init__(self, o: CaptureOptions):
        self.o, self.pre, self.change, self.post, self.op, self.since = o, None, None, None, None, None
        self.lost: list[tuple] = []

    @property
    def empty(self) -> bool:
        return self.pre is None and self.change is None and self.post is None

    def give_up(self, reason: str | None = None) -> None:
        """Empties the slots."""
        if not self.empty:
            self.lost.append((self.pre, self.change, self.post, reason or (NO_CHANGE if self.change is None else NO_IMAGE)))
        self.pre = self.change = self.post = self.op = self.since = None

    def feed(self, op: int, record, at=None):
        """(pre, change, post) if this record completes a change, else None. Images not asked for fill no slot.

        at: the record's time in milliseconds; slots older than the timeout are given up. Without it nothing is.
        """
        if at is not None and self.since is not None and at - self.since > self.o.incomplete_timeout:
            self.give_up(TIMED_OUT)
        if self.since is None:
            self.since = at
        if op == Op.PRE_IMAGE:
            if self.o.needs_pre:
                self.pre = record
        elif op == Op.POST_IMAGE:
            if self.o.needs_post:
                self.post = record
        else:
            if self.change is not None:
                self.lost.append((self.pre, self.change, self.post, OVERWRITTEN))
            self.change, self.op = record, op
        if self.empty:
            self.since = None
        if self.change is None:
            return None
        pre, post = wants(self.op, self.o)
        if (pre and self.pre is None) or (post and self.post is None):
            return None
        out = (self.pre, self.change, self.post)
        self.pre = self.change = self.post = self.op = self.since = None
        return out


def _machine(o: CaptureOptions):
    """Rows (new, op, record) in order to (pre, chg, post, reason); `new` marks a row key's first record."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots, held = Slots(o), None
        for batch in batches:
            body, first = batch.column(2), 0
            if held is not None and len(held):
                body, first = pa.concat_arrays([held, body]), len(held)
            out: list[tuple] = []
            for i, (new, op) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()), first):
                if new:
                    slots.give_up()
                if (hit := slots.feed(op, i)) is not None:
                    out.append((*hit, None))
                if slots.lost:
                    out += slots.lost
                    slots.lost = []
            if out:
                yield _taken(body, out)
            places = [x for x in (slots.pre, slots.change, slots.post) if x is not None]
            held = body.take(pa.array(places, pa.int64()))
            slots.pre, slots.change, slots.post = (None if x is None else places.index(x) for x in (slots.pre, slots.change, slots.post))
        slots.give_up()
        if slots.lost:
            yield _taken(held, slots.lost)

    return run


def _taken(body: pa.Array, rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows))
    return pa.RecordBatch.from_arrays([*[body.take(pa.array(c, pa.int64())) for c in columns[:3]], pa.array(columns[3], pa.string())], names=[PRE, CHANGE, POST, "reason"])


def record(log: DataFrame, spec: TableSpec, change_id: Sequence[str]) -> Column:
    """What travels through the state machine: a record's image, and its change id beside it."""
    return F.struct(spec.image(log.columns).alias("r"), *[c for c in change_id if c not in spec.key])


def unpacked(hits: DataFrame, spec: TableSpec, change_id: Sequence[str]) -> DataFrame:
    """Key, change id, pre, chg, post and reason from records; the key is that of any slot, the id that of the change, else of an image."""
    some = F.coalesce(CHANGE, PRE, POST)
    return hits.select(*[some["r"][c].alias(c) for c in spec.key], *[some[c].alias(c) for c in change_id if c not in spec.key],
                       *[F.col(f"{s}.r").alias(s) for s in (PRE, CHANGE, POST)], "reason")


def state_machine(log: DataFrame, spec: TableSpec, o: CaptureOptions, change_id: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Key, change id, pre, chg, post, and reason: null for events, else why the change, or images without one, made none."""
    ship(log.sparkSession)
    w = Window.partitionBy(*spec.key).orderBy(*order)
    ordered = relevant(log, spec, o.needs_pre, o.needs_post).select(
        (F.row_number().over(w) == 1).alias("new"), F.col(OPERATION).cast("int").alias("op"), record(log, spec, change_id).alias("b"))
    kind = ordered.schema["b"].dataType
    out = T.StructType([T.StructField(s, kind) for s in (PRE, CHANGE, POST)] + [T.StructField("reason", T.StringType())])
    return unpacked(ordered.mapInArrow(_machine(o), out), spec, change_id)


def by_order(log: DataFrame, spec: TableSpec, o: CaptureOptions, change_id: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Like by_change, by the state machine; the change id is that of the change record."""
    return state_machine(log, spec, o, change_id, order).where("reason IS NULL").drop("reason")


def with_last_preimage(log: DataFrame, spec: TableSpec, change_id: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The older format's pairing: a change takes the last before image since the previous change of its row, and never waits."""
    image, op = spec.image(log.columns), F.col(OPERATION)
    is_change = op.isin([int(x) for x in spec.change_operations()])
    w = Window.partitionBy(*spec.key).orderBy(*order)
    numbered = (
        relevant(log, spec, True, False)
        .withColumn("_turn", F.coalesce(F.sum(is_change.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    )
    within = Window.partitionBy(*spec.key, "_turn").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        numbered.withColumn(PRE, F.last(F.when(op == int(Op.PRE_IMAGE), image), ignorenulls=True).over(within))
        .where(is_change).select(*spec.key, *[c for c in change_id if c not in spec.key], PRE, image.alias(CHANGE))
    )
