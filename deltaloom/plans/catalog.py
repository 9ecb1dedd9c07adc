"""The registered queries of the capture engine, each with the SQL that DuckDB can check it by."""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import tasks, timeuuid, wire
from ..functions.instants import instant
from ..operators import correlate, filters, shape, transforms
from ..options import CaptureOptions, Format, Image, Place
from ..sources import sinks, validate, windows
from .fixtures import CHANGE_ID, EVENTS, EVENTS_ONE_ROW, LOG_SQL, ORDER, ORDERS, SLOTS_SQL, TASKS, events, events_log, orders_log, with_time

QUERIES: dict = {}
SQL: dict = {}
FULL = CaptureOptions(logical_name="app", before=Image.FULL, after=Image.FULL)
KEYS = ("user_id", "event_type", "event_id")


def query(sql: str | None = None, name: str | None = None):
    def register(f):
        key = name or f.__name__
        QUERIES[key] = f
        if sql:
            SQL[key] = sql
        return f

    return register


def cells(df: DataFrame, *keep: str) -> DataFrame:
    return df.select(*keep, "op", *[F.col(f"{side}.{c}").alias(f"{side}_{c}") for side in ("before", "after") for c in ("value", "note")])


def flat(df: DataFrame, o: CaptureOptions, spec=EVENTS) -> DataFrame:
    return cells(shape.images(df, spec, o, KEYS), *KEYS)


# -- shapes and modes

def mode_sql(before: str, after: str, sql: str = SLOTS_SQL) -> str:
    """Independent statement of the mode tables over one row per change."""
    def col(side: str, c: str) -> str:
        mod = "chg_value IS NOT NULL" if c == "value" else "(chg_note IS NOT NULL OR del)"
        pre, post = f"CASE WHEN has_pre THEN pre_{c} END", f"CASE WHEN has_post THEN post_{c} END"
        if side == "before":
            update = {"none": "NULL", "full": pre if after == "none" else f"CASE WHEN {mod} THEN pre_{c} ELSE post_{c} END", "only": f"CASE WHEN {mod} THEN pre_{c} END"}[before]
            other = "NULL" if before == "none" else f"CASE WHEN op = 3 THEN pre_{c} END"
        else:
            update = {"none": "NULL", "full": post, "only": f"CASE WHEN {mod} THEN post_{c} END"}[after]
            other = "NULL" if after == "none" else f"CASE WHEN op = 2 THEN post_{c} END"
        kind = "DOUBLE" if c == "value" else "BIGINT"
        return f"CAST(CASE WHEN op = 1 THEN {update} ELSE {other} END AS {kind}) AS {side}_{c}"

    parts = ", ".join(col(s, c) for s in ("before", "after") for c in ("value", "note"))
    return f"{sql} SELECT user_id, event_type, event_id, CASE op WHEN 1 THEN 'u' WHEN 2 THEN 'c' ELSE 'd' END AS op, {parts} FROM s WHERE op IS NOT NULL"


MODES = {"none": Image.NONE, "full": Image.FULL, "only": Image.ONLY_UPDATED}


def _mode(before: str, after: str, how=correlate.by_change):
    o = CaptureOptions(before=MODES[before], after=MODES[after])

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return flat(how(events_log(spark, sf_dir), EVENTS, o, CHANGE_ID, ORDER), o)

    return run


query(mode_sql("full", "full"), "cdc_correlate_full_full")(_mode("full", "full"))
for _b, _a in product(MODES, MODES):
    query(mode_sql(_b, _a), f"cdc_mode_{_b}_{_a}")(_mode(_b, _a))
query(mode_sql("full", "full"), "cdc_state_machine_full_full")(_mode("full", "full", correlate.by_order))
query(mode_sql("full", "none"), "cdc_state_machine_full_none")(_mode("full", "none", correlate.by_order))

MISSING = " WHERE NOT (op = 0 AND event_id % 7 = 0) AND NOT (op IN (1, 2, 3) AND event_id % 11 = 0)"
TORN_SQL = SLOTS_SQL.replace("FROM log GROUP", f"FROM log{MISSING} GROUP")


def _torn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log without some before images and without some changes."""
    op = F.col("cdc_operation")
    return events_log(spark, sf_dir).where(~((op == 0) & (F.col("event_id") % 7 == 0)) & ~(op.isin(1, 2, 3) & (F.col("event_id") % 11 == 0)))


_INCOMPLETE = "(NOT has_chg OR (op = 1 AND NOT (has_pre AND has_post)) OR (op = 2 AND NOT has_post) OR (op = 3 AND NOT has_pre))"


@query(TORN_SQL + f"SELECT user_id, event_type, event_id, has_pre, has_chg AS has_change, has_post FROM s WHERE {_INCOMPLETE}")
def cdc_completion_incomplete(spark, sf_dir):
    return correlate.incomplete(_torn(spark, sf_dir), EVENTS, FULL, CHANGE_ID, ORDER)


@query(mode_sql("full", "full", TORN_SQL) + f" AND NOT {_INCOMPLETE}")
def cdc_orphan_images(spark, sf_dir):
    return flat(correlate.by_change(_torn(spark, sf_dir), EVENTS, FULL, CHANGE_ID, ORDER), FULL)


def _partition_deletes(spark, sf_dir):
    op = F.col("cdc_operation")
    return events_log(spark, sf_dir).withColumn("cdc_operation", F.when(op == 3, 4).otherwise(op))


@query(mode_sql("none", "full").replace("WHERE op IS NOT NULL", "WHERE op IN (1, 2)"))
def cdc_partition_delete_with_ck(spark, sf_dir):
    o = CaptureOptions(after=Image.FULL)
    return flat(correlate.by_change(_partition_deletes(spark, sf_dir), EVENTS, o, CHANGE_ID, ORDER), o)


@query(mode_sql("full", "full"))
def cdc_partition_delete_without_ck(spark, sf_dir):
    return flat(correlate.by_change(_partition_deletes(spark, sf_dir), EVENTS_ONE_ROW, FULL, CHANGE_ID, ORDER), FULL, EVENTS_ONE_ROW)


_NO_PRE = SLOTS_SQL.replace("FROM log GROUP", "FROM log WHERE NOT (op = 0 AND event_id % 7 = 0) GROUP")


@query(mode_sql("full", "none", _NO_PRE) + " AND (op = 2 OR has_pre)")
def cdc_partition_delete_wait_preimage(spark, sf_dir):
    o = CaptureOptions(before=Image.FULL, wait_preimage_for_partition_delete=True)
    log = _partition_deletes(spark, sf_dir).where(~((F.col("cdc_operation") == 0) & (F.col("event_id") % 7 == 0)))
    return flat(correlate.by_change(log, EVENTS_ONE_ROW, o, CHANGE_ID, ORDER), o, EVENTS_ONE_ROW)


def _tasks(log: DataFrame) -> DataFrame:
    return log.withColumn("task_id", F.pmod("user_id", F.lit(TASKS)))


@query(LOG_SQL + f"""
SELECT user_id % {TASKS} AS task_id, max(event_id) AS last_event_id, count(*)::BIGINT AS records,
       (count(*) FILTER (op IN (1, 2)))::BIGINT AS changes FROM log GROUP BY 1""")
def cdc_ignored_ops_progress(spark, sf_dir):
    """Deletes recoded as range deletes make no event, and still move the position on."""
    op = F.col("cdc_operation")
    log = _tasks(events_log(spark, sf_dir).withColumn("cdc_operation", F.when(op == 3, 5 + F.col("event_id") % 4).otherwise(op)))
    moved = filters.progress(log, ["task_id"], ["event_id", "cdc_batch_seq_no"], ["event_id"])
    kept = filters.changes(log, EVENTS).groupBy(F.col("task_id").alias("_t")).agg(F.count("*").alias("changes"))
    return moved.join(kept, F.col("task_id") == F.col("_t")).select("task_id", F.col("last.event_id").alias("last_event_id"), "records", "changes")


@query(LOG_SQL + "SELECT user_id, event_type, event_id, value IS NOT NULL AS mod_value, note IS NOT NULL OR del AS mod_note FROM log WHERE op IN (1, 2)")
def cdc_modified_columns(spark, sf_dir):
    log = events_log(spark, sf_dir)
    return log.where(F.col("cdc_operation").isin(1, 2)).select(*KEYS, *[filters.modified(c, log.columns).alias(f"mod_{c}") for c in EVENTS.columns])


#: Records in a partition's batches: all before images, then all changes, then all after images; `place` is where one stands.
BATCH_SQL = LOG_SQL + """, b AS (SELECT *, row_number() OVER (PARTITION BY user_id, n ORDER BY seq, event_id) AS place FROM log)"""


@query(BATCH_SQL + """ SELECT c.user_id, c.event_type, c.event_id, c.op, c.place, p.place AS pre_place, p.value AS pre_value, q.place AS post_place, q.value AS post_value
FROM b c LEFT JOIN b p ON p.event_id = c.event_id AND p.seq = 0 LEFT JOIN b q ON q.event_id = c.event_id AND q.seq = 2 WHERE c.seq = 1""")
def cdc_batch_alignment(spark, sf_dir):
    """Several rows of a partition in one batch: pairs are made by row, not by partition or place."""
    in_batch = Window.partitionBy("user_id", "n").orderBy("cdc_batch_seq_no", "event_id")
    log = events_log(spark, sf_dir).withColumn("place", F.row_number().over(in_batch).cast("long"))
    spec = EVENTS.with_columns("value", "place")
    e = correlate.by_order(log, spec, FULL, CHANGE_ID, ("n", "place"))
    return e.select(*KEYS, F.col("chg._op").alias("op"), F.col("chg.place").alias("place"), F.col("pre.place").alias("pre_place"), F.col("pre.value").alias("pre_value"),
                    F.col("post.place").alias("post_place"), F.col("post.value").alias("post_value"))


#: The state machine in SQL over the torn log, a step for each record of a row: k numbers its records, slots hold their numbers.
MACHINE_SQL = LOG_SQL.replace("WITH e AS", "WITH RECURSIVE e AS", 1) + f""",
t AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id, seq) AS k FROM log{MISSING}),
m AS (
  SELECT user_id, event_type, 0::BIGINT AS k, NULL::BIGINT AS pre, NULL::BIGINT AS chg, NULL::BIGINT AS post, NULL::INTEGER AS cop,
         NULL::BIGINT AS e_pre, NULL::BIGINT AS e_chg, NULL::BIGINT AS e_post, NULL::BIGINT AS lost FROM (SELECT DISTINCT user_id, event_type FROM t)
  UNION ALL
  SELECT user_id, event_type, k, CASE WHEN NOT done THEN pre END, CASE WHEN NOT done THEN chg END, CASE WHEN NOT done THEN post END, CASE WHEN NOT done THEN cop END,
         CASE WHEN done THEN pre END, CASE WHEN done THEN chg END, CASE WHEN done THEN post END, lost
  FROM (SELECT *, coalesce((cop = 1 AND pre IS NOT NULL AND post IS NOT NULL) OR (cop = 2 AND post IS NOT NULL) OR (cop = 3 AND pre IS NOT NULL), false) AS done
        FROM (SELECT t.user_id, t.event_type, t.k, CASE WHEN t.op = 0 THEN t.k ELSE m.pre END AS pre, CASE WHEN t.op IN (1, 2, 3) THEN t.k ELSE m.chg END AS chg,
                     CASE WHEN t.op = 9 THEN t.k ELSE m.post END AS post, CASE WHEN t.op IN (1, 2, 3) THEN t.op ELSE m.cop END AS cop, CASE WHEN t.op IN (1, 2, 3) THEN m.chg END AS lost
              FROM m JOIN t ON t.user_id = m.user_id AND t.event_type = m.event_type AND t.k = m.k + 1)))
"""


@query(MACHINE_SQL + """SELECT c.user_id, c.event_type, c.event_id, c.op, p.event_id AS pre_event, p.value AS pre_value, c.value AS value, q.event_id AS post_event, q.value AS post_value
FROM m JOIN t c ON c.user_id = m.user_id AND c.event_type = m.event_type AND c.k = m.e_chg
LEFT JOIN t p ON p.user_id = m.user_id AND p.event_type = m.event_type AND p.k = m.e_pre LEFT JOIN t q ON q.user_id = m.user_id AND q.event_type = m.event_type AND q.k = m.e_post""")
def cdc_state_machine_torn(spark, sf_dir):
    """Missing images and changes: what is left over pairs with a later change, whose images may be another event's."""
    log = _torn(spark, sf_dir).withColumn("of", F.col("event_id"))
    e = correlate.by_order(log, EVENTS.with_columns("value", "of"), FULL, CHANGE_ID, ORDER)
    return e.select(*KEYS, F.col("chg._op").alias("op"), F.col("pre.of").alias("pre_event"), F.col("pre.value").alias("pre_value"), F.col("chg.value").alias("value"),
                    F.col("post.of").alias("post_event"), F.col("post.value").alias("post_value"))


@query(MACHINE_SQL + f""", l AS (
  SELECT user_id, event_type, lost AS k, '{correlate.OVERWRITTEN}' AS reason FROM m WHERE lost IS NOT NULL
  UNION ALL SELECT user_id, event_type, chg, '{correlate.NO_IMAGE}' FROM m WHERE chg IS NOT NULL AND k = (SELECT max(x.k) FROM t x WHERE x.user_id = m.user_id AND x.event_type = m.event_type))
SELECT user_id, event_type, t.event_id, t.op, reason FROM l JOIN t USING (user_id, event_type, k)""")
def cdc_state_machine_incomplete(spark, sf_dir):
    """Changes that the state machine never completes, with the reason; with those that it does they are all changes."""
    e = correlate.state_machine(_torn(spark, sf_dir), EVENTS, FULL, CHANGE_ID, ORDER).where("reason IS NOT NULL AND chg IS NOT NULL")
    return e.select(*KEYS, F.col("chg._op").alias("op"), "reason")


@query(LOG_SQL + "SELECT user_id, event_type, event_id, note IS NOT NULL OR del OR event_id % 11 = 0 AS mod_note, value IS NOT NULL AS mod_value FROM log WHERE op = 1")
def cdc_removed_elements(spark, sf_dir):
    """A change that only removes elements of a collection modifies its column."""
    log = events_log(spark, sf_dir).where("cdc_operation = 1").withColumn("cdc_deleted_elements_note", F.when(F.col("event_id") % 11 == 0, F.array(F.col("event_id"))))
    return log.select(*KEYS, *[filters.modified(c, log.columns).alias(f"mod_{c}") for c in EVENTS.columns])


# -- the older format

def _legacy(spark, sf_dir):
    log = events_log(spark, sf_dir)
    return shape.legacy(correlate.with_last_preimage(log, EVENTS, CHANGE_ID, ORDER), EVENTS, KEYS)


_OP = "CASE op WHEN 1 THEN 'u' WHEN 2 THEN 'c' ELSE 'd' END AS op"


@query(SLOTS_SQL + f"SELECT user_id, event_type, event_id, {_OP}, chg_value IS NOT NULL AS value_cell, chg_value AS after_value, chg_note IS NOT NULL OR del AS note_cell, chg_note AS after_note FROM s WHERE op IN (1, 2)")
def cdc_legacy_cells(spark, sf_dir):
    e = _legacy(spark, sf_dir).where("op != 'd'")
    return e.select(*KEYS, "op", F.col("after.value").isNotNull().alias("value_cell"), F.col("after.value.value").alias("after_value"),
                    F.col("after.note").isNotNull().alias("note_cell"), F.col("after.note.value").alias("after_note"))


@query(SLOTS_SQL + f"SELECT user_id, event_type, event_id, {_OP}, has_pre AS has_before, pre_value AS before_value, has_pre AND (pre_note IS NOT NULL OR del) AS note_cell, pre_note AS before_note FROM s WHERE op IN (1, 2)")
def cdc_legacy_preimage(spark, sf_dir):
    e = _legacy(spark, sf_dir).where("op != 'd'")
    return e.select(*KEYS, "op", F.col("before").isNotNull().alias("has_before"), F.col("before.value.value").alias("before_value"),
                    F.col("before.note").isNotNull().alias("note_cell"), F.col("before.note.value").alias("before_note"))


@query(SLOTS_SQL.replace("FROM log GROUP", "FROM log WHERE NOT (op = 0 AND event_id % 2 = 0) GROUP")
       + "SELECT user_id, event_type, event_id, user_id AS before_user_id, has_pre AND pre_value IS NOT NULL AS value_cell, pre_value AS before_value, true AS no_after FROM s WHERE op = 3")
def cdc_legacy_delete(spark, sf_dir):
    log = events_log(spark, sf_dir).where(~((F.col("cdc_operation") == 0) & (F.col("event_id") % 2 == 0)))
    e = shape.legacy(correlate.with_last_preimage(log, EVENTS, CHANGE_ID, ORDER), EVENTS, KEYS).where("op = 'd'")
    return e.select(*KEYS, F.col("before.user_id").alias("before_user_id"), F.col("before.value").isNotNull().alias("value_cell"),
                    F.col("before.value.value").alias("before_value"), F.col("after").isNull().alias("no_after"))


# -- keys, headers, topics, tombstones

PLACES = {
    "default": frozenset({Place.KAFKA_KEY, Place.PAYLOAD_AFTER, Place.PAYLOAD_BEFORE}), "kafka_key": frozenset({Place.KAFKA_KEY}),
    "payload_key": frozenset({Place.PAYLOAD_KEY}), "all": frozenset(Place),
}


def _events(spark, sf_dir, o: CaptureOptions) -> DataFrame:
    log = events_log(spark, sf_dir)
    slots = correlate.by_change(log, EVENTS, o, (*CHANGE_ID, "change_ts"), ORDER)
    return shape.envelope(slots, EVENTS, o, F.unix_micros("change_ts"), F.lit(0).cast("long"), KEYS)


def _field(df: DataFrame, path: str) -> Column:
    kind = df.schema
    for p in path.split("."):
        kind = kind[p].dataType if p in kind.names else None
        if kind is None:
            return F.lit(None).cast("long")
    return F.col(path)


def _placement(which: str):
    o = FULL.with_(places=PLACES[which])

    def run(spark, sf_dir):
        e = _events(spark, sf_dir, o)
        return e.select("event_id", *[_field(e, p).cast("long").alias(a) for p, a in (
            ("key.user_id", "key_user_id"), ("value.key.user_id", "payload_user_id"), ("value.before.user_id", "before_user_id"), ("value.after.user_id", "after_user_id"))],
            F.coalesce(F.size("headers"), F.lit(0)).cast("long").alias("n_headers"))

    def on(*names: Place) -> str:
        return "user_id" if set(names) & PLACES[which] else "NULL"

    sql = SLOTS_SQL + f"""SELECT event_id, CAST({on(Place.KAFKA_KEY)} AS BIGINT) AS key_user_id, CAST({on(Place.PAYLOAD_KEY)} AS BIGINT) AS payload_user_id,
      CAST(CASE WHEN op IN (1, 3) THEN {on(Place.PAYLOAD_BEFORE)} END AS BIGINT) AS before_user_id, CAST(CASE WHEN op IN (1, 2) THEN {on(Place.PAYLOAD_AFTER)} END AS BIGINT) AS after_user_id,
      CAST({2 if Place.KAFKA_HEADERS in PLACES[which] else 0} AS BIGINT) AS n_headers FROM s WHERE op IS NOT NULL"""
    query(sql, f"cdc_pk_placement_{which}")(run)


for _which in PLACES:
    _placement(_which)


@query(SLOTS_SQL + "SELECT event_id, user_id AS key_user_id, event_type AS key_event_type FROM s WHERE op IS NOT NULL")
def cdc_kafka_key(spark, sf_dir):
    return _events(spark, sf_dir, FULL).select("event_id", F.col("key.user_id").alias("key_user_id"), F.col("key.event_type").alias("key_event_type"))


@query(SLOTS_SQL + "SELECT event_id, 'pk.user_id' AS header, CAST(user_id AS VARCHAR) AS text FROM s WHERE op IS NOT NULL UNION ALL SELECT event_id, 'ck.event_type', event_type FROM s WHERE op IS NOT NULL")
def cdc_headers(spark, sf_dir):
    e = _events(spark, sf_dir, FULL.with_(places=frozenset({Place.KAFKA_HEADERS})))
    return e.select("event_id", F.explode("headers").alias("h")).select("event_id", F.col("h.key").alias("header"), F.col("h.value").cast("string").alias("text"))


def _orders(spark, sf_dir, o: CaptureOptions) -> DataFrame:
    slots = correlate.by_change(orders_log(spark, sf_dir), ORDERS, o, ("step", "change_ts"), ("step", "cdc_batch_seq_no"))
    return shape.envelope(slots, ORDERS, o, F.unix_micros("change_ts"), F.lit(0).cast("long"), ("o_orderkey",))


@query(SLOTS_SQL + """SELECT 'app.shop.events' AS topic, CASE op WHEN 1 THEN 'u' WHEN 2 THEN 'c' ELSE 'd' END AS op, count(*)::BIGINT AS n FROM s WHERE op IS NOT NULL GROUP BY ALL
UNION ALL SELECT 'app.shop.orders', 'c', count(*)::BIGINT FROM orders HAVING count(*) > 0
UNION ALL SELECT 'app.shop.orders', 'd', count(*)::BIGINT FROM orders WHERE o_orderstatus = 'F' HAVING count(*) > 0""")
def cdc_topic(spark, sf_dir):
    both = [_events(spark, sf_dir, FULL), _orders(spark, sf_dir, FULL)]
    a, b = (x.select("topic", F.col("value.op").alias("op")) for x in both)
    return a.unionByName(b).groupBy("topic", "op").agg(F.count("*").alias("n"))


@query("""SELECT o_orderkey, 0 AS part, 'c' AS op, o_custkey AS key_custkey, o_totalprice AS price FROM orders
UNION ALL SELECT o_orderkey, 0, 'd', o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT o_orderkey, 1, NULL, o_custkey, NULL FROM orders WHERE o_orderstatus = 'F'""")
def cdc_tombstones(spark, sf_dir):
    e = shape.with_tombstones(_orders(spark, sf_dir, FULL))
    return e.select("o_orderkey", "part", F.col("value.op").alias("op"), F.col("key.o_custkey").alias("key_custkey"),
                    F.coalesce("value.after.o_totalprice", "value.before.o_totalprice").alias("price"))


@query(LOG_SQL + """SELECT event_id, 'app' AS name, 'shop' AS db, 'events' AS table_name, epoch_us(ts) AS ts_us, epoch_us(ts) // 1000 AS ts_ms FROM log WHERE op IN (1, 2, 3)""")
def cdc_source_metadata(spark, sf_dir):
    o = CaptureOptions(logical_name="app")
    log = with_time(events_log(spark, sf_dir))
    slots = correlate.by_change(log, EVENTS, o, (*CHANGE_ID, "cdc_time"), ORDER)
    e = shape.envelope(slots, EVENTS, o, timeuuid.micros("cdc_time"), F.lit(0).cast("long"), KEYS)
    return e.select("event_id", *[F.col(f"value.source.{c}").alias(c) for c in ("name", "db", "table_name", "ts_us", "ts_ms")])


# -- transforms and consumers

@query(SLOTS_SQL + f"SELECT event_id, {_OP}, CASE WHEN op <> 3 THEN user_id END AS user_id, chg_value AS value, chg_note AS note FROM s WHERE op IS NOT NULL")
def cdc_new_record_state(spark, sf_dir):
    e = _legacy(spark, sf_dir).select("event_id", "op", "before", "after")
    return transforms.new_record_state(e, Format.LEGACY).select("event_id", "op", "user_id", "value", "note")


@query(SLOTS_SQL + f"SELECT event_id, {_OP}, CASE WHEN op = 3 OR has_pre THEN pre_value END AS before_value, chg_value AS after_value, chg_note AS after_note FROM s WHERE op IS NOT NULL")
def cdc_flatten_columns(spark, sf_dir):
    e = transforms.flatten_columns(_legacy(spark, sf_dir))
    return e.select("event_id", "op", F.col("before.value").alias("before_value"), F.col("after.value").alias("after_value"), F.col("after.note").alias("after_note"))


@query(SLOTS_SQL + """, l AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS k FROM s WHERE op IS NOT NULL)
SELECT user_id, event_type, post_value AS value, post_note AS note FROM l WHERE k = 1 AND op <> 3""")
def cdc_latest_state(spark, sf_dir):
    """An addition: what the table looks like after the log."""
    o = FULL
    e = shape.images(correlate.by_change(events_log(spark, sf_dir), EVENTS, o, (*CHANGE_ID, "change_ts"), ORDER), EVENTS, o, (*KEYS, "change_ts"))
    last = transforms.latest_state(e, ("user_id", "event_type"), ("change_ts", "event_id"))
    return last.select("user_id", "event_type", F.col("after.value").alias("value"), F.col("after.note").alias("note"))


@query(SLOTS_SQL + f", t AS (SELECT event_type, {_OP}, user_id FROM s WHERE op IS NOT NULL) SELECT event_type, op, count(*)::BIGINT AS n, count(DISTINCT user_id)::BIGINT AS users FROM t GROUP BY ALL")
def cdc_change_counts(spark, sf_dir):
    """An addition: changes by kind."""
    e = flat(correlate.by_change(events_log(spark, sf_dir), EVENTS, CaptureOptions(), CHANGE_ID, ORDER), CaptureOptions())
    return e.groupBy("event_type", "op").agg(F.count("*").alias("n"), F.countDistinct("user_id").alias("users"))


# -- types and functions

@query(LOG_SQL + "SELECT event_id, epoch_us(ts) AS us FROM log WHERE seq = 1")
def cdc_timeuuid_us(spark, sf_dir):
    log = with_time(events_log(spark, sf_dir).where("cdc_batch_seq_no = 1"))
    return log.select("event_id", timeuuid.micros("cdc_time").alias("us"))


@query("""WITH e AS (SELECT event_id, user_id, value, epoch_us(ts) * 10 + 122192928000000000 AS t FROM events),
k AS (SELECT *, ((t % 4294967296) * 4294967296 + ((t // 4294967296) % 65536) * 65536 + 4096 + t // 281474976710656) AS h FROM (SELECT event_id, user_id, value, CAST(t AS HUGEINT) AS t FROM e)),
s AS (SELECT *, CASE WHEN h >= 9223372036854775808 THEN h - 18446744073709551616 ELSE h END AS high FROM k)
SELECT user_id, array_to_string(list(event_id ORDER BY high, event_id), ',') AS reference_order, array_to_string(list(event_id ORDER BY t, event_id), ',') AS chronological FROM s GROUP BY user_id""")
def cdc_nonfrozen_list(spark, sf_dir):
    e = events(spark, sf_dir).select("event_id", "user_id", timeuuid.from_micros(F.unix_micros("ts"), F.col("event_id")).alias("k"))
    m = e.groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("k", "event_id"))).alias("m"))
    return m.select("user_id", F.array_join(wire.ordered_values(F.col("m")), ",").alias("reference_order"), F.array_join(wire.ordered_values(F.col("m"), chronological=True), ",").alias("chronological"))


@query("SELECT o_orderkey, 1 AS key_a, o_orderpriority AS key_b, o_totalprice AS value FROM orders UNION ALL SELECT o_orderkey, 2, o_orderstatus, o_totalprice + 1 FROM orders")
def cdc_map_entries(spark, sf_dir):
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    m = F.create_map(F.struct(F.lit(1).alias("a"), F.col("o_orderpriority").alias("b")), F.col("o_totalprice"), F.struct(F.lit(2).alias("a"), F.col("o_orderstatus").alias("b")), F.col("o_totalprice") + 1)
    return o.select("o_orderkey", F.explode(wire.entries(m)).alias("e")).select("o_orderkey", F.col("e.key.a").alias("key_a"), F.col("e.key.b").alias("key_b"), F.col("e.value").alias("value"))


@query("SELECT p_partkey, p_size AS field_0, p_brand AS field_1, CASE WHEN p_size % 5 = 0 THEN NULL ELSE p_retailprice END AS field_2, true AS is_struct FROM part")
def cdc_tuple_struct(spark, sf_dir):
    p = spark.read.parquet(f"{sf_dir}/part.parquet")
    t = wire.tuple_struct(F.col("p_size"), F.col("p_brand"), F.when(F.col("p_size") % 5 != 0, F.col("p_retailprice")))
    return p.select("p_partkey", t.alias("t")).select("p_partkey", "t.*", F.col("t").isNotNull().alias("is_struct"))


@query("""SELECT p_partkey, CASE WHEN p_size % 3 = 0 AND p_size % 2 = 0 THEN true ELSE false END AS is_null, p_size % 3 = 0 AS inner_null,
CASE WHEN p_size % 2 <> 0 THEN p_size END AS z FROM part""")
def cdc_udt_collapse(spark, sf_dir):
    p = spark.read.parquet(f"{sf_dir}/part.parquet")
    on = F.col("p_size") % 3 != 0
    inner = F.struct(F.when(on, F.col("p_size")).alias("x"), F.when(on, F.col("p_brand")).alias("y"))
    made = p.select("p_partkey", F.struct(inner.alias("inner"), F.when(F.col("p_size") % 2 != 0, F.col("p_size")).alias("z"), F.array().cast("array<int>").alias("l")).alias("u"))
    u = made.select("p_partkey", wire.collapse_udt(F.col("u"), made.schema["u"].dataType).alias("u"))
    return u.select("p_partkey", F.col("u").isNull().alias("is_null"), F.col("u.inner").isNull().alias("inner_null"), F.col("u.z").alias("z"))


@query("""SELECT o_orderkey, epoch_us(o_orderdate) // 1000 AS ts_ms, CAST(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS INTEGER) AS days,
CAST(o_custkey AS VARCHAR) AS varint, base64(encode(o_orderpriority)) AS blob_text, CAST(o_custkey % 100 AS TINYINT) AS tiny FROM orders""")
def cdc_scalar_wire(spark, sf_dir):
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return o.select("o_orderkey", wire.scalar(instant(o, "o_orderdate"), "timestamp").alias("ts_ms"), wire.scalar(F.to_date("o_orderdate"), "date").alias("days"),
                    wire.scalar(F.col("o_custkey"), "varint").alias("varint"), F.base64(wire.scalar(F.col("o_orderpriority"), "blob")).alias("blob_text"),
                    wire.scalar(F.col("o_custkey") % 100, "tinyint").alias("tiny"))


_DAYS = "CAST(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS INTEGER)"


@query(f"""SELECT o_orderkey, o_orderstatus AS ascii, o_orderpriority AS text, o_orderpriority AS varchar, o_orderkey AS bigint, o_custkey AS counter, CAST(o_custkey % 1000 AS INTEGER) AS int,
CAST(o_custkey % 1000 AS SMALLINT) AS smallint, CAST(o_custkey % 100 AS TINYINT) AS tinyint, CAST(o_totalprice AS FLOAT) AS float, o_totalprice AS double, o_custkey % 2 = 0 AS boolean,
base64(encode(o_orderpriority)) AS blob, {_DAYS} AS date, o_orderkey * 1000 AS time, epoch_us(o_orderdate) // 1000 AS timestamp, CAST(CAST(o_custkey AS DECIMAL(12, 2)) AS VARCHAR) AS decimal,
CAST(o_custkey * 1000000007 AS VARCHAR) AS varint, '00000000-0000-4000-8000-' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS uuid,
'00000000-0000-1000-8000-' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS timeuuid, '10.0.0.' || (o_custkey % 256) AS inet, '1d' || (o_custkey % 24) || 'h' AS duration FROM orders""")
def cdc_scalar_types(spark, sf_dir):
    """Every scalar type, with nulls left out of none."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    key, cust, prio = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderpriority")
    tail = F.lpad(key.cast("string"), 12, "0")
    source = {
        "ascii": F.col("o_orderstatus"), "text": prio, "varchar": prio, "bigint": key, "counter": cust, "int": cust % 1000, "smallint": cust % 1000, "tinyint": cust % 100,
        "float": F.col("o_totalprice"), "double": F.col("o_totalprice"), "boolean": cust % 2 == 0, "blob": prio.cast("binary"), "date": F.to_date(instant(o, "o_orderdate")), "time": key * 1000,
        "timestamp": instant(o, "o_orderdate"), "decimal": cust.cast("decimal(12,2)"), "varint": (cust * 1000000007).cast("decimal(38,0)"), "uuid": F.concat(F.lit("00000000-0000-4000-8000-"), tail),
        "timeuuid": F.concat(F.lit("00000000-0000-1000-8000-"), tail), "inet": F.concat(F.lit("10.0.0."), (cust % 256).cast("string")), "duration": F.concat(F.lit("1d"), (cust % 24).cast("string"), F.lit("h")),
    }
    made = {t: wire.value(c, wire.parse_type(t)) for t, c in source.items()}
    return o.select("o_orderkey", *[(F.base64(c) if t == "blob" else c).alias(t) for t, c in made.items()])


#: Nested types by column, and user types (fixed values of the query below).
NESTED = {
    "dates": "frozen<list<date>>", "times_of": "map<int, frozen<list<timestamp>>>", "by_pair": "frozen<map<frozen<tuple<int, date>>, text>>",
    "pair": "tuple<int, frozen<set<timestamp>>>", "outer": "frozen<outer_type>", "kept": "map<timeuuid, date>",
}
USER_TYPES = {"inner_type": {"x": "date", "y": "varint"}, "outer_type": {"inner": "frozen<inner_type>", "l": "list<date>", "z": "int"}}


@query(f"""WITH o AS (SELECT o_orderkey, CAST(o_custkey % 1000 AS INTEGER) AS c, o_orderpriority AS p, {_DAYS} AS d, epoch_us(o_orderdate) // 1000 AS ms FROM orders)
SELECT o_orderkey, CAST(to_json([d, d + 1]) AS VARCHAR) AS dates, CAST(to_json([{{'key': c, 'value': [ms]}}, {{'key': -1, 'value': []::BIGINT[]}}]) AS VARCHAR) AS times_of,
CAST(to_json([{{'key': {{'field_0': c, 'field_1': d}}, 'value': p}}]) AS VARCHAR) AS by_pair, CAST(to_json({{'field_0': CASE WHEN c % 4 > 0 THEN c END, 'field_1': CASE WHEN c % 3 > 0 THEN [ms] END}}) AS VARCHAR) AS pair,
CASE WHEN c % 3 > 0 OR c % 4 > 0 THEN CAST(to_json({{'inner': CASE WHEN c % 3 > 0 THEN {{'x': d, 'y': CAST(c AS VARCHAR)}} END, 'l': []::INTEGER[], 'z': CASE WHEN c % 4 > 0 THEN c END}}) AS VARCHAR) END AS "outer",
CAST(to_json([d + 1, d]) AS VARCHAR) AS kept FROM o""")
def cdc_types_nested(spark, sf_dir):
    """Collections, tuples and user types within each other, translated at every depth."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    c, at, day = (F.col("o_custkey") % 1000).cast("int"), instant(o, "o_orderdate"), F.to_date(instant(o, "o_orderdate"))
    some, any_ = c % 3 > 0, c % 4 > 0
    no_times = F.array().cast("array<timestamp>")
    columns = {
        "dates": F.array(day, F.date_add(day, 1)), "times_of": F.create_map(c, F.array(at), F.lit(-1), no_times), "by_pair": F.create_map(wire.tuple_struct(c, day), F.col("o_orderpriority")),
        "pair": wire.tuple_struct(F.when(any_, c), F.when(some, F.array(at))),
        "outer": F.struct(F.struct(F.when(some, day).alias("x"), F.when(some, c).cast("decimal(38,0)").alias("y")).alias("inner"), F.array().cast("array<date>").alias("l"), F.when(any_, c).alias("z")),
        "kept": F.create_map(F.lit("00000002-0000-1000-8000-000000000001"), day, F.lit("00000001-0000-1000-8000-000000000001"), F.date_add(day, 1)),
    }
    made = {n: wire.value(columns[n], wire.parse_type(t, USER_TYPES), wire.parse_type("list<date>") if n == "kept" else None) for n, t in NESTED.items()}
    return o.select("o_orderkey", *[F.to_json(v, {"ignoreNullFields": "false"}).alias(n) for n, v in made.items()])


# -- reading and planning

#: 2024-01-20 00:00 UTC, a fixed present for the queries below.
NOW_MS = 1705708800000
DAY_MS = 86_400_000


@query(f"SELECT event_id FROM events WHERE epoch_us(ts) // 1000 >= {NOW_MS - 3 * DAY_MS} AND epoch_us(ts) // 1000 < {NOW_MS - 2 * DAY_MS}")
def cdc_initial_lookback(spark, sf_dir):
    o = CaptureOptions(lookback=3 * DAY_MS, query_window=DAY_MS)
    return windows.read(spark.read.parquet(f"{sf_dir}/events.parquet"), windows.first_window(o, NOW_MS), "ts").select("event_id")


@query("SELECT epoch_us(ts) // 1000 - epoch_us(ts) // 1000 % 30000 AS window_start_ms, count(*)::BIGINT AS n FROM events GROUP BY 1")
def cdc_time_window_slices(spark, sf_dir):
    return windows.slices(spark.read.parquet(f"{sf_dir}/events.parquet"), CaptureOptions(), "ts").groupBy("window_start_ms").agg(F.count("*").alias("n"))


@query(f"SELECT event_id FROM events WHERE ts < make_timestamp({(NOW_MS - 30000) * 1000})")
def cdc_confidence_cutoff(spark, sf_dir):
    return windows.confident(spark.read.parquet(f"{sf_dir}/events.parquet"), CaptureOptions(), NOW_MS, "ts").select("event_id")


@query(f"SELECT event_id FROM events WHERE event_id > (SELECT max(x.event_id) FROM events x WHERE x.user_id % {TASKS} = events.user_id % {TASKS} AND x.event_id % 2 = 0 AND x.event_id < 500) OR user_id % {TASKS} = 0")
def cdc_resume_from_offset(spark, sf_dir):
    e = _tasks(spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "user_id"))
    saved = filters.progress(e.where("event_id % 2 = 0 AND event_id < 500 AND task_id != 0"), ["task_id"], ["event_id"], ["event_id"])
    return windows.resume(e, saved, ("task_id",), ("event_id",)).select("event_id")


@query("""WITH t AS (SELECT '1;' || n_nationkey || ';shop;events;' || lower(hex('s' || n_nationkey)) AS task FROM nation),
r AS (SELECT task, row_number() OVER (ORDER BY task) - 1 AS i, count(*) OVER () AS n FROM t)
SELECT task, CAST(i // CAST(ceil(n / 4.0) AS BIGINT) AS BIGINT) AS worker FROM r""")
def cdc_task_packing(spark, sf_dir):
    n = spark.read.parquet(f"{sf_dir}/nation.parquet")
    t = n.select(tasks.serialise(F.lit(1), F.col("n_nationkey"), F.lit("shop"), F.lit("events"), F.array(F.concat(F.lit("s"), F.col("n_nationkey").cast("string")).cast("binary"))).alias("task"))
    return tasks.pack(t, "task", 4)


@query("SELECT n_nationkey, 's' || n_nationkey AS stream, 'events' AS tbl FROM nation")
def cdc_task_parse(spark, sf_dir):
    n = spark.read.parquet(f"{sf_dir}/nation.parquet")
    s = tasks.serialise(F.lit(1), F.col("n_nationkey"), F.lit("shop"), F.lit("events"), F.array(F.concat(F.lit("s"), F.col("n_nationkey").cast("string")).cast("binary")))
    return n.select("n_nationkey", tasks.parse(s).alias("t")).select("n_nationkey", F.get("t.stream_ids", F.lit(0)).cast("string").alias("stream"), F.col("t.table").alias("tbl"))


@query(f"SELECT bool_and(m > 1704067200000) AS drained FROM (SELECT user_id % {TASKS}, max(epoch_us(ts) // 1000) AS m FROM events GROUP BY 1)")
def cdc_drained_until(spark, sf_dir):
    e = _tasks(events(spark, sf_dir)).groupBy("task_id").agg(F.max(F.unix_millis("ts")).alias("window_start_ms"))
    return filters.drained(e, 1704067200000)


@query("SELECT n_nationkey AS id, CASE WHEN n_nationkey < 15 THEN 'a' ELSE 'b' END AS origin FROM nation WHERE n_nationkey < 15 OR n_nationkey >= 10")
def cdc_task_merge(spark, sf_dir):
    n = spark.read.parquet(f"{sf_dir}/nation.parquet").select(F.col("n_nationkey").alias("id"))
    return filters.merge_tasks(n.where("id < 15").withColumn("origin", F.lit("a")), n.where("id >= 10").withColumn("origin", F.lit("b")), key=["id"])


_OPTION_CASES = """WITH c AS (SELECT m, n_name AS tbl, n_nationkey % 6 AS k FROM nation, (VALUES ('both'), ('before'), ('none')) v(m))
SELECT m AS mode, tbl, 'warning' AS level, 'the table was not found' AS problem FROM c WHERE k = 5 AND m <> 'none'
UNION ALL SELECT m, tbl, 'error', 'cdc is not enabled' FROM c WHERE k = 0 AND m <> 'none'
UNION ALL SELECT m, tbl, 'error', 'preimage is not enabled' FROM c WHERE k IN (1, 2, 4) AND m <> 'none'
UNION ALL SELECT m, tbl, 'error', 'postimage is not enabled' FROM c WHERE k = 1 AND m = 'both'"""


@query(_OPTION_CASES)
def cdc_table_option_errors(spark, sf_dir):
    """Tables by n % 6: 0 off, 1 on without images, 2 no before image, 3 all on, 4 the text `full` for the before image, 5 missing."""
    n = spark.read.parquet(f"{sf_dir}/nation.parquet").select(F.col("n_name").alias("tbl"), (F.col("n_nationkey") % 6).alias("k"))
    k = F.col("k")
    opts = F.create_map(F.lit("enabled"), F.when(k > 0, F.lit("TRUE")).otherwise(F.lit("false")), F.lit("preimage"), F.when(k == 3, F.lit("true")).when(k == 4, F.lit("full")).otherwise(F.lit("false")),
                        F.lit("postimage"), F.when(k >= 2, F.lit("True")).otherwise(F.lit("false")))
    found = n.where("k < 5").withColumn("options", opts)
    modes = {"both": FULL, "before": CaptureOptions(before=Image.ONLY_UPDATED), "none": CaptureOptions()}
    out = [validate.table_errors(found, n, o).select(F.lit(m).alias("mode"), "tbl", "level", "problem") for m, o in modes.items()]
    return out[0].unionByName(out[1]).unionByName(out[2])


@query("SELECT n_nationkey, n_nationkey >= 11 AS gate FROM nation")
def cdc_version_gate(spark, sf_dir):
    n = spark.read.parquet(f"{sf_dir}/nation.parquet")
    text = F.concat(F.lit("release "), F.when(F.col("n_nationkey") < 24, F.concat((F.col("n_nationkey") + 2015).cast("string"), F.lit(".1.0-rc1"))).otherwise(F.lit("2039.10.2")))
    return n.select("n_nationkey", validate.at_least(text, validate.PARTITION_DELETE_PREIMAGES).alias("gate"))


@query("""SELECT o_orderkey, 'd' AS op, o_totalprice AS before_price FROM orders WHERE o_orderstatus = 'F'""")
def cdc_ttl_delete(spark, sf_dir):
    """A row that expires comes as a delete with its before image."""
    return _orders(spark, sf_dir, FULL).where("value.op = 'd'").select("o_orderkey", F.col("value.op").alias("op"), F.col("value.before.o_totalprice").alias("before_price"))


@query("SELECT 'shop.orders' AS ks_tbl, count(*)::BIGINT AS n FROM orders HAVING count(*) > 0")
def cdc_table_selection(spark, sf_dir):
    rows = [spark.read.parquet(f"{sf_dir}/{t}.parquet").select(F.lit("shop").alias("ks"), F.lit(t).alias("tbl")) for t in ("orders", "customer")]
    kept = filters.tables(rows[0].unionByName(rows[1]), frozenset({("shop", "orders")}))
    return kept.groupBy(F.concat_ws(".", "ks", "tbl").alias("ks_tbl")).agg(F.count("*").alias("n"))


@query(SLOTS_SQL + """SELECT event_id, op, o.user_id AS pk_user, o.half AS pk_half, o.event_type AS ck_type, o.parity AS ck_parity,
'ck.event_type=' || o.event_type || ',ck.parity=' || o.parity || ',pk.half=' || o.half || ',pk.user_id=' || o.user_id AS headers, pre_value AS before_value
FROM (SELECT *, CASE WHEN user_id % 2 = 0 THEN 'even' ELSE 'odd' END AS half, user_id % 5 AS parity FROM s WHERE op IS NOT NULL) o""")
def cdc_composite_key(spark, sf_dir):
    """Two partition and two clustering columns: key order, headers, and a delete with its before image."""
    spec = EVENTS.with_key(("user_id", "half"), ("event_type", "parity"))
    user = F.col("user_id")
    log = events_log(spark, sf_dir).withColumns({"half": F.when(user % 2 == 0, "even").otherwise("odd"), "parity": user % 5})
    o = FULL.with_(places=frozenset({Place.KAFKA_KEY, Place.KAFKA_HEADERS}))
    e = shape.envelope(correlate.by_change(log, spec, o, (*CHANGE_ID, "change_ts"), ORDER), spec, o, F.unix_micros("change_ts"), F.lit(0).cast("long"), ("event_id",))
    headers = F.transform(F.sort_array("headers"), lambda h: F.concat(h["key"], F.lit("="), h["value"].cast("string")))
    op = F.when(F.col("value.op") == "u", 1).when(F.col("value.op") == "c", 2).otherwise(3)
    names = dict(zip(e.schema["key"].dataType.names, ("pk_user", "pk_half", "ck_type", "ck_parity")))  # by position: partition columns come first
    return e.select("event_id", op.alias("op"), *[F.col(f"key.{n}").alias(a) for n, a in names.items()], F.array_join(headers, ",").alias("headers"), F.col("value.before.value").alias("before_value"))


@query(f"""SELECT user_id % {TASKS} AS task_id, {NOW_MS} AS ts_ms FROM events GROUP BY 1 HAVING user_id % {TASKS} = 0 OR {NOW_MS} - max(epoch_us(ts) // 1000) >= -{9 * DAY_MS}""")
def cdc_heartbeats(spark, sf_dir):
    """Tasks whose last beat, here their last event, is long enough ago, and one that never beat."""
    last = F.when(F.col("task_id") != 0, F.max(F.unix_millis("ts")))
    offsets = _tasks(events(spark, sf_dir)).groupBy("task_id").agg(last.alias("last_beat_ms"))
    return filters.heartbeats(offsets, ["task_id"], NOW_MS, -9 * DAY_MS)


@query("""WITH l AS (SELECT event_id, event_id % 3 * 100 AS generation_start FROM events), o AS (SELECT n_nationkey % 3 * 100 AS g, CASE WHEN n_nationkey % 3 = 0 THEN 150 + n_nationkey ELSE 160 END AS w FROM nation)
SELECT event_id, generation_start FROM l WHERE NOT EXISTS (SELECT 1 FROM o WHERE g < generation_start AND w <= generation_start)""")
def cdc_current_generation(spark, sf_dir):
    """A generation opens when every task of all older ones has passed its start: 0 and 100 have, 200 has to wait."""
    log = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", (F.col("event_id") % 3 * 100).alias("generation_start"))
    k = F.col("n_nationkey")
    offsets = spark.read.parquet(f"{sf_dir}/nation.parquet").select((k % 3 * 100).cast("long").alias("generation_start"), F.when(k % 3 == 0, 150 + k).otherwise(160).cast("long").alias("window_start_ms"))
    return filters.current_generation(log, offsets)


@query("SELECT n_nationkey, n_name, n_regionkey, true AS optional FROM nation")
def cdc_make_optional(spark, sf_dir):
    """The same rows, every scalar column nullable."""
    n = spark.read.parquet(f"{sf_dir}/nation.parquet").select("n_nationkey", "n_name", F.coalesce("n_regionkey", F.lit(-1)).alias("n_regionkey"))
    made = transforms.make_optional(n)
    return made.withColumn("optional", F.lit(all(f.nullable for f in made.schema.fields)))


@query(SLOTS_SQL + f"SELECT event_id, {_OP}, user_id AS key_user_id, CASE WHEN op IN (1, 2) THEN 1 ELSE 0 END AS has_after, 'struct' AS schema_type, CAST(CASE WHEN op = 3 THEN pre_note WHEN op = 1 THEN CASE WHEN chg_note IS NOT NULL OR del THEN pre_note ELSE post_note END END AS VARCHAR) AS before_note FROM s WHERE op IS NOT NULL")
def cdc_json_sink(spark, sf_dir):
    """Keys and values as JSON with their schemas."""
    e = sinks.as_json(_events(spark, sf_dir, FULL), schemas=True, prefix="app.shop.events.")
    def part(c, p):
        return F.get_json_object(c, f"$.payload.{p}")

    return e.select("event_id", part("value", "op").alias("op"), part("key", "user_id").cast("long").alias("key_user_id"), part("value", "after").isNotNull().cast("int").alias("has_after"),
                    F.get_json_object("value", "$.schema.type").alias("schema_type"), part("value", "before.note").alias("before_note"))


@query(SLOTS_SQL + """, l AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS k FROM s WHERE op IS NOT NULL)
SELECT user_id, event_type, event_id, CASE op WHEN 1 THEN 'u' WHEN 2 THEN 'c' ELSE 'd' END AS op FROM l WHERE k = 1""")
def cdc_upsert_sink(spark, sf_dir):
    """The log in four batches, the second of them twice, into a table by key."""
    from ..streaming.run import fresh_dir

    e = _events(spark, sf_dir, FULL).select(*KEYS, F.col("value.source.ts_us").alias("ts_us"), F.col("value.op").alias("op"))
    store = sinks.KeyedTable(spark, fresh_dir(spark, "upsert"), ("user_id", "event_type"), ("ts_us", "event_id"), parts=8)
    for i in (0, 1, 1, 2, 3):
        store.apply(e.where(F.pmod("event_id", F.lit(4)) == i), i)
    return store.read().select("user_id", "event_type", "event_id", "op")


@query()
def cdc_stream_correlate(spark, sf_dir):
    """The derived log as a stream of files; rows only, as SQL has no streams."""
    from ..streaming.run import correlate_files

    return correlate_files(spark, events_log(spark, sf_dir), EVENTS, FULL, CHANGE_ID, ORDER)
