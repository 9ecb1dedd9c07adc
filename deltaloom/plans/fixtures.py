"""Change logs derived from the test tables: a row key is (user_id, event_type), a change is an event.

Of every five changes of a row the first inserts, the fifth deletes, the others update. Images carry the row before
and after. Column `value` is set by every insert and update; `note` by every third event, and set to null by every
seventh; otherwise it stays as it is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.instants import instant
from ..functions.timeuuid import from_micros
from ..model import TableSpec

EVENTS = TableSpec("shop", "events", ("user_id",), ("event_type",), ("value", "note"))
EVENTS_ONE_ROW = TableSpec("shop", "events_flat", ("user_id", "event_type"), (), ("value", "note"))
ORDERS = TableSpec("shop", "orders", ("o_custkey",), ("o_orderkey",), ("o_totalprice", "o_orderstatus"))
CHANGE_ID = ("event_id",)
ORDER = ("change_ts", "event_id", "cdc_batch_seq_no")
TASKS = 8


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    return e.withColumn("ts", instant(e, "ts"))


def events_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One scan and one window shuffle; each event becomes its two or three log records by an explode."""
    w = Window.partitionBy("user_id", "event_type").orderBy("ts", "event_id")
    upto, before = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(Window.unboundedPreceding, -1)
    third = F.when(F.col("event_id") % 3 == 0, F.col("event_id"))
    e = (
        events(spark, sf_dir).select("event_id", "ts", "user_id", "event_type", "value")
        .withColumn("n", F.row_number().over(w)).withColumn("prev", F.lag("value").over(w))
        .withColumn("kept", F.max(third).over(upto)).withColumn("kept_before", F.max(third).over(before))
        .withColumn("op", F.when(F.col("n") % 5 == 1, 2).when(F.col("n") % 5 == 0, 3).otherwise(1))
    )
    nulled = F.col("event_id") % 7 == 0

    def rec(seq, op, value, note, deleted):
        return F.struct(F.lit(seq).alias("seq"), op.cast("int").alias("op"), value.alias("value"), note.alias("note"), deleted.alias("deleted"))

    none, no = F.lit(None), F.lit(False)
    is_delete = F.col("op") == 3
    pre = F.when(F.col("op") != 2, rec(0, F.lit(0), F.col("prev"), F.col("kept_before"), no))
    change = rec(1, F.col("op"), F.when(~is_delete, F.col("value")), F.when(is_delete | nulled, none.cast("long")).otherwise(third), ~is_delete & nulled)
    post = F.when(~is_delete, rec(2, F.lit(9), F.col("value"), F.when(~nulled, F.col("kept")), no))
    return e.select("user_id", "event_type", "event_id", "ts", "n", F.explode(F.filter(F.array(pre, change, post), lambda r: r.isNotNull())).alias("r")).select(
        "user_id", "event_type", "event_id", F.col("ts").alias("change_ts"), "n", F.col("r.seq").alias("cdc_batch_seq_no"), F.col("r.op").alias("cdc_operation"),
        F.col("r.value").alias("value"), F.col("r.note").alias("note"), F.col("r.deleted").alias("cdc_deleted_note"))


def with_time(log: DataFrame) -> DataFrame:
    """cdc_time, the time UUID of a record's change."""
    return log.withColumn("cdc_time", from_micros(F.unix_micros("change_ts"), F.col("event_id")))


def orders_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order is inserted; finished ones are then deleted."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    rows = o.select("o_custkey", "o_orderkey", "o_totalprice", "o_orderstatus", instant(o, "o_orderdate").alias("change_ts"),
                    F.explode(F.when(F.col("o_orderstatus") == "F", F.array(*map(F.lit, (2, 9, 0, 3)))).otherwise(F.array(*map(F.lit, (2, 9))))).alias("cdc_operation"))
    return rows.withColumn("step", F.when(F.col("cdc_operation").isin(2, 9), 0).otherwise(1)).withColumn(
        "cdc_batch_seq_no", F.when(F.col("cdc_operation") == 0, 0).when(F.col("cdc_operation") == 9, 2).otherwise(1)).withColumns(
        {c: F.when(F.col("cdc_operation") != 3, F.col(c)) for c in ("o_totalprice", "o_orderstatus")})


#: The same log in SQL, for checking: CTEs up to `log`.
LOG_SQL = """
WITH e AS (
  SELECT event_id, ts, user_id, event_type, value,
         row_number() OVER w AS n, lag(value) OVER w AS prev,
         max(CASE WHEN event_id % 3 = 0 THEN event_id END) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS kept,
         max(CASE WHEN event_id % 3 = 0 THEN event_id END) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS kept_before
  FROM events WINDOW w AS (PARTITION BY user_id, event_type ORDER BY ts, event_id)),
o AS (SELECT *, CASE WHEN n % 5 = 1 THEN 2 WHEN n % 5 = 0 THEN 3 ELSE 1 END AS chg FROM e),
log AS (
  SELECT user_id, event_type, event_id, ts, n, 0 AS seq, 0 AS op, prev AS value, kept_before AS note, false AS del FROM o WHERE chg <> 2
  UNION ALL
  SELECT user_id, event_type, event_id, ts, n, 1, chg, CASE WHEN chg <> 3 THEN value END,
         CASE WHEN chg <> 3 AND event_id % 7 <> 0 AND event_id % 3 = 0 THEN event_id END, chg <> 3 AND event_id % 7 = 0 FROM o
  UNION ALL
  SELECT user_id, event_type, event_id, ts, n, 2, 9, value, CASE WHEN event_id % 7 <> 0 THEN kept END, false FROM o WHERE chg <> 3)
"""
#: One row per change, with its images' cells.
SLOTS_SQL = LOG_SQL + """, s AS (
  SELECT user_id, event_type, event_id, ts,
         max(op) FILTER (op IN (1, 2, 3, 4)) AS op, coalesce(bool_or(del), false) AS del,
         count(*) FILTER (op = 0) > 0 AS has_pre, count(*) FILTER (op = 9) > 0 AS has_post, count(*) FILTER (op IN (1, 2, 3, 4)) > 0 AS has_chg,
         max(value) FILTER (op = 0) AS pre_value, max(note) FILTER (op = 0) AS pre_note,
         max(value) FILTER (op IN (1, 2, 3, 4)) AS chg_value, max(note) FILTER (op IN (1, 2, 3, 4)) AS chg_note,
         max(value) FILTER (op = 9) AS post_value, max(note) FILTER (op = 9) AS post_note
  FROM log GROUP BY user_id, event_type, event_id, ts)
"""
