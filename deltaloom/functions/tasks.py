"""Tasks (generation, vnode, table and its stream ids) as text and bytes, and their packing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def to_hex(c: Column) -> Column:
    return F.lower(F.hex(c))


def from_hex(c: Column) -> Column:
    return F.unhex(c)


def serialise(generation: Column, vnode: Column, keyspace: Column, table: Column, stream_ids: Column) -> Column:
    """`gen;vnode;ks;table;id,id`, ids in order and in hexadecimal."""
    ids = F.array_join(F.transform(F.sort_array(stream_ids), lambda x: to_hex(x)), ",")
    return F.concat_ws(";", generation.cast("string"), vnode.cast("string"), keyspace, table, ids)


def parse(c: Column) -> Column:
    part = F.split(c, ";")
    return F.struct(
        F.get(part, F.lit(0)).cast("long").alias("generation"), F.get(part, F.lit(1)).cast("int").alias("vnode"), F.get(part, F.lit(2)).alias("keyspace"),
        F.get(part, F.lit(3)).alias("table"), F.transform(F.split(F.get(part, F.lit(4)), ","), lambda x: F.unhex(x)).alias("stream_ids"),
    )


def pack(tasks: DataFrame, order: str, most: int) -> DataFrame:
    """Contiguous groups: chunk = ceil(n / most); adds `worker`. Positions come from per-range counts, not one big sort."""
    n = tasks.count()
    if not n:
        return tasks.withColumn("worker", F.lit(None).cast("long"))
    chunk = -(-n // most)
    ranged = tasks.repartitionByRange(F.col(order)).sortWithinPartitions(order).withColumn("_p", F.spark_partition_id()).withColumn("_m", F.monotonically_increasing_id())
    start, total = {}, 0
    for p, size in sorted(tuple(r) for r in ranged.groupBy("_p").count().collect()):  # one row per partition
        start[p] = total
        total += size
    first = F.create_map(*[F.lit(x) for kv in start.items() for x in kv])
    at = first[F.col("_p")].cast("long") + F.col("_m").bitwiseAND(F.lit((1 << 33) - 1))
    return ranged.withColumn("worker", F.floor(at / chunk)).drop("_p", "_m")
