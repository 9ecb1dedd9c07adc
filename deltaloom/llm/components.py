"""Connected components of links.

Links are first contracted: tasks of at most `TASK_LINKS` links each keep a spanning star of every component they
see, which leaves fewer links than nodes. What then fits one such task is finished there; what doesn't is finished by
alternating large and small stars over the whole cluster: each round links every node's larger neighbours to the
smallest node it knows, then its smaller ones, until nothing changes. A node of any degree is spread by
pre-aggregation and adaptive skew joins. Rounds are written to the shared folder, so lost executors cost one round at
most; no task holds more than its bound and nothing goes to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .shared import cut, ship

TASK_LINKS = 1_000_000


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each node that isn't its component's smallest, with that."""
    up: dict[int, int] = {}

    def top(x: int) -> int:
        while (y := up.get(x, x)) != x:
            up[x] = x = up.get(y, y)
        return x

    for b in batches:
        for x, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            x, y = top(x), top(y)
            if x != y:
                up[max(x, y)] = min(x, y)
    nodes = list(up)
    for i in range(0, len(nodes), 100_000):
        part = nodes[i : i + 100_000]
        yield pa.record_batch([pa.array(np.array(part, np.int64)), pa.array(np.array([top(x) for x in part], np.int64))], names=["u", "v"])


def contracted(e: DataFrame, tasks: int) -> DataFrame:
    return cut(e.repartition(tasks).mapInArrow(K.released(_contract), "u long, v long"))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def stars(e: DataFrame, most_rounds: int = 100) -> DataFrame:
    """(u, v) links -> every node that isn't its component's smallest, with that."""
    state = _state(e)
    for _ in range(most_rounds):
        if not state[0]:
            return e
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
        large = both.join(least, both.u == least.k).where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "k")
        joined = large.join(small, large.u == small.k)
        e = cut(
            joined.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x"))
            .select("x.u", "x.v").where(F.col("u") != F.col("v")).distinct()
        )
        before, state = state, _state(e)
        if state == before:
            return e
    raise RuntimeError(f"no end after {most_rounds} rounds")


def components(edges: DataFrame, a: str = "a", b: str = "b", task_links: int = TASK_LINKS) -> DataFrame:
    """(node, label) for every node with a link to another; label is the component's smallest node.

    Nulls, loops and repeated links are ignored; no links give an empty table.
    """
    ship(edges.sparkSession)
    e = cut(edges.where(F.col(a) != F.col(b)).select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")))
    n = e.count()
    if n:
        e = contracted(e, -(-n // task_links))
        if n > task_links:
            left = e.count()
            e = contracted(e, 1) if left <= task_links else stars(e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    return e.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
