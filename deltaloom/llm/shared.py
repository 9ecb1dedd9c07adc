"""The folder all machines share, lineage cuts, and small helpers."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..ship import ship
from . import kernels as K

CHECKPOINT_CONF = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; in local mode (tests) a temporary one where none is configured."""
    configured = spark.conf.get(CHECKPOINT_CONF, None)
    ship(spark)
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        if not configured and not sc.master.startswith("local"):
            raise ValueError(f"{CHECKPOINT_CONF} must name a folder that all machines share")
        sc.setCheckpointDir(configured or tempfile.mkdtemp(prefix="deltaloom-"))
    return configured or sc._jsc.sc().getCheckpointDir().get()


def run_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder of this run inside the shared one."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Materialise in the shared folder and forget the lineage; survives lost executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def partitions(spark: SparkSession, least: int = 1) -> int:
    return max(least, int(spark.conf.get("spark.sql.shuffle.partitions")))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_shuffles(spark: SparkSession) -> None:
    """Shuffle files of steps that are materialised go when Python and the driver's JVM have collected what refers to them.

    What the driver's Python then holds of free memory goes back to the system.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    K.give_back()


def fresh(columns: list[str], name: str) -> str:
    """The name, with more underscores in front while there is a column of that name."""
    while name.lower() in {c.lower() for c in columns}:
        name = f"_{name}"
    return name


#: Tables of keys up to this size are sent to all tasks rather than shuffled against.
SMALL_BYTES = 32 << 20


def small(df: DataFrame, row_bytes: int = 24, beyond: str = "merge") -> DataFrame:
    """A materialised table of keys, to be joined with a large one: broadcast if its rows are counted to be few, else shuffled."""
    return F.broadcast(df) if df.count() * row_bytes <= SMALL_BYTES else df.hint(beyond)


#: No more keys than this can have so large a share of all rows each.
FEW_KEYS = 10_000


def join_few(rows: DataFrame, keyed: DataFrame, key: str, other: str, total: Callable[[], int], count: str = "c", row_bytes: int = 24) -> DataFrame:
    """Rows joined with the one row of their key in `keyed`, without gathering the rows of a hot key in one task.

    keyed: materialised, one row for each key `other`, with the count of its rows. Where it is small it is broadcast. Else keys
    of more than 1/FEW_KEYS of all `total()` rows, and 1000, which are FEW_KEYS at most, are; the rest meet by a shuffle. Both
    sides are read twice then.
    """
    if keyed.count() * row_bytes <= SMALL_BYTES:
        return rows.join(F.broadcast(keyed.drop(count)), F.col(key) == F.col(other))
    limit = max(1000, -(-total() // FEW_KEYS))
    few = F.broadcast(keyed.where(F.col(count) > limit).drop(count))
    many = keyed.where(F.col(count) <= limit).drop(count).hint("merge")
    hot = few.select(other)
    return rows.join(few, F.col(key) == F.col(other)).unionByName(rows.join(F.broadcast(hot), F.col(key) == F.col(other), "left_anti").join(many, F.col(key) == F.col(other)))


def words_of(text) -> F.Column:
    """Number of runs of bytes that are not ASCII white space; null counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
