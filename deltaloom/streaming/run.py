"""Run a stream over what there is and return its rows."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..model import TableSpec
from ..options import CaptureOptions
from .correlate import correlate_stream, open_slots

STORE = "spark.sql.streaming.stateStore.providerClass"
#: A file of a log, and how many of them are a step where a log has many.
FILE_ROWS, FILES_A_STEP = 500_000, 12
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def base_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; in local mode a temporary one where none is configured."""
    if folder := spark.conf.get("spark.checkpoint.dir", None):
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
    return tempfile.mkdtemp(prefix="deltaloom-")


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A folder of its own for one run."""
    return f"{base_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def _date_files(spark: SparkSession, folder: str) -> int:
    """Give the files of a folder modification times in the order of their names: file streams are read in that order. How many there are."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files = sorted((str(f.getPath().getName()), f) for f in fs.listStatus(path) if f.getPath().getName().endswith(".parquet"))
    for i, (_, f) in enumerate(files):
        fs.setTimes(f.getPath(), f.getModificationTime() - 1000 * (len(files) - i), -1)
    return len(files)


def correlate_files(spark: SparkSession, log: DataFrame, spec: TableSpec, o: CaptureOptions, change_id: tuple[str, ...], order: tuple[str, ...],
                    files: int = 4, timeout_s: int | None = None) -> DataFrame:
    """Write a log as files in time order, stream them in steps, and return key, change id, op and completeness.

    Files have FILE_ROWS rows at most, so that the steps of a large log are more, not larger. The stream ends with the log; timeout_s:
    give up earlier. What is still open when the log ends stays in the stream's state, which a later run would go on from; it
    is listed too, as OPEN.
    """
    folder = fresh_dir(spark, "stream")
    log.repartitionByRange(files, "change_ts").sortWithinPartitions("change_ts").write.option("maxRecordsPerFile", FILE_ROWS).parquet(f"{folder}/log")
    pieces = _date_files(spark, f"{folder}/log")
    a_step = max(1, files // 2) if pieces <= files else FILES_A_STEP
    old = spark.conf.get(STORE, None)
    spark.conf.set(STORE, ROCKSDB)
    try:
        stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", a_step).parquet(f"{folder}/log")
        rows = _result(correlate_stream(stream, spec, o, change_id, order), spec, change_id)
        q = (rows.writeStream.format("parquet").option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start(f"{folder}/out"))
        try:
            if q.awaitTermination(timeout_s) is False:
                raise TimeoutError(f"the stream has not ended after {timeout_s} s")
        finally:
            q.stop()
        left = _result(open_slots(spark.read.schema(log.schema).parquet(f"{folder}/log"), spec, change_id, f"{folder}/checkpoint"), spec, change_id)
        left.write.parquet(f"{folder}/open")  # the state store's class is that of this session's setting, which ends here
    finally:
        spark.conf.unset(STORE) if old is None else spark.conf.set(STORE, old)
    return spark.read.schema(rows.schema).parquet(f"{folder}/out").unionByName(spark.read.schema(rows.schema).parquet(f"{folder}/open"))


def _result(out: DataFrame, spec: TableSpec, change_id: tuple[str, ...]) -> DataFrame:
    ids = [c for c in change_id if c not in spec.key]
    return out.select(*spec.key, *ids, F.col("chg._op").alias("op"), F.col("pre.value").alias("pre_value"), F.col("post.value").alias("post_value"), "reason")
