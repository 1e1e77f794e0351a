"""Session helpers: shared work folder, written intermediates, size-checked joins."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A lookup table is broadcast only when its counted rows stay below this.
BROADCAST_ROWS = 1_000_000
# Bytes of rows in one batch between Spark and a Python worker.
BATCH_BYTES = 4 << 20


@lru_cache(maxsize=None)
def _local_folder(application_id: str) -> str:
    return tempfile.mkdtemp(prefix=f"roadspark-{application_id}-")


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a ``local`` session without the setting gets a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return _local_folder(spark.sparkContext.applicationId)


# Paths given out inside each open call of :func:`written_alone`.
_GIVEN: list[list[str]] = []


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    if _GIVEN:
        _GIVEN[-1].append(path)
    return path


def path_exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def remove(spark: SparkSession, path: str) -> None:
    """Delete an intermediate that nothing reads any more."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def freed(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of tables that nothing refers to any more; it does so as its driver collects garbage."""
    gc.collect()
    spark._jvm.System.gc()


def first_lines(spark: SparkSession, paths: list[str]) -> dict[str, str]:
    """The first line of each text file, read by the driver; nothing beyond it is parsed."""
    read = {}
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        stream = place.getFileSystem(spark._jsc.hadoopConfiguration()).open(place)
        try:
            reader = spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(stream, "UTF-8"))
            read[path] = reader.readLine() or ""
        finally:
            stream.close()
    return read


def small_batches(spark: SparkSession, most: int = BATCH_BYTES) -> None:
    """From now on, rows of this session go to Python workers in batches of about ``most`` bytes; a lower limit stays.

    An executor holds a batch outside its heap and the worker holds it again, with what it makes of it, for every
    task that runs. No result depends on the size.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name)) > most:
        spark.conf.set(name, f"{most}b")


def use_checkpoints(spark: SparkSession) -> None:
    """Point iterative ML training at the shared folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Later steps start from the files, so a lost executor re-reads them instead
    of repeating the work above.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written_alone(spark: SparkSession, make: Callable[[], DataFrame], name: str) -> DataFrame:
    """Write what ``make`` returns, read it back, and delete whatever ``make`` wrote on the way to it."""
    _GIVEN.append([])
    try:
        result = written(make(), name)
    finally:
        *on_the_way, last = _GIVEN.pop() or [None]
    for path in on_the_way:
        remove(spark, path)
    if _GIVEN:
        _GIVEN[-1].append(last)
    return result


def lookup_join(
    df: DataFrame,
    lookup: DataFrame,
    key: str,
    rows: int,
    hot: Column,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Left join to a table with one row per key.

    ``rows`` is the counted size of ``lookup``. Up to ``broadcast_rows`` it is
    broadcast. Beyond, the keys marked by ``hot`` (a condition that at most a
    fixed number of keys can meet) are broadcast and leave the shuffle, so that
    no reducer receives one key's share of the whole table.
    """
    if rows <= broadcast_rows:
        return df.join(F.broadcast(lookup), key, "left")
    values = [c for c in lookup.columns if c != key]
    marked = df.join(
        F.broadcast(lookup.where(hot).withColumn("_hot", F.lit(True))), key, "left"
    )
    settled = F.col("_hot").isNotNull() | F.col(key).isNull()
    rest = marked.where(~settled).drop("_hot", *values).join(lookup.where(~hot), key, "left")
    return marked.where(settled).drop("_hot").unionByName(rest)
