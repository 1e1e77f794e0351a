"""Marts kept fresh as observations arrive."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from roadspark import schema as S


def _partials() -> list[Column]:
    y = F.col(S.TARGET)
    return [F.count(y).alias("n"), F.avg(y).alias("mean"), F.var_pop(y).alias("var")]


def start_incremental_mart(
    observations: DataFrame, key: Column, name: str, folder: str, checkpoint: str, **trigger
) -> StreamingQuery:
    """Append each micro-batch's count, mean and variance per key to ``folder``.

    There is no state store to lose or outgrow. A batch writes to a folder of its
    own number, so a batch that is run again after a failure replaces itself.
    """

    def add(batch: DataFrame, number: int) -> None:
        batch.groupBy(key.alias(name)).agg(*_partials()).where("n > 0").write.mode("overwrite").parquet(
            f"{folder}/batch={number}"
        )

    return (
        observations.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
    )


def read_incremental_mart(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Merge the partial results into mean, std and count per key."""
    parts = spark.read.parquet(folder)
    n, mean = F.sum("n"), F.sum(F.col("n") * F.col("mean")) / F.sum("n")
    overall = parts.groupBy(name).agg(n.alias("_n"), mean.alias("_mean"))
    merged = parts.join(overall, name)
    gap = F.col("mean") - F.col("_mean")
    spread = F.sum(F.col("n") * (F.col("var") + gap * gap))
    return merged.groupBy(name, "_n", "_mean").agg(spread.alias("_m2")).select(
        name, F.col("_mean").alias("mean"),
        F.when(F.col("_n") > 1, F.sqrt(F.try_divide("_m2", F.col("_n") - 1))).alias("std"),
        F.col("_n").alias("count"),
    )


def start_complete_mart(mart: DataFrame, folder: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Rewrite a mart with few keys (hours, lanes) after every micro-batch.

    ``mart`` is an aggregated stream without a watermark, so late rows count too.
    """

    def replace(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/version={number:012d}")

    return (
        mart.writeStream.outputMode("complete").foreachBatch(replace)
        .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
    )


def read_complete_mart(spark: SparkSession, folder: str) -> DataFrame:
    """The newest version of a mart."""
    versions = spark.read.parquet(folder)
    newest = versions.agg(F.max("version")).first()[0]
    return versions.where(F.col("version") == newest).drop("version")


def windowed_demand(
    observations: DataFrame, time_col: str = "ts", width: str = "1 hour", lateness: str = "2 hours"
) -> DataFrame:
    """Demand per dated window for append output; rows later than ``lateness`` are dropped."""
    timed = observations.withColumn("_time", F.col(time_col).cast("timestamp"))
    return (
        timed.withWatermark("_time", lateness)
        .groupBy(F.window("_time", width).alias("w"))
        .agg(F.avg(S.TARGET).alias("mean"), F.count(S.TARGET).alias("count"))
        .select(F.col("w.start").alias("window_start"), "mean", "count")
    )
