"""Regression metrics as aggregates over a prediction table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadspark import schema as S
from roadspark.functions.moments import rounded


def clipped(prediction: Column) -> Column:
    """Demand cannot be negative; there is no upper bound. An absent prediction stays absent."""
    return F.when(prediction.isNotNull(), F.greatest(prediction, F.lit(0.0)))


def regression_metrics(predictions: DataFrame, by: list[str], target: str = S.TARGET) -> DataFrame:
    """R2, RMSE and MAE of the clipped ``pred`` per group, in one aggregation.

    Only rows with both a target and a prediction count.
    """
    y = F.col(target)
    error = y - clipped(F.col("pred"))
    sse, n = F.sum(error * error), F.count(error)
    spread = F.var_pop(F.when(error.isNotNull(), y)) * n
    return predictions.groupBy(*by).agg(
        (1 - F.try_divide(sse, spread)).alias("r2"),
        F.sqrt(sse / n).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
    )


def cv_leaderboard(fold_metrics: DataFrame, digits: int = 4, half_even: bool = True) -> DataFrame:
    """Mean and population std of R2, mean RMSE and MAE per model, and which is best.

    ``position`` sorts by mean R2, then by name. One row per model.
    """
    table = fold_metrics.groupBy("model").agg(
        F.avg("r2").alias("r2"), F.stddev_pop("r2").alias("r2_std"),
        F.avg("rmse").alias("rmse"), F.avg("mae").alias("mae"),
    )
    position = F.row_number().over(Window.orderBy(F.desc("r2"), "model"))
    return table.withColumn("position", position).select(
        "position", "model",
        rounded(F.col("r2"), digits, half_even).alias("r2_mean"),
        rounded(F.col("r2_std"), digits, half_even).alias("r2_std"),
        rounded(F.col("rmse"), digits, half_even).alias("rmse_mean"),
        rounded(F.col("mae"), digits, half_even).alias("mae_mean"),
        (F.col("position") == 1).alias("is_best"),
    )


def prediction_summary(predictions: DataFrame, column: str = S.TARGET) -> DataFrame:
    x = F.col(column)
    return predictions.agg(
        F.avg(x).alias("mean"), F.stddev_pop(x).alias("std"), F.min(x).alias("min"), F.max(x).alias("max")
    )
