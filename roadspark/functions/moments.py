"""Aggregate expressions that Spark has no built-in for."""

from __future__ import annotations

import math

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sample_skewness(x: Column) -> Column:
    """Bias-corrected skewness; NULL below three values."""
    n = F.count(x)
    corrected = F.try_divide(F.skewness(x) * F.sqrt(n * (n - 1.0)), n - 2.0)
    return F.when(n > 2, corrected)


def sample_kurtosis(x: Column) -> Column:
    """Bias-corrected excess kurtosis; NULL below four values."""
    n = F.count(x)
    corrected = F.try_divide(
        ((n + 1.0) * F.kurtosis(x) + 6.0) * (n - 1.0), (n - 2.0) * (n - 3.0)
    )
    return F.when(n > 3, corrected)


def pearson(x: Column, y: Column) -> Column:
    """Correlation over rows where both are present; NULL for a constant column."""
    both = x.isNotNull() & y.isNotNull()
    a, b = F.when(both, x.cast("double")), F.when(both, y.cast("double"))
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))


def pearson_matrix(df: DataFrame, columns: list[str]) -> list[list[float | None]]:
    """Correlations of columns without missing values; None for a constant column."""
    vectors = VectorAssembler(inputCols=columns, outputCol="_v").transform(df).select("_v")
    matrix = Correlation.corr(vectors, "_v").first()[0].toArray()
    return [[None if math.isnan(r) else float(r) for r in row] for row in matrix]


def rounded(x: Column, digits: int, half_even: bool = True) -> Column:
    return F.bround(x, digits) if half_even else F.round(x, digits)
