"""Exploratory aggregates: the table behind each chart."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadspark import schema as S
from roadspark.functions import columns as C
from roadspark.functions.moments import pearson
from roadspark.functions.quantiles import exact_quantiles, quantile_values
from roadspark.operators.sampling import hash_sample

QUANTILES = [0.01, 0.05, 0.10, 0.25, 0.50, 0.75, 0.90, 0.95, 0.99]
QUARTILES = [0.25, 0.50, 0.75]
# Width of a density bin in bandwidths, and the powers kept of a value's offset
# inside its bin. The density is then off by less than 1e-8 of its peak.
_BINS_PER_BANDWIDTH = 16
_POWERS = 4


def _value(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("double")


def histogram(df: DataFrame, column: str | Column = S.TARGET, bins: int = 80) -> DataFrame:
    """Equal-width bins over [min, max], the last one closed; empty bins are kept.

    Each row also carries the column's mean and median as markers.
    """
    x = _value(column)
    low, high, mean = df.agg(F.min(x), F.max(x), F.avg(x)).first()
    median = quantile_values(df, x, [0.5])[0]
    spark = df.sparkSession
    if low is None:
        return spark.createDataFrame(
            [], "bin int, left double, right double, count bigint, mean double, median double"
        )
    if low == high:
        low, high = low - 0.5, high + 0.5
    number = F.least(F.width_bucket(x, F.lit(low), F.lit(high), F.lit(bins)), F.lit(bins))
    counts = (
        df.where(x.isNotNull()).groupBy(number.cast("int").alias("bin")).agg(F.count("*").alias("count"))
    )
    width = (high - low) / bins
    frame = spark.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    return frame.join(F.broadcast(counts), "bin", "left").select(
        "bin",
        (low + (F.col("bin") - 1) * width).alias("left"),
        (low + F.col("bin") * width).alias("right"),
        F.coalesce("count", F.lit(0)).alias("count"),
        F.lit(mean).alias("mean"),
        F.lit(median).alias("median"),
    )


def log_histogram(df: DataFrame, column: str = S.TARGET, bins: int = 80) -> DataFrame:
    return histogram(df, F.log1p(column), bins)


def _hermite(u: Column) -> list[Column]:
    """Probabilists' Hermite polynomials, the derivatives of the Gaussian kernel."""
    polynomials = [F.lit(1.0), u]
    for k in range(1, _POWERS):
        polynomials.append(u * polynomials[k] - k * polynomials[k - 1])
    return polynomials


def kde_curve(
    df: DataFrame, column: str | Column = S.TARGET, grid: int = 200, cut: float = 0.0, by: str | None = None
) -> DataFrame:
    """Gaussian density on ``grid`` points, bandwidth sd * n^(-1/5), per group of ``by``.

    Rows are first reduced to the power sums of narrow bins. A Taylor expansion
    of the kernel around a bin's centre then gives each bin's contribution, so
    the work on grid points depends on the bins and not on the rows.
    """
    x = _value(column)
    key = F.col(by) if by else F.lit("")
    rows = df.select(key.alias("_g"), x.alias("_x")).where("_g IS NOT NULL AND _x IS NOT NULL")
    size = F.count("_x")
    shape = (
        rows.groupBy("_g")
        .agg(size.alias("n"), F.min("_x").alias("lo"), F.max("_x").alias("hi"),
             (F.stddev_samp("_x") * F.pow(size, F.lit(-0.2))).alias("h"))
        .where("h > 0")
    )
    # One row per category.
    shape = F.broadcast(shape)
    width = F.col("h") / _BINS_PER_BANDWIDTH
    placed = rows.join(shape, "_g").withColumn("bin", F.floor((F.col("_x") - F.col("lo")) / width))
    centre = F.col("lo") + (F.col("bin") + 0.5) * width
    offset = (F.col("_x") - centre) / F.col("h")
    binned = placed.withColumn("_o", offset).groupBy("_g", "n", "lo", "hi", "h", "bin").agg(
        *[F.sum(F.pow("_o", F.lit(float(k))) / math.factorial(k)).alias(f"m{k}") for k in range(_POWERS + 1)]
    )
    start = F.col("lo") - cut * F.col("h")
    step = (F.col("hi") - F.col("lo") + 2 * cut * F.col("h")) / (grid - 1)
    points = binned.withColumn("c", centre).withColumn(
        "point", F.explode(F.sequence(F.lit(0), F.lit(grid - 1)))
    ).withColumn("x", start + F.col("point") * step)
    points = points.withColumn("u", (F.col("x") - F.col("c")) / F.col("h"))
    u = F.col("u")
    kernel = F.exp(-u * u / 2) * sum(
        (p * F.col(f"m{k}") for k, p in enumerate(_hermite(u))), F.lit(0.0)
    )
    norm = F.col("n") * F.col("h") * math.sqrt(2 * math.pi)
    curve = points.groupBy("_g", "point", "x").agg(F.sum(kernel / norm).alias("density"))
    keys = [F.col("_g").alias(by)] if by else []
    return curve.select(*keys, "point", "x", "density")


def box_stats(df: DataFrame, column: str = S.TARGET, by: str | None = None) -> DataFrame:
    """Quartiles, whiskers (furthest values within 1.5 IQR) and outliers beyond them."""
    key = by or "_all"
    rows = df.select((F.col(by) if by else F.lit("all")).alias(key), F.col(column).alias("_x"))
    rows = rows.where(F.col(key).isNotNull() & F.col("_x").isNotNull())
    quartiles = _wide_quartiles(exact_quantiles(rows, "_x", QUARTILES, by=key), key)
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    joined = rows.join(F.broadcast(quartiles), key)
    x = F.col("_x")
    inside = (x >= F.col("q1") - reach) & (x <= F.col("q3") + reach)
    stats = joined.groupBy(key, "q1", "median", "q3").agg(
        F.min(F.when(inside, x)).alias("whisker_low"),
        F.max(F.when(inside, x)).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"),
        F.count("*").alias("count"),
    )
    return stats if by else stats.drop(key)


def _wide_quartiles(quantiles: DataFrame, key: str) -> DataFrame:
    at = lambda p: F.max(F.when(F.col("prob") == p, F.col("value")))
    return quantiles.groupBy(key).agg(
        at(0.25).alias("q1"), at(0.5).alias("median"), at(0.75).alias("q3")
    )


def quartiles_by(df: DataFrame, by: str, column: str = S.TARGET, only: list[str] | None = None) -> DataFrame:
    """Inner quartiles of a violin per category, optionally of listed categories only."""
    rows = df.where(F.col(by).isin(only)) if only else df
    return _wide_quartiles(exact_quantiles(rows, column, QUARTILES, by=by), by)


def quantile_table(df: DataFrame, column: str = S.TARGET, probs: list[float] = QUANTILES) -> DataFrame:
    return exact_quantiles(df, column, probs)


def demand_by_hour(df: DataFrame) -> DataFrame:
    return df.where(C.hour().isNotNull()).groupBy(C.hour().alias("hour")).agg(
        F.avg(S.TARGET).alias("mean"), F.stddev_samp(S.TARGET).alias("std")
    ).select(
        "hour", "mean", "std",
        (F.col("mean") - F.col("std")).alias("low"), (F.col("mean") + F.col("std")).alias("high"),
    )


def _mean_by(df: DataFrame, name: str, key: Column) -> DataFrame:
    """Means of known keys."""
    return df.where(key.isNotNull()).groupBy(key.alias(name)).agg(F.avg(S.TARGET).alias("mean"))


def demand_by_day(df: DataFrame) -> DataFrame:
    return _mean_by(df, "day", F.col("day"))


def demand_by_weekday(df: DataFrame) -> DataFrame:
    return _mean_by(df, "weekday", C.weekday()).select(
        "weekday", C.weekday_name(F.col("weekday")).alias("weekday_name"),
        (F.col("weekday") >= 5).alias("is_weekend"), "mean",
    )


def demand_by_month_clipped(df: DataFrame) -> DataFrame:
    return _mean_by(df, "month_clipped", C.month_clipped())


def top_locations(df: DataFrame, n: int = 30) -> DataFrame:
    return _mean_by(df, "geohash", F.col("geohash")).orderBy(F.desc("mean"), "geohash").limit(n)


def top_regions(df: DataFrame, prefix: int = 4, n: int = 20) -> DataFrame:
    return (
        df.where(F.col("geohash").isNotNull()).groupBy(F.substring("geohash", 1, prefix).alias("region"))
        .agg(F.avg(S.TARGET).alias("mean"), F.count(S.TARGET).alias("count"))
        .orderBy(F.desc("mean"), "region").limit(n)
    )


def weather_means_ordered(df: DataFrame) -> DataFrame:
    """The four known kinds of weather in fixed order; an absent one has a NULL mean."""
    means = _mean_by(df.where(F.col("Weather").isin(S.WEATHER_ORDER)), "Weather", F.col("Weather"))
    names = [(i, w) for i, w in enumerate(S.WEATHER_ORDER)]
    order = df.sparkSession.createDataFrame(names, "position int, Weather string")
    return order.join(F.broadcast(means), "Weather", "left").select("position", "Weather", "mean")


def temperature_fit(df: DataFrame, sample: int | None = None, id_col: str = S.ID) -> DataFrame:
    """Least-squares line of demand on temperature, over all rows or a hash sample."""
    known = df.where(F.col("Temperature").isNotNull())
    rows = hash_sample(known, sample, id_col=id_col) if sample else known
    y, x = F.col(S.TARGET), F.col("Temperature")
    return rows.agg(
        F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"),
        F.min(x).alias("t_min"), F.max(x).alias("t_max"), F.count("*").alias("n"),
    )


def temperature_trend(
    df: DataFrame, sample: int | None = None, points: int = 100, id_col: str = S.ID
) -> DataFrame:
    """The line fitted to all rows (or to a sample, if asked for) on evenly spaced temperatures."""
    fit = temperature_fit(df, sample, id_col)
    step = (F.col("t_max") - F.col("t_min")) / (points - 1)
    return (
        fit.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
        .withColumn("temperature", F.col("t_min") + F.col("point") * step)
        .select("point", "temperature", (F.col("intercept") + F.col("slope") * F.col("temperature")).alias("trend"))
    )


def demand_by_lanes(df: DataFrame) -> DataFrame:
    return df.where(F.col("NumberofLanes").isNotNull()).groupBy("NumberofLanes").agg(
        F.avg(S.TARGET).alias("mean"), F.stddev_samp(S.TARGET).alias("std")
    )


def correlation_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """Strict lower triangle of the Pearson matrix as rows ``(a, b, r)``, from one scan."""
    pairs = [(columns[i], columns[j]) for i in range(len(columns)) for j in range(i)]
    one = df.agg(*[pearson(F.col(a), F.col(b)).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    rows = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"r{i}").alias("r"))
            for i, (a, b) in enumerate(pairs)]
    return one.select(F.inline(F.array(*rows)))
