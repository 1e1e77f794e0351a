"""Analytics marts: hourly, weather, road, weekday and location tables and what is read off them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadspark import schema as S
from roadspark.functions import columns as C
from roadspark.functions import geo
from roadspark.functions.moments import rounded
from roadspark.functions.quantiles import exact_quantiles

BAND_Z = 1.96


def _stats(*, std: bool = True, count: bool = True) -> list[Column]:
    y = F.col(S.TARGET)
    parts = [F.avg(y).alias("mean")]
    if std:
        parts.append(F.stddev_samp(y).alias("std"))
    if count:
        parts.append(F.count(y).alias("count"))
    return parts


def hourly_demand(df: DataFrame) -> DataFrame:
    return df.where(C.hour().isNotNull()).groupBy(C.hour().alias("hour")).agg(*_stats())


def _with_median(df: DataFrame, by: str) -> DataFrame:
    """Mean, median, std and count per known category."""
    known = df.where(F.col(by).isNotNull())
    medians = exact_quantiles(known, S.TARGET, [0.5], by=by)
    return (
        known.groupBy(by).agg(*_stats())
        .join(F.broadcast(medians.select(by, F.col("value").alias("median"))), by, "left")
        .select(by, "mean", "median", "std", "count")
    )


def weather_impact(df: DataFrame) -> DataFrame:
    return _with_median(df, "Weather")


def road_capacity(df: DataFrame) -> DataFrame:
    return _with_median(df, "RoadType")


def lane_analysis(df: DataFrame) -> DataFrame:
    return df.where(F.col("NumberofLanes").isNotNull()).groupBy("NumberofLanes").agg(*_stats())


def weekday_demand(df: DataFrame) -> DataFrame:
    return (
        df.where(C.weekday().isNotNull()).groupBy(C.weekday().alias("weekday")).agg(*_stats(count=False))
        .withColumn("name", C.weekday_name(F.col("weekday")))
    )


def peak_hours(hourly: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` busiest and ``k`` quietest hours, each in descending order of mean.

    ``avg_demand`` is the plain mean over the listed hours. ``hourly`` has at
    most 24 rows, hence the unpartitioned windows.
    """
    top = Window.orderBy(F.desc("mean"), "hour")
    bottom = Window.orderBy("mean", F.desc("hour"))
    ranked = hourly.select(
        "hour", "mean", F.row_number().over(top).alias("top"), F.row_number().over(bottom).alias("low")
    )
    kinds = F.array(
        F.when(F.col("top") <= k, F.struct(F.lit("peak").alias("kind"), F.col("top").alias("place"))),
        F.when(F.col("low") <= k, F.struct(F.lit("off_peak").alias("kind"), F.col("top").alias("place"))),
    )
    listed = ranked.select("hour", "mean", F.explode(F.array_compact(kinds)).alias("k"))
    return listed.select(
        "k.kind",
        F.row_number().over(Window.partitionBy("k.kind").orderBy("k.place")).alias("position"),
        "hour", "mean",
        F.avg("mean").over(Window.partitionBy("k.kind")).alias("avg_demand"),
    )


def heatmap(df: DataFrame) -> DataFrame:
    """Mean demand per known location, decoded after the grouping."""
    return df.where(F.col("geohash").isNotNull()).groupBy("geohash").agg(F.avg(S.TARGET).alias(S.TARGET)).select(
        "geohash", S.TARGET, geo.latitude().alias("latitude"), geo.longitude().alias("longitude")
    )


def forecast(hourly: DataFrame, digits: int = 4, half_even: bool = True) -> DataFrame:
    """Hourly mean with a 95 % band; an hour seen once has a band of width zero."""
    spread = BAND_Z * F.coalesce(F.col("std"), F.lit(0.0))
    return hourly.select(
        "hour",
        rounded(F.col("mean"), digits, half_even).alias("predicted_demand"),
        rounded(F.greatest(F.lit(0.0), F.col("mean") - spread), digits, half_even).alias("confidence_low"),
        rounded(F.col("mean") + spread, digits, half_even).alias("confidence_high"),
    )


def overview(df: DataFrame, digits: int = 4, half_even: bool = True) -> DataFrame:
    """One row: locations, highest hourly forecast, weather types, road types."""
    top = forecast(hourly_demand(df), digits, half_even).agg(F.max("predicted_demand")).first()[0]
    return df.agg(
        F.count_distinct("geohash").alias("total_locations"),
        F.count_distinct("Weather").alias("weather_types"),
        F.count_distinct("RoadType").alias("road_types"),
    ).withColumn("peak_demand", F.lit(top).cast("double"))


def peak_flags(hourly: DataFrame, k: int = 5) -> DataFrame:
    peaks = peak_hours(hourly, k).where("kind = 'peak'").select("hour", F.lit(True).alias("is_peak"))
    return hourly.join(F.broadcast(peaks), "hour", "left").withColumn(
        "is_peak", F.coalesce("is_peak", F.lit(False))
    ).withColumn("label", F.concat(F.col("hour").cast("string"), F.lit(":00")))


def peak_ratio(hourly: DataFrame, k: int = 5) -> DataFrame:
    """Mean of the peak hours over that of the quiet hours; a zero divisor counts as 1."""
    pick = lambda kind: F.max(F.when(F.col("kind") == kind, F.col("avg_demand")))
    return peak_hours(hourly, k).agg(
        pick("peak").alias("peak_avg_demand"), pick("off_peak").alias("off_peak_avg_demand")
    ).withColumn(
        "peak_ratio",
        F.col("peak_avg_demand") / F.coalesce(F.nullif(F.col("off_peak_avg_demand"), F.lit(0.0)), F.lit(1.0)),
    )


def heat_summary(locations: DataFrame) -> DataFrame:
    y = F.col(S.TARGET)
    return locations.agg(
        F.max(y).alias("max_demand"), F.min(y).alias("min_demand"),
        F.avg(y).alias("avg_demand"), F.count("*").alias("total"),
    )


def hotspots(locations: DataFrame, n: int = 10) -> DataFrame:
    return locations.orderBy(F.desc(S.TARGET), "geohash").limit(n)


def coldspots(locations: DataFrame, n: int = 5) -> DataFrame:
    return locations.orderBy(S.TARGET, F.desc("geohash")).limit(n)


def heat_bands(locations: DataFrame) -> DataFrame:
    """Each location's place between the lowest and the highest mean."""
    low, high = locations.agg(F.min(S.TARGET), F.max(S.TARGET)).first()
    y = F.col(S.TARGET)
    ratio = (y - F.lit(low)) / (F.lit(high) - F.lit(low) + 0.0001)
    band = F.lit("very_low")
    for limit, name in ((0.2, "low"), (0.4, "medium"), (0.6, "high"), (0.8, "very_high")):
        band = F.when(F.col("ratio") > limit, name).otherwise(band)
    return locations.select(
        "geohash", S.TARGET, ratio.alias("ratio")
    ).withColumn("band", band).withColumn(
        "bar_pct", F.greatest(F.lit(8.0), F.col("ratio") * 100)
    )


def forecast_peak(forecast_table: DataFrame) -> DataFrame:
    """The first hour with the largest prediction."""
    first = F.max_by(F.col("hour"), F.struct("predicted_demand", -F.col("hour")))
    return forecast_table.agg(first.alias("hour"), F.max("predicted_demand").alias("predicted_demand"))


def weather_extremes(impact: DataFrame) -> DataFrame:
    """Weather with the highest and the lowest mean; the first name wins a tie."""
    name, mean = F.col("Weather"), F.col("mean")
    top = F.max("mean").alias("max_demand")
    low = F.min("mean").alias("min_demand")
    ends = impact.agg(
        top, low,
        F.min_by(name, F.struct(-mean, name)).alias("best_weather"),
        F.min_by(name, F.struct(mean, name)).alias("worst_weather"),
    )
    return ends.select("best_weather", "max_demand", "worst_weather", "min_demand")


def weather_profile(impact: DataFrame) -> DataFrame:
    return impact.select("Weather", F.col("mean").alias("demand"), F.col("std").alias("variability"))


def road_utilization(capacity: DataFrame) -> DataFrame:
    """Mean demand of a road type in percent of the busiest type (a handful of rows)."""
    busiest = F.greatest(F.max("mean").over(Window.partitionBy()), F.lit(0.001))
    return capacity.withColumn("utilization", F.least(F.lit(100.0), F.col("mean") / busiest * 100))


def all_marts(df: DataFrame, half_even: bool = True) -> dict[str, DataFrame]:
    """Every mart by name. Cache ``df`` when more than one is written."""
    hourly = hourly_demand(df)
    bands = forecast(hourly, half_even=half_even)
    weather, roads, locations = weather_impact(df), road_capacity(df), heatmap(df)
    return {
        "hourly_demand": hourly,
        "weather_impact": weather,
        "road_capacity": roads,
        "lane_analysis": lane_analysis(df),
        "weekday_demand": weekday_demand(df),
        "peak_hours": peak_hours(hourly),
        "heatmap": locations,
        "forecast": bands,
        "overview": overview(df, half_even=half_even),
        "peak_flags": peak_flags(hourly),
        "peak_ratio": peak_ratio(hourly),
        "heat_summary": heat_summary(locations),
        "hotspots": hotspots(locations),
        "coldspots": coldspots(locations),
        "heat_bands": heat_bands(locations),
        "forecast_peak": forecast_peak(bands),
        "weather_extremes": weather_extremes(weather),
        "weather_profile": weather_profile(weather),
        "road_utilization": road_utilization(roads),
    }
