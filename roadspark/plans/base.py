"""Shared inputs of the registered queries and the matching SQL fragments.

Doubles are rounded to six places on both sides, as the engines add in
different orders; adding 0.0 turns a rounded -0.0 into 0.0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadspark.operators.features import RoadFeatures, RoadFeaturesModel
from roadspark.sources.traffic import PROJECTION, SPLIT_DAY, read_traffic, split

DIGITS = 6


def r6(df: DataFrame, **digits: int) -> DataFrame:
    """Round every double; ``digits`` names columns that need more places."""
    return df.select(*[
        (F.round(f.name, digits.get(f.name, DIGITS)) + F.lit(0.0)).alias(f.name)
        if isinstance(f.dataType, T.DoubleType) else f.name
        for f in df.schema.fields
    ])


def r(expression: str, name: str | None = None, digits: int = DIGITS) -> str:
    """SQL twin of :func:`r6` for one column."""
    return f"round({expression}, {digits}) + 0.0 AS {name or expression}"


def traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_traffic(spark, sf_dir)


def train_test(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return split(traffic(spark, sf_dir))


def fitted(df: DataFrame, **options) -> RoadFeaturesModel:
    """Features without regions, whose numbering is arbitrary."""
    return RoadFeatures(clusters=options.pop("clusters", ()), **options).fit(df)


_TRAFFIC = "traffic AS (SELECT " + ", ".join(p.format(q='"') for p in PROJECTION) + " FROM events)"
_SIDES = (
    f"train AS (SELECT * FROM traffic WHERE day < {SPLIT_DAY}), "
    f"test AS (SELECT * FROM traffic WHERE day >= {SPLIT_DAY})"
)


def with_traffic(body: str, *ctes: str) -> str:
    return "WITH " + ", ".join([_TRAFFIC, _SIDES, *ctes]) + "\n" + body


def fit_ctes(source: str = "train") -> str:
    """What the feature model learns from ``source``."""
    mode = (
        "(SELECT {c} FROM " + source + " WHERE {c} IS NOT NULL GROUP BY {c}"
        " ORDER BY count(*) DESC, {c} LIMIT 1)"
    )
    return f"""
    state AS (SELECT coalesce({mode.format(c='RoadType')}, 'Residential') AS road_mode,
                     coalesce({mode.format(c='Weather')}, 'Sunny') AS weather_mode,
                     (SELECT quantile_cont(Temperature, 0.5) FROM {source}) AS temp_median),
    edges AS (SELECT list_sort(list_distinct(quantile_cont(coalesce(Temperature, temp_median),
                     [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]))) AS e
              FROM {source}, state),
    freq AS (SELECT geohash, count(*) AS f FROM {source} GROUP BY geohash)"""


_BIT = "(((strpos('0123456789bcdefghjkmnpqrstuvwxyz', substr(geohash, i // 5 + 1, 1)) - 1) >> (4 - i % 5)) & 1)"
_BITS = "range(0, 5 * CAST(length(geohash) AS BIGINT))"


def _axis(span: int, parity: int, count: str) -> str:
    """Cell centre as the sum of the halvings that each set bit stands for."""
    return (
        f"-{span // 2} + coalesce(list_sum(list_transform({_BITS}, lambda i: CASE WHEN i % 2 = {parity}"
        f" THEN {_BIT} * {span}.0::DOUBLE / power(2, i // 2 + 1) ELSE 0 END)), 0)"
        f" + {span}.0::DOUBLE / power(2, {count} + 1)"
    )


LATITUDE = _axis(180, 1, "(5 * length(geohash)) // 2")
LONGITUDE = _axis(360, 0, "(5 * length(geohash) + 1) // 2")

HOUR = "CAST(split_part(timestamp, ':', 1) AS INTEGER)"
MINUTE = "coalesce(TRY_CAST(split_part(timestamp, ':', 2) AS INTEGER), 0)"


def feature_cte(source: str = "traffic", name: str = "feats") -> str:
    """All features but the regions, for the rows of ``source``; needs :func:`fit_ctes`."""
    return f"""
    places AS (SELECT geohash, {LATITUDE} AS latitude, {LONGITUDE} AS longitude
               FROM (SELECT DISTINCT geohash FROM {source})),
    filled AS (SELECT t.* REPLACE (coalesce(RoadType, road_mode) AS RoadType,
                      coalesce(Weather, weather_mode) AS Weather,
                      coalesce(Temperature, temp_median) AS Temperature),
                      p.latitude, p.longitude, coalesce(f, 1) AS geo_frequency, e
               FROM {source} t CROSS JOIN state CROSS JOIN edges
               LEFT JOIN freq USING (geohash) LEFT JOIN places p USING (geohash)),
    timed AS (SELECT *, {HOUR} AS hour, {MINUTE} AS minute, day % 7 AS weekday,
                     CAST(floor(day / 7) AS INTEGER) AS week,
                     CAST(floor(day / 30) % 12 + 1 AS INTEGER) AS month FROM filled),
    coded AS (SELECT *, CAST(floor((month - 1) / 3) + 1 AS INTEGER) AS quarter,
                     CAST(weekday >= 5 AS INTEGER) AS is_weekend,
                     CAST(hour BETWEEN 7 AND 9 AS INTEGER) AS is_morning_peak,
                     CAST(hour BETWEEN 17 AND 19 AS INTEGER) AS is_evening_peak,
                     CAST(hour BETWEEN 7 AND 9 OR hour BETWEEN 17 AND 19 AS INTEGER) AS is_peak_hour,
                     sin(2 * pi() * hour / 24) AS hour_sin, cos(2 * pi() * hour / 24) AS hour_cos,
                     sin(2 * pi() * weekday / 7) AS weekday_sin, cos(2 * pi() * weekday / 7) AS weekday_cos,
                     CASE RoadType WHEN 'Street' THEN 2 WHEN 'Highway' THEN 3 ELSE 1 END AS road_type_encoded,
                     CAST(coalesce(LargeVehicles = 'Allowed', false) AS INTEGER) AS large_vehicles_allowed,
                     CAST(coalesce(Landmarks = 'Yes', false) AS INTEGER) AS has_landmarks,
                     NumberofLanes * Temperature AS lanes_x_temperature,
                     CASE Weather WHEN 'Sunny' THEN 0 WHEN 'Rainy' THEN 2 WHEN 'Snowy' THEN 3 ELSE 1 END
                       AS weather_severity_score,
                     CAST(CASE WHEN len(e) < 2 OR Temperature IS NULL THEN 2
                          ELSE len(list_filter(e[2:-2], lambda v: v < Temperature)) END AS INTEGER) AS temperature_bin,
                     CAST(Weather IN ('Rainy', 'Snowy') AS INTEGER) AS adverse_weather FROM timed),
    {name} AS (SELECT * EXCLUDE (e),
                     road_type_encoded * NumberofLanes * (1 + 0.5::DOUBLE * large_vehicles_allowed) AS road_capacity_score,
                     adverse_weather * NumberofLanes AS adverse_weather_x_lanes,
                     weather_severity_score * road_type_encoded * NumberofLanes
                       * (1 + 0.5::DOUBLE * large_vehicles_allowed) AS weather_x_capacity,
                     NumberofLanes * weather_severity_score AS lanes_x_weather_severity,
                     road_type_encoded * weather_severity_score AS roadtype_x_weather,
                     has_landmarks * geo_frequency AS landmark_density_score,
                     has_landmarks * NumberofLanes AS landmark_lane_interaction FROM coded)"""


def features_sql(body: str, source: str = "train", *ctes: str) -> str:
    return with_traffic(body, fit_ctes(source), feature_cte(), *ctes)
