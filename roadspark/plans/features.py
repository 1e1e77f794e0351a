"""Feature steps one by one and the whole fitted pipeline.

State is learnt on the days before the split and applied to every row.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from roadspark.functions import columns as C
from roadspark.functions import geo
from roadspark.functions.quantiles import quantile_values
from roadspark.operators import features as X
from roadspark.plans.base import (
    HOUR, LATITUDE, LONGITUDE, MINUTE, features_sql, fit_ctes, fitted, r, r6, traffic, train_test, with_traffic,
)
from roadspark.schema import CLUSTER_SIZES, FEATURE_COLUMNS

PLAIN = [c for c in FEATURE_COLUMNS if not c.startswith("region_cluster")]
DOUBLES = {
    "Temperature", "hour_sin", "hour_cos", "weekday_sin", "weekday_cos", "latitude", "longitude",
    "road_capacity_score", "lanes_x_temperature", "weather_x_capacity",
}
# Example centres (latitude, longitude) for the assignment on its own.
CENTRES = [(-6.5, 91.0), (-6.0, 92.5), (-5.4, 90.3), (-5.1, 96.0), (-7.4, 94.2)]


def _model(s, d):
    return fitted(train_test(s, d)[0])


def _columns(make, *more):
    """The id and columns made from the raw rows alone."""
    def run(s, d):
        df = traffic(s, d)
        made = make()
        return r6(df.withColumns(made).select("Index", *more, *made))
    return run


def _stage(*names):
    """The id and named outputs of the whole fitted pipeline."""
    def run(s, d):
        return r6(_model(s, d).transform(traffic(s, d)).select("Index", *names))
    return run


def _calendar(*names):
    def run(s, d):
        df = traffic(s, d).withColumns(C.calendar()).withColumns(C.calendar_flags())
        return r6(df.select("Index", *names))
    return run


def frequency_with_unseen(s, d):
    train, _ = train_test(s, d)
    model = fitted(train.where("substr(geohash, 5, 1) <> 'z'"))
    return model.add_location(traffic(s, d)).select("Index", "geohash", "geo_frequency")


def median_and_fill(s, d):
    train, _ = train_test(s, d)
    median = quantile_values(train, "Temperature", [0.5])[0]
    filled = F.coalesce(F.col("Temperature"), F.lit(median).cast("double"))
    return r6(traffic(s, d).select("Index", filled.alias("Temperature")))


def mode_and_fill(s, d):
    train, _ = train_test(s, d)
    mode = X.modes(train, {"RoadType": "Residential", "Weather": "Sunny"})
    return traffic(s, d).select("Index", *[F.coalesce(F.col(c), F.lit(v)).alias(c) for c, v in mode.items()])


def rejected(s, d):
    broken = (
        F.when(F.col("Index") % 50 == 0, F.upper("geohash")).when(F.col("Index") % 77 == 0, F.lit("qa0000"))
        .when(F.col("Index") % 91 == 0, F.lit(None)).otherwise(F.col("geohash"))
    )
    return X.rejected_geohashes(traffic(s, d).withColumn("geohash", broken))


def regions(s, d):
    """Fitted centres with the locations and rows assigned to each."""
    places = X.locations(traffic(s, d)).persist()
    centres = X.fit_regions(places, CLUSTER_SIZES, restarts=10, seed=42)
    assigned = places.select("geo_frequency", *[
        C.nearest("latitude", "longitude", c).alias(str(k)) for k, c in centres.items()
    ]).unpivot("geo_frequency", [str(k) for k in centres], "k", "cluster")
    counts = assigned.groupBy("k", "cluster").agg(
        F.count("*").alias("locations"), F.sum("geo_frequency").alias("rows")
    )
    rows = [(str(k), i, a, b) for k, c in centres.items() for i, (a, b) in enumerate(c)]
    table = s.createDataFrame(rows, "k string, cluster int, latitude double, longitude double")
    return table.join(F.broadcast(counts), ["k", "cluster"], "left")


def nearest_region(s, d):
    placed = traffic(s, d).withColumns({"latitude": geo.latitude(), "longitude": geo.longitude()})
    return placed.select("Index", C.nearest("latitude", "longitude", CENTRES).alias("region"))


def assembled(s, d):
    model = _model(s, d)
    vectors = model.assemble(model.transform(traffic(s, d)), ["Index"])
    values = vector_to_array("features")
    return r6(vectors.select(
        "Index", F.size(values).alias("width"),
        F.aggregate(values, F.lit(0.0), lambda a, v: a + v).alias("total"),
    ))


def refitted_bins(s, d):
    """Bins whose edges come from the transformed rows themselves."""
    train, _ = train_test(s, d)
    model = fitted(train, refit_bins=True)
    return model.transform(traffic(s, d)).select("Index", "temperature_bin")


QUERIES = {
    "F01_impute_mode": mode_and_fill,
    "F02_impute_median": median_and_fill,
    "F03_hour_minute": _calendar("hour", "minute"),
    "F04_weekday_week": _calendar("weekday", "week"),
    "F05_month_quarter": _calendar("month", "quarter"),
    "F06_is_weekend": _calendar("is_weekend"),
    "F07_peak_flags": _calendar("is_morning_peak", "is_evening_peak", "is_peak_hour"),
    "F08_cyclic": _calendar("hour_sin", "hour_cos", "weekday_sin", "weekday_cos"),
    "F09_geohash_decode": _columns(lambda: {"latitude": geo.latitude(), "longitude": geo.longitude()}, "geohash"),
    "F09_rejected_geohashes": rejected,
    "F10_geo_frequency": frequency_with_unseen,
    "F11_region_clusters": regions,
    "F11_nearest_region": nearest_region,
    "F12_road_type_encoded": _stage("road_type_encoded"),
    "F13_binary_flags": _columns(
        lambda: {k: v for k, v in C.infrastructure().items() if k in ("large_vehicles_allowed", "has_landmarks")}
    ),
    "F14_road_capacity_score": _stage("road_capacity_score"),
    "F15_lanes_x_temperature": _stage("lanes_x_temperature"),
    "F16_weather_severity": _stage("weather_severity_score"),
    "F17_temperature_bin": _stage("temperature_bin"),
    "F17_temperature_bin_refit": refitted_bins,
    "F18_adverse_weather": _stage("adverse_weather", "adverse_weather_x_lanes"),
    "F19_interactions": _stage("weather_x_capacity", "lanes_x_weather_severity", "roadtype_x_weather"),
    "F20_landmarks": _stage("landmark_density_score", "landmark_lane_interaction"),
    "F21_transform": _stage(*PLAIN),
    "F22_assemble": assembled,
}


def _pick(*names: str) -> str:
    columns = ", ".join(r(n) if n in DOUBLES else n for n in names)
    return features_sql(f'SELECT "Index", {columns} FROM feats')


_DECODED = f"places AS (SELECT geohash, {LATITUDE} AS latitude, {LONGITUDE} AS longitude FROM (SELECT DISTINCT geohash FROM traffic))"
_DISTANCES = ", ".join(
    f"{{'d': (latitude - ({a})) * (latitude - ({a})) + (longitude - ({b})) * (longitude - ({b})), 'i': {i}}}"
    for i, (a, b) in enumerate(CENTRES)
)

ORACLE = {
    "F01_impute_mode": _pick("RoadType", "Weather"),
    "F02_impute_median": _pick("Temperature"),
    "F03_hour_minute": with_traffic(f'SELECT "Index", {HOUR} AS hour, {MINUTE} AS minute FROM traffic'),
    "F04_weekday_week": _pick("weekday", "week"),
    "F05_month_quarter": _pick("month", "quarter"),
    "F06_is_weekend": _pick("is_weekend"),
    "F07_peak_flags": _pick("is_morning_peak", "is_evening_peak", "is_peak_hour"),
    "F08_cyclic": _pick("hour_sin", "hour_cos", "weekday_sin", "weekday_cos"),
    "F09_geohash_decode": with_traffic(
        f'SELECT "Index", geohash, {r("latitude")}, {r("longitude")} FROM traffic JOIN places USING (geohash)', _DECODED
    ),
    "F09_rejected_geohashes": with_traffic(
        """SELECT count(*) AS rows, count(*) FILTER ("Index" % 50 = 0 OR "Index" % 77 = 0 OR "Index" % 91 = 0)
        AS rejected FROM traffic"""
    ),
    "F10_geo_frequency": with_traffic(
        """SELECT "Index", geohash, coalesce(f, 1) AS geo_frequency FROM traffic LEFT JOIN
        (SELECT geohash, count(*) AS f FROM train WHERE substr(geohash, 5, 1) <> 'z' GROUP BY geohash) USING (geohash)"""
    ),
    "F11_nearest_region": with_traffic(
        f'SELECT "Index", list_min([{_DISTANCES}]).i AS region FROM traffic JOIN places USING (geohash)', _DECODED
    ),
    "F12_road_type_encoded": _pick("road_type_encoded"),
    "F13_binary_flags": _pick("large_vehicles_allowed", "has_landmarks"),
    "F14_road_capacity_score": _pick("road_capacity_score"),
    "F15_lanes_x_temperature": _pick("lanes_x_temperature"),
    "F16_weather_severity": _pick("weather_severity_score"),
    "F17_temperature_bin": _pick("temperature_bin"),
    "F17_temperature_bin_refit": with_traffic(
        """SELECT "Index", CAST(len(list_filter(e[2:-2], lambda v: v < coalesce(Temperature, temp_median))) AS INTEGER)
        AS temperature_bin FROM traffic, state, own""", fit_ctes(),
        """own AS (SELECT list_sort(list_distinct(quantile_cont(coalesce(Temperature, temp_median),
        [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]))) AS e FROM traffic, state)""",
    ),
    "F18_adverse_weather": _pick("adverse_weather", "adverse_weather_x_lanes"),
    "F19_interactions": _pick("weather_x_capacity", "lanes_x_weather_severity", "roadtype_x_weather"),
    "F20_landmarks": _pick("landmark_density_score", "landmark_lane_interaction"),
    "F21_transform": _pick(*PLAIN),
    "F22_assemble": features_sql(
        f'SELECT "Index", {len(PLAIN)} AS width, {r(" + ".join(PLAIN), "total")} FROM feats'
    ),
}
