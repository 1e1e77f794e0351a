"""Table schemas and the constants shared by every operator."""

from __future__ import annotations

from pyspark.sql import types as T

ID = "Index"
TARGET = "demand"
KEY_COLUMNS = ["geohash", "day", "timestamp"]

TEST_SCHEMA = T.StructType([
    T.StructField("Index", T.LongType()),
    T.StructField("geohash", T.StringType()),
    T.StructField("day", T.IntegerType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("RoadType", T.StringType()),
    T.StructField("NumberofLanes", T.IntegerType()),
    T.StructField("LargeVehicles", T.StringType()),
    T.StructField("Landmarks", T.StringType()),
    T.StructField("Temperature", T.DoubleType()),
    T.StructField("Weather", T.StringType()),
])
TRAIN_SCHEMA = T.StructType(
    TEST_SCHEMA.fields[:4] + [T.StructField(TARGET, T.DoubleType())] + TEST_SCHEMA.fields[4:]
)
SUBMISSION_SCHEMA = T.StructType([
    T.StructField("Index", T.LongType()),
    T.StructField(TARGET, T.DoubleType()),
])
SCHEMAS = {"train": TRAIN_SCHEMA, "test": TEST_SCHEMA, "submission": SUBMISSION_SCHEMA}

# Fixed values that results depend on.
ROAD_TYPE_CODES = {"Residential": 1, "Street": 2, "Highway": 3}
WEATHER_SEVERITY = {"Sunny": 0, "Foggy": 1, "Rainy": 2, "Snowy": 3}
ADVERSE_WEATHER = ["Rainy", "Snowy"]
WEATHER_ORDER = list(WEATHER_SEVERITY)
WEEKDAY_NAMES = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]
MORNING_PEAK = (7, 9)
EVENING_PEAK = (17, 19)
CLUSTER_SIZES = (5, 10, 15)
SEED = 42
CV_FOLDS = 5
TUNING_FOLDS = 3
TUNING_TRIALS = 100

DOMAINS = {
    "RoadType": list(ROAD_TYPE_CODES),
    "Weather": WEATHER_ORDER,
    "LargeVehicles": ["Allowed", "Not Allowed"],
    "Landmarks": ["Yes", "No"],
}

# Values a prediction request takes for fields it leaves out.
REQUEST_DEFAULTS = {
    "RoadType": "Residential",
    "NumberofLanes": "2",
    "LargeVehicles": "Not Allowed",
    "Landmarks": "No",
    "Temperature": "20.0",
    "Weather": "Sunny",
}

FEATURE_COLUMNS = [
    "NumberofLanes", "Temperature", "hour", "minute", "weekday", "week", "month", "quarter",
    "is_weekend", "is_morning_peak", "is_evening_peak", "is_peak_hour",
    "hour_sin", "hour_cos", "weekday_sin", "weekday_cos",
    "latitude", "longitude", "geo_frequency",
    "region_cluster_5", "region_cluster_10", "region_cluster_15",
    "road_type_encoded", "large_vehicles_allowed", "has_landmarks", "road_capacity_score",
    "lanes_x_temperature", "weather_severity_score", "temperature_bin", "adverse_weather",
    "adverse_weather_x_lanes", "weather_x_capacity", "lanes_x_weather_severity",
    "roadtype_x_weather", "landmark_density_score", "landmark_lane_interaction",
]
