"""Road observations derived from the ``events`` table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"

_SLOT_HOUR = "CAST(CAST(extract(hour FROM ts) AS INT) AS VARCHAR(2))"
_SLOT_MINUTE = "CAST(CAST(floor(extract(minute FROM ts) / 15) * 15 AS INT) AS VARCHAR(2))"

# Each entry reads the same in Spark SQL and in the checking database.
PROJECTION = [
    'event_id AS {q}Index{q}',
    f"'qp0' || substr('{_ALPHABET}', CAST(floor(user_id / 32) AS INT) % 32 + 1, 1)"
    f" || substr('{_ALPHABET}', CAST(user_id % 32 AS INT) + 1, 1)"
    f" || substr('{_ALPHABET}', CAST((user_id * 7) % 32 AS INT) + 1, 1) AS geohash",
    "48 + CAST(extract(day FROM ts) AS INT) - 1 AS day",
    f"{_SLOT_HOUR} || ':' || {_SLOT_MINUTE} AS timestamp",
    "value / 500.0 AS demand",
    "CASE WHEN event_id % 129 = 0 THEN NULL WHEN user_id % 20 = 0 THEN 'Highway'"
    " WHEN user_id % 20 = 1 THEN 'Street' ELSE 'Residential' END AS RoadType",
    "CAST(1 + user_id % 5 AS INT) AS NumberofLanes",
    "CASE WHEN user_id % 3 = 0 THEN 'Allowed' ELSE 'Not Allowed' END AS LargeVehicles",
    "CASE WHEN user_id % 3 = 1 THEN 'No' ELSE 'Yes' END AS Landmarks",
    "CASE WHEN event_id % 31 = 0 THEN NULL"
    " ELSE CAST((event_id * 37) % 631 AS DOUBLE) / 10.0 - 14.9 END AS Temperature",
    "CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_type IN ('view','signup') THEN 'Sunny'"
    " WHEN event_type = 'click' THEN 'Rainy' WHEN event_type = 'purchase' THEN 'Foggy'"
    " ELSE 'Snowy' END AS Weather",
]

# The first day of the scoring side; earlier days are for fitting.
SPLIT_DAY = 70


def from_events(events: DataFrame) -> DataFrame:
    return events.selectExpr(*[p.format(q="`") for p in PROJECTION])


def read_traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return from_events(spark.read.parquet(f"{sf_dir}/events.parquet"))


def split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return df.where(f"day < {SPLIT_DAY}"), df.where(f"day >= {SPLIT_DAY}")
