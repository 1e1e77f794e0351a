"""Column expressions of the feature set. Each one is a plain Catalyst expression."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from roadspark import schema as S


def _int(c: Column) -> Column:
    return c.cast("int")


def hour(slot: str = "timestamp") -> Column:
    return F.split_part(F.col(slot), F.lit(":"), F.lit(1)).try_cast("int")


def minute(slot: str = "timestamp") -> Column:
    """The part after the colon; 0 where a slot has none."""
    return F.coalesce(F.split_part(F.col(slot), F.lit(":"), F.lit(2)).try_cast("int"), F.lit(0))


def weekday(day: str = "day") -> Column:
    return F.pmod(F.col(day), F.lit(7))


def weekday_name(number: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, S.WEEKDAY_NAMES)), number + 1)


def week(day: str = "day") -> Column:
    return _int(F.floor(F.col(day) / 7))


def month(day: str = "day") -> Column:
    """30-day months that wrap after the twelfth."""
    return _int(F.pmod(F.floor(F.col(day) / 30), F.lit(12)) + 1)


def month_clipped(day: str = "day") -> Column:
    """30-day months where every later day stays in the twelfth."""
    return _int(F.least(F.floor(F.col(day) / 30), F.lit(11)) + 1)


def quarter(month_number: Column) -> Column:
    return _int(F.floor((month_number - 1) / 3) + 1)


def flag(condition: Column) -> Column:
    """1 where true, 0 where false or unknown."""
    return _int(F.coalesce(condition, F.lit(False)))


def calendar(day: str = "day", slot: str = "timestamp") -> dict[str, Column]:
    return {
        "hour": hour(slot), "minute": minute(slot), "weekday": weekday(day),
        "week": week(day), "month": month(day),
    }


def calendar_flags() -> dict[str, Column]:
    """Flags and cyclic codes over the columns of :func:`calendar`."""
    h, wd = F.col("hour"), F.col("weekday")
    morning, evening = ([*range(first, last + 1)] for first, last in (S.MORNING_PEAK, S.EVENING_PEAK))
    turn = 2 * math.pi
    return {
        "quarter": quarter(F.col("month")),
        "is_weekend": flag(wd >= 5),
        "is_morning_peak": flag(h.isin(morning)),
        "is_evening_peak": flag(h.isin(evening)),
        "is_peak_hour": flag(h.isin(morning + evening)),
        "hour_sin": F.sin(turn * h / 24),
        "hour_cos": F.cos(turn * h / 24),
        "weekday_sin": F.sin(turn * wd / 7),
        "weekday_cos": F.cos(turn * wd / 7),
    }


def code(name: str, codes: dict[str, int], unknown: int = 1) -> Column:
    lookup = F.create_map(*[F.lit(x) for pair in codes.items() for x in pair])
    return F.coalesce(F.try_element_at(lookup, F.col(name)), F.lit(unknown))


def infrastructure() -> dict[str, Column]:
    return {
        "road_type_encoded": code("RoadType", S.ROAD_TYPE_CODES),
        "large_vehicles_allowed": flag(F.col("LargeVehicles") == "Allowed"),
        "has_landmarks": flag(F.col("Landmarks") == "Yes"),
        "lanes_x_temperature": F.col("NumberofLanes") * F.col("Temperature"),
    }


def weather(bin_edges: list[float]) -> dict[str, Column]:
    return {
        "weather_severity_score": code("Weather", S.WEATHER_SEVERITY),
        "temperature_bin": quantile_bin(F.col("Temperature"), bin_edges),
        "adverse_weather": flag(F.col("Weather").isin(S.ADVERSE_WEATHER)),
    }


def quantile_bin(x: Column, edges: list[float], missing: int = 2) -> Column:
    """Right-closed bins between distinct ``edges``, the lowest edge included."""
    distinct = sorted(set(edges))
    if len(distinct) < 2:
        return F.lit(missing)
    above = [F.when(x > e, 1).otherwise(0) for e in distinct[1:-1]]
    return F.when(x.isNull(), missing).otherwise(sum(above, F.lit(0)))


def interactions() -> dict[str, Column]:
    """Products of earlier columns; ``road_capacity_score`` must exist."""
    lanes, severity = F.col("NumberofLanes"), F.col("weather_severity_score")
    landmarks = F.col("has_landmarks")
    return {
        "adverse_weather_x_lanes": F.col("adverse_weather") * lanes,
        "weather_x_capacity": severity * F.col("road_capacity_score"),
        "lanes_x_weather_severity": lanes * severity,
        "roadtype_x_weather": F.col("road_type_encoded") * severity,
        "landmark_density_score": landmarks * F.col("geo_frequency"),
        "landmark_lane_interaction": landmarks * lanes,
    }


def road_capacity() -> Column:
    return (
        F.col("road_type_encoded") * F.col("NumberofLanes")
        * (1 + 0.5 * F.col("large_vehicles_allowed"))
    )


def nearest(lat: str, lon: str, centres: list[list[float]]) -> Column:
    """Number of the closest centre, the lowest number on a tie."""
    distances = [
        F.struct(
            ((F.col(lat) - a) * (F.col(lat) - a) + (F.col(lon) - b) * (F.col(lon) - b)).alias("d"),
            F.lit(i).alias("i"),
        )
        for i, (a, b) in enumerate(centres)
    ]
    best = F.least(*distances) if len(distances) > 1 else distances[0]
    return F.when(F.col(lat).isNotNull() & F.col(lon).isNotNull(), best["i"])
