"""Exploratory tables."""

from __future__ import annotations

from roadspark.functions import columns as C
from roadspark.operators import eda as E
from roadspark.operators.sampling import hash_sample
from roadspark.plans.base import HOUR, MINUTE, r, r6, traffic, with_traffic
from roadspark.schema import WEATHER_ORDER

# Demand has five decimals, an eightieth of a range four more: nine hold an edge exactly.
EDGE_DIGITS = 9
NUMERIC = ["Index", "day", "demand", "NumberofLanes", "Temperature", "hour", "minute"]


def _numeric(s, d):
    return traffic(s, d).withColumns({"hour": C.hour(), "minute": C.minute()})


QUERIES = {
    "E01_histogram": lambda s, d: r6(E.histogram(traffic(s, d)), left=EDGE_DIGITS, right=EDGE_DIGITS),
    "E02_log_histogram": lambda s, d: r6(E.log_histogram(traffic(s, d)), left=EDGE_DIGITS, right=EDGE_DIGITS),
    "E03_kde_curve": lambda s, d: r6(E.kde_curve(traffic(s, d))),
    "E03_kde_violin_by_weather": lambda s, d: r6(
        E.kde_curve(traffic(s, d).where("Weather IS NOT NULL"), grid=100, cut=2.0, by="Weather")
    ),
    "E04_box_stats": lambda s, d: r6(E.box_stats(traffic(s, d))),
    "E04_box_stats_by_road_type": lambda s, d: r6(E.box_stats(traffic(s, d), by="RoadType")),
    "E04_box_stats_by_landmarks": lambda s, d: r6(E.box_stats(traffic(s, d), by="Landmarks")),
    "E05_quartiles_by_weather": lambda s, d: r6(E.quartiles_by(traffic(s, d), "Weather", only=WEATHER_ORDER)),
    "E05_quartiles_by_large_vehicles": lambda s, d: r6(E.quartiles_by(traffic(s, d), "LargeVehicles")),
    "E06_quantile_table": lambda s, d: r6(E.quantile_table(traffic(s, d))),
    "E07_demand_by_hour": lambda s, d: r6(E.demand_by_hour(traffic(s, d))),
    "E08_demand_by_day": lambda s, d: r6(E.demand_by_day(traffic(s, d))),
    "E09_demand_by_weekday": lambda s, d: r6(E.demand_by_weekday(traffic(s, d))),
    "E10_demand_by_month_clipped": lambda s, d: r6(E.demand_by_month_clipped(traffic(s, d))),
    "E11_top_locations": lambda s, d: r6(E.top_locations(traffic(s, d))),
    "E12_top_regions": lambda s, d: r6(E.top_regions(traffic(s, d))),
    "E13_weather_means_ordered": lambda s, d: r6(E.weather_means_ordered(traffic(s, d))),
    "E14_temperature_trend": lambda s, d: r6(E.temperature_trend(traffic(s, d))),
    "E14_temperature_fit": lambda s, d: r6(E.temperature_fit(traffic(s, d))),
    "E15_demand_by_lanes": lambda s, d: r6(E.demand_by_lanes(traffic(s, d))),
    "E16_correlation_matrix": lambda s, d: r6(E.correlation_matrix(_numeric(s, d), NUMERIC)),
    "X01_hash_sample": lambda s, d: r6(hash_sample(traffic(s, d), 5000)),
}


def _histogram(value: str) -> str:
    return with_traffic(
        f"""SELECT CAST(b AS INTEGER) AS bin, {r('lo + (b - 1) * w', '"left"', EDGE_DIGITS)},
        {r('lo + b * w', '"right"', EDGE_DIGITS)},
        coalesce(n, 0) AS count, {r('mean')}, {r('median')}
        FROM range(1, 81) g(b) CROSS JOIN m LEFT JOIN counts ON counts.bin = b""",
        f"x AS (SELECT {value} AS v FROM traffic)",
        """m AS (SELECT min(v) AS lo, (max(v) - min(v)) / 80 AS w, max(v) AS hi, avg(v) AS mean,
        median(v) AS median FROM x)""",
        """counts AS (SELECT least(floor(80 * (v - lo) / (hi - lo)) + 1, 80) AS bin, count(*) AS n
        FROM x, m GROUP BY 1)""",
    )


def _kde(by: str, grid: int, cut: float, where: str = "true") -> str:
    key = by or "''"
    out = f"g AS {by}, " if by else ""
    return with_traffic(
        f"""SELECT {out}CAST(p AS INTEGER) AS point, {r('gx', 'x')},
        {r('sum(exp(-0.5 * power((gx - v) / h, 2))) / (any_value(n) * any_value(h) * sqrt(2 * pi()))', 'density')}
        FROM grid JOIN x USING (g) GROUP BY g, p, gx""",
        f"x AS (SELECT {key} AS g, demand AS v FROM traffic WHERE {where})",
        """shape AS (SELECT g, count(*) AS n, min(v) AS lo, max(v) AS hi,
        stddev_samp(v) * power(count(*), -0.2) AS h FROM x GROUP BY g)""",
        f"""grid AS (SELECT g, p, n, h, lo - {cut} * h + p * ((hi - lo + {2 * cut} * h) / {grid - 1}) AS gx
        FROM shape CROSS JOIN range(0, {grid}) t(p))""",
    )


def _box(by: str | None) -> str:
    key = by or "'all'"
    out = f"g AS {by}, " if by else ""
    return with_traffic(
        f"""SELECT {out}{r('q1')}, {r('median')}, {r('q3')},
        {r('min(v) FILTER (inside)', 'whisker_low')}, {r('max(v) FILTER (inside)', 'whisker_high')},
        count(*) FILTER (NOT inside) AS outliers, count(*) AS count
        FROM (SELECT *, v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside FROM x JOIN q USING (g))
        GROUP BY g, q1, median, q3""",
        f"x AS (SELECT {key} AS g, demand AS v FROM traffic WHERE {key} IS NOT NULL)",
        """q AS (SELECT g, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median,
        quantile_cont(v, 0.75) AS q3 FROM x GROUP BY g)""",
    )


def _quartiles(by: str) -> str:
    return with_traffic(
        f"""SELECT {by}, {r('quantile_cont(demand, 0.25)', 'q1')}, {r('median(demand)', 'median')},
        {r('quantile_cont(demand, 0.75)', 'q3')} FROM traffic WHERE {by} IS NOT NULL GROUP BY {by}"""
    )


def _mean_by(name: str, key: str, tail: str = "", more: str = "") -> str:
    return with_traffic(
        f"SELECT {name}, {r('mean')}{more} FROM (SELECT {key} AS {name}, avg(demand) AS mean,"
        f" stddev_samp(demand) AS std, count(*) AS count FROM traffic GROUP BY 1 {tail})"
    )


def _sample(n: int, where: str = "true") -> str:
    return f"""sample AS (SELECT * FROM traffic WHERE {where}
        ORDER BY md5('42:' || CAST("Index" AS VARCHAR)), "Index" LIMIT {n})"""


_FIT = """(SELECT regr_slope(demand, Temperature) AS slope, regr_intercept(demand, Temperature) AS intercept,
    min(Temperature) AS t_min, max(Temperature) AS t_max, count(*) AS n FROM {source})"""


def _correlation() -> str:
    pairs = [(NUMERIC[i], NUMERIC[j]) for i in range(len(NUMERIC)) for j in range(i)]
    rows = " UNION ALL ".join(
        f"""SELECT '{a}' AS a, '{b}' AS b, CASE WHEN isnan(corr("{a}", "{b}")) THEN NULL
        ELSE round(corr("{a}", "{b}"), 6) + 0.0 END AS r FROM x""" for a, b in pairs
    )
    return with_traffic(rows, f"x AS (SELECT *, {HOUR} AS hour, {MINUTE} AS minute FROM traffic)")


_PROBS = ", ".join(str(p) for p in E.QUANTILES)

ORACLE = {
    "E01_histogram": _histogram("demand"),
    "E02_log_histogram": _histogram("ln(1 + demand)"),
    "E03_kde_curve": _kde("", 200, 0.0),
    "E03_kde_violin_by_weather": _kde("Weather", 100, 2.0, "Weather IS NOT NULL"),
    "E04_box_stats": _box(None),
    "E04_box_stats_by_road_type": _box("RoadType"),
    "E04_box_stats_by_landmarks": _box("Landmarks"),
    "E05_quartiles_by_weather": _quartiles("Weather"),
    "E05_quartiles_by_large_vehicles": _quartiles("LargeVehicles"),
    "E06_quantile_table": with_traffic(
        f"""SELECT unnest([{_PROBS}])::DOUBLE AS prob, {r(f'unnest(quantile_cont(demand, [{_PROBS}]))', 'value')}
        FROM traffic"""
    ),
    "E07_demand_by_hour": with_traffic(
        f"""SELECT hour, {r('mean')}, {r('std')}, {r('mean - std', 'low')}, {r('mean + std', 'high')}
        FROM (SELECT {HOUR} AS hour, avg(demand) AS mean, stddev_samp(demand) AS std FROM traffic GROUP BY 1)"""
    ),
    "E08_demand_by_day": _mean_by("day", "day"),
    "E09_demand_by_weekday": _mean_by(
        "weekday", "day % 7",
        more=", ['Mon','Tue','Wed','Thu','Fri','Sat','Sun'][weekday + 1] AS weekday_name, weekday >= 5 AS is_weekend",
    ),
    "E10_demand_by_month_clipped": _mean_by("month_clipped", "CAST(least(floor(day / 30), 11) + 1 AS INTEGER)"),
    "E11_top_locations": _mean_by("geohash", "geohash", "ORDER BY mean DESC, geohash LIMIT 30"),
    "E12_top_regions": _mean_by("region", "substr(geohash, 1, 4)", "ORDER BY mean DESC, region LIMIT 20", ", count"),
    "E13_weather_means_ordered": with_traffic(
        f"""SELECT CAST(position AS INTEGER) AS position, o.Weather, {r('mean')}
        FROM (VALUES (0, 'Sunny'), (1, 'Foggy'), (2, 'Rainy'), (3, 'Snowy')) o(position, Weather)
        LEFT JOIN (SELECT Weather, avg(demand) AS mean FROM traffic GROUP BY Weather) m USING (Weather)"""
    ),
    "E14_temperature_trend": with_traffic(
        f"""SELECT CAST(p AS INTEGER) AS point, {r('t', 'temperature')}, {r('intercept + slope * t', 'trend')}
        FROM (SELECT *, t_min + p * ((t_max - t_min) / 99) AS t FROM {_FIT.format(source='traffic WHERE Temperature IS NOT NULL')} f
        CROSS JOIN range(0, 100) g(p))""",
    ),
    "E14_temperature_fit": with_traffic(
        f"""SELECT {r('slope')}, {r('intercept')}, {r('t_min')}, {r('t_max')}, n
        FROM {_FIT.format(source='(SELECT * FROM traffic WHERE Temperature IS NOT NULL)')} f"""
    ),
    "E15_demand_by_lanes": _mean_by("NumberofLanes", "NumberofLanes", more=f", {r('std')}"),
    "E16_correlation_matrix": _correlation(),
    "X01_hash_sample": with_traffic(
        f'SELECT * REPLACE ({r("demand")}, {r("Temperature")}) FROM sample', _sample(5000)
    ),
}
