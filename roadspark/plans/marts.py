"""Analytics marts and the measures read off them."""

from __future__ import annotations

from pyspark.sql import functions as F

from roadspark.operators import marts as M
from roadspark.plans.base import HOUR, LATITUDE, LONGITUDE, r, r6, traffic, with_traffic
from roadspark.runtime import new_path
from roadspark.sources.traffic import from_events
from roadspark.streaming import marts as live


def _events_stream(spark, sf_dir):
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    # The glob lets the stream read a single file as well as a folder of files.
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/event[s].parquet")


def _finish(query) -> None:
    query.awaitTermination()


def _live_complete(spark, sf_dir, mart):
    folder = new_path(spark, "live")
    _finish(live.start_complete_mart(
        mart(from_events(_events_stream(spark, sf_dir))), folder, new_path(spark, "progress")
    ))
    return live.read_complete_mart(spark, folder)


def live_hourly(spark, sf_dir):
    return r6(_live_complete(spark, sf_dir, M.hourly_demand))


def live_lanes(spark, sf_dir):
    return r6(_live_complete(spark, sf_dir, M.lane_analysis))


def live_heatmap(spark, sf_dir):
    folder = new_path(spark, "live")
    _finish(live.start_incremental_mart(
        from_events(_events_stream(spark, sf_dir)), F.col("geohash"), "geohash", folder,
        new_path(spark, "progress"),
    ))
    return r6(live.read_incremental_mart(spark, folder, "geohash"))


def live_windows(spark, sf_dir):
    folder = new_path(spark, "live")
    stream = _events_stream(spark, sf_dir).withColumn("demand", F.col("value") / 500)
    _finish(
        live.windowed_demand(stream).writeStream.outputMode("append").format("parquet")
        .option("path", folder).option("checkpointLocation", new_path(spark, "progress"))
        .trigger(availableNow=True).start()
    )
    return r6(spark.read.schema("window_start timestamp, mean double, count bigint").parquet(folder))


def _hourly(spark, sf_dir):
    return M.hourly_demand(traffic(spark, sf_dir))


def _forecast(spark, sf_dir):
    return M.forecast(_hourly(spark, sf_dir), half_even=False)


def _heat(spark, sf_dir):
    return M.heatmap(traffic(spark, sf_dir))


QUERIES = {
    "A01_hourly_demand": lambda s, d: r6(_hourly(s, d)),
    "A02_weather_impact": lambda s, d: r6(M.weather_impact(traffic(s, d))),
    "A03_road_capacity": lambda s, d: r6(M.road_capacity(traffic(s, d))),
    "A04_lane_analysis": lambda s, d: r6(M.lane_analysis(traffic(s, d))),
    "A05_weekday_demand": lambda s, d: r6(M.weekday_demand(traffic(s, d))),
    "A06_peak_hours": lambda s, d: r6(M.peak_hours(_hourly(s, d))),
    "A07_heatmap": lambda s, d: r6(_heat(s, d)),
    "A08_forecast": _forecast,
    "A09_incremental_hourly": live_hourly,
    "A09_incremental_lanes": live_lanes,
    "A09_incremental_heatmap": live_heatmap,
    "A09_windowed_demand": live_windows,
    "A10_overview": lambda s, d: M.overview(traffic(s, d), half_even=False),
    "A11_peak_flag": lambda s, d: r6(M.peak_flags(_hourly(s, d))),
    "A11_peak_ratio": lambda s, d: r6(M.peak_ratio(_hourly(s, d))),
    "A12_heat_summary": lambda s, d: r6(M.heat_summary(_heat(s, d))),
    "A13_hotspots": lambda s, d: r6(M.hotspots(_heat(s, d))),
    "A13_coldspots": lambda s, d: r6(M.coldspots(_heat(s, d))),
    "A14_heat_band": lambda s, d: r6(M.heat_bands(_heat(s, d))),
    "A15_forecast_peak": lambda s, d: M.forecast_peak(_forecast(s, d)),
    "A16_weather_extremes": lambda s, d: r6(M.weather_extremes(M.weather_impact(traffic(s, d)))),
    "A16_weather_profile": lambda s, d: r6(M.weather_profile(M.weather_impact(traffic(s, d)))),
    "A17_road_utilization": lambda s, d: r6(M.road_utilization(M.road_capacity(traffic(s, d)))),
}

_HOURLY = f"""hourly AS (SELECT {HOUR} AS hour, avg(demand) AS mean, stddev_samp(demand) AS std,
    count(*) AS count FROM traffic GROUP BY 1)"""
_FORECAST = """forecast AS (SELECT hour, round(mean, 4) AS predicted_demand,
    round(greatest(0, mean - 1.96 * coalesce(std, 0)), 4) AS confidence_low,
    round(mean + 1.96 * coalesce(std, 0), 4) AS confidence_high FROM hourly)"""
_HEAT = f"""heat AS (SELECT geohash, demand, {LATITUDE} AS latitude, {LONGITUDE} AS longitude
    FROM (SELECT geohash, avg(demand) AS demand FROM traffic GROUP BY geohash))"""
_PEAKS = """ranked AS (SELECT hour, mean, row_number() OVER (ORDER BY mean DESC, hour) AS top,
      row_number() OVER (ORDER BY mean, hour DESC) AS low FROM hourly),
    listed AS (SELECT 'peak' AS kind, top AS place, hour, mean FROM ranked WHERE top <= 5
      UNION ALL SELECT 'off_peak', top, hour, mean FROM ranked WHERE low <= 5),
    peaks AS (SELECT kind, row_number() OVER (PARTITION BY kind ORDER BY place) AS position, hour, mean,
      avg(mean) OVER (PARTITION BY kind) AS avg_demand FROM listed)"""


def _category(column: str) -> str:
    return f"""SELECT {column}, avg(demand) AS mean, median(demand) AS median, stddev_samp(demand) AS std,
        count(*) AS count FROM traffic WHERE {column} IS NOT NULL GROUP BY {column}"""


_FULL = f"{r('mean')}, {r('median')}, {r('std')}, count"
_HOUR_ROWS = with_traffic(f"SELECT hour, {r('mean')}, {r('std')}, count FROM hourly", _HOURLY)
_LANE_ROWS = with_traffic(
    f"""SELECT NumberofLanes, {r('avg(demand)', 'mean')}, {r('stddev_samp(demand)', 'std')},
    count(*) AS count FROM traffic GROUP BY NumberofLanes"""
)

ORACLE = {
    "A01_hourly_demand": _HOUR_ROWS,
    "A02_weather_impact": with_traffic(f"SELECT Weather, {_FULL} FROM ({_category('Weather')})"),
    "A03_road_capacity": with_traffic(f"SELECT RoadType, {_FULL} FROM ({_category('RoadType')})"),
    "A04_lane_analysis": _LANE_ROWS,
    "A05_weekday_demand": with_traffic(
        f"""SELECT day % 7 AS weekday, {r('avg(demand)', 'mean')}, {r('stddev_samp(demand)', 'std')},
        ['Mon','Tue','Wed','Thu','Fri','Sat','Sun'][day % 7 + 1] AS name FROM traffic GROUP BY day % 7"""
    ),
    "A06_peak_hours": with_traffic(
        f"SELECT kind, CAST(position AS INTEGER) AS position, hour, {r('mean')}, {r('avg_demand')} FROM peaks",
        _HOURLY, _PEAKS,
    ),
    "A07_heatmap": with_traffic(
        f"SELECT geohash, {r('demand')}, {r('latitude')}, {r('longitude')} FROM heat", _HEAT
    ),
    "A08_forecast": with_traffic("SELECT * FROM forecast", _HOURLY, _FORECAST),
    "A09_incremental_hourly": _HOUR_ROWS,
    "A09_incremental_lanes": _LANE_ROWS,
    "A09_incremental_heatmap": with_traffic(
        f"""SELECT geohash, {r('avg(demand)', 'mean')}, {r('stddev_samp(demand)', 'std')}, count(*) AS count
        FROM traffic GROUP BY geohash"""
    ),
    "A10_overview": with_traffic(
        """SELECT count(DISTINCT geohash) AS total_locations, count(DISTINCT Weather) AS weather_types,
        count(DISTINCT RoadType) AS road_types, (SELECT max(predicted_demand) FROM forecast) AS peak_demand
        FROM traffic""", _HOURLY, _FORECAST,
    ),
    "A11_peak_flag": with_traffic(
        f"""SELECT hour, {r('mean')}, {r('std')}, count,
        hour IN (SELECT hour FROM peaks WHERE kind = 'peak') AS is_peak, hour || ':00' AS label FROM hourly""",
        _HOURLY, _PEAKS,
    ),
    "A11_peak_ratio": with_traffic(
        f"""SELECT {r('p', 'peak_avg_demand')}, {r('o', 'off_peak_avg_demand')},
        {r('p / coalesce(nullif(o, 0), 1)', 'peak_ratio')}
        FROM (SELECT max(avg_demand) FILTER (kind = 'peak') AS p,
                     max(avg_demand) FILTER (kind = 'off_peak') AS o FROM peaks)""", _HOURLY, _PEAKS,
    ),
    "A12_heat_summary": with_traffic(
        f"""SELECT {r('max(demand)', 'max_demand')}, {r('min(demand)', 'min_demand')},
        {r('avg(demand)', 'avg_demand')}, count(*) AS total FROM heat""", _HEAT,
    ),
    "A13_hotspots": with_traffic(
        f"""SELECT geohash, {r('demand')}, {r('latitude')}, {r('longitude')}
        FROM (SELECT * FROM heat ORDER BY demand DESC, geohash LIMIT 10)""", _HEAT,
    ),
    "A13_coldspots": with_traffic(
        f"""SELECT geohash, {r('demand')}, {r('latitude')}, {r('longitude')}
        FROM (SELECT * FROM heat ORDER BY demand, geohash DESC LIMIT 5)""", _HEAT,
    ),
    "A14_heat_band": with_traffic(
        f"""SELECT geohash, {r('demand')}, {r('ratio')},
        CASE WHEN ratio > 0.8 THEN 'very_high' WHEN ratio > 0.6 THEN 'high' WHEN ratio > 0.4 THEN 'medium'
             WHEN ratio > 0.2 THEN 'low' ELSE 'very_low' END AS band,
        {r('greatest(8, 100 * ratio)', 'bar_pct')}
        FROM (SELECT geohash, demand, (demand - min(demand) OVER ())
              / (max(demand) OVER () - min(demand) OVER () + 0.0001) AS ratio FROM heat)""", _HEAT,
    ),
    "A15_forecast_peak": with_traffic(
        "SELECT hour, predicted_demand FROM forecast ORDER BY predicted_demand DESC, hour LIMIT 1",
        _HOURLY, _FORECAST,
    ),
    "A16_weather_extremes": with_traffic(
        f"""SELECT (SELECT Weather FROM w ORDER BY mean DESC, Weather LIMIT 1) AS best_weather,
        (SELECT Weather FROM w ORDER BY mean, Weather LIMIT 1) AS worst_weather,
        {r('max(mean)', 'max_demand')}, {r('min(mean)', 'min_demand')} FROM w""",
        f"w AS ({_category('Weather')})",
    ),
    "A16_weather_profile": with_traffic(
        f"SELECT Weather, {r('mean', 'demand')}, {r('std', 'variability')} FROM ({_category('Weather')})"
    ),
    "A17_road_utilization": with_traffic(
        f"""SELECT RoadType, {_FULL},
        {r('least(100, 100 * mean / greatest(max(mean) OVER (), 0.001))', 'utilization')} FROM w""",
        f"w AS ({_category('RoadType')})",
    ),
}
