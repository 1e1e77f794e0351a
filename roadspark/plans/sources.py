"""Readers and writers, each checked by reading back what was written."""

from __future__ import annotations

from pyspark.sql import functions as F

from roadspark.operators import marts
from roadspark.operators import training as T
from roadspark.operators.features import RoadFeaturesModel
from roadspark.operators.metrics import cv_leaderboard
from roadspark.operators.ranking import aggregate_rankings, pearson_rank, spearman_rank, stacked_scores, stored_features
from roadspark.operators.scoring import load_models, save_models, submission
from roadspark.plans import models as P
from roadspark.plans import quality as PQ
from roadspark.plans.base import features_sql, fitted, r, r6, traffic, train_test, with_traffic
from roadspark.runtime import new_path
from roadspark.schema import SUBMISSION_SCHEMA
from roadspark.sources import observations as O
from roadspark.sources.requests import read_requests

STATE_CHECK = ["RoadType", "Weather", "Temperature", "geo_frequency", "temperature_bin", "landmark_density_score"]
RANKED = ["NumberofLanes", "hour", "day"]


def round_trip(s, d):
    path = new_path(s, "observations")
    O.write_csv(traffic(s, d), path)
    return r6(O.read_observations(s, path, "train"))


def quality_file(s, d):
    path = new_path(s, "quality")
    train, test = train_test(s, d)
    O.write_quality_report(train, test.drop("demand"), path, half_even=False)
    report = s.read.json(path)
    return r6(report.select(
        "dataset", "total_rows", "total_missing_cells", "full_duplicates", "key_duplicates",
        F.size("columns_with_missing").alias("columns_with_missing"),
        F.col("target_analysis.mean").alias("target_mean"),
    ))


def summary_file(s, d):
    path = new_path(s, "summary")
    O.write_feature_summary(traffic(s, d), path, half_even=False)
    schema = (
        "feature string, dtype string, missing_count bigint, missing_pct double, unique_values bigint,"
        " mean double, std double, min double, max double"
    )
    return r6(s.read.schema(schema).option("header", True).csv(path))


def leaderboard_file(s, d):
    path = new_path(s, "leaderboard")
    O.write_cv_results(cv_leaderboard(P.fold_metrics(s, d), half_even=False), path)
    schema = (
        "position int, model string, r2_mean double, r2_std double, rmse_mean double, mae_mean double, is_best boolean"
    )
    return s.read.schema(schema).option("header", True).csv(path)


def rankings_file(s, d):
    path = new_path(s, "rankings")
    df = traffic(s, d).withColumn("hour", F.split_part("timestamp", F.lit(":"), F.lit(1)).cast("int"))
    df = stored_features(df, RANKED)
    tables = {"pearson": pearson_rank(df, RANKED), "spearman": spearman_rank(df, RANKED)}
    O.write_rankings(aggregate_rankings(stacked_scores(tables), list(tables)), path)
    schema = "feature string, pearson_rank double, spearman_rank double, avg_rank double"
    return s.read.schema(schema).option("header", True).csv(path)


def submission_file(s, d):
    path = new_path(s, "submission")
    scored = P.raw_predictions(train_test(s, d)[1]).select("Index", F.greatest("pred_a", F.lit(0.0)).alias("demand"))
    O.write_submission(submission(scored), path)
    return r6(s.read.schema(SUBMISSION_SCHEMA).option("header", True).csv(path))


def saved_state(s, d):
    path = new_path(s, "features")
    fitted(train_test(s, d)[0]).save(path)
    model = RoadFeaturesModel.load(s, path)
    return r6(model.transform(traffic(s, d)).select("Index", *STATE_CHECK))


def partial_models(s, d):
    """Two models are saved, three are asked for; test error of those that load."""
    own = P.study(s, d)
    path = new_path(s, "models")
    save_models(s, own.models(["linear", "boosted_full"]), path)
    models = load_models(s, path, ["linear", "boosted_full", "boosted_columns"])
    scored = T.predict(own.test_rows, models)
    long = scored.select("Index", "demand", *[F.col(f"pred_{n}").alias(n) for n in models]).unpivot(
        ["Index", "demand"], list(models), "model", "pred"
    )
    return r6(P.M.regression_metrics(long, ["model"]))


# Requests leave some fields out and set some to null, by row number.
_ABSENT = {"RoadType": 2, "NumberofLanes": 3, "LargeVehicles": 5, "Landmarks": 7, "Temperature": 11, "Weather": 13}


def requests(s, d):
    df = traffic(s, d).drop("demand")
    pairs = [
        F.struct(F.lit(c).alias("key"), F.col(c).cast("string").alias("value"))
        if c not in _ABSENT else
        F.when(F.col("Index") % _ABSENT[c] != 0, F.struct(F.lit(c).alias("key"), F.col(c).cast("string").alias("value")))
        for c in df.columns if c != "Index"
    ]
    entries = F.map_from_entries(F.array_compact(F.array(*pairs)))
    text = df.select("Index", F.to_json(entries, {"ignoreNullFields": "false"}).alias("value"))
    return r6(read_requests(text))


def mart_sizes(s, d):
    folder = new_path(s, "marts")
    df = traffic(s, d).persist()
    paths = O.publish_marts(marts.all_marts(df, half_even=False), folder)
    counts = [s.read.parquet(p).agg(F.count("*").alias("rows")).select(F.lit(n).alias("mart"), "rows")
              for n, p in paths.items()]
    table = counts[0]
    for part in counts[1:]:
        table = table.unionByName(part)
    df.unpersist()
    return table


QUERIES = {
    "S01_read_observations": round_trip,
    "S03_quality_report": quality_file,
    "S04_feature_summary": summary_file,
    "S05_cv_results": leaderboard_file,
    "S05_rankings": rankings_file,
    "S06_submission": submission_file,
    "S07_saved_state": saved_state,
    "S08_load_models": partial_models,
    "S09_read_requests": requests,
    "S10_publish_marts": mart_sizes,
}

_DEFAULTS = {
    "RoadType": "'Residential'", "NumberofLanes": "2", "LargeVehicles": "'Not Allowed'", "Landmarks": "'No'",
    "Temperature": "20.0", "Weather": "'Sunny'",
}
_MART_ROWS = {
    "hourly_demand": "count(DISTINCT split_part(timestamp, ':', 1))",
    "weather_impact": "count(DISTINCT Weather)", "road_capacity": "count(DISTINCT RoadType)",
    "lane_analysis": "count(DISTINCT NumberofLanes)", "weekday_demand": "count(DISTINCT day % 7)",
    "peak_hours": "2 * least(count(DISTINCT split_part(timestamp, ':', 1)), 5)",
    "heatmap": "count(DISTINCT geohash)", "forecast": "count(DISTINCT split_part(timestamp, ':', 1))",
    "overview": "1", "peak_flags": "count(DISTINCT split_part(timestamp, ':', 1))", "peak_ratio": "1",
    "heat_summary": "1", "hotspots": "least(count(DISTINCT geohash), 10)",
    "coldspots": "least(count(DISTINCT geohash), 5)", "heat_bands": "count(DISTINCT geohash)",
    "forecast_peak": "1", "weather_extremes": "1", "weather_profile": "count(DISTINCT Weather)",
    "road_utilization": "count(DISTINCT RoadType)",
}
_RANK_SQL = "rank() OVER (ORDER BY {s} DESC) + (count(*) OVER (PARTITION BY {s}) - 1) / 2.0"


def _side(name: str, source: str, target: bool) -> str:
    columns = [c for c in PQ.COLUMNS if target or c != "demand"]
    missing = " + ".join(f'count(*) - count("{c}")' for c in columns)
    empty = "0" if target else "count(*)"
    present = " + ".join(f'CAST(count(*) > count("{c}") AS INTEGER)' for c in columns)
    return f"""SELECT '{name}' AS dataset, count(*) AS total_rows,
        CAST({missing} + {empty} AS BIGINT) AS total_missing_cells,
        count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {source})) AS full_duplicates,
        count(*) - (SELECT count(*) FROM (SELECT DISTINCT {PQ.KEYS} FROM {source})) AS key_duplicates,
        CAST({present} + {0 if target else 1} AS INTEGER) AS columns_with_missing,
        {r('avg(demand)' if target else 'NULL::DOUBLE', 'target_mean')} FROM {source}"""


ORACLE = {
    "S01_read_observations": with_traffic(f"SELECT * REPLACE ({r('demand')}, {r('Temperature')}) FROM traffic"),
    "S03_quality_report": with_traffic(
        _side("train", "train", True) + " UNION ALL " + _side("test", "test", False)
    ),
    "S04_feature_summary": with_traffic(f"SELECT * EXCLUDE (position) FROM ({PQ._summary('traffic')})"),
    "S05_cv_results": P.ORACLE["M06_cv_leaderboard"],
    "S05_rankings": with_traffic(
        """SELECT *, (pearson_rank + spearman_rank) / 2 AS avg_rank FROM (SELECT feature,
        CAST(""" + _RANK_SQL.format(s="p") + """ AS DOUBLE) AS pearson_rank,
        CAST(""" + _RANK_SQL.format(s="q") + """ AS DOUBLE) AS spearman_rank FROM
        (SELECT feature, abs(corr(x, demand)) AS p, abs(corr(rx, ry)) AS q FROM ranked GROUP BY feature))""",
        """lng AS (UNPIVOT (SELECT "Index", demand, NumberofLanes::DOUBLE AS NumberofLanes,
        split_part(timestamp, ':', 1)::DOUBLE AS hour, day::DOUBLE AS day FROM traffic)
        ON NumberofLanes, hour, day INTO NAME feature VALUE x)""",
        """ranked AS (SELECT *, rank() OVER (PARTITION BY feature ORDER BY x)
          + (count(*) OVER (PARTITION BY feature, x) - 1) / 2.0 AS rx,
          rank() OVER (PARTITION BY feature ORDER BY demand)
          + (count(*) OVER (PARTITION BY feature, demand) - 1) / 2.0 AS ry FROM lng)""",
    ),
    "S06_submission": with_traffic(f'SELECT "Index", {r("greatest(a, 0)", "demand")} FROM raw WHERE day >= 70', P._RAW),
    "S07_saved_state": features_sql(
        'SELECT "Index", ' + ", ".join(r(c) if c == "Temperature" else c for c in STATE_CHECK) + " FROM feats"
    ),
    "S09_read_requests": with_traffic(
        'SELECT "Index", geohash, day, timestamp, ' + ", ".join(
            f'CASE WHEN "Index" % {k} = 0 THEN {_DEFAULTS[c]} ELSE {c} END AS {c}' if c != "Temperature"
            else r(f'CASE WHEN "Index" % {k} = 0 THEN {_DEFAULTS[c]}::DOUBLE ELSE {c} END', c)
            for c, k in _ABSENT.items()
        ) + " FROM traffic"
    ),
    "S10_publish_marts": with_traffic(" UNION ALL ".join(
        f"SELECT '{m}' AS mart, CAST({n} AS BIGINT) AS rows FROM traffic" + ("" if "count" in n else " LIMIT 1")
        if "count" in n else f"(SELECT '{m}' AS mart, CAST({n} AS BIGINT) AS rows FROM traffic LIMIT 1)"
        for m, n in _MART_ROWS.items()
    )),
}
