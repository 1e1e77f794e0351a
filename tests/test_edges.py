"""Edges: absent keys and targets, broken input, early stopping, partial ensembles."""

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from roadspark.operators import eda, ensemble, marts, metrics, training
from roadspark.sources.observations import read_observations
from roadspark.sources.requests import read_requests, rejected_requests


@pytest.fixture(scope="module")
def holes(traffic):
    gone = lambda c, k: F.when(F.col("Index") % 5 != k, F.col(c)).alias(c)
    return traffic.select(
        "Index", gone("geohash", 0), gone("day", 1), gone("timestamp", 2), gone("NumberofLanes", 3), gone("demand", 4),
        "RoadType", "Weather", "Temperature",
    )


def test_absent_keys_are_left_out(holes):
    tables = {
        "hour": [eda.demand_by_hour(holes), marts.hourly_demand(holes)], "day": [eda.demand_by_day(holes)],
        "weekday": [eda.demand_by_weekday(holes), marts.weekday_demand(holes)],
        "month_clipped": [eda.demand_by_month_clipped(holes)], "geohash": [eda.top_locations(holes), marts.heatmap(holes)],
        "region": [eda.top_regions(holes)], "NumberofLanes": [eda.demand_by_lanes(holes), marts.lane_analysis(holes)],
    }
    for key, found in tables.items():
        for table in found:
            assert table.count() > 0 and table.where(F.col(key).isNull()).count() == 0, key
    assert marts.heat_summary(marts.heatmap(holes)).first()["total"] == holes.agg(F.count_distinct("geohash")).first()[0]


def test_metrics_use_rows_with_both_values(spark):
    rows = [("m", 0.1, 0.2), ("m", 0.5, 0.4), ("m", None, 0.9), ("m", 0.3, None)]
    found = metrics.regression_metrics(spark.createDataFrame(rows, "model string, demand double, pred double"), ["model"]).first()
    assert found["rmse"] == pytest.approx(0.1) and found["mae"] == pytest.approx(0.1) and found["r2"] == pytest.approx(0.75)


def test_stacking_refuses_a_missing_model():
    config = ensemble.EnsembleConfig("stacking", coefficients={"a": 0.4, "b": 0.3, "c": 0.3}, intercept=0.0)
    for models in (["a", "b"], ["a"]):
        with pytest.raises(ValueError, match="fitted on"):
            ensemble.combine(models, config)


def test_best_rounds_waits():
    errors = [1.0, 0.5, 0.6, 0.55, 0.4, 0.45, 0.46, 0.47, 0.1]
    assert training.best_rounds(errors, patience=3) == 5
    assert training.best_rounds(errors, patience=2) == 2
    assert training.best_rounds(errors, patience=50) == 9


def test_boosting_goes_on_while_it_learns(spark):
    rows = spark.range(4000).select(
        F.col("id").alias("Index"), (F.col("id") % 97 / 97).alias("x"), (F.col("id") % 31 / 31).alias("z"), F.rand(3).alias("noise")
    )
    rows = rows.withColumn("signal", 0.4 * F.sin(F.col("x") * 9) ** 2 + 0.5 * F.col("x") * F.col("z"))
    rows = VectorAssembler(inputCols=["x", "z"], outputCol="features").transform(rows)
    model = training.boosted(rounds=30, depth=3)
    learnt = training.fit(model, rows.withColumn("demand", F.col("signal")), early_stop=True)
    random = training.fit(model, rows.withColumn("demand", F.col("noise")), early_stop=True, patience=5)
    assert learnt.getNumTrees > 6 and random.getNumTrees < 30


def test_broken_requests_are_set_apart(spark):
    good = '{"geohash": "qp03", "day": 3, "timestamp": "1:15"}'
    texts = [good, "{not json", '{"day":"abc"}', '{"geohash":"qp03","day":"abc","timestamp":"1:15"}',
             '{"geohash":null,"day":1,"timestamp":"1:15"}', None, good[:-1] + ', "Temperature": "warm"}']
    raw = spark.createDataFrame(list(enumerate(texts)), "Index long, value string")
    assert [(r.Index, r.RoadType, r.Temperature) for r in read_requests(raw).collect()] == [(0, "Residential", 20.0)]
    assert {r.Index: r.reason for r in rejected_requests(raw).collect()} == {
        1: "unreadable", 2: "geohash is missing", 3: "day is malformed", 4: "geohash is missing", 5: "unreadable",
        6: "Temperature is malformed",
    }


def test_files_are_read_by_their_own_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Index,geohash,day,timestamp,demand,Temperature\n1,qp03,48,0:0,0.5,NaN\n2,qp04,49,0:15,0.25,10\n")
    (tmp_path / "b.csv").write_text("demand,day,Index,geohash,timestamp,Weather\n0.75,50,3,qp05,1:0,N/A\n")
    rows = {r.Index: r for r in read_observations(spark, str(tmp_path), "train").collect()}
    assert [(rows[i].geohash, rows[i].day, rows[i].demand) for i in (1, 2, 3)] == [("qp03", 48, 0.5), ("qp04", 49, 0.25), ("qp05", 50, 0.75)]
    assert rows[1].Temperature is None and rows[2].Temperature == 10.0 and rows[3].Weather is None
