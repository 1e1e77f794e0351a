from pyspark.sql import functions as F

from roadspark.operators import marts
from roadspark.streaming import marts as live


def hours(spark, rows):
    return spark.createDataFrame(rows, "timestamp string, demand double, day int, geohash string")


def test_peaks_with_few_hours(spark):
    df = hours(spark, [("1:0", 0.1, 1, "a"), ("2:0", 0.3, 1, "a"), ("3:0", 0.2, 1, "a")])
    rows = marts.peak_hours(marts.hourly_demand(df)).orderBy("kind", "position").collect()
    assert [(r.kind, r.hour) for r in rows] == [
        ("off_peak", 2), ("off_peak", 3), ("off_peak", 1), ("peak", 2), ("peak", 3), ("peak", 1),
    ]


def test_an_hour_seen_once_has_a_flat_band(spark):
    hourly = marts.hourly_demand(hours(spark, [("7", 0.25, 1, "a")]))
    assert hourly.first()["std"] is None
    row = marts.forecast(hourly).first()
    assert (row.predicted_demand, row.confidence_low, row.confidence_high) == (0.25, 0.25, 0.25)


def test_rounding_is_half_to_even(spark):
    hourly = spark.createDataFrame([(1, 2.5, 0.0)], "hour int, mean double, std double")
    assert marts.forecast(hourly, digits=0).first().predicted_demand == 2.0
    assert marts.forecast(hourly, digits=0, half_even=False).first().predicted_demand == 3.0


def test_ratio_with_an_idle_quiet_time(spark):
    hourly = spark.createDataFrame([(h, 0.0 if h < 5 else 0.4, 0.1, 1) for h in range(10)], "hour int, mean double, std double, count long")
    assert marts.peak_ratio(hourly).first().peak_ratio == 0.4


def test_first_hour_wins_a_forecast_tie(spark):
    table = spark.createDataFrame([(3, 0.5), (9, 0.5), (1, 0.1)], "hour int, predicted_demand double")
    assert marts.forecast_peak(table).first().hour == 3


def batches(spark, traffic, folder, parts=3):
    for i in range(parts):
        traffic.where(F.col("Index") % parts == i).coalesce(1).write.parquet(f"{folder}/p{i}")
    return spark.readStream.schema(traffic.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/*")


def same(a, b, key):
    a, b = a.orderBy(key).collect(), b.orderBy(key).collect()
    assert len(a) == len(b)
    for x, y in zip(a, b):
        assert x[key] == y[key] and x["count"] == y["count"] and abs(x["mean"] - y["mean"]) < 1e-12
        assert (x["std"] is None and y["std"] is None) or abs(x["std"] - y["std"]) < 1e-9


def test_complete_stream_equals_batch(spark, traffic, tmp_path):
    stream = batches(spark, traffic, tmp_path / "in")
    live.start_complete_mart(marts.hourly_demand(stream), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    same(live.read_complete_mart(spark, str(tmp_path / "out")), marts.hourly_demand(traffic), "hour")


def test_incremental_stream_equals_batch_and_restarts(spark, traffic, tmp_path):
    out, cp = str(tmp_path / "out"), str(tmp_path / "cp")
    stream = batches(spark, traffic, tmp_path / "in")
    for _ in range(2):  # the second run finds nothing new
        live.start_incremental_mart(stream, F.col("geohash"), "geohash", out, cp).awaitTermination()
    batch = traffic.groupBy("geohash").agg(
        F.avg("demand").alias("mean"), F.stddev_samp("demand").alias("std"), F.count("demand").alias("count")
    )
    same(live.read_incremental_mart(spark, out, "geohash"), batch, "geohash")
