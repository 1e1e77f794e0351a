import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from roadspark.operators import eda, quality
from roadspark.operators.sampling import hash_sample, with_folds
from roadspark.sources import observations


def test_duplicates_treat_nulls_as_equal(spark):
    rows = [(None, 48, "1:0", 1), (None, 48, "1:0", 2), ("a", 48, "1:0", 3), ("a", 48, "1:0", 3)]
    df = spark.createDataFrame(rows, "geohash string, day int, timestamp string, v int")
    assert quality.key_duplicates(df).first().key_duplicates == 2
    for limit in (10, 0):
        row = quality.full_duplicates(df, broadcast_rows=limit).first()
        assert (row.total_rows, row.full_duplicates) == (4, 1)
    assert tuple(quality.full_duplicates(df.where("v > 9")).first()) == (0, 0)
    assert quality.key_duplicates(df.where("v > 9")).first().key_duplicates == 0


def test_describe_matches_pandas(traffic):
    got = quality.numeric_describe(traffic).toPandas().set_index("column")
    want = traffic.select("day", "demand", "Temperature").toPandas().describe().round(4)
    for c in want.columns:
        assert list(got.loc[c, ["count", "mean", "std", "min", "p25", "p50", "p75", "max"]]) == pytest.approx(
            list(want[c]), abs=1.01e-4
        )


def test_schema_report(spark, traffic):
    report = quality.validate_schema(traffic.drop("Weather").withColumn("note", F.lit("x"))).toPandas()
    status = dict(zip(report["column"], report["status"]))
    assert status["Weather"] == "missing" and status["note"] == "extra" and status["day"] == "ok"
    assert not report["schema_valid"].any()
    assert quality.validate_schema(traffic.withColumn("note", F.lit("x"))).first().schema_valid


def test_csv_reader_matches_by_name_and_rejects_nothing(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("day,Index,geohash,timestamp,Temperature,extra\n48,1,qp03xk,2:0,,x\nbad,2,qp03xk,3:15,20.5,y\n")
    rows = observations.read_observations(spark, str(path), "test").orderBy("Index").collect()
    assert [(r.Index, r.day, r.Temperature, r.Weather) for r in rows] == [(1, 48, None, None), (2, None, 20.5, None)]


def test_histogram_matches_numpy(traffic):
    values = np.array([r[0] for r in traffic.select("demand").collect()])
    counts, edges = np.histogram(values, bins=80)
    got = eda.histogram(traffic).orderBy("bin").toPandas()
    assert list(got["count"]) == list(counts)
    assert np.allclose(got["left"], edges[:-1])


def test_histogram_of_one_value(spark):
    df = spark.createDataFrame([(2.0,), (2.0,)], "demand double")
    got = eda.histogram(df, bins=4).toPandas()
    assert list(got.sort_values("bin")["count"]) == list(np.histogram([2.0, 2.0], bins=4)[0])


@pytest.mark.parametrize("cut", [0.0, 2.0])
def test_kde_equals_the_sum_over_rows(spark, cut):
    values = np.concatenate([np.random.default_rng(1).normal(0, 1, 500), [25.0]])
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    got = eda.kde_curve(df, "x", grid=50, cut=cut).orderBy("point").toPandas()
    h = values.std(ddof=1) * len(values) ** -0.2
    grid = np.linspace(values.min() - cut * h, values.max() + cut * h, 50)
    direct = np.exp(-0.5 * ((grid[:, None] - values) / h) ** 2).sum(axis=1) / (len(values) * h * np.sqrt(2 * np.pi))
    assert np.allclose(got["x"], grid)
    assert np.allclose(got["density"], direct, atol=1e-8)


def test_box_whiskers(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 5, 6, 7, 8, 9, 100]], "demand double")
    row = eda.box_stats(df).first()
    assert (row.q1, row.median, row.q3) == (3.25, 5.5, 7.75)
    assert (row.whisker_low, row.whisker_high, row.outliers) == (1.0, 9.0, 1)


def test_correlation_matrix_is_pairwise_complete(spark):
    pdf = pd.DataFrame({"a": [1.0, 2, 3, 4, 5], "b": [2.0, np.nan, 1, 5, 4], "c": [3.0, 1, np.nan, 2, 2], "k": [1.0] * 5})
    rows = [tuple(None if pd.isna(v) else float(v) for v in r) for r in pdf.itertuples(index=False)]
    df = spark.createDataFrame(rows, "a double, b double, c double, k double")
    got = {(r.a, r.b): r.r for r in eda.correlation_matrix(df, list("abck")).collect()}
    want = pdf.corr()
    assert len(got) == 6
    for (a, b), value in got.items():
        assert value is None if "k" in (a, b) else value == pytest.approx(want.loc[a, b])


def test_absent_weather_keeps_its_row(traffic):
    rows = eda.weather_means_ordered(traffic.where("Weather <> 'Foggy'")).orderBy("position").collect()
    assert [r.Weather for r in rows] == ["Sunny", "Foggy", "Rainy", "Snowy"] and rows[1]["mean"] is None


def test_sample_is_exact_and_independent_of_layout(spark):
    df = spark.range(20000).withColumnRenamed("id", "Index")
    first = {r.Index for r in hash_sample(df, 100).collect()}
    second = {r.Index for r in hash_sample(df.repartition(7), 100).collect()}
    by_sort = {r.Index for r in df.orderBy(F.md5(F.concat(F.lit("42:"), F.col("Index").cast("string")))).limit(100).collect()}
    assert first == second == by_sort
    assert hash_sample(df.limit(5), 100).count() == 5


def test_folds_partition_the_rows(traffic):
    counts = with_folds(traffic, 5).groupBy("fold").count().collect()
    assert {r.fold for r in counts} == set(range(5))
    assert sum(r["count"] for r in counts) == traffic.count()
    assert max(r["count"] for r in counts) < 0.3 * traffic.count()
