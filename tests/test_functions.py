import math
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from roadspark.functions import columns as C
from roadspark.functions import geo
from roadspark.functions.moments import pearson, pearson_matrix, sample_kurtosis, sample_skewness
from roadspark.functions.quantiles import exact_quantiles, quantile_values
from roadspark.functions.ranks import average_rank, running_counts
from roadspark.operators.features import rejected_geohashes

ALPHABET = geo.GEOHASH_ALPHABET


def bisect(code):
    """Halve the interval bit by bit, longitude first."""
    spans = [[-180.0, 180.0], [-90.0, 90.0]]
    turn = 0
    for char in code:
        for bit in format(ALPHABET.index(char), "05b"):
            low, high = spans[turn]
            spans[turn] = [(low + high) / 2, high] if bit == "1" else [low, (low + high) / 2]
            turn = 1 - turn
    return sum(spans[1]) / 2, sum(spans[0]) / 2


def decode(spark, codes, **options):
    df = spark.createDataFrame([(c,) for c in codes], "geohash string")
    rows = df.select("geohash", geo.latitude(**options).alias("a"), geo.longitude(**options).alias("b")).collect()
    return {r["geohash"]: (r["a"], r["b"]) for r in rows}


def test_geohash_is_bit_exact_for_every_length(spark):
    rng = random.Random(7)
    codes = ["".join(rng.choices(ALPHABET, k=n)) for n in range(1, 13) for _ in range(60)]
    found = decode(spark, codes + ["qp03xk", ""])
    assert found["qp03xk"] == (-5.33660888671875, 90.6756591796875)
    assert found[""] == (0.0, 0.0)
    assert all(found[c] == bisect(c) for c in codes)


def test_geohash_longer_than_twelve(spark):
    codes = ["".join(random.Random(n).choices(ALPHABET, k=n)) for n in range(13, 30)]
    for code, position in decode(spark, codes).items():
        assert position == pytest.approx(bisect(code), abs=1e-12)


def test_illegal_geohash(spark):
    assert set(decode(spark, ["qa0000", "QP03XK", None]).values()) == {(None, None)}
    df = spark.createDataFrame([("qa0000",), ("QP03XK",), (None,), ("qp03xk",)], "geohash string")
    assert rejected_geohashes(df).first().rejected == 3
    with pytest.raises(Exception, match="illegal geohash"):
        decode(spark, ["qa0000"], strict=True)


def test_slots_and_days(spark):
    df = spark.createDataFrame(
        [("7", 48), ("2:0", 49), ("1:45", 359), ("6:45", 360), ("9:45", 400), ("10:0", 1), ("19:45", 2), ("20:0", 3),
         ("16:45", 4), ("17:0", 5), ("7:0", 6)], "timestamp string, day int",
    )
    rows = df.withColumns(C.calendar()).withColumns(C.calendar_flags()).withColumn("mc", C.month_clipped()).collect()
    by_slot = {r["timestamp"]: r for r in rows}
    assert [(by_slot[s].hour, by_slot[s].minute) for s in ("7", "2:0", "1:45")] == [(7, 0), (2, 0), (1, 45)]
    peaks = {s: by_slot[s].is_peak_hour for s in ("6:45", "7:0", "9:45", "10:0", "16:45", "17:0", "19:45", "20:0")}
    assert list(peaks.values()) == [0, 1, 1, 0, 0, 1, 1, 0]
    months = {r.day: (r.month, r.mc) for r in rows}
    assert (months[359], months[360], months[400]) == ((12, 12), (1, 12), (2, 12))
    assert {r.day: (r.weekday, r.is_weekend) for r in rows if r.day in (48, 49)} == {48: (6, 1), 49: (0, 0)}


def test_unknown_categories(spark):
    df = spark.createDataFrame(
        [("Alley", "Windy", None, None, 2, 20.0)],
        "RoadType string, Weather string, LargeVehicles string, Landmarks string, NumberofLanes int, Temperature double",
    )
    row = df.withColumns({**C.infrastructure(), **C.weather([0.0, 10.0, 30.0])}).first()
    assert (row.road_type_encoded, row.weather_severity_score, row.adverse_weather) == (1, 1, 0)
    assert (row.large_vehicles_allowed, row.has_landmarks) == (0, 0)


@pytest.mark.parametrize("values", [
    [5.0] * 700 + [float(v) for v in range(300)], [float(v * v % 97) for v in range(400)], [20.0], [1.0, 1.0, 2.0],
])
def test_quantile_bin_matches_pandas(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    edges = quantile_values(df, "x", [0, 0.2, 0.4, 0.6, 0.8, 1.0])
    got = [r[0] for r in df.select(C.quantile_bin(F.col("x"), edges)).collect()]
    want = pd.qcut(pd.Series(values), 5, labels=False, duplicates="drop").fillna(2).astype(int).tolist()
    assert got == want


@pytest.mark.parametrize("ties", [0, 3000])
@pytest.mark.parametrize("sketch", [20, 200])
def test_quantiles_by_narrowing_are_exact(spark, ties, sketch):
    rng = random.Random(ties)
    rows = [(g, rng.lognormvariate(0, 2)) for g in "ab" for _ in range(4000)] + [("a", 1.5)] * ties + [("c", 3.0)]
    rows += [("a", None), (None, 2.0)]
    probs = [0.0, 0.01, 0.25, 0.5, 0.9, 0.999, 1.0]
    df = spark.createDataFrame(rows, "g string, x double")
    got = exact_quantiles(df, "x", probs, by="g", buffer_rows=100, sketch=sketch).toPandas()
    want = pd.DataFrame(rows, columns=["g", "x"]).dropna().groupby("g")["x"].quantile(probs)
    assert len(got) == len(want)
    for r in got.itertuples():
        assert r.value == pytest.approx(want[(r.g, r.prob)], rel=1e-12)


def test_corrected_moments_match_pandas(spark):
    values = [0.1, 0.5, 0.5, 2.0, 9.0, 1.1]
    row = spark.createDataFrame([(v,) for v in values], "x double").agg(
        sample_skewness(F.col("x")).alias("s"), sample_kurtosis(F.col("x")).alias("k")
    ).first()
    assert (row.s, row.k) == pytest.approx((pd.Series(values).skew(), pd.Series(values).kurtosis()))
    short = spark.createDataFrame([(1.0,), (2.0,)], "x double")
    assert tuple(short.agg(sample_skewness(F.col("x")), sample_kurtosis(F.col("x"))).first()) == (None, None)


def test_correlation_of_a_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 5.0, 2.0), (2.0, 5.0, 1.0), (4.0, 5.0, 0.0)], "x double, c double, y double")
    assert df.agg(pearson(F.col("x"), F.col("c"))).first()[0] is None
    matrix = pearson_matrix(df, ["x", "c", "y"])
    assert matrix[0][1] is None
    assert matrix[0][2] == pytest.approx(df.agg(pearson(F.col("x"), F.col("y"))).first()[0])


def test_average_ranks_match_pandas(spark):
    rng = random.Random(3)
    rows = [(k, float(rng.randint(0, 40))) for k in "xy" for _ in range(500)] + [("x", 7.0)] * 400
    pdf = pd.DataFrame(rows, columns=["k", "v"])
    counts = spark.createDataFrame(rows, "k string, v double").groupBy("k", "v").agg(F.count("*").alias("n"))
    got = running_counts(counts, "k", "v", "n").withColumn("rank", average_rank()).toPandas()
    pdf["rank"] = pdf.groupby("k")["v"].rank()
    want = pdf.drop_duplicates().set_index(["k", "v"])["rank"]
    assert len(got) == len(want)
    assert all(want[(r.k, r.v)] == r.rank for r in got.itertuples())
    assert not math.isnan(want.iloc[0])
