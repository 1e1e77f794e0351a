import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from roadspark.functions.columns import nearest
from roadspark.operators.features import RoadFeatures, RoadFeaturesModel, fit_regions, locations, modes
from roadspark.schema import FEATURE_COLUMNS, TEST_SCHEMA, TRAIN_SCHEMA


def one_row(spark, **changes):
    row = {
        "Index": 1, "geohash": "qp03xk", "day": 48, "timestamp": "2:0", "RoadType": "Street", "NumberofLanes": 2,
        "LargeVehicles": "Allowed", "Landmarks": "Yes", "Temperature": 20.0, "Weather": "Rainy", **changes,
    }
    return spark.createDataFrame([tuple(row[f.name] for f in TEST_SCHEMA.fields)], TEST_SCHEMA)


def test_mode_takes_the_smallest_of_a_tie_and_a_default(spark):
    df = spark.createDataFrame([("b", None), ("a", None), ("a", None), ("b", None), (None, None)], "x string, y string")
    assert modes(df, {"x": "none", "y": "Sunny"}) == {"x": "a", "y": "Sunny"}


def test_all_36_features_in_order(features, sides):
    full = RoadFeatures(restarts=1).fit(sides[0])
    assert full.feature_columns == FEATURE_COLUMNS and len(FEATURE_COLUMNS) == 36
    assert full.transform(sides[1]).columns[-36:] == FEATURE_COLUMNS


def test_unseen_geohash_and_category(spark, features):
    row = features.transform(one_row(spark, geohash="9q8yyk", RoadType="Alley", Weather=None)).first()
    assert row.geo_frequency == 1 and row.road_type_encoded == 1
    assert row.Weather == features.state["Weather"]


def test_one_row_refit_is_bin_two(spark, sides):
    model = RoadFeatures(clusters=(), refit_bins=True).fit(sides[0])
    assert model.transform(one_row(spark)).first().temperature_bin == 2


def test_strict_mode_rejects_illegal_geohash(spark, sides):
    model = RoadFeatures(clusters=(), strict=True).fit(sides[0])
    with pytest.raises(Exception, match="illegal geohash"):
        model.transform(one_row(spark, geohash="qa0000")).collect()


def test_transform_needs_a_fit(sides):
    with pytest.raises(AttributeError):
        RoadFeatures().transform(sides[1])


def test_transform_ignores_row_order_and_partitions(features, sides):
    a = features.transform(sides[1]).orderBy("Index").collect()
    b = features.transform(sides[1].repartition(5).sortWithinPartitions(F.desc("demand"))).orderBy("Index").collect()
    assert a == b and len(a) == sides[1].count()


def test_hot_key_join_equals_broadcast_join(features, sides):
    df = sides[1].withColumn("geohash", F.when(F.col("Index") % 3 == 0, "qp0000").when(
        F.col("Index") % 50 == 1, F.lit(None)).otherwise(F.col("geohash")))
    small = features.add_location(df).orderBy("Index").collect()
    split = features.add_location(df, broadcast_rows=0).orderBy("Index")
    assert split.collect() == small
    assert len(small) == df.count()


def test_regions_are_nearest_centres_and_cheaper_than_two(traffic):
    places = locations(traffic).cache()
    centres = fit_regions(places, (4,), restarts=3, seed=1)[4]
    rows = places.withColumn("c", nearest("latitude", "longitude", centres)).collect()
    gap = lambda r, c: (r.latitude - c[0]) ** 2 + (r.longitude - c[1]) ** 2
    assert all(gap(r, centres[r.c]) == min(gap(r, c) for c in centres) for r in rows)
    cost = lambda some: sum(r.geo_frequency * min(gap(r, c) for c in some) for r in rows)
    assert cost(centres) < cost(fit_regions(places, (2,), restarts=3, seed=1)[2])


def test_saved_model_gives_the_same_features(spark, features, sides, tmp_path):
    features.save(str(tmp_path / "m"))
    loaded = RoadFeaturesModel.load(spark, str(tmp_path / "m"))
    assert loaded.state == features.state
    assert loaded.transform(sides[1]).orderBy("Index").collect() == features.transform(sides[1]).orderBy("Index").collect()


def test_missing_values_become_zero_in_vectors(spark, features):
    row = features.assemble(features.transform(one_row(spark, geohash=None, timestamp=None))).first()
    assert row.features.toArray()[features.feature_columns.index("latitude")] == 0.0


def test_works_inside_a_pipeline(sides):
    model = Pipeline(stages=[RoadFeatures(clusters=())]).fit(sides[0])
    assert "landmark_density_score" in model.transform(sides[1]).columns


def test_schemas():
    assert [f for f in TRAIN_SCHEMA.names if f != "demand"] == TEST_SCHEMA.names


def test_region_fits_do_not_carry_the_plan_of_their_points(spark, sides, monkeypatch):
    """Every stage of every restart ships the plan it reads from, so it begins at a checkpoint."""
    from roadspark.operators import features as module

    plans = []

    class Seen(module.KMeans):
        def fit(self, dataset, params=None):
            plans.append(dataset._jdf.queryExecution().optimizedPlan().toString())
            return super().fit(dataset, params)

    monkeypatch.setattr(module, "KMeans", Seen)
    places = module.locations(sides[0])
    centres = module.fit_regions(places, (2,), 2, 42)
    assert len(plans) == 2 and all(p.startswith("LogicalRDD") for p in plans)
    assert len(centres[2]) == 2
