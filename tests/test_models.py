import inspect

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import DATA
from roadspark.operators import attribution, ensemble, metrics, ranking, training, tuning
from roadspark.operators.scoring import Scorer, load_models, save_models
from roadspark.sources.requests import read_requests
from roadspark.streaming.scoring import start_scoring

NAMES = ["linear", "boosted_full"]


def estimators():
    return dict(zip(NAMES, (training.linear_regression(), training.boosted(rounds=3, depth=3))))


@pytest.fixture(scope="module")
def oof(assembled):
    return training.oof_predictions(assembled, estimators(), k=3).cache()


@pytest.fixture(scope="module")
def scorer(features, assembled, oof):
    models, errors = training.train_final(assembled, estimators())
    assert not errors
    return Scorer(features, models, ensemble.select_ensemble(oof, list(models)))


def fixed(spark, n=300, seed=5):
    rng = np.random.default_rng(seed)
    y = rng.random(n)
    preds = [np.clip(y + rng.normal(0, s, n), 0, None) for s in (0.1, 0.2, 0.15)]
    rows = [(i, i % 3, float(y[i]), *[float(p[i]) for p in preds]) for i in range(n)]
    return spark.createDataFrame(rows, "Index long, fold int, demand double, pred_a double, pred_b double, pred_c double")


def test_metrics_match_numpy(spark):
    df = fixed(spark).withColumnRenamed("pred_a", "pred")
    pdf = df.toPandas()
    for r in metrics.regression_metrics(df, ["fold"]).collect():
        part = pdf[pdf.fold == r.fold]
        e = part.demand - part.pred
        assert r.r2 == pytest.approx(1 - (e**2).sum() / ((part.demand - part.demand.mean()) ** 2).sum())
        assert (r.rmse, r.mae) == pytest.approx((np.sqrt((e**2).mean()), e.abs().mean()))


def test_oof_covers_every_row_once(oof, assembled):
    assert oof.count() == assembled.count() == oof.select("Index").distinct().count()
    assert oof.where("pred_linear < 0 OR pred_boosted_full < 0").count() == 0
    board = training.cross_validate(oof, NAMES).orderBy("position").collect()
    assert [r.is_best for r in board] == [True, False] and board[0].r2_mean >= board[1].r2_mean


def test_weights_beat_every_grid_point(spark):
    df, names = fixed(spark), ["a", "b", "c"]
    weights, r2 = ensemble.fit_weights(ensemble.moments(df, names), names)
    assert min(weights.values()) >= 0 and sum(weights.values()) == pytest.approx(1)
    pdf = df.toPandas()
    y, x = pdf.demand.to_numpy(), pdf[["pred_a", "pred_b", "pred_c"]].to_numpy()
    score = lambda w: 1 - ((y - x @ w) ** 2).sum() / ((y - y.mean()) ** 2).sum()
    assert score(np.array(list(weights.values()))) == pytest.approx(r2)
    grid = [np.array([i, j, 20 - i - j]) / 20 for i in range(21) for j in range(21 - i)]
    assert all(score(w) <= r2 + 1e-12 for w in grid)


def test_identical_models_still_get_weights(spark):
    df = fixed(spark).withColumn("pred_b", F.col("pred_a"))
    weights, _ = ensemble.fit_weights(ensemble.moments(df, ["a", "b"]), ["a", "b"])
    assert sum(weights.values()) == pytest.approx(1)


def test_stacking_matches_ridge(spark):
    df, names = fixed(spark), ["a", "b", "c"]
    beta, intercept = ensemble.fit_stacking(ensemble.moments(df, names), names)
    pdf = df.toPandas()
    x, y = pdf[["pred_a", "pred_b", "pred_c"]].to_numpy(), pdf.demand.to_numpy()
    xc, yc = x - x.mean(0), y - y.mean()
    want = np.linalg.solve(xc.T @ xc + np.eye(3), xc.T @ yc)
    assert np.allclose(list(beta.values()), want)
    assert intercept == pytest.approx(y.mean() - x.mean(0) @ want)


def test_combiners(spark):
    df = spark.createDataFrame([(0.3, 0.6, -0.9), (-0.2, -0.2, -0.2)], "pred_a double, pred_b double, pred_c double")
    names = ["a", "b", "c"]

    def run(config, models=names):
        return [r[0] for r in df.select(ensemble.combine(models, config)).collect()]

    assert run(None) == pytest.approx([0.3, 0.0])
    half = ensemble.EnsembleConfig("weighted", {"a": 0.5, "c": 0.5})
    assert run(half) == pytest.approx([(0.15 + 0.2) / (4 / 3), 0.0])
    assert run(ensemble.EnsembleConfig("stacking")) == pytest.approx([0.3, 0.0])
    stack = ensemble.EnsembleConfig("stacking", coefficients={"a": -1.0, "b": 0.0, "c": 0.0}, intercept=0.1)
    assert run(stack) == pytest.approx([0.0, 0.1])
    assert run(half, ["c"]) == [0.0, 0.0]
    with pytest.raises(ValueError):
        ensemble.combine([], None)


def test_one_model_needs_no_ensemble(oof):
    assert ensemble.select_ensemble(oof, ["linear"]).best_type == "single"


def test_selected_ensemble_is_at_least_the_best_model(scorer):
    scores = scorer.ensemble.scores
    assert max(scores["weighted"], scores["stacking"]) >= max(scores[m] for m in NAMES) - 1e-12


def test_saved_scorer_batch_and_stream_agree(spark, scorer, sides, tmp_path):
    batch = {r.Index: r.demand for r in scorer.score(sides[1]).collect()}
    assert len(batch) == sides[1].count() and min(batch.values()) >= 0
    scorer.save(str(tmp_path / "s"))
    loaded = Scorer.load(spark, str(tmp_path / "s"))
    assert {r.Index: r.demand for r in loaded.score(sides[1]).collect()} == batch
    sides[1].write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(sides[1].schema).parquet(str(tmp_path / "in"))
    start_scoring(loaded, stream, str(tmp_path / "out"), str(tmp_path / "cp"), None, None).awaitTermination()
    assert {r.Index: r.demand for r in spark.read.parquet(str(tmp_path / "out")).collect()} == batch


def test_available_models_are_used(spark, scorer, tmp_path):
    save_models(spark, {"linear": scorer.models["linear"]}, str(tmp_path))
    assert list(load_models(spark, str(tmp_path), ["boosted_full", "linear"])) == ["linear"]
    with pytest.raises(FileNotFoundError):
        load_models(spark, str(tmp_path), ["boosted_full"])


def test_request_defaults_only_for_absent_fields(spark):
    text = '{"geohash":"qp03xk","day":50,"timestamp":"2:15","Weather":null,"NumberofLanes":4}'
    row = read_requests(spark.createDataFrame([(1, text)], "Index long, value string")).first()
    assert (row.geohash, row.day, row.timestamp, row.NumberofLanes) == ("qp03xk", 50, "2:15", 4)
    assert row.Weather is None and row.Temperature == 20.0 and row.RoadType == "Residential"


def test_collinear_columns_keep_predictions(spark):
    from pyspark.ml.feature import VectorAssembler

    rows = [(i, float(i % 7), 2.0 * (i % 7), 5.0, 0.1 * (i % 7) + 0.3) for i in range(50)]
    df = spark.createDataFrame(rows, "Index long, x double, twice double, one double, demand double")
    vectors = VectorAssembler(inputCols=["x", "twice", "one"], outputCol="features").transform(df)
    scored = training.predict(vectors, {"m": training.fit(training.linear_regression(), vectors)})
    assert scored.where("abs(pred_m - demand) > 1e-9").count() == 0


def test_failed_model_is_skipped(assembled):
    models, errors = training.train_final(assembled, {"ok": training.linear_regression(), "bad": training.boosted(rounds=2, depth=99)})
    assert list(models) == ["ok"] and list(errors) == ["bad"]


def test_search_is_reproducible():
    space = tuning.SPACES["boosted_columns"]
    first, second = (tuning.sample_parameters(space, 20, 42) for _ in range(2))
    assert first == second
    assert all(0.01 <= p["rate"] <= 0.3 and 3 <= p["depth"] <= 12 and 500 <= p["rounds"] <= 3000 for p in first)


def test_tuning_marks_the_best_trial(assembled):
    spaces = {"boosted_full": {"depth": ("int", 2, 3), "rounds": ("int", 2, 3), "rate": ("log", 0.05, 0.3)}}
    trials = tuning.tune(assembled, spaces, trials=2, k=2)
    rows = trials.collect()
    assert sum(r.is_best for r in rows) == 1
    assert max(r.r2 for r in rows) == next(r.r2 for r in rows if r.is_best)
    best = tuning.best_parameters(trials, spaces)["boosted_full"]
    assert isinstance(best["depth"], int) and tuning.tuned_models({"boosted_full": best})


def test_search_halves_stores_and_resumes(spark, assembled, tmp_path, monkeypatch):
    spaces = {"boosted_full": {"depth": ("int", 1, 2), "rounds": ("int", 30, 40), "rate": ("log", 0.02, 0.1), "l1": ("log", 1e-3, 1.0)}}
    options = dict(trials=4, k=2, first_rounds=8, keep=2, patience=50, store=str(tmp_path / "t"))
    whole = tuning.tune(assembled, spaces, **options).orderBy("trial").collect()
    assert [r.trial for r in whole] == [0, 1, 2, 3] and sorted(r.rung for r in whole)[:2] == [0, 0]
    rungs = spark.read.parquet(str(tmp_path / "t")).groupBy("rung").count().orderBy("rung").collect()
    assert [r["count"] for r in rungs] == [4, 2, 1, 1][: len(rungs)] and len(rungs) >= 2

    def again(*args, **kwargs):
        raise RuntimeError("nothing is left to run")

    monkeypatch.setattr(tuning, "grow", again)
    assert tuning.tune(assembled, spaces, **options).orderBy("trial").collect() == whole
    best = tuning.best_parameters(tuning.finished_trials(spark, str(tmp_path / "t")), spaces)
    tuning.save_parameters(best, spark, str(tmp_path / "p"))
    assert tuning.load_parameters(spark, str(tmp_path / "p")) == best and set(best["boosted_full"]) == set(spaces["boosted_full"])


def test_search_goes_on_from_grown_trees(spark, assembled, tmp_path, monkeypatch):
    """Later rungs grow only the rounds that are new, and find what growing them anew finds."""
    spaces = {"boosted_full": {"depth": ("int", 2, 3), "rounds": ("int", 12, 14), "rate": ("log", 0.05, 0.1)}}
    options = dict(trials=2, k=2, first_rounds=4, keep=2, patience=50)
    grow, begun = tuning.grow, []

    def counted(rows, fits, *args, **kwargs):
        begun.append([len(f.trees) for f in fits])
        return grow(rows, fits, *args, **kwargs)

    monkeypatch.setattr(tuning, "grow", counted)
    went_on = tuning.tune(assembled, spaces, store=str(tmp_path / "a"), **options).orderBy("trial").collect()
    assert begun[0] == [0] * 4 and begun[1] == [4] * 2

    def anew(rows, fits, *args, **kwargs):
        for f in fits:
            f.trees, f.errors = [], []
        return grow(rows, fits, *args, **kwargs)

    monkeypatch.setattr(tuning, "grow", anew)
    assert tuning.tune(assembled, spaces, store=str(tmp_path / "b"), **options).orderBy("trial").collect() == went_on


def test_permutation_values_add_up(assembled, scorer, features):
    model = scorer.models["boosted_full"]
    phi, base = attribution.permutation_attribution(
        assembled, model, features.feature_columns, explained=4, background=5, permutations=1
    )
    start = base.first().base_value
    sums = {r.Index: r.s for r in phi.groupBy("Index").agg(F.sum("phi").alias("s")).collect()}
    assert len(sums) == 4
    for r in model.transform(assembled.where(F.col("Index").isin(list(sums)))).collect():
        assert start + sums[r.Index] == pytest.approx(r.prediction)


def test_local_lines_add_up(features, sides):
    df = features.transform(sides[0])
    coefficients = {c: 0.01 * (i + 1) for i, c in enumerate(["hour", "NumberofLanes", "Temperature", "week"])}
    phi, base = attribution.linear_attribution(df, coefficients, 0.5, sample=50)
    lines = attribution.local_explanation(phi, base, rows=3, shown=3).toPandas()
    assert len(lines) == 9 and set(lines[lines.position == 3].feature) == {"(rest)"}
    for index, part in lines.groupby("Index"):
        row = df.where(F.col("Index") == int(index)).first()
        want = 0.5 + sum(b * row[c] for c, b in coefficients.items())
        assert part.prediction.iloc[0] == pytest.approx(want)
        assert part.base_value.iloc[0] + part.phi.sum() == pytest.approx(want)


def test_rank_methods_match_pandas(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"a": rng.integers(0, 4, 400), "b": rng.normal(size=400), "k": 1.0})
    pdf["demand"] = np.where(rng.random(400) < 0.35, 0.0, pdf.a + pdf.b + rng.normal(size=400))
    df = spark.createDataFrame(pdf.astype(float))
    names = ["a", "b", "k"]
    ranks = pdf.rank()
    for limit in (10**6, 0):  # broadcast, and hot target value split from the shuffle
        got = {r.feature: r.score for r in ranking.spearman_rank(df, names, broadcast_rows=limit).collect()}
        assert got["k"] is None
        for c in "ab":
            assert got[c] == pytest.approx(abs(ranks[c].corr(ranks.demand)))
    got = {r.feature: r.score for r in ranking.pearson_rank(df, names).collect()}
    assert got["k"] is None and got["a"] == pytest.approx(abs(pdf.a.corr(pdf.demand)))
    information = {r.feature: r.score for r in ranking.mutual_information(df, names, bins=8).collect()}
    assert information["k"] == 0.0 and information["a"] > 0


def test_mean_rank_skips_missing_scores(spark):
    rows = [("m1", "x", 0.9), ("m1", "y", 0.5), ("m1", "z", 0.5), ("m1", "c", None),
            ("m2", "x", 0.1), ("m2", "y", 0.2), ("m2", "z", 0.2), ("m2", "c", 0.0)]
    scores = spark.createDataFrame(rows, "method string, feature string, score double")
    got = ranking.aggregate_rankings(scores, ["m1", "m2"]).toPandas().set_index("feature")
    wide = scores.toPandas().pivot(index="feature", columns="method", values="score").rank(ascending=False)
    assert got["avg_rank"].to_dict() == wide.mean(axis=1).to_dict()
    assert ranking.select_features(ranking.aggregate_rankings(scores, ["m1", "m2"]), list("xyzc"), 2) == ["x", "y"]
    assert ranking.select_features(None, ["x"]) == ["x"]


def test_importances_sum_to_one(assembled, features):
    names = features.feature_columns
    tables = ranking.gbt_importance(assembled, names, rounds=2, depth=3)
    for table in [*tables.values(), ranking.rf_importance(assembled, names, trees=3, depth=3)]:
        rows = table.collect()
        assert len(rows) == len(names) and sum(r.score for r in rows) == pytest.approx(1)


def test_failed_jobs_are_not_swallowed(monkeypatch, assembled):
    """Refused parameters are told in the result; a failing job ends tuning and training."""
    spaces = {"bad": {"depth": ("int", 99, 99), "rounds": ("int", 2, 2)}}
    row = tuning.tune(assembled, spaces, trials=1, k=2).first()
    assert row.r2 is None and "depth=99" in row.error

    def lost(*args, **kwargs):
        raise RuntimeError("executor lost")

    monkeypatch.setattr(training, "fit", lost)
    monkeypatch.setattr(tuning, "grow", lost)
    with pytest.raises(RuntimeError):
        training.train_final(assembled, estimators())
    with pytest.raises(RuntimeError):
        tuning.tune(assembled, {"boosted": {"rounds": ("int", 2, 2)}}, trials=1, k=2)


def test_queries_fit_only_the_models_they_use(spark, assembled, sides, features, monkeypatch):
    from roadspark.plans import models as plans
    from roadspark.plans import sources

    asked = []

    def train(rows, estimators, **options):
        asked.append(list(estimators))
        return {n: training.fit(training.linear_regression(), rows) for n in estimators}, {}

    own = plans.Study(spark, DATA)
    own.__dict__ |= {"features": features, "rows": assembled}
    monkeypatch.setattr(plans, "study", lambda s, d: own)
    monkeypatch.setattr(plans.T, "train_final", train)
    assert [r.model for r in plans.QUERIES["M02_linear_regression"](spark, DATA).collect()] == ["linear"]
    assert asked == [["linear"]]
    assert sorted(r.model for r in sources.partial_models(spark, DATA).collect()) == ["boosted_full", "linear"]
    assert asked == [["linear"], ["boosted_full"]]
    assert plans.QUERIES["M04_boosted_trees"](spark, DATA).count() == 3
    assert asked[2:] == [["boosted_bagged", "boosted_columns"]]
    assert {r.model for r in plans.final_models(spark, DATA).collect()} == {"linear", "random_forest", *training.BOOSTED}
    assert asked[3:] == [["random_forest"]]


def test_permutation_query_explains_its_whole_sample(spark, assembled, features, monkeypatch):
    from roadspark.plans import models as plans

    own = plans.Study(spark, DATA)
    own.__dict__ |= {"features": features, "rows": assembled, "_final": {"boosted_bagged": training.fit(training.linear_regression(), assembled)}}
    monkeypatch.setattr(plans, "study", lambda s, d: own)
    walked, walk = [], attribution.random.Random.sample
    monkeypatch.setattr(attribution.random.Random, "sample", lambda *args: walked.append(1) or walk(*args))
    found = plans.permuted(spark, DATA).groupBy("Index").count().collect()
    assert len(found) == min(200, assembled.count()) == 200 and len(walked) == 2
    assert {r["count"] for r in found} == {len(features.feature_columns)}


def test_search_queries_run_the_whole_search(spark, assembled, features, monkeypatch):
    """The library's trials, rounds and patience; final models grow all their rounds."""
    from roadspark.plans import models as plans

    own = plans.Study(spark, DATA)
    own.__dict__ |= {"features": features, "rows": assembled}
    monkeypatch.setattr(plans, "study", lambda s, d: own)
    tune, train, grow, asked, sizes, kept = tuning.tune, training.train_final, tuning.grow, [], [], []

    def searched(rows, spaces, **options):
        call = inspect.signature(tune).bind(rows, spaces, **options)
        call.apply_defaults()
        asked.append(call.arguments)
        return tune(rows, {"boosted_full": {"depth": ("int", 1, 2), "rounds": ("int", 12, 14)}}, trials=1, k=2, first_rounds=4)

    def trained(rows, estimators, **options):
        models, errors = train(rows, estimators, **options)
        sizes.extend((len(models[n].trees) - 1, estimators[n].rounds) for n in models)
        return models, errors

    def grown(rows, fits, *args, **options):
        edges = grow(rows, fits, *args, **options)
        kept.extend("stats" in tree for f in fits for tree in f.trees)
        return edges

    monkeypatch.setattr(plans.U, "tune", searched)
    monkeypatch.setattr(plans.T, "train_final", trained)
    monkeypatch.setattr(tuning, "grow", grown)
    assert plans.tuned(spark, DATA).count() == 1
    assert asked[0]["spaces"] is tuning.SPACES and asked[0]["k"] == 3
    assert (asked[0]["trials"], asked[0]["first_rounds"], asked[0]["patience"]) == (100, 40, 50)
    assert sizes == [(rounds, rounds) for _, rounds in sizes] and len(sizes) == 1
    assert kept and not any(kept)


def test_search_lets_go_of_what_others_pushed_out():
    ended = {("m", t): {"going": t != 2, "held_out": error} for t, error in enumerate([0.4, 0.2, 0.1, 0.3])}
    trials = [("m", t) for t in range(6)]
    assert tuning._going(trials, ended, {"m": 2}) == [("m", 1), ("m", 3)]
    assert tuning._going(trials, ended | {("m", 5): {"going": True, "held_out": 0.2}}, {"m": 2}) == [("m", 1), ("m", 5)]
