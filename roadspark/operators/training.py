"""Base models, cross-validation and final fits on assembled feature vectors."""

from __future__ import annotations

from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.errors import IllegalArgumentException
from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadspark import schema as S
from roadspark.operators.boosting import PATIENCE, Boosting, Fit, as_model, best_rounds, grow, scored  # noqa: F401
from roadspark.operators.metrics import clipped, cv_leaderboard, regression_metrics
from roadspark.operators.sampling import fold_column, with_folds
from roadspark.runtime import use_checkpoints, written

BOOSTED = ["boosted_full", "boosted_bagged", "boosted_columns"]


def linear_regression() -> LinearRegression:
    """Ordinary least squares; collinear columns get a least-squares solution."""
    return LinearRegression(labelCol=S.TARGET, solver="normal", regParam=0.0)


def random_forest(trees: int = 200, depth: int = 15, min_leaf: int = 5, seed: int = S.SEED) -> RandomForestRegressor:
    return RandomForestRegressor(
        labelCol=S.TARGET, numTrees=trees, maxDepth=depth, minInstancesPerNode=min_leaf, seed=seed,
        featureSubsetStrategy="all", maxMemoryInMB=512,
    )


def boosted(
    rounds: int = 1000, depth: int = 8, rate: float = 0.1, rows: float = 1.0, columns: float = 1.0,
    min_leaf: int = 1, l1: float = 0.0, l2: float = 0.0, min_gain: float = 0.0, seed: int = S.SEED,
) -> Boosting:
    return Boosting(rounds, depth, rate, rows, columns, min_leaf, l1, l2, min_gain, seed)


def boosted_models(rounds: int = 1000, depth: int = 8, seed: int = S.SEED) -> dict[str, Boosting]:
    """Three presets: all rows with strong L2; rows and columns with 2^6 leaves; rows and columns with L2."""
    return {
        "boosted_full": boosted(rounds, depth, l2=5.0, seed=seed),
        "boosted_bagged": boosted(rounds, min(depth, 6), rows=0.8, columns=0.8, min_leaf=20, seed=seed),
        "boosted_columns": boosted(rounds, depth, rows=0.8, columns=0.8, l2=1.0, seed=seed),
    }


def default_models(
    rounds: int = 1000, depth: int = 8, trees: int = 200, forest_depth: int = 15, seed: int = S.SEED
) -> dict[str, Estimator | Boosting]:
    return {
        "linear": linear_regression(),
        "random_forest": random_forest(trees, forest_depth, seed=seed),
        **boosted_models(rounds, depth, seed),
    }


def fit(
    estimator: Estimator | Boosting, train: DataFrame, early_stop: bool = False, id_col: str = S.ID, patience: int = PATIENCE
) -> Model:
    """Fit one model. With ``early_stop`` a tenth of the *training* rows decides, as the trees
    grow, how many rounds boosting gets; the rows a model is scored on never steer it."""
    if isinstance(estimator, Boosting):
        return boosted_fits(train, {"m": Fit(estimator, stop=early_stop)}, id_col, patience)["m"]
    use_checkpoints(train.sparkSession)
    return estimator.fit(train)


def boosted_fits(
    assembled: DataFrame, fits: dict, id_col: str = S.ID, patience: int = PATIENCE
) -> dict:
    """Models of boosted fits that grow side by side over the same rows."""
    if not fits:
        return {}
    edges = grow(assembled, list(fits.values()), id_col, patience=patience)
    return {name: as_model(assembled.sparkSession, one, edges) for name, one in fits.items()}


def predict(df: DataFrame, models: dict[str, Model], prefix: str = "pred_") -> DataFrame:
    """One clipped prediction column per model, next to the columns of ``df``."""
    for name, model in models.items():
        column = f"{prefix}{name}"
        stage = model.stages[-1] if isinstance(model, PipelineModel) else model
        scored = stage.copy({stage.predictionCol: column}).transform(df)
        df = scored.withColumn(column, clipped(F.col(column)))
    return df


def oof_predictions(
    assembled: DataFrame,
    estimators: dict[str, Estimator | Boosting],
    k: int = S.CV_FOLDS,
    seed: int = S.SEED,
    early_stop: bool = True,
    id_col: str = S.ID,
    parallelism: int = 4,
    patience: int = PATIENCE,
) -> DataFrame:
    """Every model's prediction for each row by the fit that did not see its fold.

    Columns ``(id, fold, demand, pred_<model>...)``, written once; leaderboard and
    ensembles all read this table. All boosted fits grow side by side in the same
    passes; the others run as separate Spark jobs.
    """
    folded = written(with_folds(assembled, k, seed, id_col), "folded")

    def train(job: tuple[int, str]) -> tuple[int, str, Model]:
        fold, name = job
        rows = folded.where(F.col("fold") != fold)
        return fold, name, fit(estimators[name], rows, early_stop, id_col)

    plain = [name for name, e in estimators.items() if not isinstance(e, Boosting)]
    jobs = [(f, name) for name in plain for f in range(k)]
    with ThreadPool(max(min(parallelism, len(jobs)), 1)) as pool:
        fitted = pool.map(inheritable_thread_target(assembled.sparkSession)(train), jobs, chunksize=1)
    table = folded
    if plain:
        parts = []
        for fold in range(k):
            models = {name: m for f, name, m in fitted if f == fold}
            parts.append(predict(folded.where(F.col("fold") == fold), {name: models[name] for name in plain}))
        table = parts[0]
        for part in parts[1:]:
            table = table.unionByName(part)
    together = [(f, name) for name, e in estimators.items() if isinstance(e, Boosting) for f in range(k)]
    if together:
        fits = [Fit(estimators[name], f, early_stop) for f, name in together]
        edges = grow(folded, fits, id_col, patience=patience)
        table = scored(table, fits, edges)
        # Of a model's fits, one belongs to the row's fold.
        place = {name: [i for i, job in enumerate(together) if job[1] == name] for _, name in together}
        table = table.withColumns({
            f"pred_{name}": clipped(F.element_at("scores", F.element_at(F.array(*[F.lit(i + 1) for i in own]), F.col("fold") + 1)))
            for name, own in place.items()
        })
    columns = [c for c in folded.columns if c != "features"] + [f"pred_{name}" for name in estimators]
    table = table.select(*columns)
    return written(table, "oof")


def long_predictions(oof: DataFrame, models: list[str], id_col: str = S.ID) -> DataFrame:
    """``(id, fold, demand, model, pred)``, one row per model."""
    wide = oof.select(id_col, "fold", S.TARGET, *[F.col(f"pred_{m}").alias(m) for m in models])
    return wide.unpivot([id_col, "fold", S.TARGET], models, "model", "pred")


def cross_validate(oof: DataFrame, models: list[str], id_col: str = S.ID, half_even: bool = True) -> DataFrame:
    folds = regression_metrics(long_predictions(oof, models, id_col), ["model", "fold"])
    return cv_leaderboard(folds, half_even=half_even)


def train_final(
    assembled: DataFrame, estimators: dict[str, Estimator | Boosting], parallelism: int = 4, early_stop: bool = False,
    id_col: str = S.ID, patience: int = PATIENCE,
) -> tuple[dict[str, Model], dict[str, str]]:
    """Fit on all rows, without early stopping unless asked for. A model whose parameters are refused is left out.

    Returns the models and the errors by name. A Spark job that fails is raised.
    """
    rows = assembled.persist(StorageLevel.MEMORY_AND_DISK)
    results, together = [], {}
    for name, estimator in estimators.items():
        if isinstance(estimator, Boosting):
            try:
                together[name] = Fit(estimator.checked(), stop=early_stop)
            except ValueError as error:  # one bad parameter set must not end the others
                results.append((name, None, str(error)))

    def train(name: str):
        try:
            return name, fit(estimators[name], rows), None
        except IllegalArgumentException as error:
            return name, None, str(error)

    others = [name for name, estimator in estimators.items() if not isinstance(estimator, Boosting)]
    with ThreadPool(min(parallelism, max(len(others), 1))) as pool:
        results += pool.map(inheritable_thread_target(assembled.sparkSession)(train), others, chunksize=1)
    results += [(name, model, None) for name, model in boosted_fits(rows, together, id_col, patience).items()]
    rows.unpersist()
    results.sort(key=lambda r: list(estimators).index(r[0]))
    return (
        {name: model for name, model, error in results if error is None},
        {name: error for name, _, error in results if error is not None},
    )
