"""Weighted and stacking ensembles fitted on second moments of out-of-fold predictions.

R2 of any weighting, and the ridge solution, depend on the predictions only
through their means and covariances. One aggregation therefore carries all the
data there is; what follows works on a handful of numbers.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadspark import schema as S
from roadspark.operators.metrics import clipped, regression_metrics


@dataclass
class Moments:
    n: int
    mean: np.ndarray        # of the m predictions and the target
    covariance: np.ndarray  # population, (m+1) x (m+1), target last


@dataclass
class EnsembleConfig:
    best_type: str = "mean"
    weights: dict[str, float] = field(default_factory=dict)
    coefficients: dict[str, float] = field(default_factory=dict)
    intercept: float = 0.0
    scores: dict[str, float | None] = field(default_factory=dict)


def moments(oof: DataFrame, models: list[str], target: str = S.TARGET) -> Moments:
    names = [*[f"pred_{m}" for m in models], target]
    pairs = [(i, j) for i in range(len(names)) for j in range(i + 1)]
    row = oof.agg(
        F.count("*").alias("n"),
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(names)],
        *[F.covar_pop(names[i], names[j]).alias(f"c{i}_{j}") for i, j in pairs],
    ).first()
    covariance = np.zeros((len(names), len(names)))
    for i, j in pairs:
        covariance[i, j] = covariance[j, i] = row[f"c{i}_{j}"]
    return Moments(row["n"], np.array([row[f"m{i}"] for i in range(len(names))]), covariance)


def fit_weights(gram: Moments, models: list[str]) -> tuple[dict[str, float], float]:
    """Weights >= 0 with sum 1 that maximise R2, and that R2.

    Minimises the mean squared error exactly: for every subset of the (few)
    models the minimum on the plane sum = 1 is a linear solve; the best one
    without negative weights is the answer.
    """
    m = len(models)
    second = gram.covariance + np.outer(gram.mean, gram.mean)
    a, b, yy = second[:m, :m], second[:m, m], second[m, m]
    best, best_error = np.full(m, 1.0 / m), np.inf
    for size in range(1, m + 1):
        for subset in map(list, combinations(range(m), size)):
            system = np.ones((size + 1, size + 1))
            system[:size, :size] = a[np.ix_(subset, subset)]
            system[size, size] = 0.0
            solution = np.linalg.lstsq(system, np.append(b[subset], 1.0), rcond=None)[0][:size]
            if (solution < -1e-12).any() or abs(solution.sum() - 1.0) > 1e-6:
                continue
            w = np.zeros(m)
            w[subset] = np.clip(solution, 0.0, None)
            w /= w.sum()
            error = yy - 2 * w @ b + w @ a @ w
            if error < best_error - 1e-15:
                best, best_error = w, error
    variance = gram.covariance[m, m]
    r2 = float(1 - best_error / variance) if variance > 0 else float("nan")
    return dict(zip(models, map(float, best))), r2


def fit_stacking(gram: Moments, models: list[str], alpha: float = 1.0) -> tuple[dict[str, float], float]:
    """Ridge coefficients and free intercept from centred moments."""
    m = len(models)
    xx, xy = gram.n * gram.covariance[:m, :m], gram.n * gram.covariance[:m, m]
    beta = np.linalg.solve(xx + alpha * np.eye(m), xy)
    return dict(zip(models, map(float, beta))), float(gram.mean[m] - beta @ gram.mean[:m])


def combine(models: list[str], config: EnsembleConfig | None, prefix: str = "pred_") -> Column:
    """The ensemble's prediction from one column per model, clipped before and after.

    A model without a weight counts with 1/m before the weights are scaled to
    sum 1. Stacking without coefficients, and no ensemble at all, give the mean.
    Stacking needs every model it was fitted on: a partial sum would be wrong.
    """
    if not models:
        raise ValueError("no models to combine")
    columns = [clipped(F.col(f"{prefix}{m}")) for m in models]
    kind = config.best_type if config else "mean"
    if len(models) == 1 and not (kind == "stacking" and config.coefficients):
        return clipped(columns[0])
    if kind == "weighted":
        weights = [config.weights.get(m, 1.0 / len(models)) for m in models]
        terms = [c * (w / sum(weights)) for c, w in zip(columns, weights)]
        return clipped(sum(terms[1:], terms[0]))
    if kind == "stacking" and config.coefficients:
        if set(models) != set(config.coefficients):
            raise ValueError(f"stacking was fitted on {sorted(config.coefficients)}, not on {sorted(models)}")
        terms = [c * config.coefficients[m] for c, m in zip(columns, models)]
        return clipped(sum(terms, F.lit(config.intercept)))
    return clipped(sum(columns[1:], columns[0]) / len(columns))


def candidates(oof: DataFrame, models: list[str], id_col: str = S.ID) -> tuple[DataFrame, EnsembleConfig]:
    """R2 of every base model and ensemble on the out-of-fold table, and the fitted ensembles."""
    config = EnsembleConfig()
    columns = {m: F.col(f"pred_{m}") for m in models}
    if len(models) >= 2:
        gram = moments(oof, models)
        config.weights, _ = fit_weights(gram, models)
        config.coefficients, config.intercept = fit_stacking(gram, models)
        for kind in ("weighted", "stacking"):
            config.best_type = kind
            columns[kind] = combine(models, config)
    wide = oof.select(id_col, S.TARGET, *[c.alias(n) for n, c in columns.items()])
    long = wide.unpivot([id_col, S.TARGET], list(columns), "candidate", "pred")
    return regression_metrics(long, ["candidate"]), config


def select_ensemble(oof: DataFrame, models: list[str], id_col: str = S.ID) -> EnsembleConfig:
    """The better of weighted and stacking; weighted wins a tie. Needs two models."""
    if len(models) < 2:
        return EnsembleConfig("single" if models else "mean")
    scores, config = candidates(oof, models, id_col)
    config.scores = {r["candidate"]: r["r2"] for r in scores.collect()}
    low = float("-inf")
    weighted, stacked = (low if config.scores[c] is None else config.scores[c] for c in ("weighted", "stacking"))
    config.best_type = "weighted" if weighted >= stacked else "stacking"
    return config
