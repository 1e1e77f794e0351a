"""Additive attribution of predictions to features."""

from __future__ import annotations

import random

from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadspark import schema as S
from roadspark.operators.sampling import hash_sample

BACKGROUND_ROWS = 100
PERMUTED_ROWS = 200


def linear_attribution(
    df: DataFrame, coefficients: dict[str, float], intercept: float,
    sample: int | None = None, id_col: str = S.ID,
) -> tuple[DataFrame, DataFrame]:
    """Exact Shapley values of a linear model: coefficient x distance from the mean.

    Returns ``(id, feature, value, phi)`` for all rows, or for a sample if asked for, and the one-row
    ``base_value``, the mean prediction over all of ``df``.
    """
    names = list(coefficients)
    means = df.agg(*[F.avg(c).alias(c) for c in names]).first()
    rows = hash_sample(df.select(id_col, *names), sample, id_col=id_col) if sample else df
    cells = [
        F.struct(
            F.lit(c).alias("feature"), F.col(c).cast("double").alias("value"),
            (F.lit(float(b)) * (F.col(c) - F.lit(means[c]))).alias("phi"),
        )
        for c, b in coefficients.items()
    ]
    base = intercept + sum(b * (means[c] or 0.0) for c, b in coefficients.items())
    spark = df.sparkSession
    return (
        rows.select(id_col, F.inline(F.array(*cells))),
        spark.createDataFrame([(float(base),)], "base_value double"),
    )


def permutation_attribution(
    assembled: DataFrame, model: Model, features: list[str], explained: int = PERMUTED_ROWS,
    background: int = BACKGROUND_ROWS, permutations: int = 2, seed: int = S.SEED, id_col: str = S.ID,
) -> tuple[DataFrame, DataFrame]:
    """Shapley values of any model by walking random feature orders.

    Along an order, features switch one at a time from a background row's value
    to the explained row's; each switch credits its change in the prediction to
    that feature. Orders come in mirrored pairs. For every row the values add up
    exactly to its prediction less the mean background prediction. The sample
    sizes bound the work: explained x background x orders x (features + 1) rows.
    """
    width = len(features)
    explain = hash_sample(assembled.select(id_col, "features"), explained, seed, id_col)
    reference = hash_sample(assembled.select(id_col, "features"), background, seed + 1, id_col)
    vectors = [[float(v) for v in r["features"].toArray()] for r in reference.select("features").collect()]
    rng = random.Random(seed)
    orders = []
    for _ in range(permutations):
        order = rng.sample(range(width), width)
        orders += [order, order[::-1]]
    # place[k] is when feature k switches.
    places = [[o.index(k) for k in range(width)] for o in orders]
    spark = assembled.sparkSession
    walks = spark.createDataFrame(
        [(vectors, orders, places)],
        "z array<array<double>>, orders array<array<int>>, places array<array<int>>",
    )
    rows = explain.withColumn("x", vector_to_array("features")).select(id_col, "x")
    # Few rows, but each becomes thousands below: spread them over the cluster first.
    rows = rows.repartition(max(1, min(explained, spark.sparkContext.defaultParallelism)), id_col)
    # walks: one row, sized by the parameters.
    steps = (
        rows.withColumn("_k", F.lit(0)).join(F.broadcast(walks.withColumn("_k", F.lit(0))), "_k")
        .withColumn("_z", F.explode("z"))
        .withColumn("_o", F.explode(F.arrays_zip("orders", "places")))
        .select(id_col, "x", F.col("_z").alias("z"), F.col("_o.orders").alias("order"),
                F.col("_o.places").alias("place"),
                F.explode(F.sequence(F.lit(0), F.lit(width))).alias("step"))
    )
    mixed = F.transform(
        "place", lambda p, k: F.when(p < F.col("step"), F.get("x", k)).otherwise(F.get("z", k))
    )
    scored = model.transform(steps.withColumn("features", array_to_vector(mixed)))
    pairs = len(vectors) * len(orders)
    share = F.col("prediction") / pairs
    # A step's prediction counts for the feature just switched and against the next one.
    credit = F.array_compact(F.array(
        F.when(F.col("step") > 0, F.struct(F.get("order", F.col("step") - 1).alias("k"), share.alias("phi"))),
        F.when(F.col("step") < width, F.struct(F.get("order", "step").alias("k"), (-share).alias("phi"))),
    ))
    phi = (
        scored.select(id_col, F.explode(credit).alias("c"))
        .groupBy(id_col, F.col("c.k").alias("k")).agg(F.sum("c.phi").alias("phi"))
    )
    names = F.array(*map(F.lit, features))
    values = rows.select(id_col, F.posexplode("x").alias("k", "value"))
    base = model.transform(reference).agg(F.avg("prediction").alias("base_value"))
    return (
        phi.join(F.broadcast(values), [id_col, "k"])
        .select(id_col, F.element_at(names, F.col("k") + 1).alias("feature"), "value", "phi"),
        base,
    )


def global_importance(phi: DataFrame, n: int = 20) -> DataFrame:
    """Mean absolute attribution per feature, the ``n`` largest."""
    return (
        phi.groupBy("feature").agg(F.avg(F.abs("phi")).alias("importance"))
        .orderBy(F.desc("importance"), "feature").limit(n)
    )


def summary_points(phi: DataFrame, n: int = 20, id_col: str = S.ID) -> DataFrame:
    """(feature value, attribution) of every explained row for the top features."""
    top = global_importance(phi, n).select("feature")
    return phi.join(F.broadcast(top), "feature", "left_semi").select(id_col, "feature", "value", "phi")


def local_explanation(
    phi: DataFrame, base: DataFrame, rows: int = 3, shown: int = 15, id_col: str = S.ID
) -> DataFrame:
    """Base value and largest attributions of the first ``rows`` explained rows.

    At most ``shown`` lines per row; if there are more features, the last line
    pools the rest. Base value and lines add up to the prediction.
    """
    first = phi.select(id_col).distinct().orderBy(id_col).limit(rows)
    order = Window.partitionBy(id_col).orderBy(F.desc(F.abs("phi")), "feature")
    size = F.count("*").over(Window.partitionBy(id_col))
    placed = phi.join(F.broadcast(first), id_col, "left_semi").select(
        id_col, "feature", "phi", F.row_number().over(order).alias("place"), size.alias("features")
    )
    own = (F.col("features") <= shown) | (F.col("place") < shown)
    name = F.when(own, F.col("feature")).otherwise("(rest)")
    lines = placed.groupBy(
        id_col, name.alias("feature"), F.when(own, F.col("place")).otherwise(shown).alias("position")
    ).agg(F.sum("phi").alias("phi"), F.count("*").alias("pooled"))
    total = F.sum("phi").over(Window.partitionBy(id_col))
    base_value = base.first()["base_value"]
    return lines.select(
        id_col, "position", "feature", "phi", "pooled", F.lit(base_value).cast("double").alias("base_value"),
        (F.lit(base_value) + total).alias("prediction"),
    )
