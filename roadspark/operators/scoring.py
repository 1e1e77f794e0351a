"""End-to-end scoring for batches and streams, and the saved scorer."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

from pyspark.ml import Model, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadspark import schema as S
from roadspark.functions.moments import rounded
from roadspark.operators.ensemble import EnsembleConfig, combine
from roadspark.operators.features import RoadFeaturesModel
from roadspark.operators.training import predict
from roadspark.runtime import path_exists


@dataclass
class Scorer:
    """Fitted features, base models and the way to combine them."""

    features: RoadFeaturesModel
    models: dict[str, Model]
    ensemble: EnsembleConfig | None = None

    def score(self, rows: DataFrame, combiner: str | None = None, digits: int | None = None) -> DataFrame:
        """``(id, demand)`` for every row. ``combiner="mean"`` ignores the ensemble.

        Row-wise throughout, so ``rows`` may be a stream.
        """
        if not self.models:
            raise ValueError("no models loaded")
        id_col = self.features.state["id_col"]
        config = EnsembleConfig(combiner) if combiner == "mean" else self.ensemble
        assembled = self.features.assemble(self.features.transform(rows), [id_col])
        demand = combine(list(self.models), config)
        if digits is not None:
            demand = rounded(demand, digits)
        return predict(assembled, self.models).select(id_col, demand.alias(S.TARGET))

    def save(self, path: str) -> None:
        spark = self.features.places.sparkSession
        self.features.save(f"{path}/features")
        save_models(spark, self.models, f"{path}/models")
        config = json.dumps(asdict(self.ensemble)) if self.ensemble else None
        spark.createDataFrame([(config,)], "config string").write.mode("overwrite").parquet(f"{path}/ensemble")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "Scorer":
        models = load_models(spark, f"{path}/models")
        config = spark.read.parquet(f"{path}/ensemble").first()["config"]
        return cls(
            RoadFeaturesModel.load(spark, f"{path}/features"), models,
            EnsembleConfig(**json.loads(config)) if config else None,
        )


def save_models(spark: SparkSession, models: dict[str, Model], path: str) -> None:
    """Each model in its own folder and a manifest that names them in order."""
    for name, model in models.items():
        stages = model if isinstance(model, PipelineModel) else PipelineModel([model])
        stages.write().overwrite().save(f"{path}/{name}")
    rows = [(i, name) for i, name in enumerate(models)]
    spark.createDataFrame(rows, "position int, name string").coalesce(1).write.mode("overwrite").parquet(
        f"{path}/manifest"
    )


def load_models(spark: SparkSession, path: str, names: list[str] | None = None) -> dict[str, Model]:
    """Whichever of the listed models can be read; an error if there is none."""
    if names is None:
        manifest = spark.read.parquet(f"{path}/manifest").orderBy("position")
        names = [r["name"] for r in manifest.collect()]
    # A model that is not there is skipped; one that cannot be read is an error.
    found: dict[str, Model] = {
        name: PipelineModel.load(f"{path}/{name}").stages[-1] for name in names if path_exists(spark, f"{path}/{name}")
    }
    if not found:
        raise FileNotFoundError(f"no models under {path}")
    return found


def submission(scored: DataFrame, id_col: str = S.ID) -> DataFrame:
    return scored.select(F.col(id_col).alias("Index"), F.col(S.TARGET))
