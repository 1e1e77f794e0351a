"""The fitted feature pipeline as an ML estimator and its model."""

from __future__ import annotations

import json
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadspark import schema as S
from roadspark.functions import columns as C
from roadspark.functions import geo
from roadspark.functions.quantiles import quantile_values
from roadspark.runtime import BROADCAST_ROWS, lookup_join, use_checkpoints, written

BIN_EDGES = [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]
# A location with at least this share of the rows is handled as a hot join key.
HOT_SHARE = 0.001
LOCATIONS_PER_PARTITION = 20_000


def modes(df: DataFrame, defaults: dict[str, str]) -> dict[str, str]:
    """Most frequent value per text column, the smallest one on a tie, from one scan."""
    names = list(defaults)
    counts = (
        df.select(*names).unpivot([], names, "column", "value").where("value IS NOT NULL")
        .groupBy("column", "value").agg(F.count("*").alias("n"))
    )
    best = counts.groupBy("column").agg(F.min_by("value", F.struct(-F.col("n"), "value")).alias("value"))
    found = {r["column"]: r["value"] for r in best.collect()}
    return {c: found.get(c, default) for c, default in defaults.items()}


def locations(df: DataFrame) -> DataFrame:
    """Distinct geohashes with their row count and cell centre."""
    return df.where("geohash IS NOT NULL").groupBy("geohash").agg(F.count("*").alias("geo_frequency")).select(
        "geohash", "geo_frequency", geo.latitude().alias("latitude"), geo.longitude().alias("longitude")
    )


def rejected_geohashes(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count("*").alias("rows"), F.count_if(~geo.is_valid(F.col("geohash"))).alias("rejected")
    )


def fit_regions(
    places: DataFrame, sizes: tuple[int, ...], restarts: int, seed: int, parallelism: int = 8,
    rows: int | None = None,
) -> dict[int, list[list[float]]]:
    """K-means centres per size: the restart with the lowest cost.

    Runs on distinct locations weighted by their row count, which has the same
    objective as running on all rows. Restarts are separate Spark jobs side by
    side; few locations go into few partitions, as every iteration is a job.
    """
    if not sizes:
        return {}
    points = VectorAssembler(inputCols=["latitude", "longitude"], outputCol="point").transform(
        places.where("latitude IS NOT NULL").withColumn("weight", F.col("geo_frequency").cast("double"))
    ).select("point", "weight")
    rows = places.count() if rows is None else rows
    if rows <= LOCATIONS_PER_PARTITION * points.rdd.getNumPartitions():
        points = points.coalesce(max(1, rows // LOCATIONS_PER_PARTITION))
    # Every stage of a fit carries the plan it reads from; from a checkpoint on it is a short one.
    use_checkpoints(places.sparkSession)
    points = points.checkpoint()
    if not points.take(1):
        return {k: [[0.0, 0.0]] for k in sizes}

    def run(job: tuple[int, int]):
        k, restart = job
        model = KMeans(k=k, seed=seed + restart, featuresCol="point", weightCol="weight").fit(points)
        centres = [[float(v) for v in c] for c in model.clusterCenters()]
        return k, (model.summary.trainingCost, restart, centres)

    jobs = [(k, r) for k in sizes for r in range(restarts)]
    with ThreadPool(min(parallelism, len(jobs))) as pool:
        results = pool.map(inheritable_thread_target(places.sparkSession)(run), jobs)
    return {k: min(r for size, r in results if size == k)[2] for k in sizes}


def region_columns(centres: dict[str, list[list[float]]]) -> dict:
    return {f"region_cluster_{k}": C.nearest("latitude", "longitude", c) for k, c in centres.items()}


class RoadFeatures(Estimator):
    """Learns imputation values, temperature bins, location counts and regions."""

    def __init__(
        self,
        clusters: tuple[int, ...] = S.CLUSTER_SIZES,
        restarts: int = 10,
        seed: int = S.SEED,
        refit_bins: bool = False,
        strict: bool = False,
        id_col: str = S.ID,
    ):
        super().__init__()
        self.clusters, self.restarts, self.seed = tuple(clusters), restarts, seed
        self.refit_bins, self.strict, self.id_col = refit_bins, strict, id_col

    def _fit(self, dataset: DataFrame) -> "RoadFeaturesModel":
        def learn_places() -> tuple:
            places = written(locations(dataset), "locations")
            size = places.agg(F.count("*").alias("n"), F.sum("geo_frequency").alias("rows")).first()
            centres = fit_regions(places, self.clusters, self.restarts, self.seed, rows=size["n"])
            return places, size, centres

        def learn_temperature() -> tuple:
            rows = dataset.count()
            median = quantile_values(dataset, "Temperature", [0.5], rows_at_most=rows)[0]
            return median, bin_edges(dataset, median, rows)

        def learn_modes() -> dict:
            return modes(dataset, {"RoadType": "Residential", "Weather": "Sunny"})

        # Three independent scans, run side by side.
        steps = (learn_places, learn_temperature, learn_modes)
        run = inheritable_thread_target(dataset.sparkSession)(lambda step: step())
        with ThreadPool(len(steps)) as pool:
            (places, size, centres), (median, edges), mode = pool.map(run, steps, chunksize=1)
        state = {
            **mode,
            "Temperature": median,
            "bin_edges": edges,
            "refit_bins": self.refit_bins,
            "strict": self.strict,
            "id_col": self.id_col,
            "locations": size["n"],
            "rows": size["rows"] or 0,
            "centres": {str(k): v for k, v in centres.items()},
        }
        return RoadFeaturesModel(state, places.withColumns(region_columns(state["centres"])))


def bin_edges(df: DataFrame, median: float | None, rows: int | None = None) -> list[float]:
    """Distinct temperature quintile edges after imputation."""
    filled = F.coalesce(F.col("Temperature"), F.lit(median).cast("double"))
    edges = quantile_values(df, filled, BIN_EDGES, rows_at_most=rows)
    return sorted({e for e in edges if e is not None})


class RoadFeaturesModel(Model):
    """Adds the features of a fitted :class:`RoadFeatures` with native expressions."""

    def __init__(self, state: dict, places: DataFrame):
        super().__init__()
        self.state, self.places = state, places

    @property
    def feature_columns(self) -> list[str]:
        fitted = {f"region_cluster_{k}" for k in self.state["centres"]}
        return [c for c in S.FEATURE_COLUMNS if not c.startswith("region_cluster") or c in fitted]

    def impute(self, df: DataFrame) -> DataFrame:
        fill = lambda c: F.coalesce(F.col(c), F.lit(self.state[c]))
        median = F.lit(self.state["Temperature"]).cast("double")
        return df.withColumns({
            "RoadType": fill("RoadType"), "Weather": fill("Weather"),
            "Temperature": F.coalesce(F.col("Temperature"), median),
        })

    def add_location(self, df: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
        """Row count, cell centre and regions of the geohash.

        Known locations were decoded and assigned once, at fit time; only an
        unseen geohash is worked out in its row.
        """
        hot = F.col("geo_frequency") >= max(self.state["rows"] * HOT_SHARE, 1)
        joined = lookup_join(df, self.places, "geohash", self.state["locations"], hot, broadcast_rows)
        strict = self.state["strict"]
        placed = joined.withColumns({
            "geo_frequency": F.coalesce("geo_frequency", F.lit(1)),
            "latitude": F.coalesce("latitude", geo.latitude(strict=strict)),
            "longitude": F.coalesce("longitude", geo.longitude(strict=strict)),
        })
        return placed.withColumns({
            name: F.coalesce(name, column) for name, column in region_columns(self.state["centres"]).items()
        })

    def _transform(self, dataset: DataFrame) -> DataFrame:
        df = self.impute(dataset)
        edges = self.state["bin_edges"]
        if self.state["refit_bins"]:
            edges = bin_edges(dataset, self.state["Temperature"])
        df = df.withColumns(C.calendar()).withColumns(C.calendar_flags())
        df = self.add_location(df)
        df = df.withColumns({**C.infrastructure(), **C.weather(edges)})
        df = df.withColumn("road_capacity_score", C.road_capacity())
        df = df.withColumns(C.interactions())
        first = [c for c in dataset.columns if c not in self.feature_columns]
        return df.select(*first, *self.feature_columns)

    def assemble(self, df: DataFrame, keep: list[str] | None = None) -> DataFrame:
        """Feature vectors, with any value still missing set to 0."""
        names = self.feature_columns
        filled = df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in names})
        vector = VectorAssembler(inputCols=names, outputCol="features", handleInvalid="error")
        keep = keep or [c for c in (self.state["id_col"], S.TARGET) if c in df.columns]
        return vector.transform(filled).select(*keep, "features")

    def save(self, path: str) -> None:
        spark = self.places.sparkSession
        spark.createDataFrame([(json.dumps(self.state),)], "state string").write.mode("overwrite").parquet(
            f"{path}/state"
        )
        self.places.write.mode("overwrite").parquet(f"{path}/places")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "RoadFeaturesModel":
        state = json.loads(spark.read.parquet(f"{path}/state").first()["state"])
        return cls(state, spark.read.parquet(f"{path}/places"))
