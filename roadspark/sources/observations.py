"""Reading observations and saving tables and reports."""

from __future__ import annotations

from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadspark import schema as S
from roadspark.operators import quality
from roadspark.runtime import first_lines

# The words that stand for a missing value in CSV files.
MISSING_WORDS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
]


def read_observations(spark: SparkSession, path: str, kind: str = "train", file_format: str = "csv") -> DataFrame:
    """Typed observations from CSV with a header, or from parquet or JSON.

    Columns are matched by name, in every file of a folder by that file's own
    header; columns the schema does not name are left out and absent ones are
    NULL. In CSV the words of ``MISSING_WORDS`` are NULL, too.
    """
    schema = S.SCHEMAS[kind]
    if file_format != "csv":
        return spark.read.format(file_format).schema(schema).load(path)
    raw = read_raw(spark, path)
    known = lambda name: F.when(~F.trim(name).isin(MISSING_WORDS), F.col(name))
    return raw.select(*[
        known(f.name).try_cast(f.dataType).alias(f.name) if f.name in raw.columns
        else F.lit(None).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """Every column as text, for :func:`roadspark.operators.quality.validate_schema`.

    Files are read together with those of the same header and stacked by name.
    """
    files = spark.read.text(path).inputFiles()
    heads: dict[str, list[str]] = {}
    for file, line in first_lines(spark, sorted(files)).items():
        heads.setdefault(line, []).append(file)
    if len(heads) < 2:
        return spark.read.option("header", True).csv(path)
    parts = [spark.read.option("header", True).csv(own) for line, own in heads.items() if line]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_quality_report(train: DataFrame, test: DataFrame, path: str, half_even: bool = True) -> None:
    quality.quality_report(train, test, half_even).write.mode("overwrite").json(path)


def write_feature_summary(df: DataFrame, path: str, half_even: bool = True) -> None:
    """One line per column, in the order of the table."""
    table = quality.feature_summary(df, half_even=half_even).orderBy("position").drop("position")
    write_csv(table.coalesce(1), path)


def write_rankings(rankings: DataFrame, path: str) -> None:
    write_csv(rankings.orderBy(F.asc_nulls_last("avg_rank"), "feature").coalesce(1), path)


def write_cv_results(leaderboard: DataFrame, path: str) -> None:
    write_csv(leaderboard.orderBy("position").coalesce(1), path)


def write_submission(scored: DataFrame, path: str, id_col: str = S.ID) -> None:
    """Exactly ``(Index, demand)``, one line per scored row, in many part files."""
    write_csv(scored.select(F.col(id_col).alias("Index"), F.col(S.TARGET)), path)


def publish_marts(marts: dict[str, DataFrame], folder: str, parallelism: int = 4) -> dict[str, str]:
    """Write each mart once as parquet, a few at a time; returns its path by name."""
    paths = {name: f"{folder}/{name}" for name in marts}

    def write(name: str) -> None:
        marts[name].write.mode("overwrite").parquet(paths[name])

    if marts:
        spark = next(iter(marts.values())).sparkSession
        with ThreadPool(min(parallelism, len(marts))) as pool:
            pool.map(inheritable_thread_target(spark)(write), list(marts), chunksize=1)
    return paths
