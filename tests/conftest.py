import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def traffic(spark):
    from roadspark.sources.traffic import read_traffic

    return read_traffic(spark, DATA).cache()


@pytest.fixture(scope="session")
def sides(traffic):
    from roadspark.sources.traffic import split

    return split(traffic)


@pytest.fixture(scope="session")
def features(sides):
    from roadspark.operators.features import RoadFeatures

    return RoadFeatures(clusters=(3,), restarts=2).fit(sides[0])


@pytest.fixture(scope="session")
def assembled(features, sides):
    from roadspark.runtime import written

    return written(features.assemble(features.transform(sides[0])), "vectors")
