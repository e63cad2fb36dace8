import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.log.level", "ERROR")
        .config("spark.sql.session.timeZone", "America/New_York")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-", dir="/tmp"))
        .getOrCreate()
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def src(spark):
    from tokenloom.sources.fixtures import fixture_sources

    return fixture_sources(spark, FOLDER)


@pytest.fixture(scope="session")
def tables(spark, src, tmp_path_factory):
    """The fixture tables written once, as the jobs would find them."""
    from tokenloom.sources.tables import parquet_sources

    folder = str(tmp_path_factory.mktemp("tables"))
    for name in src:
        src[name].write.parquet(f"{folder}/{name}")
    return folder, parquet_sources(spark, folder)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)
