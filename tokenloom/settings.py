"""Business parameters and the session options the jobs are written for."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Settings:
    id_offset: int = 100_000_000
    zone: str = "Africa/Lagos"
    raw_max_chars: int = 128
    money_scale: int = 1


DEFAULT = Settings()

# The JVM does not compile methods of more than 8000 bytecodes, so larger generated stages would be
# interpreted; below the limit Spark splits them into small methods instead.
#
# Lookups here are left joins from a large side to a table with one row per key, so the only
# possible hot partition is on the large side and Spark may split it. The forced mode also splits
# it when a later grouping wants the same key, at the price of one extra exchange for hot data.
SESSION_OPTIONS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def tune(spark: SparkSession) -> SparkSession:
    for name, value in SESSION_OPTIONS.items():
        spark.conf.set(name, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="tokenloom-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries that run within leave no shuffle files behind; else these stay until the driver happens to collect its garbage."""
    option = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(option)
    spark.conf.set(option, "true")
    try:
        yield
    finally:
        spark.conf.set(option, before)


class Workspace:
    """Tables of one piece of work in the shared folder, gone when it is done."""

    def __init__(self, spark: SparkSession):
        self.spark, self.count = spark, 0
        self.folder = f"{shared_folder(spark).rstrip('/')}/work-{uuid.uuid4().hex}"

    def keep(self, df: DataFrame) -> DataFrame:
        """Write rows once. Their real size is known from then on, and a lost executor does not lose them."""
        self.count += 1
        path = f"{self.folder}/{self.count}"
        with shuffles_dropped(self.spark):
            df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *_) -> None:
        delete_folder(self.spark, self.folder)


def exists(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def delete_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def checkpointed(df: DataFrame) -> DataFrame:
    """Run ``df`` once and keep its rows where a lost executor does not lose them."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()
