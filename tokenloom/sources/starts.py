"""A point in time kept in a folder."""

from __future__ import annotations

import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException


def record_start(spark: SparkSession, folder: str, start_ms: int | None = None, origin: str = "job") -> int:
    start_ms = int(time.time() * 1000) if start_ms is None else start_ms
    row = spark.range(1).select(F.lit(start_ms).alias("start_ms"), F.lit(origin).alias("origin"))
    row.coalesce(1).write.mode("overwrite").json(folder)
    return start_ms


def load_start(spark: SparkSession, folder: str) -> int | None:
    try:
        rows = spark.read.schema("start_ms bigint, origin string").json(folder).limit(1).collect()
    except AnalysisException:
        return None
    return rows[0].start_ms if rows else None
