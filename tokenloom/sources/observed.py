"""Counts taken while a query writes, so that no table is read again to be counted."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


class CountsWritten:
    """Counts of rows per group, for groups known beforehand (a handful: each count is one metric).

    ``watch`` passes rows through; once the query that holds them has run, ``rows`` gives the counts. A task that
    runs again is counted once, as metrics of a stage come from its successful tasks.
    """

    def __init__(self, group: str, values: Iterable, counts: dict[str, Column]):
        self.group, self.values, self.counts = group, list(values), counts
        self.observation = Observation()

    def watch(self, df: DataFrame) -> DataFrame:
        metrics = [
            F.count(F.when((F.col(self.group) == value) & condition, 1)).alias(f"{name}_{at}")
            for at, value in enumerate(self.values)
            for name, condition in self.counts.items()
        ]
        return df.observe(self.observation, *metrics)

    def rows(self, spark: SparkSession) -> DataFrame:
        """One row per group, zeros included."""
        seen = self.observation.get
        made = [(value, *[seen[f"{name}_{at}"] for name in self.counts]) for at, value in enumerate(self.values)]
        kind = "int" if all(isinstance(v, int) for v in self.values) else "string"
        return spark.createDataFrame(made, ", ".join([f"{self.group} {kind}", *[f"{name} bigint" for name in self.counts]]))


class RowsWritten:
    """How many rows of a query were written."""

    def __init__(self):
        self.observation = Observation()

    def watch(self, df: DataFrame) -> DataFrame:
        return df.observe(self.observation, F.count(F.lit(1)).alias("n"))

    @property
    def count(self) -> int:
        return self.observation.get["n"]
