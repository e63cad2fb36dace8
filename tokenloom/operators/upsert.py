"""Keyed writes as DataFrame operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.operators.latest import latest_by


def dedupe_last(batch: DataFrame, pk: list[str], position: list[str]) -> DataFrame:
    """Of several rows for one key, the last by position."""
    return latest_by(batch, pk, position).select(*batch.columns)


def upsert_rows(target: DataFrame, batch: DataFrame, pk: list[str]) -> DataFrame:
    """``target`` after the rows of ``batch`` (one per key) have replaced theirs."""
    kept = target.join(batch.select(*pk), pk, "left_anti")
    return kept.unionByName(batch.select(*target.columns))


def delete_rows(target: DataFrame, keys: DataFrame, pk: list[str]) -> DataFrame:
    return target.join(keys.select(*pk).distinct(), pk, "left_anti")


def key_violations(df: DataFrame, pk: list[str]) -> DataFrame:
    """Keys that are NULL or occur more than once."""
    some_null = F.lit(False)
    for c in pk:
        some_null = some_null | F.col(c).isNull()
    counted = df.groupBy(*pk).agg(F.count(F.lit(1)).alias("n"))
    return counted.filter((F.col("n") > 1) | some_null)


def assert_unique(df: DataFrame, pk: list[str]) -> DataFrame:
    bad = key_violations(df, pk).limit(1).collect()
    if bad:
        raise ValueError(f"primary key {pk} is NULL or repeated")
    return df


def keep_existing(batch: DataFrame, target: DataFrame, pk: list[str], column: str) -> DataFrame:
    """``column`` of the stored row where there is one, else the value in ``batch``."""
    stored = target.join(batch.select(*pk), pk, "left_semi").select(*pk, F.col(column).alias("stored_value"))
    value: Column = F.coalesce("stored_value", F.col(column))
    joined = batch.join(stored, pk, "left").withColumn(column, value)
    return joined.select(*batch.columns)
