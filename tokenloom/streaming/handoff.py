"""The moment a bulk load began, kept so that the change stream can begin there.

The moment is taken before any table is read. Changes made while the load runs are then applied
again by the stream, which does no harm, and none is lost.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from tokenloom.sources.starts import load_start, record_start

__all__ = ["load_start", "record_start", "start_position"]


def start_position(spark: SparkSession, folder: str, start_ms: int | None = None) -> tuple[str, int | None]:
    """Start mode and time of a change stream: the given time, else the recorded one, else all."""
    start_ms = load_start(spark, folder) if start_ms is None else start_ms
    return ("initial", None) if start_ms is None else ("timestamp", start_ms)
