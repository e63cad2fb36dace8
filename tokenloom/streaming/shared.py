"""Events that many users share, kept once for all of them.

A change of an advertising id counts for every user with it, so its events times its users may be far more rows than either. They
are written out only where a result needs each of them, and then in tiles: some events of a value, one user after the other.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The events of a value are dealt over at most so many arrays; its users over so many tasks.
ARRAYS, SHARES = 64, 16


@dataclass(frozen=True)
class Dirty:
    """Events of users: ``own`` (user_id, ts, wait_s), and ``shared`` (value, ts, wait_s), each of which counts for all
    ``members`` (value, user_id) of its value. Rows of ``shared`` and of ``members`` are distinct."""

    own: DataFrame
    shared: DataFrame
    members: DataFrame

    def users(self) -> DataFrame:
        """Every user with an event, once."""
        touched = self.members.join(self.shared.select("value").distinct(), "value", "left_semi")
        return self.own.select("user_id").unionByName(touched.select("user_id")).distinct()

    def rows(self) -> DataFrame:
        """One row per user and event."""
        arrays = in_arrays(self.shared, F.struct("ts", "wait_s"))
        return self.own.select("user_id", "ts", "wait_s").unionByName(dealt(arrays, self.members).select("user_id", F.inline("items")))


def array_of(*columns: str) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(ARRAYS)).cast("int").alias("array")


def in_arrays(events: DataFrame, item: Column) -> DataFrame:
    """(value, array, items): the events of each value in some arrays."""
    rows = events.select("value", array_of("ts"), item.alias("item"))
    return rows.groupBy("value", "array").agg(F.collect_list("item").alias("items"))


def dealt(arrays: DataFrame, members: DataFrame) -> DataFrame:
    """Each user with each array of its value. A value with very many users has them in several tasks; the users of a task follow each
    other for one array, so written rows repeat and compress."""
    copied = arrays.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1))))
    placed = members.withColumn("share", F.pmod(F.xxhash64("user_id"), F.lit(SHARES)).cast("int"))
    # few bytes here make very many rows, so the number of tasks is not left to adaptive execution, which goes by bytes
    tasks = 2 * arrays.sparkSession.sparkContext.defaultParallelism
    copied, placed = [df.repartition(tasks, "value", "share") for df in (copied, placed)]
    return copied.hint("merge").join(placed, ["value", "share"]).drop("share")
