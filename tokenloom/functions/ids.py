"""64-bit ids made of a time, a worker number and a sequence."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# monotonically_increasing_id keeps the row number of a partition in its low 33 bits
_ROW_BITS = 33


@dataclass(frozen=True)
class IdLayout:
    """Epoch and the 5/5/12 split. ``spread_layout`` suits jobs with many tasks."""

    epoch_ms: int = 1288834974657
    datacenter: int = 0
    worker_base: int = 16
    datacenter_bits: int = 5
    worker_bits: int = 5
    sequence_bits: int = 12

    def __post_init__(self) -> None:
        if self.datacenter_bits + self.worker_bits + self.sequence_bits > 22:
            raise ValueError("datacenter, worker and sequence bits must not exceed 22")
        if not 0 <= self.datacenter < 1 << self.datacenter_bits:
            raise ValueError(f"datacenter {self.datacenter} is out of range")
        if not 0 <= self.worker_base < 1 << self.worker_bits:
            raise ValueError(f"worker {self.worker_base} is out of range")

    @property
    def free_workers(self) -> int:
        return (1 << self.worker_bits) - self.worker_base


def spread_layout() -> IdLayout:
    """Room for 4080 tasks, 1024 ids per task and millisecond."""
    return IdLayout(datacenter_bits=0, worker_bits=12, sequence_bits=10)


def snowflake_id(start_ms: int, layout: IdLayout) -> Column:
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    sequence = row.bitwiseAND(F.lit((1 << layout.sequence_bits) - 1))
    elapsed = F.lit(start_ms - layout.epoch_ms) + F.shiftright(row, layout.sequence_bits)
    worker_shift = layout.sequence_bits
    datacenter_shift = worker_shift + layout.worker_bits
    time_shift = datacenter_shift + layout.datacenter_bits
    worker = (F.spark_partition_id() + layout.worker_base).cast("bigint")
    return (
        F.shiftleft(elapsed, time_shift)
        .bitwiseOR(F.lit(layout.datacenter << datacenter_shift).cast("bigint"))
        .bitwiseOR(F.shiftleft(worker, worker_shift))
        .bitwiseOR(sequence)
    )


def with_snowflake_ids(
    df: DataFrame,
    keys: list[str],
    start_ms: int,
    layout: IdLayout | None = None,
    partitions: int | None = None,
    name: str = "id",
) -> DataFrame:
    """Adds unique ids. Rows are placed and ordered by ``keys``, so a task that runs again gives
    every row the id it had before. A task of n rows uses n / 2^sequence_bits milliseconds from
    ``start_ms`` on; the next run must start after the last one used (``free_start_ms``)."""
    layout = layout or spread_layout()
    partitions = partitions or _default_partitions(df)
    if partitions > layout.free_workers:
        raise ValueError(f"{partitions} partitions but only {layout.free_workers} free worker ids: pass partitions or another layout")
    placed = df.repartition(partitions, *keys).sortWithinPartitions(*keys)
    return placed.withColumn(name, snowflake_id(start_ms, layout))


def id_time_ms(id_column: str, layout: IdLayout) -> Column:
    """The millisecond an id was made of."""
    shift = layout.datacenter_bits + layout.worker_bits + layout.sequence_bits
    return F.shiftright(F.col(id_column), shift) + F.lit(layout.epoch_ms)


def free_start_ms(earlier: DataFrame, wanted_ms: int, layout: IdLayout | None = None, name: str = "id") -> int:
    """``wanted_ms``, or the first millisecond after all ids in ``earlier`` if that is later."""
    last = earlier.agg(F.max(id_time_ms(name, layout or spread_layout()))).first()[0]
    return wanted_ms if last is None else max(wanted_ms, last + 1)


def _default_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
