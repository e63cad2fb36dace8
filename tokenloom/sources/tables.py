"""Named source tables, read from parquet or over JDBC."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tokenloom.sources.schemas import SOURCE_SCHEMAS


class Sources(Mapping):
    """Table name -> DataFrame. A table is planned only when a job asks for it."""

    def __init__(self, makers: Mapping[str, Callable[[], DataFrame]]):
        self._makers = dict(makers)
        self._made: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._makers[name]()
        return self._made[name]

    def __iter__(self):
        return iter(self._makers)

    def __len__(self) -> int:
        return len(self._makers)

    def using(self, **tables: DataFrame) -> Sources:
        """The same sources with some tables exchanged."""
        return Sources({n: lambda n=n: self[n] for n in self} | {n: lambda t=t: t for n, t in tables.items()})


def typed_view(df: DataFrame, schema: str | StructType) -> DataFrame:
    """Only the declared columns, each cast to its declared type."""
    fields = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])


def parquet_sources(spark: SparkSession, folder: str, names=tuple(SOURCE_SCHEMAS)) -> Sources:
    def maker(name: str) -> Callable[[], DataFrame]:
        schema = StructType.fromDDL(SOURCE_SCHEMAS[name])
        return lambda: spark.read.schema(schema).parquet(f"{folder}/{name}")

    return Sources({name: maker(name) for name in names})


def scan_bulk(
    spark: SparkSession,
    url: str,
    table: str,
    key: str,
    partitions: int,
    lower: int = 1,
    upper: int = 500_000_000,
    fetch: int = 10_000,
    **options: str,
) -> DataFrame:
    """A JDBC table read in ``partitions`` strides of a numeric key. Rows outside the bounds are
    read too, by the first and the last stride, so take bounds near the real ones."""
    return spark.read.format("jdbc").options(**scan_options(url, table, key, partitions, lower, upper, fetch), **options).load()


def scan_options(url: str, table: str, key: str, partitions: int, lower: int, upper: int, fetch: int) -> dict[str, str]:
    if partitions < 1 or lower >= upper:
        raise ValueError("scan needs at least one partition and lower < upper")
    return {
        "url": url,
        "dbtable": table,
        "partitionColumn": key,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
        "fetchsize": str(fetch),
    }
