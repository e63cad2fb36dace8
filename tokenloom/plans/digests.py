"""Comparing two large tables by digests: rows move only where the tables differ.

Every row has a 128-bit hash over all its columns. Rows are put into buckets by a hash of their key, and a bucket's digest is the number of
its rows and the sums of their hashes, so neither the order of rows nor their number of copies is lost. Both sides send one line per bucket and
task; buckets with equal digests hold equal rows, and only the rows of the others meet. Two unlike buckets look alike with a probability of
about 2^-128 for rows that nobody made for that purpose.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

from tokenloom.settings import Workspace

BUCKETS = 1 << 14
_DIGEST = ["row_cnt", "sum_a", "sum_b"]


def _flat(name: str, kind: DataType) -> Column:
    """A column as something that hashes whole; nested values as JSON that keeps its nulls."""
    if isinstance(kind, (StructType, ArrayType, MapType, VariantType)):
        return F.to_json(F.col(f"`{name}`"), {"ignoreNullFields": "false"})
    return F.col(f"`{name}`")


def row_hashes(df: DataFrame) -> list[Column]:
    """Two 64-bit hashes over all columns. A hash skips NULLs, so what is NULL goes in as well."""
    flat = [_flat(f.name, f.dataType) for f in df.schema.fields]
    missing = [c.isNull() for c in flat]
    return [F.xxhash64(F.lit(salt), *flat, *missing) for salt in (1, 2)]


def _bucketed(df: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    key = [_flat(f.name, f.dataType) for f in df.schema.fields if f.name in keys]
    return df.withColumn("digest_bucket", F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int"))


def bucket_digests(df: DataFrame, keys: list[str], buckets: int = BUCKETS) -> DataFrame:
    """One row per bucket that holds rows: their number and the sums of their hashes."""
    first, second = row_hashes(df)
    rows = _bucketed(df, keys, buckets).select("digest_bucket", first.cast("decimal(20,0)").alias("a"), second.cast("decimal(20,0)").alias("b"))
    return rows.groupBy("digest_bucket").agg(
        F.count(F.lit(1)).alias("row_cnt"), F.sum("a").cast("decimal(38,0)").alias("sum_a"), F.sum("b").cast("decimal(38,0)").alias("sum_b")
    )


def unlike_buckets(left: DataFrame, right: DataFrame, keys: list[str], buckets: int = BUCKETS) -> DataFrame:
    """The buckets whose digests differ, or that one side lacks."""
    sides = [bucket_digests(df.select(*left.columns), keys, buckets) for df in (left, right)]
    other = sides[1].select("digest_bucket", *[F.col(c).alias(f"other_{c}") for c in _DIGEST])
    same = [F.col(c).eqNullSafe(F.col(f"other_{c}")) for c in _DIGEST]
    return sides[0].join(other, "digest_bucket", "full_outer").filter(~(same[0] & same[1] & same[2])).select("digest_bucket")


def digest_differences(work: Workspace, left: DataFrame, right: DataFrame, keys: list[str], buckets: int = BUCKETS) -> DataFrame:
    """Rows that one side has more often than the other, with the side that has them and how many more (``extra``).

    Both sides are read twice, first for the digests and then, from storage, for the rows of unlike buckets: give stored tables, or keep
    them with ``work`` first. Equal tables move one line per bucket and task and no row.
    """
    right = right.select(*left.columns)
    unlike = work.keep(unlike_buckets(left, right, keys, buckets))
    rows = None
    for side, df in ((1, left), (-1, right)):
        cut = _bucketed(df, keys, buckets).join(unlike, "digest_bucket", "left_semi")
        first, second = row_hashes(df)
        cut = cut.select(F.struct(*df.columns).alias("row"), first.alias("a"), second.alias("b"), F.lit(side).alias("side"))
        rows = cut if rows is None else rows.unionByName(cut)
    counted = rows.groupBy("a", "b").agg(F.any_value("row").alias("row"), F.sum("side").alias("balance"))
    unequal = counted.filter("balance <> 0")
    return unequal.select("row.*", F.when(F.col("balance") > 0, "left").otherwise("right").alias("side"), F.abs("balance").alias("extra"))


def difference_summary(differences: DataFrame, name: str) -> DataFrame:
    """One line: rows that only one side has, and the verdict."""

    def n(side: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("side") == side, F.col("extra"))), F.lit(0)).cast("bigint")

    counts = differences.agg(n("left").alias("only_left"), n("right").alias("only_right"))
    clean = (F.col("only_left") == 0) & (F.col("only_right") == 0)
    return counts.select(F.lit(name).alias("tbl"), "only_left", "only_right", F.when(clean, "PASS").otherwise("FAIL").alias("result"))
