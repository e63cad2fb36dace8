"""Source tables stored by a hash of the key they are looked up by.

A batch of changes needs a few rows of many tables. Stored this way, a table is a folder for each bucket of its key. Keys of a
batch carry their bucket, so a join with them prunes folders while it runs (dynamic partition pruning) and reads no more than the
buckets its keys lie in. Nothing is cached, so nothing is out of date.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.settings import exists
from tokenloom.sources.schemas import SOURCE_SCHEMAS
from tokenloom.sources.tables import Sources

BUCKET = "key_bucket"
BUCKETS = 256
# The column by which a batch looks rows of a table up.
LOOKED_UP_BY = {
    "user": "id",
    "user_personal_info": "user_id",
    "user_bank_info": "user_id",
    "user_work_related": "user_id",
    "user_emergency_contact": "user_id",
    "risk_user_credit_callback": "user_id",
    "user_order": "user_id",
    "user_repay": "order_no",
    "risk_user_approval_callback": "order_no",
    "user_order_installment": "user_order_id",
    "device_ids": "device_uuid",
    "adjust_callback_record": "adid",
    "vt_token_cache": "raw_value",
}


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key.cast("string")), F.lit(buckets)).cast("int")


def write_keyed(sources: Sources, folder: str, buckets: int = BUCKETS) -> None:
    """Every table under ``folder``, those of ``LOOKED_UP_BY`` by bucket. A bucket with very many rows is written by several tasks."""
    spark = next(iter(sources.values())).sparkSession
    for name, df in sources.items():
        writer = df.write
        if name in LOOKED_UP_BY:
            writer = df.withColumn(BUCKET, bucket_of(F.col(LOOKED_UP_BY[name]), buckets)).hint("rebalance", BUCKET).write.partitionBy(BUCKET)
        writer.mode("overwrite").parquet(f"{folder}/{name}")
    spark.range(1).select(F.lit(buckets).alias("buckets")).coalesce(1).write.mode("overwrite").json(f"{folder}/_layout")


def keyed_sources(spark: SparkSession, folder: str) -> Sources:
    """The tables under ``folder``; each keyed one has the column ``key_bucket``, which knows its key and the number of buckets."""
    buckets = spark.read.schema("buckets int").json(f"{folder}/_layout").first()[0]

    def maker(name: str) -> Callable[[], DataFrame]:
        if name not in LOOKED_UP_BY:
            return lambda: spark.read.schema(SOURCE_SCHEMAS[name]).parquet(f"{folder}/{name}")
        layout = {"key": LOOKED_UP_BY[name], "buckets": buckets}
        return lambda: spark.read.schema(f"{SOURCE_SCHEMAS[name]}, {BUCKET} int").parquet(f"{folder}/{name}").withMetadata(BUCKET, layout)

    return Sources({name: maker(name) for name in SOURCE_SCHEMAS if exists(spark, f"{folder}/{name}")})


def is_keyed(spark: SparkSession, folder: str) -> bool:
    return exists(spark, f"{folder}/_layout")


def only(df: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """Rows whose ``column`` is among the values of the single column of ``keys``. A table stored by that column is read in their buckets alone."""
    wanted = keys.select(F.col(keys.columns[0]).alias("wanted_key"))
    match = df[column] == F.col("wanted_key")
    if BUCKET not in df.columns:
        return df.join(wanted, match, "left_semi")
    layout = df.schema[BUCKET].metadata
    if layout.get("key") == column:
        # pruning is planned only for keys that went through a filter
        wanted = wanted.withColumn("wanted_bucket", bucket_of(F.col("wanted_key"), layout["buckets"])).filter("wanted_bucket >= 0")
        match = match & (df[BUCKET] == F.col("wanted_bucket"))
    return df.join(wanted, match, "left_semi").drop(BUCKET)
