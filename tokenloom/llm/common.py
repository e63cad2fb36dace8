"""What several operators share: table reads, scratch tables, word patterns and blob exchange."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.settings import shared_folder

#: White space of all contracts here, as characters and as a regular expression of words.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


class Scratch:
    """A folder of intermediate tables below the folder that all executors share."""

    def __init__(self, spark: SparkSession, purpose: str):
        self.spark = spark
        self.folder = f"{shared_folder(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` once and read it back: cuts the lineage and survives lost executors."""
        df.write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, name: str) -> None:
        """Delete a table of this folder that no later step reads."""
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path(name))
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def whole_rows(docs: DataFrame) -> DataFrame:
    """``docs`` as one struct column each (doc), beside doc_id and text_hash, so that no name of theirs can clash."""
    everything = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    return docs.select(everything.alias("doc"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"))


def chosen_rows(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """One row of ``docs`` for each (doc_id, text_hash) in ``chosen``; a null doc_id is a doc_id here."""
    rows, keys = whole_rows(docs), chosen.select(F.col("doc_id").alias("i"), F.col("text_hash").alias("h")).distinct()
    rows = rows.join(keys, rows["doc_id"].eqNullSafe(F.col("i")) & (rows["text_hash"] == F.col("h")), "left_semi")
    return rows.dropDuplicates(["doc_id", "text_hash"]).select("doc.*")


def join_split(rows: DataFrame, found: DataFrame, key: list[str], sizes: DataFrame, n: int) -> DataFrame:
    """``rows`` left joined to ``found``, which has a row at most for each key. ``sizes`` has each key's number of rows (copies).

    A key with more rows than half a task's share is dealt out over several parts and its row in ``found`` copied to them. There are at most
    2 n such keys, so their list may be broadcast. ``rows`` are read from files, so a repeated task deals them as before.
    """
    share = max(1, -(-(sizes.agg(F.sum("copies")).first()[0] or 0) // (2 * n)))
    hot = F.broadcast(sizes.where(F.col("copies") > share).select(*key, F.ceil(F.col("copies") / share).cast("int").alias("parts")))
    dealt = rows.join(hot, key, "left").withColumn("part_of_key", F.coalesce((F.rand(7) * F.col("parts")).cast("int"), F.lit(0))).drop("parts")
    every = F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)
    copied = found.join(hot, key, "left").withColumn("part_of_key", F.explode(every)).drop("parts")
    return dealt.join(copied, [*key, "part_of_key"], "left").drop("part_of_key")


def words(text) -> F.Column:
    """The words of a text as an array; null gives none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE_RUN), lambda w: w != "")


def word_count(text) -> F.Column:
    """Number of words, as a long; null gives 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def bind(value, use) -> F.Column:
    """``use(value)`` with ``value`` worked out once per row, however often ``use`` names it, also inside lambdas."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


# --- blobs ---------------------------------------------------------------------------------------
# Many narrow records with a uniformly hashed key travel as one binary value per task and bucket,
# column after column. A bucket is one unit of work in numpy; the number of buckets follows the data.

BLOB_SCHEMA = "bucket int, blob binary"
_BLOB = pa.schema([("bucket", pa.int32()), ("blob", pa.binary())])


def blob_batches(bucket: np.ndarray, columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Records split by bucket. ``columns`` are one-dimensional and of equal length."""
    if not len(bucket):
        return
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    columns = [c[order] for c in columns]
    cuts = np.flatnonzero(np.diff(bucket)) + 1
    starts, ends = np.r_[0, cuts], np.r_[cuts, len(bucket)]
    for lo in range(0, len(starts), 256):
        chosen = range(lo, min(lo + 256, len(starts)))
        blobs = [b"".join(_planes(c[starts[k] : ends[k]]) for c in columns) for k in chosen]
        yield pa.RecordBatch.from_arrays([pa.array(bucket[starts[lo : lo + 256]], pa.int32()), pa.array(blobs, pa.binary())], schema=_BLOB)


def _planes(column: np.ndarray) -> bytes:
    """First bytes, then second bytes and so on: small and near numbers leave runs that the shuffle compresses."""
    return np.ascontiguousarray(column).view(np.uint8).reshape(len(column), -1).T.tobytes()


def _from_planes(blob: bytes, kind: np.dtype, count: int, at: int) -> np.ndarray:
    planes = np.frombuffer(blob, np.uint8, count * kind.itemsize, at).reshape(kind.itemsize, count)
    return np.ascontiguousarray(planes.T).view(kind).reshape(count)


def read_blobs(blobs: list[bytes], kinds: list[str]) -> list[np.ndarray]:
    """The columns of the records in ``blobs``; ``kinds`` are their numpy types, in order."""
    width = sum(np.dtype(k).itemsize for k in kinds)
    parts: list[list[np.ndarray]] = [[] for _ in kinds]
    for blob in blobs:
        count, at = len(blob) // width, 0
        for part, kind in zip(parts, kinds, strict=True):
            part.append(_from_planes(blob, np.dtype(kind), count, at))
            at += count * np.dtype(kind).itemsize
    return [np.concatenate(p) if p else np.empty(0, k) for p, k in zip(parts, kinds, strict=True)]


def buckets_in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[bytes]]]:
    """The blobs of each bucket, from rows (bucket, blob) sorted by bucket."""
    now, held = None, []
    for batch in batches:
        for bucket, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if bucket != now:
                if held:
                    yield now, held
                now, held = bucket, []
            held.append(blob)
    if held:
        yield now, held


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers (the finaliser of MurmurHash3)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))
