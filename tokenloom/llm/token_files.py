"""Documents as token ids in files of Simple-8b blocks, in ascending doc_id order, and back.

A data set is a folder with two Parquet tables. ``blocks`` has a row for each block: its shard and number,
the ids of the shard before it, its documents (ids and lengths), the 64-bit words, and the offsets that let a
reader decode a part of the block. A document lies in one block. ``shards`` has the ids before each shard.

Defined cases: a null or empty text gives only the end id; rows with the same doc_id are separate documents, ordered by
their ids; a null doc_id sorts first; an empty table gives no blocks; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tokenloom.llm import simple8b
from tokenloom.llm.common import partitions
from tokenloom.llm.tokens import word_tokenizer

BLOCK_IDS = 1 << 18

_ENCODED = "shard int, doc_id long, n_tokens long, ids binary"
_BLOCKS = (
    "shard int, block int, shard_ids long, n_ids long, doc_ids array<long>, doc_tokens array<long>, "
    "words binary, offsets array<long>"
)
_TOKENS = "doc_id long, start long, n_tokens long, ids_crc32 long, block_start long"


def _encoder(tokenizer: str, end_id: int, bounds: list[int]):
    edges = np.array(bounds, np.int64)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = word_tokenizer(tokenizer)
        for batch in batches:
            doc_ids, at = batch.column(0), 0
            keys = np.asarray(doc_ids.fill_null(np.iinfo(np.int64).min))
            shards = np.searchsorted(edges, keys, side="left").astype(np.int32)
            for count, ids, sizes in tool.encode_all(text.as_py() for text in batch.column(1)):
                ends = np.cumsum(sizes)
                flat = np.insert(ids, ends, end_id).astype("<u4")
                cuts = (np.r_[0, ends + np.arange(1, count + 1)] * 4).astype(np.int32)
                # two bytes an id on the way to its shard where the vocabulary allows it
                narrow = int(flat.max()) < 1 << 16
                data = flat.astype("<u2") if narrow else flat
                cuts = cuts // 2 if narrow else cuts
                blobs = pa.Array.from_buffers(pa.binary(), count, [None, pa.py_buffer(cuts), pa.py_buffer(data)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shards[at : at + count]), doc_ids.slice(at, count), pa.array(sizes + 1), blobs],
                    names=["shard", "doc_id", "n_tokens", "ids"],
                )
                at += count

    return encode


def _write_blocks(block_ids: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, block, done = None, 0, 0
        held: list[tuple[int | None, np.ndarray]] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal block, done, held, size
            if held:
                words, offsets = simple8b.encode(np.concatenate([ids for _, ids in held]))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([shard], pa.int32()),
                        pa.array([block], pa.int32()),
                        pa.array([done], pa.int64()),
                        pa.array([size], pa.int64()),
                        pa.array([[d for d, _ in held]], pa.list_(pa.int64())),
                        pa.array([[len(ids) for _, ids in held]], pa.list_(pa.int64())),
                        pa.array([words.astype("<u8").tobytes()], pa.binary()),
                        pa.array([offsets.tolist()], pa.list_(pa.int64())),
                    ],
                    names=["shard", "block", "shard_ids", "n_ids", "doc_ids", "doc_tokens", "words", "offsets"],
                )
                block, done, held, size = block + 1, done + size, [], 0

        for batch in batches:
            rows = zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True)
            for here, doc_id, n_tokens, data in rows:
                if here != shard:
                    yield from flush()
                    shard, block, done = here, 0, 0
                held.append((doc_id, np.frombuffer(data, "<u2" if len(data) == 2 * n_tokens else "<u4")))
                size += n_tokens
                if size >= block_ids:
                    yield from flush()
        yield from flush()

    return write


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int, block_ids: int = BLOCK_IDS) -> None:
    """Encode ``docs`` (doc_id, text) and write the data set to ``path``.

    Shards are ranges of doc_id, cut at quantiles of the doc_id column alone. Texts are encoded where they are read; only
    ids move. Each task sorts its shard and writes it block by block.
    """
    spark = docs.sparkSession
    n = partitions(spark)
    cuts = [k / n for k in range(1, n)] or [0.5]
    bounds = docs.agg(F.percentile_approx("doc_id", cuts, 10 * n).alias("cuts")).first()["cuts"] or []
    (
        docs.select(F.col("doc_id").cast("long"), "text")
        .mapInArrow(_encoder(tokenizer, end_id, sorted(set(bounds))), _ENCODED)
        .repartitionById(n, F.col("shard"))  # no sampling, which would encode all texts once more
        .sortWithinPartitions("shard", F.col("doc_id").asc_nulls_first(), "ids")
        .mapInArrow(_write_blocks(block_ids), _BLOCKS)
        .write.mode("overwrite").parquet(f"{path}/blocks")
    )
    sizes = spark.read.parquet(f"{path}/blocks").groupBy("shard").agg(F.sum("n_ids").alias("n_ids"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row for each shard
    sizes.withColumn("ids_before", F.coalesce(F.sum("n_ids").over(before), F.lit(0))).write.mode("overwrite").parquet(f"{path}/shards")


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start, n_ids, doc_ids, sizes, data in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
            ids = simple8b.decode(np.frombuffer(data, "<u8"), n_ids).astype("<u4")
            ends = np.cumsum(sizes)
            crcs = [zlib.crc32(ids[e - s : e]) for s, e in zip(sizes, ends.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(doc_ids, pa.int64()),
                    pa.array(start + ends - np.array(sizes), pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(crcs, pa.int64()),
                    pa.array([start] * len(doc_ids), pa.int64()),
                ],
                names=["doc_id", "start", "n_tokens", "ids_crc32", "block_start"],
            )


def _blocks(spark: SparkSession, path: str) -> DataFrame:
    before = spark.read.parquet(f"{path}/shards").select("shard", "ids_before")
    return spark.read.parquet(f"{path}/blocks").join(before, "shard").withColumn("start", F.col("ids_before") + F.col("shard_ids"))


def digest_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files: doc_id, start, n_tokens, ids_crc32 and the start of its block."""
    return _blocks(spark, path).select("start", "n_ids", "doc_ids", "doc_tokens", "words").mapInArrow(_digest, _TOKENS)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files: doc_id, start, and its ids as an array."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, n_ids, doc_ids, sizes, data in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                ids = simple8b.decode(np.frombuffer(data, "<u8"), n_ids).astype(np.int64)
                ends = np.cumsum(sizes)
                lists = pa.ListArray.from_arrays(pa.array(np.r_[0, ends].astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_ids, pa.int64()), pa.array(start + ends - np.array(sizes), pa.int64()), lists],
                    names=["doc_id", "start", "ids"],
                )

    return _blocks(spark, path).select("start", "n_ids", "doc_ids", "doc_tokens", "words").mapInArrow(read, "doc_id long, start long, ids array<long>")
