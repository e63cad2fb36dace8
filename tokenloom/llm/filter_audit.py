"""How filters interact: what each removes in every order of the filters, kept up to date as files arrive.

Whether a document repeats a text with a smaller id is known for certain only when all files are read. So files are taken in
micro-batches (available now), and every text has a state: the smallest id so far and the masks it was counted under. When a smaller
id arrives, the earlier counts are taken back from the counters of their parts and counted again with the repeat filter's bit. The
states of about ``BUCKET_TEXTS`` texts are kept and updated together, as columns.

Two streams, each with a checkpoint, run one after the other. The first evaluates the filters that read a text, joins the labels, and reduces each
micro-batch: a document whose text has a smaller id in the same batch is settled and goes straight to the counters, so however many copies a
text has, few rows of it move on. The second holds the state and writes changes of counters. A batch that
runs again replaces what it wrote. Later files continue both streams; sums over all changes are the counters.

Defined cases: a null text is an empty one, a null or empty lang is the part ''; a null doc_id has no smaller id and is none for
others; rows with the same smallest id are all first; labels of one doc_id are joined by "any"; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import io
import itertools
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.llm.common import Scratch, join_split, partitions, word_count, words

LETTERS = "ABCDE"
#: The repeat filter, the one that depends on other documents.
REPEAT = LETTERS.index("E")
#: Micro-batches that the files found at the start are dealt into.
BATCHES = 4
#: Texts that a bucket of states is meant to hold when an audit begins; later files let it grow.
BUCKET_TEXTS = 2048

#: 120 bits of the SHA-256 of a text.
_TEXT = ["hi", "lo"]
_CHANGE = ("part", "mask", "good", "bad")
_CHANGES = "part string, mask int, good boolean, bad boolean, n long"
_STATE = "firsts binary"
_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",  # else every partition reserves megabytes it doesn't use
}


def own_failures() -> list[Column]:
    """Conditions of failure of the filters A to D, over text and its words."""
    text, n_words = F.col("text"), word_count(F.col("text"))
    capitals = F.char_length(text) - F.char_length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return [
        n_words < 200,
        100 * F.size(F.array_distinct(words(text))) < 50 * n_words,
        100 * capitals > 3 * F.char_length(text),
        F.char_length(text) != F.char_length(F.translate(text, "#$%&*|", "")),
    ]


def facts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Narrow rows of documents: hi, lo, doc_id, part, the mask of the filters A to D, good and bad."""
    mask = sum((F.when(fails, F.lit(1 << k)).otherwise(F.lit(0)) for k, fails in enumerate(own_failures())), F.lit(0))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("lang", F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    rows = docs.select(F.sha2("text", 256).alias("digest"), "doc_id", "part", mask.cast("int").alias("mask"))
    halves = {name: F.conv(F.substring("digest", 1 + 15 * k, 15), 16, 10).cast("long") for k, name in enumerate(_TEXT)}
    # rows without an id would all meet in one task
    turn = F.when(F.col("doc_id").isNull(), F.xxhash64("digest", F.monotonically_increasing_id())).otherwise(F.lit(0))
    rows = rows.withColumns(halves).withColumn("turn", turn).drop("digest")
    marks = labels.withColumn("turn", F.lit(0).cast("long"))
    joined = rows.join(marks, ["doc_id", "turn"], "left").drop("turn")
    return joined.withColumns({c: F.coalesce(c, F.lit(False)) for c in ("good", "bad")})


def marks_of(labels: DataFrame) -> DataFrame:
    """A row for each labelled doc_id: good if any label says quality 1, bad if any says toxic 1."""
    any_one = lambda c: F.coalesce(F.bool_or(F.col(c) == 1), F.lit(False))
    grouped = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    return grouped.agg(any_one("quality").alias("good"), any_one("toxic").alias("bad"))


def summed(changes: DataFrame) -> DataFrame:
    return changes.groupBy(*_CHANGE).agg(F.sum("n").alias("n"))


def reduce_batch(rows: DataFrame, low: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The facts of a micro-batch, and ``low`` of them, as (settled changes, rows that may be the first of their text)."""
    placed = join_split(rows, low.select(*_TEXT, "low"), _TEXT, low, partitions(rows.sparkSession))
    beaten = F.col("doc_id") > F.col("low")
    settled = placed.where(F.col("doc_id").isNull() | beaten)
    mask = F.when(beaten, F.col("mask").bitwiseOR(F.lit(1 << REPEAT))).otherwise(F.col("mask")).alias("mask")
    settled = settled.groupBy("part", mask, "good", "bad").agg(F.count("*").alias("n"))
    first = placed.where(F.col("doc_id") == F.col("low")).groupBy(*_TEXT, "doc_id", *_CHANGE).agg(F.count("*").alias("n"))
    return settled, first


def lowest(rows: DataFrame) -> DataFrame:
    """For each text of a micro-batch its smallest id (low) and its number of rows (copies)."""
    return rows.groupBy(*_TEXT).agg(F.min("doc_id").alias("low"), F.count("*").alias("copies"))


def _follow_texts(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
    """Changes of counters as ids of the texts of a bucket arrive. A micro-batch brings a text few rows."""
    new = pd.concat([f[[*_TEXT, "doc_id", *_CHANGE, "n"]] for f in frames], ignore_index=True)
    old = pd.read_feather(io.BytesIO(state.get[0])) if state.exists else new.iloc[:0]
    rows = pd.concat([old, new], ignore_index=True)
    was_first = pd.Series(rows.index < len(old))
    first = rows["doc_id"] == rows.groupby(_TEXT)["doc_id"].transform("min")
    fell = rows[was_first & ~first]  # no longer the first: take back, count as a repeat
    repeats = rows[~first]
    changes = pd.concat([rows[first & ~was_first], fell.assign(n=-fell["n"]), repeats.assign(mask=repeats["mask"] | 1 << REPEAT)])
    firsts = rows[first].groupby([*_TEXT, "doc_id", *_CHANGE], as_index=False)["n"].sum()
    kept = io.BytesIO()
    firsts.to_feather(kept, compression="lz4")
    state.update((kept.getvalue(),))
    yield changes.groupby(list(_CHANGE), as_index=False)["n"].sum()


def _run(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    query = stream.writeStream.outputMode("append").foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def _files(spark: SparkSession, path: str, batches: int) -> DataFrame:
    """The files at ``path`` (a pattern) as a stream, all of them however old, in about ``batches`` micro-batches."""
    found = spark.read.parquet(path)
    each = max(1, -(-len(found.inputFiles()) // batches))
    return spark.readStream.schema(found.schema).option("maxFilesPerTrigger", each).option("maxFileAge", "36500d").parquet(path)


def _buckets(spark: SparkSession, work: Scratch) -> int:
    """The number of buckets, fixed when an audit begins."""
    found = spark.read.parquet(work.path("first/*")).agg(F.ceil(F.count("*") / BUCKET_TEXTS).alias("buckets"))
    found.select(F.greatest("buckets", F.lit(1)).alias("buckets")).write.mode("ignore").parquet(work.path("buckets"))
    return spark.read.parquet(work.path("buckets")).first()[0]


def follow_files(spark: SparkSession, path: str, labels: DataFrame, work: Scratch, batches: int = BATCHES) -> DataFrame:
    """Takes the files at ``path`` that earlier calls with the same ``work`` did not take, and returns the counters: part, mask,
    good, bad, n."""
    marks = work.keep(marks_of(labels), "marks")

    def reduced(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        rows = work.path(f"facts/{batch_id}")
        facts(batch, marks).write.mode("overwrite").parquet(rows)
        lowest(session.read.parquet(rows)).write.mode("overwrite").parquet(work.path(f"low/{batch_id}"))
        settled, first = reduce_batch(session.read.parquet(rows), session.read.parquet(work.path(f"low/{batch_id}")))
        settled.write.mode("overwrite").parquet(work.path(f"settled/{batch_id}"))
        first.write.mode("overwrite").parquet(work.path(f"first/{batch_id}"))
        work.drop(f"facts/{batch_id}")
        work.drop(f"low/{batch_id}")

    def counted(batch: DataFrame, batch_id: int) -> None:
        summed(batch).write.mode("overwrite").parquet(work.path(f"moved/{batch_id}"))

    table = path.rstrip("/")
    one = f"{table[:-1]}[{table[-1]}]"  # a table may be a single file, which a stream takes only as a pattern
    _run(_files(spark, one, batches), reduced, work.path("checkpoint-files"))
    before = {name: spark.conf.get(name, None) for name in _STORE}
    try:
        for name, value in _STORE.items():
            spark.conf.set(name, value)
        texts = _files(spark, work.path("first/*"), batches)
        texts = texts.withColumn("bucket", F.pmod("hi", F.lit(_buckets(spark, work)))).groupBy("bucket")
        _run(texts.applyInPandasWithState(_follow_texts, _CHANGES, _STATE, "append", "NoTimeout"), counted, work.path("checkpoint-texts"))
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    changes = spark.read.schema(_CHANGES).parquet(work.path("settled/*"), work.path("moved/*"))
    return work.keep(summed(changes), "counters")


def interactions(counters: DataFrame) -> DataFrame:
    """For each part, order of the filters and step: what the step's filter does there. All from the counters of masks, 32 a part."""
    per_mask = counters.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("n_good"), F.sum(F.when(F.col("bad"), F.col("n")).otherwise(0)).alias("n_bad")
    )
    orders = F.array(*(F.lit("".join(o)) for o in itertools.permutations(LETTERS)))
    rows = per_mask.withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(LETTERS)))))
    at = {c: F.instr("filter_order", c) for c in LETTERS}
    bits = lambda chosen: sum((F.when(chosen(at[c]), F.lit(1 << k)).otherwise(0) for k, c in enumerate(LETTERS)), F.lit(0))
    rows = rows.withColumns({"own": bits(lambda place: place == F.col("step")), "earlier": bits(lambda place: place < F.col("step"))})
    mask, own, earlier = F.col("mask"), F.col("own"), F.col("earlier")
    fails, gone = mask.bitwiseAND(own) != 0, mask.bitwiseAND(earlier) != 0
    here = fails & ~gone
    # a document that fails k filters is removed by each of them in the 120 / k orders that have it first
    share = F.lit(120) / F.bit_count(mask)

    def total(condition: Column, value="n") -> Column:
        return F.sum(F.when(condition, value if isinstance(value, Column) else F.col(value)).otherwise(0)).cast("long")

    return rows.groupBy("part", "filter_order", "step").agg(
        total(~fails & ~gone).alias("kept"), total(here).alias("removed"), total(fails & gone).alias("redundant"), total(mask == own).alias("unique_fails"),
        total(here, "n_good").alias("good_lost"), total(here, "n_bad").alias("toxic_lost"), total(fails, F.col("n") * share.cast("long")).alias("shapley"),
    )
