"""Mixing sources to target weights along a time-varying curriculum.

Every source has a weight and a schedule: how its share of the weight is spread over training time 0 to 1, given by
knots (time, height) joined by straight lines. The integral of the schedule, scaled to the source's target, is its cumulative
word demand. A source's documents stand in a fixed random order and repeat in passes; the demand, inverted at the
words before a document's pass, gives its training position. The document at the border is taken whole if that comes
nearer to the target, or if its source would else give nothing, and not at all if not: no text is cut. A
source's demand is spread over the words it gives. Sorting by position gives the mix.

Targets share all words by weight and stop at ``most`` times a source's words; the excess is shared
again by weight until no target is above.

Defined cases: null text has no words; a null source is a source of its own, last in order; a null doc_id is a document; rows that
repeat a doc_id count separately, in the order of their texts' hashes; a source without words has target 0; an empty
table gives no rows; other columns are ignored by ``plan_mix``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenloom.llm.common import Scratch, partitions, whole_rows, word_count

Schedule = Sequence[tuple[float, float]]


def source_targets(sizes: DataFrame, weights: Sequence[int], most: int) -> DataFrame:
    """(source, source_rank, source_size, target) from (source, size) rows.

    Sources take the weights in turn, by code point, null last. A source is full at a water level of most * size / weight;
    those below the final level keep their cap, the others share the rest by weight. Sorted by their level, the
    full ones come first, so running sums over the sources (a row each) find the level.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("source_rank") % len(weights) + 1).cast("int")).cast("long")
    ranked = sources.withColumn("source_rank", F.row_number().over(order) - 1).withColumn("weight", weight)
    ranked = ranked.withColumn("cap", F.col("source_size") * F.lit(most))
    by_level = Window.orderBy(F.col("cap").cast("double") / F.col("weight"), "source_rank")
    before, after = by_level.rowsBetween(Window.unboundedPreceding, -1), by_level.rowsBetween(0, Window.unboundedFollowing)
    everywhere = Window.partitionBy()
    ranked = (
        ranked.withColumn("rest", F.sum("source_size").over(everywhere) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("open_weight", F.sum("weight").over(after))
        .withColumn("shares", F.col("cap") * F.col("open_weight") >= F.col("rest") * F.col("weight"))
    )
    # the first source that doesn't fill up sets the level for all from it on
    level = F.min_by(F.when(F.col("shares"), F.struct("rest", "open_weight")), F.when(F.col("shares"), F.struct(F.col("cap") / F.col("weight"), F.col("source_rank")))).over(everywhere)
    target = F.when(
        F.col("level").isNull() | (F.col("cap") * F.col("level.open_weight") < F.col("level.rest") * F.col("weight")), F.col("cap").cast("double")
    ).otherwise((F.col("weight") * F.col("level.rest")).cast("double") / F.col("level.open_weight"))
    return ranked.withColumn("level", level).select("source", "source_rank", "source_size", target.alias("target"))


def training_position(share: Column, schedule: Schedule) -> Column:
    """When a source has spent ``share`` (0 to 1) of its words: the inverse of its schedule's integral."""
    areas = [(t1 - t0) * (h0 + h1) / 2 for (t0, h0), (t1, h1) in zip(schedule, schedule[1:], strict=False)]
    total = sum(areas)
    if total <= 0 or any(t1 <= t0 for (t0, _), (t1, _) in zip(schedule, schedule[1:], strict=False)):
        raise ValueError("a schedule needs ascending times and a positive area")
    found, spent = F.lit(float(schedule[-1][0])), total
    for ((t0, h0), (t1, h1)), area in reversed(list(zip(zip(schedule, schedule[1:], strict=False), areas, strict=True))):
        spent -= area
        if area <= 0:
            continue
        slope, inside = (h1 - h0) / (t1 - t0), F.greatest(share * F.lit(total) - F.lit(spent), F.lit(0.0))
        # h0 x + slope x^2 / 2 = inside, in the form that also holds for a slope of 0
        x = 2 * inside / (F.lit(float(h0)) + F.sqrt(F.greatest(F.lit(float(h0)) ** 2 + 2 * F.lit(slope) * inside, F.lit(0.0))))
        x = F.when(inside <= 0, F.lit(0.0)).otherwise(F.least(x, F.lit(float(t1 - t0))))
        found = F.when(share * F.lit(total) < F.lit(spent + area), F.lit(float(t0)) + x).otherwise(found)
    return found


def words_before(rows: DataFrame, order: Sequence[str], scratch: Scratch) -> DataFrame:
    """``rows`` (source, size, ..) with ``begin``, the words of the source before a row in ``order``, which starts with source."""
    ranged = rows.repartitionByRange(partitions(rows.sparkSession), *order).withColumn("range", F.spark_partition_id())
    ranged = scratch.keep(ranged, "ranges")
    parts = ranged.groupBy("source", "range").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("words_before", F.coalesce(F.sum("words").over(earlier), F.lit(0))).select(F.col("source").alias("s"), F.col("range").alias("r"), "words_before")
    inside = Window.partitionBy("source", "range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    placed = placed.join(parts, placed["source"].eqNullSafe(parts["s"]) & (placed["range"] == parts["r"])).drop("s", "r")
    return placed.withColumn("begin", F.col("words_before") + F.col("inside"))


def scheduled(start: Column, wanted: Column, schedules: Sequence[Schedule]) -> Column:
    """The training position of a source (source_rank) that has spent ``start`` of the ``wanted`` words."""
    share = start / F.greatest(wanted, F.lit(1)).cast("double")
    position = F.lit(None).cast("double")
    for tier, schedule in enumerate(schedules):
        position = F.when(F.col("source_rank") % len(schedules) == tier, training_position(share, schedule)).otherwise(position)
    return position


def plan_mix(
    docs: DataFrame, weights: Sequence[int], most: int, schedules: Sequence[Schedule], scratch: Scratch, seed: str = "mix"
) -> DataFrame:
    """A row for each document: doc_id, source, text_hash, size, source_size, target, begin, taken and passes.

    ``begin`` is the words of the source before the document, ``passes`` lists what each pass takes: (pass, words, position). Within a source documents are ordered by a hash of doc_id
    and ``seed``. Running totals are taken in ranges of (source, hash), so one source may hold any part of the rows.
    """
    order = ["source", "turn", "doc_id", "text_hash"]
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        F.md5(F.concat_ws(" ", F.lit(seed), F.col("doc_id"))).alias("turn"), F.xxhash64("text").alias("text_hash"),
        word_count("text").alias("size"),
    )
    rows = scratch.keep(rows, "sizes")
    targets = scratch.keep(source_targets(rows, weights, most), "targets")
    placed = words_before(rows, order, scratch)
    small = targets.withColumnRenamed("source", "s")
    wanted = F.round("target").cast("long")

    def words_of(k: Column) -> Column:
        start = F.col("begin") + k * F.col("source_size")
        rest = wanted - start
        whole = (rest >= F.col("size")) | ((rest > 0) & ((2 * rest >= F.col("size")) | (start == 0)))
        return F.when(whole, F.col("size")).otherwise(0).cast("long")

    placed = placed.join(small, placed["source"].eqNullSafe(small["s"])).drop("s")
    placed = scratch.keep(placed.withColumn("words", F.transform(F.sequence(F.lit(0), F.lit(most - 1)), words_of)), "placed")
    taken = F.aggregate("words", F.lit(0).cast("long"), lambda total, words: total + words)
    given = placed.groupBy(F.col("source").alias("s")).agg(F.sum(taken).alias("given"))
    placed = placed.join(given, placed["source"].eqNullSafe(given["s"])).drop("s")

    def one_pass(words: Column, k: Column) -> Column:
        position = scheduled(F.col("begin") + k * F.col("source_size"), F.col("given"), schedules)
        return F.struct(k.cast("int").alias("pass"), words.alias("words"), position.alias("position"))

    passes = F.filter(F.transform("words", one_pass), lambda p: p["words"] > 0)
    return placed.select("doc_id", "source", "text_hash", "size", "source_size", "target", "begin", taken.alias("taken"), passes.alias("passes"))


def mixed_order(plan: DataFrame) -> DataFrame:
    """The mix: a row for each document and pass, sorted by training position in ranges."""
    document = ["doc_id", "source", "text_hash", "size", "source_size", "target", "begin"]
    one = plan.select(*document, F.explode("passes").alias("p")).select(*document, "p.pass", "p.words", "p.position")
    keys = ["position", "source", "doc_id", "text_hash", "pass"]
    return one.repartitionByRange(partitions(plan.sparkSession), *keys).sortWithinPartitions(*keys)


def documents_of_mix(plan: DataFrame, mix: DataFrame) -> DataFrame:
    """A row for each document of ``plan``, from its passes in ``mix``: doc_id, source, text_hash, size, source_size, target, taken, positions.

    ``positions`` lists the training positions of its passes. Documents without a pass in the plan have none.
    """
    document = ["doc_id", "source", "text_hash", "size", "source_size", "target", "begin"]
    taken = mix.groupBy(*document).agg(F.sum("words").alias("taken"), F.array_sort(F.collect_list("position")).alias("positions"))
    none = plan.where(F.size("passes") == 0).select(*document, F.lit(0).cast("long").alias("taken"), F.array().cast("array<double>").alias("positions"))
    return taken.union(none).drop("begin")


def mixed_documents(docs: DataFrame, plan: DataFrame) -> DataFrame:
    """The rows of ``docs`` in training order, one for each pass. Rows that repeat doc_id and text share their text, each has its own passes."""
    mix = plan.select(F.col("doc_id").alias("mix_id"), F.col("text_hash").alias("mix_hash"), "passes").where(F.size("passes") > 0)
    rows = whole_rows(docs).dropDuplicates(["doc_id", "text_hash"])
    rows = rows.join(mix, rows["doc_id"].eqNullSafe(F.col("mix_id")) & (rows["text_hash"] == F.col("mix_hash"))).withColumn("p", F.explode("passes"))
    keys = ["p.position", "doc_id", "text_hash", "p.pass"]
    rows = rows.repartitionByRange(partitions(docs.sparkSession), *keys).sortWithinPartitions(*keys)
    return rows.select(*(F.col(f"doc.`{c}`").alias(c) for c in docs.columns))


def in_training_order(docs: DataFrame, schedules: Sequence[Schedule], scratch: Scratch, seed: str = "mix") -> DataFrame:
    """The rows of a mix (see ``mixed_documents``) in training order, however they were stored: (doc_id, text).

    Nothing but the rows is needed: rows that repeat doc_id, source and text are its passes; within a source passes follow each other, each in the
    order of the hash of doc_id and ``seed``; a source's demand is spread over its words.

    The rank of a source counts the sources of the mix. Every source with words and a target of one or more is among them.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), "text",
        F.xxhash64("text").alias("text_hash"), F.xxhash64("doc_id", "source", "text").alias("key"),
    )
    sizes = rows.select("doc_id", "source", "text_hash", "key", word_count("text").alias("size"))
    once = scratch.keep(sizes.groupBy("key").agg(*(F.first(c).alias(c) for c in sizes.columns if c != "key"), F.count("*").alias("times")), "rows")
    turn = F.md5(F.concat_ws(" ", F.lit(seed), F.col("doc_id")))
    passes = once.select("key", "source", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("pass"), turn.alias("turn"), "doc_id", "text_hash", "size")
    placed = words_before(passes, ["source", "pass", "turn", "doc_id", "text_hash"], scratch)
    sources = once.groupBy("source").agg(F.sum(F.col("size") * F.col("times")).alias("given"))
    sources = sources.withColumn("source_rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1).withColumnRenamed("source", "s")
    placed = placed.join(sources, placed["source"].eqNullSafe(sources["s"]))
    at = F.struct(scheduled(F.col("begin"), F.col("given"), schedules).alias("position"), "pass")
    positions = placed.groupBy("key").agg(F.collect_list(at).alias("at"))
    keys = ["at.position", "source", "doc_id", "at.pass", "key"]
    ordered = rows.dropDuplicates(["key"]).join(positions, "key").select("doc_id", "source", "text", "key", F.explode("at").alias("at"))
    return ordered.repartitionByRange(partitions(docs.sparkSession), *keys).sortWithinPartitions(*keys).select("doc_id", "text")
