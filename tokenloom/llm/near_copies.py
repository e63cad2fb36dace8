"""Near copies by the Jaccard similarity of word shingles: ball hashing of SimHash fingerprints finds pairs first, MinHash bands those
beyond the ball, and the shingles themselves decide.

Every text has a SimHash fingerprint of its shingles. Fingerprints at ``simhash.RADIUS`` or fewer differing bits meet by ball hashing, as in
``simhash``; texts that meet so and have the similarity link, and their components need no further pairs among themselves.

Texts at a similarity of 0.8 differ in about ten of 64 SimHash bits, too many for the ball alone. So ``BANDS`` values of
``ROWS`` minima each are also worked out for every text; two texts at similarity s share a value with probability
1 - (1 - s^ROWS)^BANDS, at 0.8 all but 3 in 100,000. Texts that share a value are paired: all with all up to ``ALL_PAIRS``, in larger groups each
with the next ``AHEAD`` in an order that every value draws anew, so pairs grow with the rows and not with their square. Only pairs whose
shingles have the similarity link; components of links are groups.

Texts of larger groups (crowded ones) are then compared exactly, as far as they are not yet in one component. Their shingles are put in one order,
rare ones first. Two sets with the similarity share one of the first (1 - similarity) part of their shingles, and where the first
shared one stands bounds what they can share in all. So crowded texts meet once more by those first shingles, and of a meeting only pairs of
different components whose places allow the similarity are checked. Texts that share much and yet too little have their own, rare
shingles in front, which rules the pair out without looking at it; copies are in one component by then.

Defined cases: texts without words have no shingles and equal each other; fewer words than a shingle are one shingle; equal
texts are one node; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.common import BLOB_SCHEMA, Scratch, blob_batches, buckets_in_order, mixed, read_blobs
from tokenloom.llm.components import connected_components
from tokenloom.llm.simhash import majority, near_links, shingle_hashes

BANDS, ROWS = 26, 5
ALL_PAIRS, AHEAD = 16, 4
#: Values that a bucket is meant to hold.
BUCKET_VALUES = 1 << 20

_SEEDS = mixed(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64))


def band_values(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A row of ``BANDS`` values for each run of ``counts`` shingle hashes; runs without any share theirs."""
    found = np.full((len(counts), BANDS), np.uint64(0))
    full = np.flatnonzero(counts)
    starts = (np.cumsum(counts) - counts)[full]
    for k, seed in enumerate(_SEEDS):
        if len(full):
            least = np.minimum.reduceat((hashes ^ seed) * (seed | np.uint64(1)), starts)
            found[full, k // ROWS] = mixed(found[full, k // ROWS] ^ least) + np.uint64(k)
    return found ^ mixed(np.arange(BANDS, dtype=np.uint64) + np.uint64(1 << 32))


def _marks(size: int):
    """The SimHash fingerprint and the band values of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            hashes: list[int] = []
            counts: list[int] = []
            for k, text in enumerate(batch.column(1)):
                found = shingle_hashes(text.as_py(), size)
                hashes += found
                counts.append(len(found))
                if len(hashes) >= 1 << 16 or k == batch.num_rows - 1:
                    runs = np.array(hashes, np.uint64), np.array(counts, np.int64)
                    prints, bands = majority(*runs).view(np.int64), [row.tobytes() for row in band_values(*runs)]
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(counts)), pa.array(prints), pa.array(bands, pa.binary())], names=["node", "fp", "bands"])
                    hashes, counts, at = [], [], k + 1

    return run


def _bands(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node = np.repeat(np.asarray(batch.column(0)).view(np.uint64), BANDS)
            value = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint64)
            yield from blob_batches((mixed(value) % np.uint64(buckets)).astype(np.int32), [value, node])

    return run


def _batch(pairs: np.ndarray) -> pa.RecordBatch:
    pairs = np.unique(np.sort(pairs, axis=1), axis=0)
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], names=["a", "b"])


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of texts that share a value; a text of a large group is also paired with itself."""
    for _, blobs in buckets_in_order(batches):
        value, node = read_blobs(blobs, ["<u8", "<u8"])
        order = np.lexsort((node, mixed(node ^ value), value))
        value, node = value[order], node[order]
        new = np.r_[True, (value[1:] != value[:-1]) | (node[1:] != node[:-1])]
        value, node = value[new], node[new].view(np.int64)
        head = np.flatnonzero(np.r_[True, value[1:] != value[:-1]])
        members = np.repeat(np.diff(np.r_[head, len(value)]), np.diff(np.r_[head, len(value)]))
        reach = np.where(members <= ALL_PAIRS, ALL_PAIRS - 1, AHEAD)
        found = [np.stack([node[members > ALL_PAIRS]] * 2, axis=1)]
        for step in range(1, min(ALL_PAIRS, len(value))):
            i = np.flatnonzero((reach[:-step] >= step) & (value[:-step] == value[step:]))
            found.append(np.stack([node[i], node[i + step]], axis=1))
        yield _batch(np.concatenate(found))


def _shingles(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [np.unique(np.array(shingle_hashes(t.as_py(), size), "<u8")).tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["node", "shingles"])

    return run


def _similar(similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_py(), "<u8"), np.frombuffer(y.as_py(), "<u8")
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(both >= similarity * (len(x) + len(y) - both))
            kept = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(kept), batch.column(1).filter(kept)], names=["a", "b"])

    return run


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    sides = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a")
    sides = sides.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b")
    return sides.select("a", "b", "x", "y").mapInArrow(_similar(similarity), "a long, b long")


def _by_bucket(blobs: DataFrame) -> DataFrame:
    return blobs.repartition("bucket").sortWithinPartitions("bucket")


def _count_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            values, counts = np.unique(np.frombuffer(b"".join(batch.column(0).to_pylist()), "<i8"), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(counts)], names=["shingle", "n"])


def _each_shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for node, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            shingles = np.frombuffer(data, "<i8")
            same = [np.full(len(shingles), x) for x in (node, len(shingles))]
            yield pa.RecordBatch.from_arrays([*map(pa.array, same), pa.array(shingles)], names=["node", "size", "shingle"])


_FRONT = ["<u8", "<i8", "<i8", "<i4", "<i4", "u1"]  # meeting, node, component, size, place, of the meeting's own class


def _meetings(buckets: int, similarity: float):
    """Front shingles by shingle and class of sizes. Sizes that allow the similarity lie in one class or in neighbours; a text comes to its
    own class's meeting and as a guest to the next one's."""
    width = -1.01 * np.log(similarity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shingle, node, component, size, place = (np.asarray(batch.column(k)) for k in range(5))
            level = (np.log(size) / width).astype(np.uint64)
            for guest in (0, 1):
                meeting = mixed(shingle.view(np.uint64) + mixed(level + np.uint64(guest + 1)))
                columns = [meeting, node, component, size.astype("<i4"), place.astype("<i4"), np.full(len(node), 1 - guest, np.uint8)]
                yield from blob_batches((meeting % np.uint64(buckets)).astype(np.int32), columns)

    return run


def _front_pairs(similarity: float):
    def allowed(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
        """Pairs of different components whose sizes and places leave room for the similarity."""
        (part, size, place, own), (other, size_2, place_2, own_2) = x, y
        room = np.minimum(size - place, size_2 - place_2)  # shared in all, if this is the first shared one
        return (part != other) & (own | own_2).astype(bool) & (room * (1 + similarity) >= similarity * (size + size_2) - 1e-6)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, blobs in buckets_in_order(batches):
            meeting, node, *rest = read_blobs(blobs, _FRONT)
            order = np.lexsort((rest[0], meeting))
            meeting, node, rest = meeting[order], node[order], [r[order] for r in rest]
            head = np.flatnonzero(np.r_[True, meeting[1:] != meeting[:-1]])
            sizes = np.diff(np.r_[head, len(meeting)])
            small = np.repeat(sizes <= ALL_PAIRS, sizes)
            for step in range(1, min(ALL_PAIRS, len(meeting))):
                i = np.flatnonzero(small[:-step] & (meeting[:-step] == meeting[step:]))
                i = i[allowed([r[i] for r in rest], [r[i + step] for r in rest])]
                if len(i):
                    yield _batch(np.stack([node[i], node[i + step]], axis=1))
            for lo, count in zip(head[sizes > ALL_PAIRS].tolist(), sizes[sizes > ALL_PAIRS].tolist(), strict=True):
                hi = lo + count
                if rest[0][lo] == rest[0][hi - 1]:
                    continue  # one component
                for k in range(lo, hi - 1):  # against the rest of the meeting; its own component comes first and is left out
                    first = k + int(np.searchsorted(rest[0][k:hi], rest[0][k], side="right"))
                    mine = [r[k : k + 1] for r in rest]
                    i = first + np.flatnonzero(allowed(mine, [r[first:hi] for r in rest]))
                    if len(i):
                        yield _batch(np.stack([np.repeat(node[k], len(i)), node[i]], axis=1))

    return run


def crowded_pairs(sets: DataFrame, components: DataFrame, scratch: Scratch, similarity: float) -> DataFrame:
    """Pairs (a, b) among the texts of ``sets`` (node, shingles) that may have the similarity and are in different ``components``."""
    shared = sets.select("shingles").mapInArrow(_count_shingles, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n")).where("n > 1")
    rows = sets.select("node", "shingles").mapInArrow(_each_shingle, "node long, size long, shingle long").join(shared, "shingle")
    front = rows.groupBy("node", "size").agg(F.sort_array(F.collect_list(F.struct("n", "shingle"))).alias("common"))
    # shingles that no other text has come first in the order and pair with nothing
    alone = F.col("size") - F.size("common")
    reach = F.col("size") - F.ceil(F.col("size") * F.lit(similarity) - 1e-6) + 1
    front = front.withColumn("alone", alone).withColumn("first", F.slice("common", F.lit(1), F.greatest(F.lit(0), reach - alone).cast("int")))
    front = front.join(components, "node", "left").select("node", "size", "alone", F.coalesce("component", "node").alias("component"), F.posexplode("first").alias("k", "c"))
    front = scratch.keep(front.select("c.shingle", "node", "component", "size", (F.col("alone") + F.col("k")).alias("place")), "front")
    buckets = max(1, -(-2 * front.count() // BUCKET_VALUES))
    return _by_bucket(front.mapInArrow(_meetings(buckets, similarity), BLOB_SCHEMA)).mapInArrow(_front_pairs(similarity), "a long, b long").distinct()


def ball_pairs(marks: DataFrame, scratch: Scratch) -> DataFrame:
    """Pairs (a, b) of the texts in ``marks`` (node, fp) that the ball joins: the texts of a fingerprint with the least of them, and the
    least ones of fingerprints that link."""
    prints = marks.select("node", "fp").distinct()
    least = scratch.keep(prints.groupBy("fp").agg(F.min("node").alias("least")), "fingerprints")
    pairs = near_links(least, least.count())
    for side in ("a", "b"):
        pairs = pairs.join(least.select(F.col("fp").alias(side), F.col("least").alias(f"least_{side}")), side)
    same = prints.join(least, "fp").where("node <> least").select(F.col("least").alias("a"), F.col("node").alias("b"))
    return pairs.select(F.col("least_a").alias("a"), F.col("least_b").alias("b")).union(same)


def _apart(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """The ``pairs`` (a, b) that are not in one component of ``found`` yet."""
    for side in ("a", "b"):
        pairs = pairs.join(found.select(F.col("node").alias(side), F.col("component").alias(f"part_{side}")), side, "left")
    return pairs.where(F.coalesce("part_a", "a") != F.coalesce("part_b", "b")).select("a", "b")


def _joined(found: DataFrame, links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """The components of ``found`` with further ``links``."""
    return connected_components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).union(links), scratch, name)


def similar_components(texts: DataFrame, scratch: Scratch, size: int, similarity: float) -> DataFrame:
    """(node, component) of the ``texts`` (node, text) that are linked to another."""
    marks = scratch.keep(texts.select("node", "text").mapInArrow(_marks(size), "node long, fp long, bands binary"), "marks")
    near = scratch.keep(ball_pairs(marks, scratch), "ball")
    buckets = max(1, -(-marks.count() * BANDS // BUCKET_VALUES))
    pairs = _by_bucket(marks.select("node", "bands").mapInArrow(_bands(buckets), BLOB_SCHEMA)).mapInArrow(_pairs, "a long, b long").distinct()
    pairs = scratch.keep(pairs, "pairs")
    both = pairs.union(near)
    met = both.select(F.col("a").alias("node")).union(both.select("b")).distinct()
    sets = texts.join(met, "node", "left_semi").dropDuplicates(["node"]).select("node", "text")
    sets = scratch.keep(sets.mapInArrow(_shingles(size), "node long, shingles binary"), "shingles")
    found = scratch.keep(connected_components(scratch.keep(_verified(near, sets, similarity), "ball-links"), scratch, "ball"), "found-by-ball")
    links = scratch.keep(_verified(_apart(pairs.where("a <> b"), found), sets, similarity), "links")
    found = _joined(found, links, scratch, "bands")
    crowded = pairs.where("a = b").select(F.col("a").alias("node"))
    if crowded.isEmpty():
        return found
    found = scratch.keep(found, "found")
    more = crowded_pairs(scratch.keep(sets.join(crowded, "node", "left_semi"), "crowded"), found, scratch, similarity)
    more = scratch.keep(_verified(scratch.keep(more, "more"), sets, similarity), "more-links")
    if more.isEmpty():
        return found
    return _joined(found, more, scratch, "again")


def similar_groups(docs: DataFrame, scratch: Scratch, size: int, similarity: float) -> DataFrame:
    """A row for each document: doc_id, text_hash and component, the least text_hash of its group."""
    parts = similar_components(docs.select(F.xxhash64("text").alias("node"), "text"), scratch, size, similarity)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"))
    return rows.join(parts.withColumnRenamed("node", "text_hash"), "text_hash", "left").withColumn("component", F.coalesce("component", "text_hash"))
