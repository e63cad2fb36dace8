"""Near duplicates by SimHash with meet-in-the-middle ball hashing.

Fingerprints link at ``RADIUS`` = 3 or fewer differing bits. Half of an odd radius is no whole number, so the
64 bits are cut into ``BLOCKS`` blocks and every fingerprint is looked at with each block left out in turn: of up to three differing bits at
least one lies in some block, without which at most two differ. Then both fingerprints reach a common value by
changing at most one bit each. So each distinct fingerprint emits, for each block left out, all values within one bit of what is left
(4 x 49 values), and values are what moves. In the bucket of a value only verified pairs are joined, and only as many as
keep the bucket's parts connected, found through the left-out block's values (16 bits, so at most 65,536).

Defined cases: a null or empty text has fingerprint zero and links like any other; fewer than three words are one shingle; rows with
equal doc_id are linked by their fingerprints like others; a null doc_id is never a component's smallest unless all are null; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.common import BLOB_SCHEMA, Scratch, blob_batches, buckets_in_order, mixed, read_blobs
from tokenloom.llm.components import connected_components

RADIUS = 3
BLOCKS = 4
SHINGLE = 3
#: Emitted values that a bucket is meant to hold.
BUCKET_VALUES = 1 << 20

_WIDTH = 64 // BLOCKS
_REST = 64 - _WIDTH
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def shingle_hashes(text: str | None, size: int = SHINGLE) -> list[int]:
    """XXH64 (seed 42) of every shingle of the lower-cased (A-Z) words; none for a text without words."""
    tokens = (text or "").encode().translate(_LOWER).split()
    if not tokens:
        return []
    hashed = xxhash.xxh64_intdigest
    if len(tokens) < size:
        return [hashed(b" ".join(tokens), 42)]
    line = b" ".join(tokens)
    ends = np.cumsum([len(t) + 1 for t in tokens])
    starts = (ends - [len(t) + 1 for t in tokens])[: len(tokens) - size + 1]
    return [hashed(line[a:b], 42) for a, b in zip(starts.tolist(), (ends[size - 1 :] - 1).tolist(), strict=True)]


def majority(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A fingerprint for each run of ``counts`` hashes: bits set in over half of them; zero for an empty run."""
    found = np.zeros(len(counts), np.uint64)
    full = np.flatnonzero(counts)
    if not len(full):
        return found
    starts = (np.cumsum(counts) - counts)[full]
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    ones = np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
    over = 2 * ones > counts[full][:, None]
    found[full] = np.packbits(over, axis=1, bitorder="little").view("<u8").reshape(-1)
    return found


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, fp) of ``docs`` (doc_id, text); fp holds the 64 bits as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes: list[int] = []
            counts: list[int] = []
            prints = []
            for text in batch.column(2):
                found = shingle_hashes(text.as_py())
                hashes += found
                counts.append(len(found))
                if len(hashes) >= 1 << 17:
                    prints.append(majority(np.array(hashes, np.uint64), np.array(counts)))
                    hashes, counts = [], []
            prints.append(majority(np.array(hashes, np.uint64), np.array(counts, np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.concatenate(prints).view(np.int64))], names=["doc_id", "text_hash", "fp"])

    return docs.select(F.col("doc_id").cast("long"), F.xxhash64("text"), "text").mapInArrow(run, "doc_id long, text_hash long, fp long")


def without_block(fp: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """What is left of fingerprints without a block, and the block."""
    low = np.uint64(block * _WIDTH)
    out = (fp >> low) & np.uint64((1 << _WIDTH) - 1)
    below = fp & np.uint64((1 << (block * _WIDTH)) - 1)
    above = (fp >> low) >> np.uint64(_WIDTH)
    return below | (above << low), out


_FLIPS = np.r_[np.uint64(0), np.uint64(1) << np.arange(_REST, dtype=np.uint64)]


def _emit(buckets: int):
    """Every fingerprint's ball of radius one around each of its parts, by value.

    A record is the fingerprint and the number of the value among its own (block left out, then changed bit), from which
    the receiver works out the value.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = np.asarray(batch.column(0)).view(np.uint64)
            for lo in range(0, len(every), 1 << 14):
                fp = every[lo : lo + (1 << 14)]
                number = np.repeat(np.arange(BLOCKS * len(_FLIPS), dtype=np.uint8), len(fp))
                owner = np.tile(fp, BLOCKS * len(_FLIPS))
                bucket = mixed(values(owner, number)) % np.uint64(buckets)
                yield from blob_batches(bucket.astype(np.int32), [owner, number])

    return run


def values(fp: np.ndarray, number: np.ndarray) -> np.ndarray:
    """The values of the given numbers: what is left of fp, one bit changed or none, below the block's number."""
    block, bit = np.divmod(number, np.uint8(len(_FLIPS)))
    low = block.astype(np.uint64) * np.uint64(_WIDTH)
    below = fp & ((np.uint64(1) << low) - np.uint64(1))
    rest = below | (((fp >> low) >> np.uint64(_WIDTH)) << low)
    return (rest ^ _FLIPS[bit]) | (block.astype(np.uint64) << np.uint64(_REST))


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).astype(np.uint8)


def _bucket_links(fp: np.ndarray, bit: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """Verified links that connect what one value's members connect.

    Members with the same block differ in two bits at most: each is linked to the first. Two blocks that differ in one bit: all
    their members link. In two bits: a member that is the value itself (nothing changed) links to the other block's
    members. In three: only such members of both.
    """
    _, outs = without_block(fp, block)
    order = np.lexsort((bit, outs))  # unchanged members come first in their block
    fp, bit, outs = fp[order], bit[order], outs[order]
    head = np.flatnonzero(np.r_[True, outs[1:] != outs[:-1]])
    first = fp[head]
    left, right = [np.repeat(first, np.diff(np.r_[head, len(fp)]))], [fp]
    values, exact = outs[head].astype(np.int64), bit[head] == 0
    if len(values) > 1:
        where = np.full(1 << _WIDTH, -1)
        where[values] = np.arange(len(values))
        root = np.arange(len(values))
        if len(values) <= 700:  # pairs of block values, or look up all changes of up to three bits
            i, j = np.triu_indices(len(values), 1)
            apart = _popcount(values[i] ^ values[j])
            good = (apart == 1) | ((apart == 2) & (exact[i] | exact[j])) | ((apart == 3) & exact[i] & exact[j])
            i, j = i[good], j[good]
            left.append(first[i])
            right.append(first[j])
            left, right = [np.concatenate(left)], [np.concatenate(right)]
        else:
            changes = np.arange(1, 1 << _WIDTH)
            apart = _popcount(changes)
            for change, d in zip(changes[apart <= RADIUS].tolist(), apart[apart <= RADIUS].tolist(), strict=True):
                i = np.arange(len(values))
                j = where[values ^ change]
                ok = (j > i) & (root[i] != root[j])
                ok &= (d == 1) | ((d == 2) & (exact | exact[j])) | ((d == 3) & exact & exact[j])
                left.append(first[i[ok]])
                right.append(first[j[ok]])
                for a, b in zip(i[ok].tolist(), j[ok].tolist(), strict=True):
                    ra, rb = root[a], root[b]
                    if ra != rb:
                        root[root == max(ra, rb)] = min(ra, rb)
    a, b = np.concatenate(left), np.concatenate(right)
    keep = a != b
    return a[keep], b[keep]


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, blobs in buckets_in_order(batches):
        fp, number = read_blobs(blobs, ["<u8", "u1"])
        value, bit = values(fp, number), number % np.uint8(len(_FLIPS))
        order = np.argsort(value, kind="stable")
        value, fp, bit = value[order], fp[order], bit[order]
        same = value[1:] == value[:-1]
        met = np.r_[False, same] | np.r_[same, False]
        value, fp, bit = value[met], fp[met], bit[met]
        if not len(value):
            continue
        head = np.flatnonzero(np.r_[True, value[1:] != value[:-1]])
        ends = np.r_[head[1:], len(value)]
        pairs = ends - head == 2
        i = head[pairs]
        found = [(fp[i], fp[i + 1])]
        for lo, hi in zip(head[~pairs].tolist(), ends[~pairs].tolist(), strict=True):
            found.append(_bucket_links(fp[lo:hi], bit[lo:hi], int(value[lo] >> np.uint64(_REST))))
        a, b = (np.concatenate(x) for x in zip(*found, strict=True))
        a, b = np.minimum(a.view(np.int64), b.view(np.int64)), np.maximum(a.view(np.int64), b.view(np.int64))
        good = (a != b) & (_popcount((a ^ b).view(np.uint64)) <= RADIUS)
        edges = np.unique(np.stack([a[good], b[good]], axis=1), axis=0)
        if len(edges):
            yield pa.RecordBatch.from_arrays([pa.array(edges[:, 0].copy()), pa.array(edges[:, 1].copy())], names=["a", "b"])


def near_links(distinct: DataFrame, count: int) -> DataFrame:
    """Verified links (a, b) among ``count`` distinct fingerprints (column fp), enough to connect all that link."""
    buckets = max(1, -(-count * BLOCKS * (1 + _REST) // BUCKET_VALUES))
    return (
        distinct.select("fp").mapInArrow(_emit(buckets), BLOB_SCHEMA)
        .repartition("bucket").sortWithinPartitions("bucket")
        .mapInArrow(_links, "a long, b long").distinct()
    )


def near_groups(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """A row for each document: doc_id, text_hash, fp, component (a fingerprint), component_id (the smallest doc_id that links reach)."""
    prints = scratch.keep(fingerprints(docs), "prints")
    distinct = scratch.keep(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct")
    links = scratch.keep(near_links(distinct, distinct.count()), "links")
    parts = connected_components(links, scratch).withColumnRenamed("node", "fp")
    labelled = distinct.join(parts, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    least = labelled.groupBy("component").agg(F.min("first_id").alias("component_id"))
    # one row per fingerprint on the right: a fingerprint with very many documents can be split
    classes = scratch.keep(labelled.join(least, "component").select("fp", "component", "component_id"), "classes")
    return prints.join(classes, "fp").select("doc_id", "text_hash", "fp", "component", "component_id")


def hex_print(fp) -> F.Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
