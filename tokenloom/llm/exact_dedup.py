"""Exact duplicates through a cuckoo-filter index of content digests.

The index is a table with a row for each bucket of the digest space: a cuckoo filter (16-bit marks, four to a slot) and the keys it
stands for, with the number of live texts of each key and the one that stays. A batch of documents is reduced to one row per
digest and task before it moves to its bucket. There a filter miss proves a new digest; a hit is verified against the
bucket's stored digests. A filter that can't place a mark is built anew, twice as large, from the stored keys.

Defined cases: null text equals empty text; rows with equal doc_id count as separate members; a null doc_id never
stays unless all of its group are null; an empty table gives an empty index; other columns are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.common import SPACES, Scratch, mixed

SLOTS = 4
KICKS = 200
#: Digests that a bucket of the index is meant to hold.
BUCKET_KEYS = 1 << 16

INDEX_SCHEMA = "bucket int, filter binary, digests binary, counts binary, chars binary, keepers binary"
_NO_ID = np.iinfo(np.int64).max


class CuckooFilter:
    """Marks of live keys: insertion, lookup and deletion of many keys at once. Keys are 64-bit hashes, with repetition."""

    def __init__(self, slots: int, table: np.ndarray | None = None):
        self.size = 1 << max(2, int(slots - 1).bit_length())
        self.table = np.zeros((self.size, SLOTS), np.uint16) if table is None else table
        self.random = np.random.default_rng(self.size)

    @classmethod
    def of(cls, keys: np.ndarray) -> CuckooFilter:
        """A filter that holds all ``keys``, as large as it takes."""
        slots = max(4, len(keys) * 5 // (4 * SLOTS))
        while True:
            made = cls(slots)
            if made.insert(keys):
                return made
            slots = 2 * made.size

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        mark = ((keys >> np.uint64(48)) % np.uint64(65535) + np.uint64(1)).astype(np.uint16)
        first = (keys & np.uint64(self.size - 1)).astype(np.int64)
        return mark, first, self._other(mark, first)

    def _other(self, mark: np.ndarray, place: np.ndarray) -> np.ndarray:
        return place ^ (mixed(mark.astype(np.uint64)) & np.uint64(self.size - 1)).astype(np.int64)

    def contains(self, keys: np.ndarray) -> np.ndarray:
        mark, first, second = self._places(keys)
        return ((self.table[first] == mark[:, None]) | (self.table[second] == mark[:, None])).any(axis=1)

    def insert(self, keys: np.ndarray) -> bool:
        """False on overflow; the filter is then to be built anew from the stored keys."""
        mark, place, second = self._places(keys)
        mark, place, second = self._fill(mark, place, second)
        for _ in range(KICKS):
            mark, place, second = self._fill(mark, second, place)
            if not len(mark):
                return True
            # one waiting mark for each full slot row throws out a random mark, which goes to its other place
            _, chosen = np.unique(place, return_index=True)
            column = self.random.integers(0, SLOTS, len(chosen))
            thrown = self.table[place[chosen], column].copy()
            self.table[place[chosen], column] = mark[chosen]
            mark[chosen] = thrown
            second = second.copy()
            second[chosen] = self._other(thrown, place[chosen])
        return False

    def _fill(self, mark: np.ndarray, place: np.ndarray, second: np.ndarray):
        """Put marks where ``place`` has room; returns those left."""
        order = np.argsort(place, kind="stable")
        mark, place, second = mark[order], place[order], second[order]
        begin = np.r_[True, place[1:] != place[:-1]] if len(place) else np.empty(0, bool)
        rank = np.arange(len(place)) - np.maximum.accumulate(np.where(begin, np.arange(len(place)), 0))
        free = self.table[place] == 0
        fits = rank < free.sum(axis=1)
        nth = np.cumsum(free, axis=1) - 1
        column = np.argmax(free & (nth == rank[:, None]), axis=1)
        self.table[place[fits], column[fits]] = mark[fits]
        return mark[~fits], place[~fits], second[~fits]

    def delete(self, keys: np.ndarray) -> None:
        """Take out keys that are in the filter, each once."""
        for k in range(len(keys)):  # equal marks may share a row, so one after the other
            mark, first, second = self._places(keys[k : k + 1])
            for place in (int(first[0]), int(second[0])):
                found = np.flatnonzero(self.table[place] == mark[0])
                if len(found):
                    self.table[place, found[0]] = 0
                    break


class Bucket:
    """One row of the index: the filter and what it stands for, ordered by digest for verification."""

    def __init__(self, row: dict | None = None):
        get = lambda name, kind: np.frombuffer(row[name], kind).copy() if row else np.empty(0, kind)
        self.digests, self.counts = get("digests", "V32"), get("counts", np.int64)
        self.chars, self.keepers = get("chars", np.int64), get("keepers", np.int64)
        self.stored: dict[bytes, int] | None = None  # where each digest is, once a hit asks for it
        self.filter = CuckooFilter.of(np.empty(0, np.uint64))
        if row:
            table = np.frombuffer(row["filter"], np.uint16).reshape(-1, SLOTS).copy()
            self.filter = CuckooFilter(len(table), table)

    @staticmethod
    def keys(digests: np.ndarray) -> np.ndarray:
        """64 bits of a digest other than those that choose the bucket."""
        return np.ascontiguousarray(digests).view("<u8").reshape(-1, 4)[:, 1].copy()

    def _find(self, digests: np.ndarray) -> np.ndarray:
        """Where the digests are stored, -1 where they are not: hits of the filter, verified."""
        found = np.full(len(digests), -1)
        hit = np.flatnonzero(self.filter.contains(self.keys(digests)))
        if len(hit):
            if self.stored is None:
                self.stored = {d.tobytes(): k for k, d in enumerate(self.digests)}
            found[hit] = [self.stored.get(d.tobytes(), -1) for d in digests[hit]]
        return found

    def insert(self, digests: np.ndarray, counts: np.ndarray, chars: np.ndarray, keepers: np.ndarray) -> None:
        """Add live texts: distinct digests with their number of texts, and the longest one's length and doc_id."""
        at = self._find(digests)
        old, new = at >= 0, at < 0
        spot = at[old]
        self.counts[spot] += counts[old]
        better = (chars[old] > self.chars[spot]) | ((chars[old] == self.chars[spot]) & (keepers[old] < self.keepers[spot]))
        self.chars[spot[better]], self.keepers[spot[better]] = chars[old][better], keepers[old][better]
        if self.stored is not None:
            self.stored.update((d.tobytes(), len(self.digests) + k) for k, d in enumerate(digests[new]))
        self.digests = np.concatenate([self.digests, digests[new]])
        self.counts, self.chars = np.r_[self.counts, counts[new]], np.r_[self.chars, chars[new]]
        self.keepers = np.r_[self.keepers, keepers[new]]
        if not self.filter.insert(self.keys(digests[new])):
            self.filter = CuckooFilter.of(self.keys(self.digests))

    def delete(self, digests: np.ndarray, counts: np.ndarray) -> None:
        """Take texts away. A digest without live texts leaves the filter and the store.

        Which text stays is chosen on insertion; if that very text was taken away, choose anew with ``exact_groups``.
        """
        at = self._find(digests)
        self.counts[at[at >= 0]] -= counts[at >= 0]
        dead = self.counts <= 0
        self.filter.delete(self.keys(self.digests[dead]))
        for name in ("digests", "chars", "keepers", "counts"):
            setattr(self, name, getattr(self, name)[~dead])
        self.stored = None

    def row(self) -> dict:
        return {
            "filter": self.filter.table.tobytes(), "digests": self.digests.tobytes(), "counts": self.counts.tobytes(),
            "chars": self.chars.tobytes(), "keepers": self.keepers.tobytes(),
        }


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, hash of the text, digest of the text without white space, and code points of the original text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("text").alias("text_hash"),
        F.unhex(F.sha2(F.translate(text, SPACES, ""), 256)).alias("digest"),
        F.char_length(text).cast("long").alias("chars"),
    )


def _combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each digest of a batch of (digest, chars, doc_id): how many, and the one that stays."""
    for batch in batches:
        t = pa.Table.from_batches([batch]).sort_by([("digest", "ascending"), ("chars", "descending"), ("doc_id", "ascending")])
        t = t.group_by("digest", use_threads=False).aggregate([("chars", "count"), ("chars", "first"), ("doc_id", "first")])
        yield from t.select(["digest", "chars_count", "chars_first", "doc_id_first"]).rename_columns(["digest", "n", "chars", "doc_id"]).to_batches()


def _packed(rows: DataFrame, buckets: int) -> DataFrame:
    """(bucket, digest, n, chars, doc_id) with one row per digest and task."""
    known = rows.select("digest", "chars", F.coalesce("doc_id", F.lit(int(_NO_ID))).alias("doc_id"))
    bucket = F.pmod(F.xxhash64(F.substring("digest", 1, 8)), F.lit(buckets)).cast("int")
    return known.mapInArrow(_combined, "digest binary, n long, chars long, doc_id long").withColumn("bucket", bucket)


def _arrays(rows: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """Distinct digests of a batch, with summed counts and the text that stays."""
    digest = np.frombuffer(b"".join(rows.column("digest").to_pylist()), "V32")
    n, chars, ids = (np.asarray(rows.column(c)) for c in ("n", "chars", "doc_id"))
    order = np.lexsort((ids, -chars, *np.ascontiguousarray(digest).view(">u8").reshape(-1, 4).T[::-1]))
    digest, n, chars, ids = digest[order], n[order], chars[order], ids[order]
    raw = np.ascontiguousarray(digest).view("<u8").reshape(-1, 4)
    begin = np.flatnonzero(np.r_[True, (raw[1:] != raw[:-1]).any(axis=1)])
    return digest[begin], np.add.reduceat(n, begin), chars[begin], ids[begin]


def _index_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Index rows from rows sorted by bucket; the live texts of a bucket arrive batch after batch."""
    names = [c.split()[0] for c in INDEX_SCHEMA.split(", ")]
    now, bucket = None, Bucket()

    def out() -> pa.RecordBatch:
        row = {"bucket": now, **bucket.row()}
        return pa.RecordBatch.from_arrays([pa.array([row[c]], pa.int32() if c == "bucket" else pa.binary()) for c in names], names=names)

    for batch in batches:
        ids = np.asarray(batch.column("bucket"))
        cuts = np.r_[0, np.flatnonzero(np.diff(ids)) + 1, len(ids)]
        for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            if lo == hi:
                continue
            if now is not None and ids[lo] != now:
                yield out()
                bucket = Bucket()
            now = int(ids[lo])
            bucket.insert(*_arrays(batch.slice(lo, hi - lo)))
    if now is not None:
        yield out()


def build_index(rows: DataFrame, buckets: int) -> DataFrame:
    """The index of live texts ``rows`` (digest, chars, doc_id)."""
    return (
        _packed(rows, buckets)
        .repartition(F.col("bucket"))
        .sortWithinPartitions("bucket")
        .mapInArrow(_index_rows, INDEX_SCHEMA)
    )


def update_index(index: DataFrame, buckets: int, added: DataFrame | None = None, removed: DataFrame | None = None) -> DataFrame:
    """The index after texts were added and removed (each: digest, chars, doc_id). Untouched buckets pass through."""
    spark = index.sparkSession
    none = spark.createDataFrame([], "digest binary, n long, chars long, doc_id long, bucket int")
    change = (_packed(added, buckets) if added is not None else none).withColumn("gone", F.lit(False)).unionByName(
        (_packed(removed, buckets) if removed is not None else none).withColumn("gone", F.lit(True))
    )

    def merge(key, old: pa.Table, new: pa.Table) -> pa.Table:
        bucket = Bucket(old.to_pylist()[0] if old.num_rows else None)
        gone = np.asarray(new.column("gone")) if new.num_rows else np.empty(0, bool)
        for flag in (False, True):
            part = new.filter(pa.array(gone == flag))
            if part.num_rows:
                found = _arrays(part.combine_chunks().to_batches()[0])
                bucket.delete(*found[:2]) if flag else bucket.insert(*found)
        row = {"bucket": key[0].as_py(), **bucket.row()}
        return pa.table({c: pa.array([v], pa.int32() if c == "bucket" else pa.binary()) for c, v in row.items()})

    return index.groupBy("bucket").cogroup(change.groupBy("bucket")).applyInArrow(merge, INDEX_SCHEMA)


def index_groups(index: DataFrame) -> DataFrame:
    """A row for each live digest of an index: digest, group_size, keep_id."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                b = Bucket(row)
                raw = pa.py_buffer(b.digests.tobytes())
                digest = pa.Array.from_buffers(pa.binary(), len(b.digests), [None, pa.py_buffer(np.arange(len(b.digests) + 1, dtype=np.int32) * 32), raw])
                keep = pa.array(b.keepers, pa.int64(), mask=b.keepers == _NO_ID)
                yield pa.RecordBatch.from_arrays([digest, pa.array(b.counts), keep], names=["digest", "group_size", "keep_id"])

    return index.mapInArrow(read, "digest binary, group_size long, keep_id long")


def buckets_for(rows: int) -> int:
    return max(1, -(-rows // BUCKET_KEYS))


def exact_groups(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """A row for each document: doc_id, text_hash, keep_id, group_size, kept, text_sha256, chars.

    Rows that repeat the doc_id that stays are all marked kept: the mark goes by doc_id.
    """
    rows = scratch.keep(digests(docs), "digests")
    index = build_index(rows, buckets_for(rows.count()))
    # the side with one row per digest is on the right, so a digest with very many documents can be split
    joined = rows.join(index_groups(index), "digest", "left")
    return joined.select(
        "doc_id", "text_hash", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"), "chars",
    )
