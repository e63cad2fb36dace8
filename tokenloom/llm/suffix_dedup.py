"""Removal of repeated byte strings: what an earlier document also holds, found by sorting sampled suffixes.

A byte goes if a ``SPAN``-byte string over it also starts in a document with a smaller doc_id. The work follows induced sorting:

* Suffixes are classified by the order of their first ``GRAM`` bytes (hashed): the leftmost smallest of every window is sampled, so
  each ``SPAN``-byte string holds a sample, and equal strings hold equal ones. About one suffix in 18 is sampled.
* Samples are sorted in shards by their name, the gram, and by the context that their strings span. The order of all other
  suffixes is induced from them: a run of strings that share a sample equals another run if the contexts are equal, so
  one comparison decides all its strings.
* Where contexts with one name differ, common prefixes decide: they can share a string only if 17 bytes before or after the
  gram agree. Only those runs are read again, and their strings are sorted one by one.

Every task reduces equal contexts to the smallest doc_id before anything moves, so a passage that very many documents share is one
record per task. Equality is decided by hashes of at least 72 bits beside those that choose the shard.

Defined cases: null text is empty; strings never cross documents; documents with equal doc_id don't count as earlier than each other;
a null doc_id is neither earlier nor later than any document, so its text stays whole; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.common import BLOB_SCHEMA, blob_batches, buckets_in_order, mixed, partitions, read_blobs

SPAN = 50
GRAM = 16
#: Bytes of text in a part of the documents and in a shard of samples.
PART_BYTES = 16 << 20
CHUNK = 1 << 18
FLUSH = 1 << 19
#: Places that are compared at once; with a window they stay below 2^20.
STRETCH = 1 << 19

_WINDOW = SPAN - GRAM + 1
_SIDE = (SPAN - GRAM) // 2
_LOW = np.uint64((1 << 20) - 1)
_BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_STEP = mixed(np.arange(1, 9, dtype=np.uint64)) | np.uint64(1)

#: Records on their way: samples, requests to look closer, single strings, and ranges to remove.
#: What decides equality comes first: for samples 24 bits of name with 40 of context, then 8 of context with 12 of each side.
SAMPLE = ["<u8", "<u4", "<i4", "<i8", "<u4", "<u4", "u1", "u1"]  # key, rest, part, doc, row, start, strings, last string to gram
STRING = ["<u8", "u1", "<i4", "<i8", "<u4", "<u4", "u1"]  # key, rest, part, doc, row, start, 1
RANGE = ["<i8", "<u4", "<u4", "<u4"]  # doc, row, start, bytes or strings
_ROWS = "part int, kind int, blob binary"


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and where each begins (one more entry than texts)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    wide = np.int64 if pa.types.is_large_string(column.type) else np.int32
    at = np.frombuffer(offsets, wide)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.empty(0, np.uint8)
    return raw, at - at[0]


def _join(x: np.ndarray, y: np.ndarray, k: int) -> np.ndarray:
    """The hash of a string from those of its parts."""
    z = x * _STEP[k] + y
    return z ^ (z >> np.uint64(32))


class Grams:
    """Hashes of the substrings of a run of bytes, by doubling."""

    def __init__(self, raw: np.ndarray):
        one = _BYTE[np.concatenate([raw, np.zeros(SPAN, np.uint8)])]
        self.two = _join(one[:-1], one[1:], 0)
        four = _join(self.two[:-2], self.two[2:], 1)
        eight = _join(four[:-4], four[4:], 2)
        self.gram = _join(eight[:-8], eight[8:], 3)
        self.one = one

    def span(self, at: np.ndarray) -> np.ndarray:
        """Hashes of the ``SPAN``-byte strings that start at ``at``."""
        g = self.gram
        return mixed(_join(_join(_join(g[at], g[at + 16], 4), g[at + 32], 5), self.two[at + 48], 6))

    def side(self, at: np.ndarray) -> np.ndarray:
        """12 bits of the ``_SIDE`` bytes that start at ``at``, never 0."""
        return (mixed(_join(self.gram[at], self.one[at + GRAM], 7)) % np.uint64(4095) + np.uint64(1)).astype(np.uint32)


def least_places(gram: np.ndarray) -> np.ndarray:
    """For each place of all but the last 34 the leftmost least gram of the 35 that begin there, in stretches whose places fit the low bits."""
    found = np.empty(max(0, len(gram) - _WINDOW + 1), np.int64)
    for lo in range(0, len(found), STRETCH):
        count = min(STRETCH, len(found) - lo)
        least = mixed(gram[lo : lo + count + _WINDOW - 1]) & ~_LOW | np.arange(count + _WINDOW - 1, dtype=np.uint64)
        for step in (1, 2, 4, 8, 16):
            least = np.minimum(least[:-step], least[step:])
        least = np.minimum(least[: 32 - _WINDOW], least[_WINDOW - 32 :])
        found[lo : lo + count] = lo + (least & _LOW).astype(np.int64)
    return found


def sample_runs(raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of strings that share a sampled suffix, in documents that end at ``ends``.

    Gives first start, number of strings, name, context, hashes of the bytes before and after the gram (0: no string has
    them), and how far the gram is from the last start.
    """
    n = len(raw)
    none = (np.empty(0, np.int64),) * 2 + (np.empty(0, np.uint64),) * 2 + (np.empty(0, np.uint32),) * 2 + (np.empty(0, np.int64),)
    if n < SPAN:
        return none
    grams = Grams(raw)
    samples = least_places(grams.gram[:n])[: n - SPAN + 1]
    begins = np.r_[0, ends[:-1]]
    whole = ends - begins >= SPAN
    counts = (ends - begins - SPAN + 1)[whole]
    if not len(counts):
        return none
    valid = np.repeat(begins[whole] - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))
    sample = samples[valid]
    head = np.flatnonzero(np.r_[True, (valid[1:] != valid[:-1] + 1) | (sample[1:] != sample[:-1])])
    first, last = valid[head], valid[np.r_[head[1:], len(valid)] - 1]
    gram = sample[head]
    name = mixed(grams.gram[gram])
    count = last - first + 1
    context = mixed(_join(_join(grams.span(first), grams.span(last), 0), count.astype(np.uint64), 1))
    left, right = gram - first >= _SIDE, gram - last <= _SIDE
    before, after = np.zeros(len(head), np.uint32), np.zeros(len(head), np.uint32)
    before[left] = grams.side(gram[left] - _SIDE)
    after[right] = grams.side(gram[right] + GRAM)
    return first, count, name, context, before, after, gram - last


def chunks(raw: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, int]]:
    """Documents from, to (excluded), so that they hold about ``CHUNK`` bytes."""
    lo = 0
    while lo < len(at) - 1:
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + CHUNK, side="right")) - 1)
        yield lo, hi
        lo = hi


def merged(doc: np.ndarray, row: np.ndarray, start: np.ndarray, size: np.ndarray) -> list[np.ndarray]:
    """Ranges of each document, sorted, with those that overlap or touch made one."""
    order = np.lexsort((start, row, doc))
    doc, row, start, end = doc[order], row[order], start[order].astype(np.int64), (start.astype(np.int64) + size)[order]
    fresh = np.r_[True, (doc[1:] != doc[:-1]) | (row[1:] != row[:-1])] if len(doc) else np.empty(0, bool)
    # running maximum of the ends within a document: documents are lifted so that they can't reach each other
    group = np.cumsum(fresh)
    lift = group * (int(end.max()) + 1 if len(end) else 1)
    reach = np.maximum.accumulate(end + lift) if len(end) else end
    head = np.flatnonzero(fresh | np.r_[True, (start + lift)[1:] > reach[:-1]] if len(doc) else fresh)
    until = (reach - lift)[np.r_[head[1:], len(doc)] - 1] if len(head) else end
    return [doc[head], row[head], start[head].astype(np.uint32), (until - start[head]).astype(np.uint32)]


def _ranges(part, doc, row, start, strings) -> Iterator[pa.RecordBatch]:
    """Ranges to remove, as blobs for their parts (buckets below zero)."""
    for p in np.unique(part):
        mine = part == p
        found = merged(doc[mine], row[mine], start[mine], strings[mine].astype(np.int64) + SPAN - 1)
        yield from blob_batches(np.full(len(found[0]), -1 - p, np.int32), found)


def _least(columns: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Records sorted by (key, rest, doc), the heads of equal (key, rest), and which records have a larger doc."""
    order = np.lexsort((columns[3], columns[1], columns[0]))
    columns = [c[order] for c in columns]
    key, rest, doc = columns[0], columns[1], columns[3]
    fresh = np.r_[True, (key[1:] != key[:-1]) | (rest[1:] != rest[:-1])] if len(key) else np.empty(0, bool)
    head = np.flatnonzero(fresh)
    later = doc > np.repeat(doc[head], np.diff(np.r_[head, len(doc)]))
    return columns, head, later


def _send(hashes: np.ndarray, columns: list[np.ndarray], shards: int) -> Iterator[pa.RecordBatch]:
    """Records to the shards of their hashes, without those that this task already knows to repeat an earlier document."""
    shard = ((hashes >> np.uint64(32)) % np.uint64(shards)).astype(np.int32)
    order = np.arange(len(shard))
    columns, _, later = _least([*columns, shard, order])
    *columns, shard, order = columns
    if later.any():
        yield from _ranges(*(c[later] for c in columns[2:7]))
    kept = np.flatnonzero(~later)
    kept = kept[np.argsort(order[kept], kind="stable")]  # as they were read: documents side by side pack better
    yield from blob_batches(shard[kept], [c[kept] for c in columns])


def _sample(shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        size, last, row = 0, None, 0

        def flush() -> Iterator[pa.RecordBatch]:
            name, *columns = (np.concatenate(c) for c in zip(*held, strict=True))
            yield from _send(name, columns, shards)

        for batch in batches:
            raw, at = text_bytes(batch.column(2))
            rows = np.zeros(batch.num_rows, np.uint32)
            for k, doc in enumerate(batch.column(1).to_pylist()):
                row = row + 1 if doc == last else 0
                rows[k], last = row, doc
            known = np.asarray(batch.column(1).is_valid())
            docs, parts = np.asarray(batch.column(1).fill_null(0)), np.asarray(batch.column(0))
            for lo, hi in chunks(raw, at):
                first, count, name, context, before, after, gap = sample_runs(raw[at[lo] : at[hi]], at[lo + 1 : hi + 1] - at[lo])
                k = lo + np.searchsorted(at[lo + 1 : hi + 1] - at[lo], first, side="right")
                ok = known[k]
                start = (first + at[lo] - at[k]).astype(np.uint32)
                key = (name << np.uint64(40)) | (context >> np.uint64(24))
                rest = ((context & np.uint64(0xFF)).astype(np.uint32) << np.uint32(24)) | (before << np.uint32(12)) | after
                found = (name, key, rest, parts[k].astype(np.int32), docs[k], rows[k], start, count.astype(np.uint8), gap.astype(np.uint8))
                held.append(tuple(c[ok] for c in found))
                size += int(ok.sum())
                if size >= FLUSH:
                    yield from flush()
                    held, size = [], 0
        if held:
            yield from flush()

    return run


def _rows(part: np.ndarray, kind: int, columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    for batch in blob_batches(part, columns):
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([kind] * batch.num_rows, pa.int32()), batch.column(1)], names=["part", "kind", "blob"])


def _alike(name: np.ndarray, side: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Contexts whose name and side (not 0) a context of another first document has too."""
    key = (name.astype(np.uint64) << np.uint64(16)) | side
    order = np.argsort(key, kind="stable")
    head = np.flatnonzero(np.r_[True, key[order][1:] != key[order][:-1]])
    least, most = np.minimum.reduceat(doc[order], head), np.maximum.reduceat(doc[order], head)
    found = np.empty(len(key), bool)
    found[order] = np.repeat(least < most, np.diff(np.r_[head, len(key)]))
    return found & (side != 0)


def _unsure(columns: list[np.ndarray], head: np.ndarray, later: np.ndarray) -> tuple[np.ndarray, int, list[np.ndarray]]:
    """Strings that an unlike context of the same name in another document may hold: those with the bytes before or
    after that both share.

    A string has at least ``_SIDE`` bytes before its gram, or that many after it, or both.
    """
    key, rest, part, doc, row, start, strings, gap = columns
    name = (key >> np.uint64(40))[head]
    before = _alike(name, (rest >> np.uint32(12))[head] & np.uint32(0xFFF), doc[head])
    after = _alike(name, rest[head] & np.uint32(0xFFF), doc[head])
    size = np.diff(np.r_[head, len(doc)])
    before, after = np.repeat(before, size) & ~later, np.repeat(after, size) & ~later
    first, last = start.astype(np.int64), start.astype(np.int64) + strings - 1
    middle = last + gap - _SIDE  # up to here strings hold the bytes before, from here on those after
    lo = np.where(before, first, np.maximum(first, middle))
    hi = np.where(after, last, np.minimum(last, middle))
    some = (before | after) & (lo <= hi)
    return part[some], 1, [doc[some], row[some], lo[some].astype(np.uint32), (hi - lo + 1)[some].astype(np.uint32)]


def _compare(kinds: list[str]):
    """Shards: ranges to remove (kind 0) and runs to look at string by string (kind 1), for their parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, blobs in buckets_in_order(batches):
            if shard < 0:
                names, n = ["part", "kind", "blob"], len(blobs)
                yield pa.RecordBatch.from_arrays([pa.array([-1 - shard] * n, pa.int32()), pa.array([0] * n, pa.int32()), pa.array(blobs, pa.binary())], names=names)
                continue
            columns, head, later = _least(read_blobs(blobs, kinds))
            part, doc, row, start, strings = columns[2:7]
            if later.any():
                for batch in _ranges(part[later], doc[later], row[later], start[later], strings[later]):
                    parts = pa.array([-1 - p for p in batch.column(0).to_pylist()], pa.int32())
                    yield pa.RecordBatch.from_arrays([parts, pa.array([0] * batch.num_rows, pa.int32()), batch.column(1)], names=["part", "kind", "blob"])
            if len(columns) > 7:
                yield from _rows(*_unsure(columns, head, later))

    return run


class _Part:
    """The documents of a part: bytes, and where a (doc, row) is."""

    def __init__(self, table: pa.Table):
        self.ids = table.column("doc_id").to_pylist()
        self.raw, self.at = text_bytes(table.column("text"))
        order = sorted(range(len(self.ids)), key=lambda k: (self.ids[k] is not None, self.ids[k] or 0))
        self.place, k = {}, 0
        while k < len(order):
            same = [order[k]]
            while k + len(same) < len(order) and self.ids[order[k + len(same)]] == self.ids[order[k]]:
                same.append(order[k + len(same)])
            if len(same) > 1:
                same.sort(key=lambda i: self.raw[self.at[i] : self.at[i + 1]].tobytes())
            if self.ids[order[k]] is not None:
                self.place |= {(self.ids[i], r): i for r, i in enumerate(same)}
            k += len(same)

    def found(self, doc: np.ndarray, row: np.ndarray) -> np.ndarray:
        return np.fromiter((self.place[d, r] for d, r in zip(doc.tolist(), row.tolist(), strict=True)), np.int64, len(doc))


def _blobs(table: pa.Table, kind: int) -> list[bytes]:
    return [b for k, b in zip(table.column("kind").to_pylist(), table.column("blob").to_pylist(), strict=True) if k == kind]


def _look_closer(shards: int):
    """The strings of unsure runs, each hashed on its own; ranges found before pass through."""

    def run(key, texts: pa.Table, found: pa.Table) -> pa.Table:
        out: list[pa.RecordBatch] = []
        part = key[0].as_py()
        ranges = read_blobs(_blobs(found, 0), RANGE) if found.num_rows else []
        if ranges and len(ranges[0]):
            joined = merged(*ranges)
            out += blob_batches(np.full(len(joined[0]), -1 - part, np.int32), joined)
        doc, row, start, strings = read_blobs(_blobs(found, 1), RANGE) if found.num_rows else [np.empty(0, np.int64)] * 4
        if len(doc):
            here = _Part(texts)
            for lo in range(0, len(doc), 1 << 13):
                d, r, s, g = (c[lo : lo + (1 << 13)] for c in (doc, row, start, strings))
                s, g = s.astype(np.int64), g.astype(np.int64)
                size = g + SPAN - 1
                ends = np.cumsum(size)
                source = here.at[here.found(d, r)] + s
                at = np.repeat(source - (ends - size), size) + np.arange(int(ends[-1]))
                raw = here.raw[at]
                grams = Grams(raw)
                which = np.repeat(np.arange(len(d)), g)
                inside = np.arange(int(g.sum())) - np.repeat(np.cumsum(g) - g, g)
                spot = (ends - size)[which] + inside
                first = grams.span(spot)
                second = mixed(first ^ mixed(grams.gram[spot] + grams.gram[spot + SPAN - GRAM] * _STEP[2]))
                columns = [second, (first & np.uint64(0xFF)).astype(np.uint8), np.full(len(which), part, np.int32), d[which], r[which], (s[which] + inside).astype(np.uint32), np.ones(len(which), np.uint8)]
                out += _send(first, columns, shards)
        schema = pa.schema([("bucket", pa.int32()), ("blob", pa.binary())])
        return pa.Table.from_batches(out, schema) if out else schema.empty_table()

    return run


_RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_text binary"


def _remove(with_text: bool):
    def run(key, texts: pa.Table, found: pa.Table) -> pa.Table:
        here = _Part(texts)
        n = len(here.ids)
        spans: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        if n and found.num_rows:
            doc, row, start, size = merged(*read_blobs(_blobs(found, 0), RANGE))
            for k, s, e in zip(here.found(doc, row).tolist(), start.tolist(), (start.astype(np.int64) + size).tolist(), strict=True):
                spans[k].append((s, e))
        removed, hashes, kept_texts = [], [], []
        for k in range(n):
            raw = here.raw[here.at[k] : here.at[k + 1]]
            digest, at, gone, parts = hashlib.sha256(), 0, 0, []
            for s, e in spans[k]:
                parts.append(raw[at:s])
                at, gone = e, gone + e - s
            parts.append(raw[at:])
            for p in parts:
                digest.update(np.ascontiguousarray(p))
            removed.append(gone)
            hashes.append(digest.hexdigest())
            kept_texts.append(b"".join(p.tobytes() for p in parts) if with_text else None)
        return pa.table(
            {
                "doc_id": pa.array(here.ids, pa.int64()),
                "n_bytes": pa.array(np.diff(here.at)),
                "n_removed": pa.array(removed, pa.int64()),
                "n_spans": pa.array([len(s) for s in spans], pa.int64()),
                "kept_sha256": pa.array(hashes, pa.string()),
                "kept_text": pa.array(kept_texts, pa.binary()),
            }
        )

    return run


def remove_repeats(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """A row for each of ``docs`` (doc_id, text): doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept_text (if asked for).

    The documents are dealt into parts of about ``PART_BYTES`` once; sampling, the closer look and the removal read that one
    exchange. In between only samples, single strings and ranges move.
    """
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(partitions(docs.sparkSession), -(-total // PART_BYTES))
    part = F.pmod(F.xxhash64(F.col("doc_id").cast("long"), "text"), F.lit(count)).cast("int")  # rows of one doc_id, or of none, are spread
    dealt = docs.select(part.alias("part"), F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    dealt = dealt.repartition(count, "part").sortWithinPartitions("part", "doc_id", "text")

    def by_bucket(df: DataFrame) -> DataFrame:
        return df.repartition("bucket").sortWithinPartitions("bucket")

    found = by_bucket(dealt.mapInArrow(_sample(count), BLOB_SCHEMA)).mapInArrow(_compare(SAMPLE), _ROWS)
    strings = dealt.groupBy("part").cogroup(found.groupBy("part")).applyInArrow(_look_closer(count), BLOB_SCHEMA)
    found = by_bucket(strings).mapInArrow(_compare(STRING), _ROWS)
    return dealt.groupBy("part").cogroup(found.groupBy("part")).applyInArrow(_remove(with_text), _RESULT)
