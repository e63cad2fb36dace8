"""Packing token streams into sequences: order-preserving dynamic programming.

The ids of the documents follow each other in the order of the input; windows of at most ``length`` ids are
cut from that stream. A window that is neither full nor a power of two long is padded to ``length``. Cutting at the end of a
document is free, at the end of a sentence it costs ``sentence_cost``, elsewhere ``word_cost``, in units of padded
ids. The windows of least total cost are found by dynamic programming over the places where a cut is allowed; as the
cost of a window is (its cut's cost + length - end) + its start, the best start is a sliding minimum, kept in a monotone queue.
While planning, a window shorter than ``length`` counts as padded also where it is a power of two, so that such windows stay few.

Every task packs the rows of its partition, in their order, a round of ids at a time. A round ends at whichever place of its last window
has cost least per id so far: an end at a fixed place would leave the windows no room, and all would be cut at multiples of
``length``. The round's last window is planned anew with the next round. What is left at the end of a partition is split into powers of two, so it
ends without padding; where this begins is planned too. Nothing is shuffled.

Defined cases: a null or empty text is a document of the end id alone; rows with the same doc_id are packed
separately; a null doc_id stays null; an empty table gives no sequences; other columns are ignored.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.tokens import word_tokenizer

LENGTH = 4096
#: Ids that one round of dynamic programming plans at most.
ROUND = 1 << 18
#: A cut is allowed at least every so many ids, also within a sentence.
STEP = 128

_SEQUENCES = (
    "sequence_id long, n_ids int, padded_to int, ids binary, "
    "pieces array<struct<doc_id: bigint, start: bigint, length: bigint, doc_tokens: bigint, offset: bigint>>"
)


def best_cuts(ends: np.ndarray, costs: np.ndarray, length: int, choose: Callable[[np.ndarray], int] | None = None) -> list[int]:
    """Which of the places ``ends`` (ascending, at most ``length`` apart) to cut at, the last one included.

    ``costs`` holds what a cut at each place costs. A window between two cuts costs its padding up to ``length``. ``choose`` picks the last
    cut by the least cost of all windows up to each place; without it that is the last place.
    """
    places, price = ends.tolist(), costs.tolist()
    came_from, reached = [0] * len(places), [0.0] * len(places)
    queue: deque[tuple[float, int, int]] = deque([(0.0, 0, -1)])  # (cost + start, start, index), ascending
    for j, end in enumerate(places):
        oldest = end - length
        while queue[0][1] < oldest:
            queue.popleft()
        value, _, i = queue[0]
        came_from[j] = i
        reached[j] = value = value + length + price[j]  # = cost up to here + end
        while queue and queue[-1][0] >= value:
            queue.pop()
        queue.append((value, end, j))
    cuts, j = [], len(places) - 1 if choose is None else choose(np.array(reached) - ends)
    while j >= 0:
        cuts.append(places[j])
        j = came_from[j]
    return cuts[::-1]


class _Packer:
    """The stream of one task: documents go in, sequences come out."""

    def __init__(self, partition: int, length: int, sentence_ends: np.ndarray, sentence_cost: float, word_cost: float):
        self.length, self.sentence_ends = length, sentence_ends
        self.sentence_cost, self.word_cost = sentence_cost, word_cost
        self.next_id, self.round = partition << 32, max(ROUND, 16 * length)
        self.ids: list[np.ndarray] = []
        self.docs: list[tuple[int | None, int, int, int]] = []  # doc_id, ids cut off before, ids here, ids in all
        self.size = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> Iterator[tuple]:
        done = 0
        while done < len(ids):  # a long document fills several rounds
            part = ids[done : done + max(1, self.round - self.size)]
            self.ids.append(part)
            self.docs.append((doc_id, done, len(part), len(ids)))
            self.size += len(part)
            done += len(part)
            if self.size >= self.round:
                yield from self._plan(last=False)

    def finish(self) -> Iterator[tuple]:
        if self.size:
            yield from self._plan(last=True)

    def _plan(self, last: bool) -> Iterator[tuple]:
        stream = np.concatenate(self.ids)
        n = len(stream)
        closed = np.array([size for _, _, size, _ in self.docs]).cumsum()
        whole = np.array([before + size == total for _, before, size, total in self.docs])
        cost = np.full(n + 1, np.inf)
        step = min(STEP, self.length)
        cost[step::step] = self.word_cost
        cost[np.flatnonzero(np.isin(stream, self.sentence_ends)) + 1] = self.sentence_cost
        cost[closed[whole]] = 0
        if last:
            # the rest of the partition behind the last cut becomes powers of two at its end
            cuts = self._cuts(cost, n, lambda ends, spent: spent + self.word_cost * np.maximum(np.bitwise_count(n - ends) - 1.0, 0)) if n >= self.length else []
            at = cuts[-1] if cuts else 0
            while at < n:
                at += 1 << ((n - at).bit_length() - 1)
                cuts.append(at)
        else:
            cuts = self._cuts(cost, n, lambda ends, spent: spent / ends)[:-1]  # the last window is planned anew with what follows
        yield from self._emit(stream, closed, cuts)
        kept = cuts[-1] if cuts else 0
        self.ids, self.size = [stream[kept:]], n - kept
        left = []
        for (doc_id, before, size, total), end in zip(self.docs, closed.tolist(), strict=True):
            if end > kept:
                gone = max(0, kept - (end - size))
                left.append((doc_id, before + gone, size - gone, total))
        self.docs = left

    def _cuts(self, cost: np.ndarray, n: int, price: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> list[int]:
        """The cheapest cuts up to the place among the last ``length`` ids that has the least price, given the places and their costs."""
        places = np.flatnonzero(np.isfinite(cost[1:])) + 1
        first = int(np.searchsorted(places, n - self.length, side="right"))
        return best_cuts(places, cost[places], self.length, lambda spent: first + int(np.argmin(price(places[first:], spent[first:]))))

    def _emit(self, stream: np.ndarray, closed: np.ndarray, cuts: list[int]) -> Iterator[tuple]:
        opened = closed - np.array([size for _, _, size, _ in self.docs])
        lo = 0
        for hi in cuts:
            pieces = []
            for k in range(int(np.searchsorted(closed, lo, side="right")), int(np.searchsorted(opened, hi, side="left"))):
                doc_id, before, _, total = self.docs[k]
                begin, end = max(lo, int(opened[k])), min(hi, int(closed[k]))
                piece = {"doc_id": doc_id, "start": before + begin - int(opened[k]), "length": end - begin, "doc_tokens": total, "offset": begin - lo}
                if pieces and begin == int(opened[k]) and before and pieces[-1]["start"] + pieces[-1]["length"] == piece["start"] and self.docs[k - 1][0] == doc_id:
                    pieces[-1]["length"] += piece["length"]  # two parts of one long document meet in a window
                else:
                    pieces.append(piece)
            size = hi - lo
            yield self.next_id, size, size if size & (size - 1) == 0 else self.length, stream[lo:hi].astype("<u4").tobytes(), pieces
            self.next_id += 1
            lo = hi


def pack(
    docs: DataFrame, tokenizer: str, end_id: int, length: int = LENGTH,
    sentence_cost: float = 8, word_cost: float = 64, sentence_marks: str = ".!?",
) -> DataFrame:
    """Sequences of ``docs`` (doc_id, text): sequence_id, n_ids, padded_to, ids (32-bit, little endian), pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = word_tokenizer(tokenizer)
        marks = {i for m in sentence_marks for i in tool.tokenizer.encode(m, add_special_tokens=False).ids}
        packer = _Packer(TaskContext.get().partitionId(), length, np.array(sorted(marks), np.uint32), sentence_cost, word_cost)
        names = [f.split()[0] for f in ("sequence_id", "n_ids", "padded_to", "ids", "pieces")]
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.struct([(c, pa.int64()) for c in ("doc_id", "start", "length", "doc_tokens", "offset")]))]

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

        rows: list[tuple] = []
        for batch in batches:
            at = 0
            for count, ids, sizes in tool.encode_all(text.as_py() for text in batch.column(1)):
                doc_ids, ends = batch.column(0).slice(at, count).to_pylist(), np.cumsum(sizes)
                for doc_id, size, end in zip(doc_ids, sizes.tolist(), ends.tolist(), strict=True):
                    rows += packer.add(doc_id, np.append(ids[end - size : end], np.uint32(end_id)))
                at += count
                if len(rows) >= 256:
                    yield batch_of(rows)
                    rows = []
        rows += packer.finish()
        if rows:
            yield batch_of(rows)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, _SEQUENCES)


def pieces(sequences: DataFrame) -> DataFrame:
    """A row for each piece of a document in a sequence, with the checksum of its ids."""
    piece = F.col("piece")
    data = F.col("ids").substr((piece["offset"] * 4 + 1).cast("int"), (piece["length"] * 4).cast("int"))
    return sequences.select("sequence_id", "n_ids", "padded_to", "ids", F.explode("pieces").alias("piece")).select(
        piece["doc_id"].alias("doc_id"),
        piece["start"].alias("start"),
        piece["length"].alias("length"),
        F.crc32(data).alias("ids_crc32"),
        piece["doc_tokens"].alias("doc_tokens"),
        "sequence_id",
        piece["offset"].alias("offset"),
        "n_ids",
        "padded_to",
    )
