"""Documents rearranged so that a model learns to fill in a middle part, cut at the ends of lines.

A text falls into n units (lines with their line feed). Two of the n + 1 unit borders, drawn from a hash of the
doc_id, part it into prefix, middle and suffix, which are written in one of two orders with a sentinel before each.

Borders are found on the UTF-8 bytes, eight at a time: a batch of texts is viewed as 64-bit words, arithmetic on a
word sets one bit for each byte that ends a unit, the bits are counted per word, and running counts give the word of the k-th
border by binary search; byte-wise prefix sums inside that word then give the byte. Lengths in code points are counted in the
same way, by the bits of continuation bytes.

Defined cases: a null or empty text has no units and stays as it is (form ``plain``, an empty output), and so does a text that holds a
sentinel; a null doc_id draws from the hash of the bare seed; rows with the same doc_id draw the same numbers; an empty table gives
no rows; other columns are kept, and none of their names can clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SENTINELS = ("<P>", "<S>", "<M>")
#: Texts are worked on in groups of about this many bytes; a longer text is a group of its own.
GROUP_BYTES = 1 << 20

_EACH, _HIGH, _LOW7 = np.uint64(0x0101010101010101), np.uint64(0x8080808080808080), np.uint64(0x7F7F7F7F7F7F7F7F)
_FEEDS = np.uint64(ord("\n")) * _EACH
_ONE, _SEVEN, _EIGHT = np.uint64(1), np.uint64(7), np.uint64(8)


def line_feeds(words: np.ndarray) -> np.ndarray:
    """Words with the high bit of every byte that is a line feed. No carry leaves a byte, so the marks are exact."""
    off = words ^ _FEEDS
    return ~(((off & _LOW7) + _LOW7) | off | _LOW7)


def continuations(words: np.ndarray) -> np.ndarray:
    """Words with the high bit of every byte 10xxxxxx."""
    return words & ~(words << _ONE) & _HIGH


class Marks:
    """Rank and select over marked bytes, 64 bits at a time."""

    def __init__(self, marks: np.ndarray):
        self.marks = marks
        self.before = np.r_[0, np.cumsum(np.bitwise_count(marks), dtype=np.int64)]

    def rank(self, at: np.ndarray) -> np.ndarray:
        """How many marked bytes lie before each byte position."""
        word, bits = at >> 3, (at & 7).astype(np.uint64) * _EIGHT
        return self.before[word] + np.bitwise_count(self.marks[word] & ((_ONE << bits) - _ONE))

    def select(self, k: np.ndarray) -> np.ndarray:
        """Byte positions of the marks number ``k``, counted from 0."""
        word = np.searchsorted(self.before, k, side="right") - 1
        counts = (self.marks[word] >> _SEVEN) * _EACH  # byte i holds the marks of bytes 0 to i
        inside = (k - self.before[word]).astype(np.uint64)
        passed = ((inside * _EACH | _HIGH) - counts) & _HIGH  # bytes whose count does not reach the mark
        return (word << 3) + np.bitwise_count(passed).astype(np.int64)


def cut_lines(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, ...]:
    """Units of the texts ``data[starts:ends]``, and the bytes after prefix and middle (absolute), with their code points."""
    words = np.zeros(len(data) // 8 + 1, "<u8")  # a border may lie behind the last byte
    words.view(np.uint8)[: len(data)] = data
    feeds, inner = Marks(line_feeds(words)), Marks(continuations(words))
    first = feeds.rank(starts)
    feeds_in = feeds.rank(ends) - first
    full = ends > starts
    open_end = full & (data[np.maximum(ends - 1, 0)] != ord("\n")) if len(data) else full
    n = feeds_in + open_end
    low, high = np.minimum(h1 % (n + 1), h2 % (n + 1)), np.maximum(h1 % (n + 1), h2 % (n + 1))

    def border(units: np.ndarray) -> np.ndarray:
        at = np.where(units == 0, starts, ends)
        fed = (units > 0) & (units <= feeds_in)  # the others end where the text ends
        at[fed] = feeds.select((first + units - 1)[fed]) + 1
        return at

    def points(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return b - a - (inner.rank(b) - inner.rank(a))

    one, two = border(low), border(high)
    return n, one, two, points(starts, one), points(one, two)


def _groups(lengths: np.ndarray) -> Iterator[tuple[int, int]]:
    at, size = 0, 0
    for k, length in enumerate(lengths.tolist()):
        if size and size + length > GROUP_BYTES:
            yield at, k
            at, size = k, 0
        size += length
    if at < len(lengths):
        yield at, len(lengths)


def _transform(spm_percent: int, fim_percent: int):
    p, s, m = (x.encode() for x in SENTINELS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, texts = batch.column(0), batch.column(1)
            marked = pc.match_substring(texts, SENTINELS[0])
            for other in SENTINELS[1:]:
                marked = pc.or_(marked, pc.match_substring(texts, other))
            marked = np.asarray(marked)
            h1, h2, h3, h4 = (np.asarray(batch.column(2 + k)) for k in range(4))
            lengths = np.asarray(pc.binary_length(texts)).astype(np.int64)
            for lo, hi in _groups(lengths):
                data = b"".join(texts.slice(lo, hi - lo).cast(pa.binary()).to_pylist())
                ends = np.cumsum(lengths[lo:hi])
                starts, raw = ends - lengths[lo:hi], np.frombuffer(data, np.uint8)
                n, one, two, prefix, middle = cut_lines(raw, starts, ends, h1[lo:hi], h2[lo:hi])
                plain = (starts == ends) | marked[lo:hi] | (h3[lo:hi] % 100 >= fim_percent)
                spm = h4[lo:hi] % 100 < spm_percent
                out = []
                for a, b, c, d, whole, suffix_first in zip(*(x.tolist() for x in (starts, one, two, ends, plain, spm)), strict=True):
                    if whole:
                        out.append(data[a:d])
                    elif suffix_first:
                        out.append(b"".join((s, data[c:d], p, data[a:b], m, data[b:c])))
                    else:
                        out.append(b"".join((p, data[a:b], s, data[c:d], m, data[b:c])))
                forms = np.where(plain, "plain", np.where(spm, "spm", "psm"))
                yield pa.RecordBatch.from_arrays(
                    [
                        kept.slice(lo, hi - lo),
                        pa.array(n, pa.int64()),
                        pa.array(forms.tolist(), pa.string()),
                        pa.array(prefix, pa.int64(), mask=plain),
                        pa.array(middle, pa.int64(), mask=plain),
                        pa.array(out, pa.binary()).cast(pa.string()),
                    ],
                    names=["doc", "n", "form", "prefix_chars", "middle_chars", "output"],
                )

    return run


def fill_in_middle(docs: DataFrame, seed: int, spm_percent: int = 50, fim_percent: int = 100) -> DataFrame:
    """Each row of ``docs`` as ``doc`` (a struct of its columns but the text), with n, form, prefix_chars, middle_chars and output.

    A task holds one Arrow batch and one group of texts at a time; nothing is shuffled.
    """
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    numbers = [F.conv(F.substring(drawn, 1 + 8 * k, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]
    others = [c for c in docs.columns if c != "text"]
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in others)).alias("doc"), F.coalesce("text", F.lit("")).alias("text"), *numbers)
    made = T.StructType([rows.schema["doc"]])
    for name, kind in (("n", "long"), ("form", "string"), ("prefix_chars", "long"), ("middle_chars", "long"), ("output", "string")):
        made.add(name, kind)
    return rows.mapInArrow(_transform(spm_percent, fim_percent), made)


def restored(output: Column | str, form: Column | str) -> Column:
    """The text of an output. A text with sentinels is plain, so the three sentinels of the others are the only ones."""
    output, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    parts = F.split(output, "|".join(SENTINELS))  # what stands before the first sentinel is empty
    return F.when(form == "psm", F.concat(parts[1], parts[3], parts[2])).when(form == "spm", F.concat(parts[2], parts[3], parts[1])).otherwise(output)
