"""Simple-8b coding of unsigned integers in 64-bit words, encoded and decoded with numpy.

A word holds a 4-bit selector above 60 bits of data. Selectors 2 to 15 pack 60 to 1 values of 1 to 60 bits.
Selector 0 is an escape: the next word holds one value of up to 64 bits as it is.
"""

from __future__ import annotations

import numpy as np

#: Fixed values of the code: values in a word and bits of each, by selector from 2 on.
PER_WORD = (60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
WIDTH = (1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)
#: Words between two entries of a block's offsets.
STRIDE = 1024

_COUNT = np.array([1, 0, *PER_WORD], np.int64)


_SHORT = np.frexp(np.arange(1 << 16, dtype=np.float64))[1].astype(np.uint8)


def _bits(values: np.ndarray) -> np.ndarray:
    """Bit lengths of the values, 0 for 0."""
    if int(values.max()) < len(_SHORT):
        return _SHORT[values]
    bits = np.frexp(values.astype(np.float64))[1]
    # rounding to double can carry into the next power of two, which only wide values meet
    return np.where((values >> np.maximum(bits - 1, 0).astype(np.uint64)) == 0, np.maximum(bits - 1, 0), bits).astype(np.uint8)


def _selectors(values: np.ndarray) -> np.ndarray:
    """For every position the selector that packs most values from there on; 0 where 60 bits don't do."""
    n = len(values)
    widest = {1: np.r_[_bits(values), np.zeros(64, np.uint8)]}
    for step in (1, 2, 4, 8, 16):
        widest[2 * step] = np.maximum(widest[step][:-step], widest[step][step:])
    chosen = np.zeros(n, np.uint8)
    for selector in range(15, 1, -1):
        count, width = PER_WORD[selector - 2], WIDTH[selector - 2]
        step = 1 << (count.bit_length() - 1)
        if step == 64:
            step = 32
        most = widest[step]
        most = np.maximum(most[:n], most[count - step : count - step + n])
        chosen[most <= width] = selector
    return chosen


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words, and the number of values before every ``STRIDE``-th word (the offsets)."""
    values = np.ascontiguousarray(values, np.uint64)
    n = len(values)
    if not n:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    chosen = _selectors(values)
    step = _COUNT[chosen].astype(np.uint8).tobytes()
    at, k = [], 0
    while k < n:
        at.append(k)
        k += step[k]
    at = np.array(at)
    selector = chosen[at]
    place = np.arange(len(at)) + np.cumsum(selector == 0) - (selector == 0)
    words = np.zeros(int(len(at) + (selector == 0).sum()), np.uint64)
    padded = np.r_[values, np.zeros(60, np.uint64)]
    for s in np.unique(selector):
        mine = np.flatnonzero(selector == s)
        first = at[mine]
        if s == 0:
            words[place[mine] + 1] = values[first]
            continue
        word = np.full(len(mine), np.uint64(s) << np.uint64(60))
        for i in range(PER_WORD[s - 2]):
            word |= padded[first + i] << np.uint64(i * WIDTH[s - 2])
        words[place[mine]] = word
    before = np.zeros(len(words), np.int64)
    before[place] = at
    before[place[selector == 0] + 1] = at[selector == 0]
    return words, _offsets(before, place, selector)


def _offsets(before: np.ndarray, place: np.ndarray, selector: np.ndarray) -> np.ndarray:
    """Values before each ``STRIDE``-th word; negative (~values) where that word is an escape's second half."""
    offsets = before[::STRIDE].copy()
    raw = np.zeros(len(before), bool)
    raw[place[selector == 0] + 1] = True
    return np.where(raw[::STRIDE], ~offsets, offsets)


def decode(words: np.ndarray, count: int) -> np.ndarray:
    """The first ``count`` values of a run of words that begins with a selector."""
    words = np.asarray(words, np.uint64)
    selector = (words >> np.uint64(60)).astype(np.uint8)
    if (selector == 0).any():  # the word after an escape is raw, whatever its upper bits say
        raw, k = np.zeros(len(words), bool), 0
        zeros = np.flatnonzero(selector == 0)
        for z in zeros.tolist():
            if z >= k:
                raw[z + 1 : z + 2] = True
                k = z + 2
        heads = np.flatnonzero(~raw)
    else:
        heads = np.arange(len(words))
    kinds = selector[heads]
    sizes = _COUNT[kinds]
    starts = np.cumsum(sizes) - sizes
    out = np.zeros(int(sizes.sum()) if len(sizes) else 0, np.uint64)
    for s in np.unique(kinds):
        mine = np.flatnonzero(kinds == s)
        if s == 0:
            out[starts[mine]] = words[heads[mine] + 1]
            continue
        word, width = words[heads[mine]], WIDTH[s - 2]
        for i in range(PER_WORD[s - 2]):
            out[starts[mine] + i] = (word >> np.uint64(i * width)) & np.uint64((1 << width) - 1)
    return out[:count]


def decode_range(words: np.ndarray, offsets: np.ndarray, count: int, first: int, last: int) -> np.ndarray:
    """Values ``first`` to ``last`` - 1 of a block of ``count``, decoding only the strides that hold them."""
    last = min(last, count)
    if first >= last:
        return np.empty(0, np.uint64)
    before = np.where(offsets < 0, ~offsets, offsets)
    lo = max(int(np.searchsorted(before, first, side="right")) - 1, 0)
    hi = int(np.searchsorted(before, last, side="left"))
    begin = lo * STRIDE - int(offsets[lo] < 0)  # back to the escape that the stride cuts
    end = len(words) if hi >= len(offsets) else hi * STRIDE + int(offsets[hi] < 0)
    return decode(words[begin:end], last - int(before[lo]))[first - int(before[lo]) :]
