import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tokenloom.llm import simple8b

values = st.one_of(st.integers(0, 1), st.integers(0, 50_000), st.integers(0, 2**64 - 1), st.integers(2**59, 2**60 + 1))


@settings(max_examples=150, deadline=None)
@given(st.lists(values, max_size=400))
def test_round_trip_with_escapes(numbers):
    words, offsets = simple8b.encode(np.array(numbers, np.uint64))
    assert simple8b.decode(words, len(numbers)).tolist() == numbers
    assert len(offsets) == -(-len(words) // simple8b.STRIDE)


def test_ranges_decode_from_the_offsets():
    random = np.random.default_rng(5)
    numbers = np.where(random.random(60_000) < 0.02, random.integers(2**60, 2**63, 60_000), random.integers(0, 49_408, 60_000)).astype(np.uint64)
    words, offsets = simple8b.encode(numbers)
    assert len(offsets) > 10
    for first, last in [(0, 1), (0, 60_000), (59_999, 60_000), (5, 5), *((int(a), int(a) + 777) for a in random.integers(0, 59_000, 60))]:
        assert (simple8b.decode_range(words, offsets, len(numbers), first, last) == numbers[first:last]).all()


def test_small_ids_share_words():
    words, _ = simple8b.encode(np.full(6000, 1000, np.uint64))
    assert len(words) == 1000  # six values of ten bits
