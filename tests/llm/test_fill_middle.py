"""Fill-in-middle against a plain version, on random bytes, hard rows and whole tables."""

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.brute import HARD, frame
from tokenloom.llm import fill_middle

ROWS = [
    *HARD, (20, "a\n\n\nb", "en", "s", 5), (21, "\n", "en", "s", 1), (22, "é\n漢字\r\n\U0001f600\x85x y\n", "fr", "s", 9), (23, "has <S> in it\nand more", "en", "s", 1),
    (24, "<M>", "en", "s", 1), (25, "ends in <\nS>\n<P", "en", "s", 1), (26, "x\n" * 200_000, "en", "s", 1), (-7, "é" * 700_000 + "\n" + "z" * 9, "de", "s", 1),
]


def plain(doc_id, text, seed=7, spm=50, fim=100):
    """(n, form, prefix_chars, middle_chars, output) of one row."""
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= fim:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < spm:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


@pytest.mark.parametrize("group_bytes", [1, 1 << 20])
@pytest.mark.parametrize("percents", [(50, 100), (0, 60)])
def test_rows_equal_the_plain_version(spark, monkeypatch, group_bytes, percents):
    monkeypatch.setattr(fill_middle, "GROUP_BYTES", group_bytes)
    found = fill_middle.fill_in_middle(frame(spark, ROWS), 7, *percents)
    found = found.withColumn("back", fill_middle.restored("output", "form")).collect()
    got = sorted(repr((r["doc"]["doc_id"], *r[1:6], r["back"])) for r in found)
    assert got == sorted(repr((d, *plain(d, t, 7, *percents), t or "")) for d, t, *_ in ROWS)
    assert all(r["doc"]["bits"] == "x" for r in found)


def test_no_rows(spark):
    assert fill_middle.fill_in_middle(frame(spark, []), 7).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from([0, 9, 10, 11, 0x0A ^ 0x80, 0x7F, 0x80, 0x8A, 0xBF, 0xC3, 0xFF, 65]), max_size=40), max_size=6), st.data())
def test_words_mark_count_and_select_bytes(texts, data):
    lengths = np.array([len(t) for t in texts], np.int64)
    raw = np.array([b for t in texts for b in t], np.uint8)
    h1, h2 = (np.array(data.draw(st.lists(st.integers(0, 2**32 - 1), min_size=len(texts), max_size=len(texts))), np.int64) for _ in range(2))
    ends = np.cumsum(lengths)
    n, one, two, prefix, middle = fill_middle.cut_lines(raw, ends - lengths, ends, h1, h2)
    for k, text in enumerate(texts):
        units = re.findall(rb"[^\n]*\n|[^\n]+", bytes(text))
        a, b = sorted((h1[k] % (len(units) + 1), h2[k] % (len(units) + 1)))
        start, pieces = ends[k] - lengths[k], [b"".join(units[:a]), b"".join(units[a:b])]
        assert (n[k], one[k] - start, two[k] - one[k]) == (len(units), len(pieces[0]), len(pieces[1]))
        assert [prefix[k], middle[k]] == [sum(x & 0xC0 != 0x80 for x in p) for p in pieces]
