"""The filter audit against counting all orders, with files that arrive in any order."""

import itertools
import random
from collections import Counter

import pytest

from tests.llm import brute
from tests.llm.brute import HARD, frame
from tokenloom.llm import filter_audit
from tokenloom.llm.common import Scratch

LABELS = [(1, 1, 0), (2, 0, 1), (2, 1, 0), (3, 1, 1), (5, None, 1), (7, 1, None), (None, 1, 1), (50, 1, 1), (63, 0, 1), (99, 1, 0), (400, 1, 1)]


def texts():
    """Copies of a few texts over many ids in a drawn order, so first ones are beaten again and again."""
    draw = random.Random(3)
    kinds = ["a b c", "A B C #", "word " * 300, " ".join(f"w{i}" for i in range(250)), "X" + " ".join(f"Y{i}" for i in range(250)), "", "$ " * 250]
    rows = [(i, draw.choice(kinds), draw.choice(["en", "de", None, ""]), "s", 1) for i in draw.sample(range(40, 300), 160)]
    return [*HARD, *rows, *rows[:9], (55, None, "en", "s", 1)]


def masks(rows):
    first = {}
    for d, t, *_ in rows:
        if d is not None:
            first[t or ""] = min(first.get(t or "", d), d)
    for d, t, lang, *_ in rows:
        t = t or ""
        w = brute.WORD.findall(t)
        fails = [
            len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * sum("A" <= c <= "Z" for c in t) > 3 * len(t), any(c in "#$%&*|" for c in t),
            d is not None and first[t] < d,
        ]
        yield d, lang or "", frozenset(c for c, f in zip("ABCDE", fails, strict=True) if f)


def audit(rows, labels=LABELS):
    good, bad = ({d for d, *v in labels if d is not None and v[k] == 1} for k in (0, 1))
    out, every = Counter(), list(masks(rows))
    for part in {p for _, p, _ in every}:
        mine = [(d, m) for d, p, m in every if p == part]
        removed, table = Counter(), {}
        for order in map("".join, itertools.permutations("ABCDE")):
            left = mine
            for step, f in enumerate(order, 1):
                here = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                removed[f] += len(here)
                table[order, step] = [
                    len(left), len(here), sum(f in m for _, m in mine) - len(here), sum(m == {f} for _, m in mine), sum(d in good for d, _ in here), sum(d in bad for d, _ in here)
                ]
        out |= {(part, order, step, *v, removed[order[step - 1]]): 1 for (order, step), v in table.items()}
    return out


def write(spark, folder, rows, files, mode="overwrite"):
    """One file for each slice of the rows, the last slice first."""
    for k in range(files):
        frame(spark, rows[k::files]).coalesce(1).write.mode(mode if k == 0 else "append").parquet(folder)


def labels(spark):
    return spark.createDataFrame([(*x, "x") for x in LABELS], "doc_id long, quality int, toxic int, part string")


@pytest.mark.parametrize("files", [1, 7])
def test_counts_equal_those_of_all_orders(spark, tmp_path, files):
    path = str(tmp_path / "docs.parquet")
    write(spark, path, texts(), files)
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    counters = filter_audit.follow_files(spark, path, labels(spark), Scratch(spark, "t"), batches=files)
    found = filter_audit.interactions(counters)
    assert Counter(map(tuple, found.collect())) == audit(texts())
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before


def test_later_files_take_back_earlier_counts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(filter_audit, "BUCKET_TEXTS", 4)
    path, work = str(tmp_path / "docs.parquet"), Scratch(spark, "t")
    rows = sorted(texts(), key=lambda r: (r[0] is None, -(r[0] or 0)))  # the smallest ids come last
    taken = []
    for lo, hi in ((0, 60), (60, 130), (130, len(rows))):
        write(spark, path, rows[lo:hi], 3, "append" if lo else "overwrite")
        found = filter_audit.interactions(filter_audit.follow_files(spark, path, labels(spark), work))
        assert Counter(map(tuple, found.collect())) == audit(rows[:hi])
        taken.append(spark.read.schema("n long").parquet(work.path("moved/*")).where("n < 0").count())
    assert taken[0] < taken[1] < taken[2]
    again = filter_audit.follow_files(spark, path, labels(spark), work)  # nothing new
    assert Counter(map(tuple, filter_audit.interactions(again).collect())) == audit(rows)


def test_copies_of_a_batch_move_on_as_one_row(spark):
    rows = frame(spark, [(i, "same", "en" if i % 2 else "de", "s", 1) for i in range(9, 1009)] + [(None, "same", "en", "s", 1)] * 500)
    rows = filter_audit.facts(rows, filter_audit.marks_of(labels(spark)))
    settled, first = filter_audit.reduce_batch(rows, filter_audit.lowest(rows))
    assert [(r["doc_id"], r["n"]) for r in first.collect()] == [(9, 1)]
    assert sum(r["n"] for r in settled.collect()) == 1499 and settled.count() <= 12


def test_no_rows(spark, tmp_path):
    path = str(tmp_path / "docs.parquet")
    frame(spark, []).write.parquet(path)
    assert filter_audit.interactions(filter_audit.follow_files(spark, path, labels(spark), Scratch(spark, "t"))).count() == 0
