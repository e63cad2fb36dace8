"""Near copies of the pipeline against all pairs."""

import random
import re

import duckdb
import numpy as np
import pytest

import corpus_pipeline as pipeline
from tests.conftest import FOLDER
from tests.llm import brute
from tokenloom.llm import near_copies
from tokenloom.llm.common import Scratch


def shingles(text, size=5):
    tokens = brute.WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {" ".join(tokens[i : i + size]) for i in range(len(tokens) - size + 1)} or {" ".join(tokens)}


def kept_ids(rows):
    """The smallest doc_id of each component of pairs with a Jaccard similarity of 0.8 or more."""
    sets = [shingles(r[1]) for r in rows]
    roots = brute.components(list(range(len(rows))), lambda a, b: len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]))
    least = {}
    for k, root in roots.items():
        least[root] = min((x for x in (least.get(root), rows[k][0]) if x is not None), default=None)
    return sorted(least.values())


def edited_copies():
    """One large group of near copies, each with its own edits, and texts that share only a passage."""
    draw = random.Random(5)
    words = [f"w{k}" for k in range(4000)]
    base, passage, rows = draw.choices(words, k=200), draw.choices(words, k=60), []
    for k in range(150):
        text = list(base)
        for _ in range(draw.randint(1, 4)):
            text[draw.randrange(200)] = draw.choice(words)
        rows.append((k + 1, " ".join(text), "en", "s", 1))
    return rows + [(k + 1000, " ".join(passage + draw.choices(words, k=60)), "en", "s", 1) for k in range(60)]


def boilerplate_pairs(pairs, drift):
    """Pairs of near copies among texts that all share a long passage, so that any two are nearly as similar as a pair."""
    draw = random.Random(pairs)
    base, rows = [f"b{k}" for k in range(300)], []
    for k in range(pairs):
        mine = [f"p{k}x{i}" for i in range(drift)]
        for side in (0, 1):
            own = [f"q{k}y{side}z{i}" for i in range(draw.randint(0, 12))]
            rows.append((2 * k + side, " ".join(base + mine + own), "en", "s", 1))
    return rows


@pytest.mark.parametrize("drift", [18, 24, 30])
def test_pairs_in_crowds_of_nearly_similar_texts(spark, drift):
    rows = boilerplate_pairs(300, drift)
    docs = brute.frame(spark, rows)
    assert sorted(r["doc_id"] for r in pipeline.near_copies(spark, docs, FOLDER).collect()) == kept_ids(rows)


def test_front_shingles_find_every_pair(spark):
    """All pairs of random sets with the similarity, whatever their sizes, with no component known."""
    draw, sets = random.Random(9), []
    for k in range(60):
        base = draw.sample(range(1, 400), draw.choice([1, 2, 4, 5, 10, 40, 100]))
        for _ in range(4):
            sets.append(sorted(set(base) - set(draw.sample(base, draw.randint(0, len(base) // 6))) | set(draw.sample(range(1, 400), draw.randint(0, 1 + len(base) // 8)))))
    rows = [(k, np.array(s, "<i8").tobytes()) for k, s in enumerate(sets)]
    frame = spark.createDataFrame(rows, "node long, shingles binary").repartition(3)
    none = spark.createDataFrame([], "node long, component long")
    found = {tuple(r) for r in near_copies._verified(near_copies.crowded_pairs(frame, none, Scratch(spark, "t"), 0.8), frame, 0.8).collect()}
    sets = [set(s) for s in sets]
    assert found == {(a, b) for b in range(len(sets)) for a in range(b) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}


@pytest.mark.parametrize("rows", ["documents", "copies"])
def test_near_copies_equal_all_pairs_of_shingles(spark, rows):
    documents = "SELECT doc_id, text, lang, source, n_chars FROM '{}/documents.parquet' WHERE doc_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1"
    rows = edited_copies() if rows == "copies" else duckdb.connect().sql(documents.format(FOLDER)).fetchall()
    docs = brute.frame(spark, rows)
    assert sorted(r["doc_id"] for r in pipeline.near_copies(spark, docs, FOLDER).collect()) == kept_ids(rows)


def test_near_copies_of_no_rows(spark):
    assert pipeline.near_copies(spark, brute.frame(spark, []), FOLDER).count() == 0


def test_ball_pairs_join_fingerprints_within_the_radius(spark):
    """The ball's pairs connect the texts that fingerprints at three or fewer differing bits connect."""
    prints = [0b0, 0b111, 0b111111, 1 << 40, (1 << 60) - 1, (1 << 60) - 1, (1 << 60) - 2, 0x5555 << 20]
    rows = [(k - 4, p) for k, p in enumerate(prints)] + [(-4, 0)]
    found = near_copies.ball_pairs(spark.createDataFrame(rows, "node long, fp long"), Scratch(spark, "t")).collect()
    nodes = dict(rows)
    assert all((nodes[a] ^ nodes[b]).bit_count() <= 3 for a, b in found)
    linked = brute.components(list(nodes), lambda a, b: (nodes[a] ^ nodes[b]).bit_count() <= 3)
    assert brute.components(list(nodes), lambda a, b: (a, b) in found or (b, a) in found) == linked


def test_near_copies_come_by_ball_hashing_first(spark, monkeypatch):
    """Texts within the ball are found without any band, and are no longer pairs to check; texts the ball joins below 0.8 stay apart."""

    def nothing(batches):
        for _ in batches:
            pass
        return iter(())

    draw = random.Random(2)
    words = [f"w{k}" for k in range(3000)]
    rows = []
    for k in range(40):
        text = draw.choices(words, k=2500)
        rows += [(2 * k, " ".join(text), "en", "s", 1), (2 * k + 1, " ".join([*text, "end"]), "en", "s", 1)]
    rows += [(900, "", "en", "s", 1), (901, " ", "en", "s", 1), (902, "a b c d e f", "en", "s", 1)]
    docs = brute.frame(spark, rows)
    monkeypatch.setattr(near_copies, "_pairs", nothing)
    found = sorted(r["doc_id"] for r in pipeline.near_copies(spark, docs, FOLDER).collect())
    assert found == kept_ids(rows)
    # the ball joins all texts here, and the shingles still decide
    monkeypatch.setattr(near_copies, "majority", lambda hashes, counts: np.zeros(len(counts), np.uint64))
    far = [(k, f"p{k} q{k} r{k} s{k} t{k} u{k}", "en", "s", 1) for k in range(20)]
    assert sorted(r["doc_id"] for r in pipeline.near_copies(spark, brute.frame(spark, far), FOLDER).collect()) == kept_ids(far)
