"""The order of the mix, in the query and through packing."""

import duckdb

import corpus_pipeline as pipeline
from tests.conftest import FOLDER
from tests.llm import brute
from tokenloom.llm import mixing, queries
from tokenloom.llm.common import Scratch

ROWS = duckdb.connect().sql(f"SELECT doc_id + 100, text, lang, source, n_chars FROM '{FOLDER}/documents.parquet' WHERE doc_id IS NOT NULL").fetchall()


def plan_of(spark, rows):
    return mixing.plan_mix(brute.frame(spark, rows), queries.WEIGHTS, queries.MOST_REPEATS, queries.SCHEDULES, Scratch(spark, "t"))


def test_packing_follows_training_positions_however_the_mix_is_stored(spark):
    plan = plan_of(spark, ROWS).collect()
    want = sorted((p["position"], r["source"], r["doc_id"], p["pass"]) for r in plan for p in r["passes"])
    assert len(want) > len({w[2] for w in want})  # some documents have several passes
    mixed = pipeline.mix_sources(spark, brute.frame(spark, ROWS), FOLDER)
    packed = pipeline.pack_sequences(spark, mixed.repartition(7), FOLDER).where("start = 0").collect()
    assert len({r["sequence_id"] >> 32 for r in packed}) > 1
    assert [r["doc_id"] for r in sorted(packed, key=lambda r: (r["sequence_id"], r["offset"]))] == [w[2] for w in want]


def test_order_of_hard_rows_keeps_all_rows(spark):
    mixed = pipeline.mix_sources(spark, brute.frame(spark, brute.HARD), FOLDER)
    found = mixing.in_training_order(mixed, queries.SCHEDULES, Scratch(spark, "t"))
    pairs = lambda df: sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=repr)
    assert pairs(found) == pairs(mixed)
    assert mixing.in_training_order(mixed.limit(0), queries.SCHEDULES, Scratch(spark, "t")).count() == 0


def spent(schedule, time):
    """The integral of a schedule up to ``time``."""
    total = 0.0
    for (a, h), (b, k) in zip(schedule, schedule[1:], strict=False):
        if time > a:
            end = min(time, b)
            total += (end - a) * (2 * h + (k - h) * (end - a) / (b - a)) / 2
    return total


def test_mixing_query_takes_its_rows_from_the_sorted_mix(spark, monkeypatch):
    rows = ROWS[:60] + brute.HARD
    plan = plan_of(spark, rows)
    mix = mixing.mixed_order(plan)
    held = [[(p, r["position"]) for r in part] for p, part in enumerate(mix.rdd.glom().collect())]
    flat = [x[1] for part in held for x in part]
    assert flat == sorted(flat) and len([p for p in held if p]) > 1
    found, planned = mixing.documents_of_mix(plan, mix).collect(), plan.collect()
    key = lambda r: repr((r["doc_id"], r["source"], r["text_hash"], r["size"], r["taken"]))
    assert sorted(map(key, found)) == sorted(map(key, planned))
    # the schedule's integral at a document's positions is the words of its source before each pass
    order = sorted({r["source"] for r in planned if r["source"] is not None}) + [None]
    for r in planned:
        schedule, given = queries.SCHEDULES[order.index(r["source"]) % 3], sum(x["taken"] for x in planned if x["source"] == r["source"])
        earlier = sum(x["size"] for x in planned if x["source"] == r["source"] and x["begin"] < r["begin"])
        for p in r["passes"]:
            assert r["begin"] == earlier
            assert abs(spent(schedule, p["position"]) / spent(schedule, 1.0) - (earlier + p["pass"] * r["source_size"]) / given) < 1e-9
    seen = []
    monkeypatch.setattr(mixing, "mixed_order", lambda plan, made=mixing.mixed_order: seen.append(1) or made(plan))
    queries.op4_mixing(spark, FOLDER)
    assert seen


def test_border_documents_are_taken_whole_or_not_at_all(spark):
    rows = [(k, "w " * (1 + k % 9), "en", "abc"[k % 3], 1) for k in range(200)] + [(900 + k, "long " * 700, "en", "b", 1) for k in range(3)]
    rows += [(None, f"no id {k} " * 3, "en", "c", 1) for k in range(40)] + [(950, "alone " * 5000, "en", "d", 1)]
    plan = plan_of(spark, rows).collect()
    for source in "abcd":
        mine = [r for r in plan if r["source"] == source]
        assert all(p["words"] == r["size"] for r in mine for p in r["passes"])
        taken, target, longest = sum(r["taken"] for r in mine), mine[0]["target"], max(r["size"] for r in mine)
        assert taken > 0 and (2 * abs(taken - target) <= longest + 1 or source == "d")
    mixed = pipeline.mix_sources(spark, brute.frame(spark, rows), FOLDER)
    texts = {(r[0], r[1]) for r in rows}
    assert all((r["doc_id"], r["text"]) in texts for r in mixed.collect())
