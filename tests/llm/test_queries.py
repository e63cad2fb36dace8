"""The registered queries against DuckDB, and the pipeline stage by stage."""

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from tests.compare import compare, connect
from tests.conftest import FOLDER
from tests.llm import brute
from tests.llm.test_near_copies import kept_ids
from tests.llm.test_operators import exact
from tokenloom.llm import queries


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_query_runs_and_equals_its_statement(spark, name):
    assert name in entry.queries()
    rows, _, problem = compare(spark, connect(FOLDER), FOLDER, name, queries.QUERIES[name], queries.ORACLE_SQL.get(name))
    assert problem is None and rows > 0


def stage(spark, k, docs):
    return pipeline.STAGES[k][1](spark, docs, FOLDER)


def test_pipeline_stages_equal_plain_versions(spark):
    rows = brute.HARD + duckdb.connect().sql(f"SELECT doc_id + 100, text, lang, source, n_chars FROM '{FOLDER}/documents.parquet'").fetchall()
    docs = brute.frame(spark, rows)
    kept = stage(spark, 0, docs)
    assert kept.columns == docs.columns
    got = [tuple(r)[:5] for r in kept.collect()]
    assert Counter(got) == Counter(r for r in rows if passes(r[1]))

    unique = stage(spark, 1, kept)
    want = [r for r, e in zip(got, exact(got), strict=True) if e[3]]
    assert unique.columns == docs.columns
    assert {r["doc_id"] for r in unique.collect()} == {r[0] for r in want}
    assert unique.count() == len({e[4] for e in exact(got)})

    left = [tuple(r)[:5] for r in unique.collect()]
    near = stage(spark, 2, unique)
    assert near.columns == docs.columns
    assert sorted(repr(r["doc_id"]) for r in near.collect()) == sorted(map(repr, kept_ids(left)))

    mixed = stage(spark, 3, near)
    assert mixed.columns == docs.columns
    sizes = [(r["source"], len(brute.WORD.findall(r["text"] or ""))) for r in near.collect()]
    found = mixed.collect()
    # every source ends at most half its border document from its target
    slack = sum(max(n for s, n in sizes if s == source) / 2 + 1 for source in {s for s, _ in sizes})
    assert abs(sum(len(brute.WORD.findall(r["text"])) for r in found) - sum(n for _, n in sizes)) <= slack
    whole = {(r["doc_id"], r["text"]) for r in near.collect()}
    assert all((r["doc_id"], r["text"]) in whole for r in found)
    packed = stage(spark, 4, mixed).collect()
    assert Counter(r["doc_id"] for r in packed if r["start"] == 0) == Counter(r["doc_id"] for r in found)


def passes(text):
    tokens, lines = brute.WORD.findall(text or ""), [x for x in (text or "").split("\n") if brute.WORD.search(x)]
    windows = Counter(tuple(tokens[i : i + 5]) for i in range(len(tokens) - 4))
    repeated = {i + k for i in range(len(tokens) - 4) if windows[tuple(tokens[i : i + 5])] > 1 for k in range(5)}
    n, chars = len(tokens), sum(map(len, tokens))
    letters = sum(c.isalpha() for c in text or "")
    capitals = sum(c.isupper() and c.isalpha() for c in text or "")
    return not (
        n < 10 or 100 * len(repeated) > 20 * n or chars < 2 * n or chars > 20 * n or 10 * sum(c in "#*$%&|<>" for c in text) > n
        or 10 * (len(lines) - len(set(lines))) > 3 * len(lines) or 10 * letters < 6 * chars or (10 * capitals > 5 * letters > 0)
    )


def test_whole_pipeline_runs(spark):
    assert pipeline.run(spark, FOLDER).count() > 0
