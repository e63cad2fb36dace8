"""The tokenizer contract, its failures, and what the dictionary makes of the results."""

import json

import pytest
from pyspark.sql import functions as F

from catalog.queries import BatchHash
from tests.conftest import rows
from tokenloom.operators import dictionary as dic, tokenize
from tokenloom.operators.contacts import tokenize_contacts_json
from tokenloom.operators.tokenize import (
    DictionaryTokenizer,
    HashTokenizer,
    Tokenizer,
    TokenCountMismatch,
    preload,
    preload_summary,
    progress_stats,
    reconcile_dictionary,
    response_to_rows,
    tokenize_or_lookup,
    tokenize_values,
)
from tokenloom.plans import outputs

DICT = "id bigint, vt_type int, raw_value string, token string, masking string, status int, retry_count int, last_error string"


class Service(Tokenizer):
    def call(self, vt_type, values):
        return [f"t{vt_type}-{v}" for v in values], [v[-2:] for v in values]


class Refuses(Tokenizer):
    """Fails for any batch that holds the value."""

    def __init__(self, value):
        self.value = value

    def call(self, vt_type, values):
        if self.value in values:
            raise OSError("refused " + "x" * 600)
        return [f"t-{v}" for v in values], None


class Short(Tokenizer):
    def call(self, vt_type, values):
        return ["one"], None


class Blank(Tokenizer):
    def call(self, vt_type, values):
        return ["" for _ in values], None


def pairs(spark, *values, vt_type=1):
    return spark.createDataFrame([(vt_type, v) for v in values], "vt_type int, raw_value string")


def test_values_are_sent_once_and_paired(spark):
    out = tokenize_values(pairs(spark, "aa", "bb", "aa"), Service(), batch=1)
    assert rows(out.select("raw_value", "token", "masking", "status")) == [("aa", "t1-aa", "aa", 1), ("bb", "t1-bb", "bb", 1)]


def test_a_failing_batch_becomes_failed_rows_only(spark):
    out = tokenize_values(pairs(spark, "a", "b", "c").coalesce(1), Refuses("b"), batch=1, retries=2, pause=0)
    assert rows(out.select("raw_value", "token", "status")) == [("a", "t-a", 1), ("b", None, 2), ("c", "t-c", 1)]
    assert len(out.filter("status = 2").first().error) == 500


def test_a_batch_is_all_or_nothing(spark):
    out = tokenize_values(pairs(spark, "a", "b", "c").coalesce(1), Refuses("b"), batch=10, retries=1, calls_at_once=1)
    assert {r.status for r in out.collect()} == {2}


def test_count_mismatch_is_an_error(spark):
    with pytest.raises(TokenCountMismatch):
        response_to_rows(1, ["a", "b"], ["x"], None)
    out = tokenize_values(pairs(spark, "a", "b"), Short(), retries=1, calls_at_once=1)
    assert {(r.status, r.error) for r in out.collect()} == {(2, "asked for 2 tokens, received 1")}


def test_missing_masks_are_null():
    assert response_to_rows(1, ["a", "b"], ["x", "y"], ["m"])["masking"].tolist() == ["m", None]


def test_lookup_first_then_the_service(spark):
    df = spark.createDataFrame([(1, "a", "stored"), (2, "a", None), (3, " b ", " "), (4, " ", None), (5, None, None)], "id int, raw string, token string")
    out = tokenize_or_lookup(df, "raw", "token", 1, Service())
    assert {r.id: r.token for r in out.collect()} == {1: "stored", 2: "t1-a", 3: "t1-b", 4: None, 5: None}
    assert {r.id: r.token for r in tokenize_or_lookup(df, "raw", "token", 1, DictionaryTokenizer()).collect()}[2] is None


def test_no_token_fails_the_job(spark):
    df = spark.createDataFrame([(1, "08012345678", None)], "id int, raw string, token string")
    with pytest.raises(Exception, match="no token for value 08012") as failure:
        tokenize_or_lookup(df, "raw", "token", 1, Blank()).collect()
    assert "08012345678" not in str(failure.value).split("JVM stacktrace")[0]


def test_seeding_twice_adds_nothing(spark, src):
    seeded = dic.seed_dictionary(src)
    assert dic.seed_dictionary(src, seeded).count() == 0


def test_preload_leaves_nothing_open_but_what_failed(spark):
    dictionary = spark.createDataFrame(
        [(1, 1, "a", None, None, 0, 0, None), (2, 1, "b", None, None, 0, 3, None), (3, 1, "x" * 129, None, None, 0, 0, None), (4, 2, "c", "old", None, 1, 0, None), (5, 1, "d", "kept", None, 2, 1, "e")], DICT
    )
    after = preload(dictionary, Refuses("b"), batch=1, retries=1)
    got = {r.id: (r.token, r.status, r.retry_count) for r in after.collect()}
    assert got == {1: ("t-a", 1, 0), 2: (None, 2, 4), 3: (None, 2, 1), 4: ("old", 1, 0), 5: ("kept", 2, 1)}
    summary = {r.vt_type: r for r in progress_stats(preload_summary(dictionary, after), 60).collect()}
    assert (summary[1].work, summary[1].remaining, summary[1].state, summary[1].rate_per_min) == (2, 0, "FAILED", 2.0)
    retried = preload(after, Service(), retry_failed=True)
    assert {r.id: r.status for r in retried.collect()} == {1: 1, 2: 1, 3: 2, 4: 1, 5: 1}


def test_claims_are_freed(spark):
    df = spark.createDataFrame([(1, 9), (2, 1)], "id int, status int")
    assert rows(dic.reset_claims(df)) == [(1, 0), (2, 1)]


def test_reconcile_classes(spark):
    class Answers(Tokenizer):
        known = {"same": "a", "changed": "b", "new": "a", "lost": "", "mask": "a"}

        def call(self, vt_type, values):
            if "broken" in values:
                raise OSError("down")
            return [self.known[v] for v in values], ["m"] * len(values)

    stored = [("same", "a", "m"), ("changed", "a", "m"), ("new", "", "m"), ("lost", "a", "m"), ("mask", "a", "other"), ("broken", "a", "m")]
    dictionary = spark.createDataFrame([(i, 1, raw, token, mask, 1, 0, None) for i, (raw, token, mask) in enumerate(stored)], DICT)
    out = reconcile_dictionary(dictionary, Answers(), include_blank_tokens=True, compare_masking=True, batch=1, retries=1)
    assert {r.raw_value: r["class"] for r in out.collect()} == {"same": "MATCH", "changed": "CHANGED", "new": "NEW", "lost": "LOST", "mask": "MASKING_ONLY", "broken": "API_ERROR"}


DOCS = [
    (1, '[{"name":"a","mobile":"0801","relation":1,"x":{"y":[1,2]}},{"mobile":null},{"mobile":"tok_ab"},{"mobile":""}]'),
    (2, ' {"z":1.50,"emergency_contacts":[{"mobile":"+2348","note":"a ] b"}],"a":"q\\"x"} '),
    (3, None), (4, " NULL "), (5, "hello"), (6, '{"a":1}'), (7, " "), (8, '{"emergency_contacts":null}'), (9, "[]"),
]


@pytest.mark.parametrize("tokenizer", [HashTokenizer(), Service()])
def test_contact_documents(spark, tokenizer):
    df = spark.createDataFrame(DOCS, "id int, info string")
    got = {r.id: r.info for r in tokenize_contacts_json(df, "info", tokenizer).collect()}
    first, second = json.loads(got[1]), json.loads(got[2])
    assert first[0]["mobile"] not in ("0801", "+234801") and first[0]["x"] == {"y": [1, 2]} and first[0]["name"] == "a"
    assert [c["mobile"] for c in first[1:]] == [None, "tok_ab", ""]
    assert second["z"] == 1.5 and second["a"] == 'q"x' and second["emergency_contacts"][0]["note"] == "a ] b"
    assert second["emergency_contacts"][0]["mobile"] != "+2348"
    assert [got[i] for i in (3, 4, 7, 9)] == ["[]"] * 4 and got[5] == "hello" and json.loads(got[6]) == {"a": 1}
    assert json.loads(got[8]) == {"emergency_contacts": None}


def test_contact_documents_use_the_dictionary_first(spark):
    dictionary = spark.createDataFrame([(1, 5, "+234801", "known", None, 1, 0, None)], DICT)
    df = spark.createDataFrame(DOCS[:1], "id int, info string")
    got = tokenize_contacts_json(df, "info", DictionaryTokenizer(), dictionary=dictionary).first().info
    assert json.loads(got)[0]["mobile"] == "known"


def test_results_replace_rows(spark):
    dictionary = spark.createDataFrame([(1, 1, "a", None, None, 0, 0, None), (2, 1, "b", "t", None, 1, 0, None)], DICT)
    new = spark.createDataFrame([(1, 1, "a", "t-a", None)], "id bigint, vt_type int, raw_value string, token string, masking string")
    assert rows(dic.replace_dict_rows(dictionary, new).select("id", "token", "status")) == [(1, "t-a", 1), (2, "t", 1)]
    assert dictionary.filter(F.col("token").isNull()).count() == 1


@pytest.mark.parametrize("output", ["user", "user_info", "application"])
def test_one_pass_of_the_tokenizer_for_all_columns(spark, tables, monkeypatch, output):
    """All token columns of an output are asked for together; a service gives what the plain hash gives."""
    src, passes, real = tables[1], [], tokenize.tokenize_values
    monkeypatch.setattr(tokenize, "tokenize_values", lambda values, *more, **options: passes.append(1) or real(values, *more, **options))
    run = {"user": outputs.user_output, "user_info": outputs.user_info_output, "application": outputs.application_output}[output]
    for phase in ("miss", "all"):
        passes.clear()
        asked = rows(run(src, phase, BatchHash()))
        assert len(passes) == 1
        assert asked == rows(run(src, phase, HashTokenizer()))


def test_shared_and_missing_values_of_several_columns(spark):
    data = [(1, "a", None, "b", None), (2, "a", "known", "a", " "), (3, " ", None, None, None), (4, "b", None, "a", "kept")]
    df = spark.createDataFrame(data, "id bigint, x string, x_token string, y string, y_token string")
    columns = {"x_token": ("x", 1), "y_token": ("y", 4)}
    got = {r["id"]: (r["x_token"], r["y_token"]) for r in tokenize.tokenize_columns(df, columns, BatchHash()).collect()}
    token = lambda kind, raw: BatchHash().call(kind, [raw])[0][0]
    assert got == {1: (token(1, "a"), token(4, "b")), 2: ("known", token(4, "a")), 3: (None, None), 4: (token(1, "b"), "kept")}
    requests = tokenize.lacking_values(df, columns, "id")
    assert "raw_value" not in tokenize.ask_once([requests], BatchHash()).columns
