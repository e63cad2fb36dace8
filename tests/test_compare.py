"""Comparison by digests, counts taken while writing, and replacement of a table that stops half-way."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tokenloom.plans import digests
from tokenloom.settings import Workspace, exists
from tokenloom.sources import sinks
from tokenloom.sources.changes import sent_time
from tokenloom.sources.observed import CountsWritten, RowsWritten
from tokenloom.sources.schemas import TARGET_KEYS
from tokenloom.sources.sinks import KeyedTable
from tokenloom.streaming import rebuild

KV = "k int, v string, w string"


def differences(spark, left, right, buckets=8):
    with Workspace(spark) as work:
        return rows(digests.digest_differences(work, left, right, ["k"], buckets))


def test_equal_tables_have_no_unlike_bucket(spark):
    one = spark.range(1000).selectExpr("cast(id AS int) AS k", "cast(id % 7 AS string) AS v", "cast(NULL AS string) AS w")
    other = one.orderBy(F.desc("k")).repartition(5)
    assert digests.unlike_buckets(one, other, ["k"]).count() == 0
    assert differences(spark, one, other) == []
    changed = one.withColumn("v", F.when(F.col("k") == 500, "x").otherwise(F.col("v")))
    assert digests.unlike_buckets(one, changed, ["k"], 64).count() == 1
    assert differences(spark, one, changed) == [(500, "3", None, "left", 1), (500, "x", None, "right", 1)]


@pytest.mark.parametrize(
    "left, right, found",
    [
        ([(1, None, "a")], [(1, "a", None)], [(1, "a", None, "right", 1), (1, None, "a", "left", 1)]),  # a NULL in another column
        ([(1, "a", "b")] * 3, [(1, "a", "b")], [(1, "a", "b", "left", 2)]),  # copies count
        ([], [(None, None, None)], [(None, None, None, "right", 1)]),  # a NULL key
        ([], [], []),
        ([(1, "ab", "c")], [(1, "a", "bc")], [(1, "a", "bc", "right", 1), (1, "ab", "c", "left", 1)]),
    ],
)
def test_differences(spark, left, right, found):
    assert differences(spark, spark.createDataFrame(left, KV), spark.createDataFrame(right, KV).select("w", "v", "k")) == found


def test_nested_values_are_compared_whole(spark):
    one = spark.sql("SELECT 1 AS k, named_struct('a', cast(NULL AS string), 'b', 'x') AS s, array('p', NULL) AS l")
    other = spark.sql("SELECT 1 AS k, named_struct('a', 'x', 'b', cast(NULL AS string)) AS s, array('p', NULL) AS l")
    with Workspace(spark) as work:
        assert digests.digest_differences(work, one, one, ["k"]).count() == 0
        assert digests.digest_differences(work, one, other, ["k"]).count() == 2
        line = digests.difference_summary(digests.digest_differences(work, one, other, ["k"]), "t").first()
    assert tuple(line) == ("t", 1, 1, "FAIL")


def test_rows_of_like_buckets_stay_where_they_are(spark, tmp_path):
    """Digests are reduced before they move, and rows meet only after a join with the unlike buckets."""
    spark.range(100).selectExpr("cast(id AS int) AS k", "cast(id AS string) AS v").write.parquet(f"{tmp_path}/t")
    plan = digests.bucket_digests(spark.read.parquet(f"{tmp_path}/t"), ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_sum" in plan[plan.index("Exchange"):]


def test_counts_come_from_the_write(spark, tmp_path):
    counts = CountsWritten("kind", [1, 2, 3], {"all_rows": F.lit(True), "odd": F.col("id") % 2 == 1})
    total = RowsWritten()
    df = spark.range(10).withColumn("kind", (F.col("id") % 2 + 1).cast("int"))
    total.watch(counts.watch(df)).write.parquet(f"{tmp_path}/a")
    assert rows(counts.rows(spark)) == [(1, 5, 0), (2, 5, 5), (3, 0, 0)] and total.count == 10
    none = RowsWritten()
    none.watch(spark.range(0)).write.parquet(f"{tmp_path}/b")
    assert none.count == 0


@pytest.mark.parametrize("stops_at", [1, 2])
def test_a_replacement_that_stops_is_read_and_finished(spark, tmp_path, monkeypatch, stops_at):
    path, one = f"{tmp_path}/t", lambda v: spark.createDataFrame([(1, v)], "k int, v string")
    sinks.materialize(one("first"), path, ["k"])
    moves, rename = [], sinks.rename

    def stopping(*args):
        moves.append(args)
        if len(moves) > stops_at:
            raise OSError("the driver is gone")
        rename(*args)

    monkeypatch.setattr(sinks, "rename", stopping)
    with pytest.raises(OSError):
        sinks.materialize(one("second"), path, ["k"])
    monkeypatch.undo()
    # until the old table is set aside readers see it, from then on the new one
    assert rows(spark.read.parquet(sinks.standing(spark, path))) == [(1, "first" if stops_at == 1 else "second")]
    sinks.settle(spark, path)
    assert rows(spark.read.parquet(path)) == [(1, "second")]
    assert not exists(spark, f"{path}.next") and not exists(spark, f"{path}.previous")
    assert sinks.standing(spark, f"{tmp_path}/never") is None


def test_times_as_debezium_sends_them(spark):
    noon = dt.datetime(2024, 5, 1, 12)
    sent = {
        "1714564800000": noon,
        "1714564800000000": noon,
        "1714564800000000000": noon,
        "2024-05-01T11:00:00Z": noon,
        "2024-05-01T13:00:00+02:00": noon,
        "2024-05-01 12:00:00": noon,
        "-1000": dt.datetime(1969, 12, 31, 23, 59, 59),
        "soon": None,
        "": None,
        None: None,
    }
    got = spark.createDataFrame([(v,) for v in sent], "v string").select("v", sent_time(F.col("v"), "Africa/Lagos").alias("t")).collect()
    assert {r.v: r.t for r in got} == sent


def test_deletes_look_at_the_keys_of_their_scope(spark, tmp_path):
    """A key whose newest row left the scope does not come back with an older one, and history is cut before it is grouped."""
    schema = "mobile string, app_id int, closed_time bigint, user_id bigint"
    table = KeyedTable(spark, f"{tmp_path}/user", TARGET_KEYS["user"])
    offset = 100_000_000
    table.upsert(spark.createDataFrame([("a", 1, 0, offset + 1), ("b", 1, 0, offset + 1), ("c", 1, 0, offset + 2)], schema), 0)
    table.upsert(spark.createDataFrame([("a", 1, 0, offset + 2)], schema), 1)
    scope = spark.createDataFrame([(1,)], "user_id bigint")
    with Workspace(spark) as work:
        stored = rebuild.stored_for("user", table, 2, scope, work.keep)
        assert rows(stored.select("mobile", "user_id")) == [("a", offset + 2), ("b", offset + 1)]
        nothing = stored.limit(0)
        assert rows(rebuild.gone_rows("user", stored, nothing, scope)) == [("b", 1, 0)]
        plan = stored._jdf.queryExecution().optimizedPlan().toString()
        assert "Aggregate" in plan and "LeftSemi" in plan[plan.index("Aggregate"):]
    assert rebuild.stored_for("user", KeyedTable(spark, f"{tmp_path}/none", TARGET_KEYS["user"]), 2, scope, None) is None


def test_refused_rows_name_their_rules(spark):
    from tokenloom.operators import conform

    schema = "user_id bigint, id_number string, full_name string, password string, live_image string, id_card string, info string"
    data = [(1, "a", "n", "", "", "", "{}"), (-2, "x" * 29, "n", None, "", "", "{}"), (None, None, None, None, None, None, None)]
    kept, refused = conform.split_conformed(spark.createDataFrame(data, schema), "user_info")
    assert [r.user_id for r in kept.collect()] == [1]
    found = {r.user_id: r.broken_rules for r in refused.collect()}
    assert found == {-2: ["user_id.unsigned", "id_number.max_chars_28"], None: ["user_id.not_null", "info.not_null"]}
    assert kept.columns + ["broken_rules"] == refused.columns
    empty = conform.split_conformed(spark.createDataFrame([], schema), "user_info")
    assert [df.count() for df in empty] == [0, 0]


def test_changes_of_one_trigger_are_one_rebuild(spark):
    from tests.test_streams import log
    from tokenloom.streaming.triggers import coalesced

    card = lambda at, owner: ("user_bank_info", "u", at, {"id": 1, "user_id": owner}, {"id": 1, "user_id": owner})
    changes = log(spark, card(0, 7), card(1, 7), card(1, 8), card(30, 7), ("user_bank_info", "d", 1, {"id": 2, "user_id": 8}, None), card(2, None))
    found = rows(coalesced("user_bankcard", changes, None, 10).select("user_id", "changes"))
    assert found == [(7, 1), (7, 2), (8, 2)]
