"""Events that many users share: looked at once, with the results of one row per user and event."""

import datetime as dt
import random

from pyspark.sql import functions as F

from tests.conftest import rows
from tokenloom.streaming import debounce as deb
from tokenloom.streaming.shared import Dirty

T0 = dt.datetime(2024, 5, 1, 12)


def moment(dice, seconds):
    """Some moments repeat, some differ by less than a millisecond, some are missing."""
    if dice.random() < 0.01:
        return None
    return T0 + dt.timedelta(seconds=dice.randrange(seconds), microseconds=dice.choice([0, 0, 300, 250_000]))


def drawn(spark, seed, gap):
    """Few values with many events and users, own events of some users; two users have two values, and one has its own events alone."""
    dice, seconds = random.Random(seed), 40_000
    shared = {(f"v{dice.randrange(4)}", moment(dice, seconds), dice.choice([20, 60])) for _ in range(seconds // gap)} | {("alone", T0, 60)}
    members = {(f"v{u % 4}", u) for u in range(24)} | {("v1", 0), ("v2", 1), ("nobody", 3)}
    own = [(dice.choice([2, 3, 4, 5, 6, 99]), moment(dice, seconds), dice.choice([10, 30])) for _ in range(200)]
    own += [(7, T0 + dt.timedelta(seconds=k * 7), 10) for k in range(900)]
    return Dirty(
        spark.createDataFrame(own, "user_id bigint, ts timestamp_ntz, wait_s int"),
        spark.createDataFrame(sorted(shared, key=repr), "value string, ts timestamp_ntz, wait_s int"),
        spark.createDataFrame(sorted(members), "value string, user_id bigint"),
    )


def test_shared_events_pass_as_one_row_per_user_and_event_would(spark):
    dirty = drawn(spark, 2, 40)
    assert rows(dirty.users()) == rows(dirty.rows().select("user_id").distinct())
    expected = rows(deb.debounce(dirty.rows()))
    assert rows(deb.debounce(dirty)) == expected and len(expected) == len(set(expected))


def test_shared_events_continue_from_the_queue(spark):
    dirty = drawn(spark, 4, 9)
    stamps = [(u, T0 + dt.timedelta(seconds=1000 * u + 3)) for u in range(0, 24, 2)] + [(98, T0)]
    queue = spark.createDataFrame(stamps, "user_id bigint, updated_at timestamp_ntz")
    assert rows(deb.debounce(dirty, queue)) == rows(deb.debounce(dirty.rows(), queue))
    nothing = Dirty(dirty.own.limit(0), dirty.shared.limit(0), dirty.members.limit(0))
    assert deb.debounce(nothing).count() == 0


def test_debounce_keeps_little_when_many_users_share_a_value(spark):
    """Three hundred users of one value with three hundred events: what is kept on the way follows events and users, not their product."""
    kept = []

    def keep(df):
        df = df.localCheckpoint()
        kept.append(df.count())
        return df

    shared = spark.range(300).select(F.lit("v").alias("value"), (F.lit(T0) + F.make_dt_interval(secs=F.col("id") * 100)).cast("timestamp_ntz").alias("ts"), F.lit(60).alias("wait_s"))
    members = spark.range(300).select(F.lit("v").alias("value"), F.col("id").alias("user_id"))
    own = shared.limit(1).select(F.lit(5).cast("bigint").alias("user_id"), "ts", F.lit(10).alias("wait_s"))
    assert deb.debounce(Dirty(own, shared, members), keep=keep).count() == 300 * 300
    assert max(kept) <= 300


def test_written_events_of_a_value_follow_each_other(spark, tmp_path):
    """Rows of a value come in tiles, so pairs of events and users take far less than a byte and a half each on disk."""
    shared = spark.range(6000).select(F.lit("v").alias("value"), (F.lit(T0) + F.make_dt_interval(secs=F.col("id") * 100)).cast("timestamp_ntz").alias("ts"), F.lit(60).alias("wait_s"))
    members = spark.range(1500).select(F.lit("v").alias("value"), F.col("id").alias("user_id"))
    dirty = Dirty(shared.limit(0).select(F.lit(5).cast("bigint").alias("user_id"), "ts", "wait_s"), shared, members)
    dirty.rows().write.parquet(str(tmp_path / "rows"))
    assert spark.read.parquet(str(tmp_path / "rows")).count() == 6000 * 1500
    assert sum(p.stat().st_size for p in (tmp_path / "rows").glob("*.parquet")) < 6000 * 1500 / 3


def test_touched_users_are_found_without_pairing_them_with_events(spark):
    dirty = drawn(spark, 6, 300)
    plan = dirty.users()._jdf.queryExecution().optimizedPlan().toString()
    assert "Inner" not in plan and "Generate" not in plan
    assert {r.user_id for r in dirty.users().collect()} == {*range(24)} | {99}
