"""Change streams: hand-off, debounce, rebuild, replay, deletes."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tokenloom.functions.times import epoch_ms
from tokenloom.operators.tokenize import HashTokenizer
from tokenloom.plans import outputs
from tokenloom.sources import changes as feed
from tokenloom.sources.schemas import TARGET_KEYS
from tokenloom.sources.sinks import KeyedTable
from tokenloom.streaming import debounce as deb, enqueue, handoff, rebuild, triggers

HASH = HashTokenizer()
T0 = dt.datetime(2024, 5, 1, 12)


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def log(spark, *entries):
    """(table, op, seconds, before, after) tuples as a change log."""
    schema = feed.CHANGE_SCHEMA
    names = [part.split()[0] for part in feed.IMAGE.split(", ")]

    def image(values):
        return None if values is None else tuple(values.get(n) for n in names)

    data = [(table, op, at(s), i, image(before), image(after)) for i, (table, op, s, before, after) in enumerate(entries)]
    return spark.createDataFrame(data, schema)


# user, second, wait -> passes
DEBOUNCE = [(1, 0, 10, True), (1, 5, 10, False), (1, 9.999, 10, False), (1, 10, 10, True), (1, 15, 60, False), (1, 19, 5, True), (2, 5, 10, True), (1, 30, 60, False), (1, 79, 60, True)]


def events(spark, entries):
    return spark.createDataFrame([(u, at(s), w) for u, s, w, _ in entries], "user_id bigint, ts timestamp_ntz, wait_s int")


def passed(entries):
    return sorted((u, at(s)) for u, s, _, ok in entries if ok)


def test_debounce(spark):
    assert sorted(map(tuple, deb.debounce(events(spark, DEBOUNCE)).collect())) == passed(DEBOUNCE)


def test_debounce_does_not_depend_on_input_order_or_repeats(spark):
    twice = events(spark, DEBOUNCE[::-1]).union(events(spark, DEBOUNCE)).repartition(7)
    assert sorted(map(tuple, deb.debounce(twice).collect())) == passed(DEBOUNCE)


def test_debounce_continues_from_the_queue(spark):
    queue = spark.createDataFrame([(1, at(-4)), (3, at(0))], "user_id bigint, updated_at timestamp_ntz")
    got = deb.debounce(events(spark, DEBOUNCE), queue)
    assert sorted(map(tuple, got.collect())) == [(1, at(9.999)), (1, at(19)), (1, at(79)), (2, at(5))]


def fold(entries):
    """The rule, event by event."""
    last, out = {}, []
    for user, second, wait in sorted(entries):
        if user not in last or second - last[user] >= wait:
            last[user] = second
            out.append((user, at(second)))
    return out


def test_debounce_of_a_hot_user_is_spread(spark):
    """One user holds most events, over many blocks of time: no task has them all, and no Python runs."""
    dice = random.Random(4)
    entries, second = [], 0
    for _ in range(6000):
        second += dice.choice([1, 2, 3, 30])
        entries.append((1 if dice.random() < 0.8 else dice.randrange(2, 9), second, dice.choice([5, 10, 20])))
    found = events(spark, [(*e, None) for e in entries])
    assert sorted(map(tuple, deb.debounce(found).collect())) == fold(entries)
    placed = found.select("user_id", epoch_ms("ts", "UTC").alias("ms"), F.lit(5000).cast("bigint").alias("wait"), F.lit(False).alias("stored"))
    marked = deb._with_begins(placed, 20_000, deb.BLOCK_MS)
    held = marked.filter("user_id = 1").groupBy("block").count().collect()
    assert len(held) > 10 and max(r["count"] for r in held) < 1000
    plan = marked._jdf.queryExecution().toString()
    assert "hashpartitioning(user_id" in plan and "block" in plan and "Python" not in plan and "InPandas" not in plan


def test_debounce_follows_chains_without_a_rest(spark):
    """Runs that never rest, longer than a block, with waits that change and moments that repeat, next to a stored stamp."""
    dice = random.Random(9)
    entries = [(1, k * 4, dice.choice([5, 30, 60])) for k in range(2500)]
    entries += [(2, dice.randrange(9000), dice.choice([1, 10, 3600])) for _ in range(1500)]
    entries += [(3, k * 1800, 3600) for k in range(40)] + [(4, k * 3599, 3600) for k in range(9)]
    got = deb.debounce(events(spark, [(*e, None) for e in entries]))
    assert sorted(map(tuple, got.collect())) == fold(entries)
    queue = spark.createDataFrame([(1, at(50)), (2, at(4000)), (9, at(0))], "user_id bigint, updated_at timestamp_ntz")
    stamped = sorted([(*e, False) for e in entries] + [(1, 50, 0, True), (2, 4000, 0, True)], key=lambda e: (e[0], e[1], not e[3]))
    last, expected = {}, []
    for user, second, wait, stored in stamped:
        if stored or user not in last or second - last[user] >= wait:
            last[user] = second
            expected += [] if stored else [(user, at(second))]
    got = deb.debounce(events(spark, [(*e, None) for e in entries]), queue)
    assert sorted(map(tuple, got.collect())) == sorted(expected)
    assert deb.debounce(events(spark, [(*e, None) for e in entries]).limit(0)).count() == 0


def test_enqueue_rules(spark, src):
    some_user = src["user"].filter("adid <> ''").orderBy("id").first()
    entries = [
        ("user", "u", 0, {"id": 1, "device_id": "a"}, {"id": 1, "device_id": "a"}),
        ("user", "u", 1, {"id": 2, "device_id": None}, {"id": 2, "device_id": "b"}),
        ("user", "c", 2, None, {"id": 3}),
        ("user_personal_info", "u", 3, {"user_id": 4}, {"user_id": 5}),
        ("user_personal_info", "u", 4, {"user_id": 6}, {"user_id": 6}),
        ("risk_user_credit_callback", "c", 5, None, {"user_id": 7}),
        ("adjust_callback_record", "u", 6, {"adid": some_user.adid, "tracker_name": "x"}, {"adid": some_user.adid, "tracker_name": "x"}),
        ("user", "d", 7, {"id": 9}, None),
    ]
    got = rows(enqueue.enqueue_dirty(log(spark, *entries), src))
    assert got == [(2, at(1), 10), (3, at(2), 10), (4, at(3), 10), (5, at(3), 10), (6, at(4), 10), (7, at(5), 30)]
    moved = [("adjust_callback_record", "u", 6, {"adid": some_user.adid, "tracker_name": None}, {"adid": f" {some_user.adid} ", "tracker_name": "x"})]
    users = {r.user_id for r in enqueue.enqueue_dirty(log(spark, *moved), src).collect()}
    assert users == {r.id for r in src["user"].filter(F.col("adid") == some_user.adid).collect()}


def test_every_change_of_a_shared_value_counts(spark, src):
    """The stamp is that of the change that let the user through, not of the last one."""
    some = src["user"].filter("adid <> ''").orderBy("id").first()
    entries = [("adjust_callback_record", "c", s, None, {"adid": some.adid}) for s in (0, 30)]
    entries += [("user_personal_info", "c", 5, None, {"user_id": some.id})]
    got = {r.user_id: r.ts for r in deb.debounce(enqueue.enqueue_dirty(log(spark, *entries), src)).collect()}
    assert got[some.id] == at(0)


def test_start_position(spark, tmp_path):
    folder = str(tmp_path / "start")
    assert handoff.start_position(spark, folder) == ("initial", None)
    handoff.record_start(spark, folder, 1_714_557_600_000)
    assert handoff.start_position(spark, folder) == ("timestamp", 1_714_557_600_000)
    assert handoff.start_position(spark, folder, 5) == ("timestamp", 5)
    stamps = log(spark, ("user", "c", -1, None, {"id": 1}), ("user", "c", 0, None, {"id": 2}))
    noon_in_lagos = int(dt.datetime(2024, 5, 1, 11, tzinfo=dt.timezone.utc).timestamp() * 1000)
    kept = feed.select_changes(stamps, ["user"], "timestamp", noon_in_lagos, "Africa/Lagos")
    assert [r.after.id for r in kept.collect()] == [2]
    assert feed.select_changes(stamps, ["user"], "initial", None, "Africa/Lagos").count() == 2
    assert feed.select_changes(stamps, ["other"], "initial", None, "Africa/Lagos").count() == 0
    queue = stamps.select(F.col("after.id").alias("user_id"), F.col("ts").alias("updated_at"))
    assert [r.user_id for r in enqueue.drop_backlog(queue, noon_in_lagos).collect()] == [2]


def test_debezium_records(spark):
    record = {"payload": {"op": "r", "ts_ms": 1_714_561_200_000, "before": None, "after": {"id": 7, "adid": "a"}, "source": {"table": "user", "pos": 3}}}
    got = feed.debezium_changes(spark.createDataFrame([(json.dumps(record),)], "value string")).first()
    assert (got.source_table, got.op, got.position, got.after.id, got.before) == ("user", "c", 3, 7, None)
    assert got.ts == dt.datetime(2024, 5, 1, 12)
    assert feed.kafka_options("h", ["t"], "timestamp", 5, 10)["startingTimestamp"] == "5"
    assert feed.kafka_options("h", ["t"], "initial", None, 10)["startingOffsets"] == "earliest"
    with pytest.raises(ValueError):
        feed.kafka_options("h", ["t"], "timestamp", None, 10)


BULK = {
    "user": lambda s, phase: outputs.user_output(s, phase, HASH),
    "user_info": lambda s, phase: outputs.user_info_output(s, phase, HASH),
    "user_bankcard": lambda s, phase: outputs.bankcard_rows(s, phase, HASH),
    "application": lambda s, phase: outputs.application_output(s, phase, HASH),
}


@pytest.mark.parametrize("output", list(BULK))
def test_hit_and_miss_together_are_a_rebuild_of_everything(tables, output):
    _, src = tables
    hit, miss = BULK[output](src, "hit"), BULK[output](src, "miss")
    keys = TARGET_KEYS[output]
    assert hit.select(*keys).intersect(miss.select(*keys)).count() == 0
    # an ad id without a stored token is NULL in the hit phase and tokenised by a rebuild
    ignored = ["gaid_idfa"] if output == "application" else []
    scope = {
        "user": src["user"].select(F.col("id").alias("user_id")),
        "user_info": src["user"].select(F.col("id").alias("user_id")),
        "user_bankcard": src["user_bank_info"].select("user_id").distinct(),
        "application": src["user_order"].filter("order_no IS NOT NULL").select("user_id", "order_no").distinct(),
    }[output]
    rebuilt = rebuild.rebuild_scope(output, scope, src, HASH)
    assert rows(rebuilt.drop(*ignored)) == rows(hit.unionByName(miss).drop(*ignored))


@pytest.mark.parametrize("output", ["user", "user_bankcard", "user_product", "loan"])
def test_a_rebuild_gives_rows_of_the_bulk_load(spark, tables, output):
    _, src = tables
    first = src["user_order"].filter("risk_order_status = 10").orderBy("id").first()
    keys = {
        "user": spark.createDataFrame([(11,)], "user_id bigint"),
        "user_bankcard": src["user_bank_info"].filter("user_id = 21 OR user_id = 22").select(F.col("id").alias("bank_id")),
        "user_product": spark.createDataFrame([(first.user_id, first.product_id)], "user_id bigint, product_id string"),
        "loan": src["user_order_installment"].filter(F.col("user_order_id") == first.id).select(F.col("id").alias("installment_id")),
    }[output]
    everything = {
        "user": lambda: outputs.user_output(src, "all", HASH),
        "user_bankcard": lambda: outputs.bankcard_rows(src, "all", HASH),
        "user_product": lambda: outputs.product_output(src),
        "loan": lambda: outputs.loan_output(src),
    }[output]()
    got = rows(rebuild.rebuild_rows(output, keys, src, HASH))
    assert got and set(got) <= set(rows(everything))


def test_change_to_an_order_reaches_its_application(spark, src):
    order = src["user_order"].filter("length(trim(order_no)) > 0").orderBy("id").first()
    owner = src["user"].filter(F.col("id") == order.user_id).first()
    entries = {
        "user_repay": {"order_no": order.order_no, "current_period": 1},
        "user_order_installment": {"user_order_id": order.id},
        "user_bank_info": {"user_id": order.user_id},
        "risk_user_approval_callback": {"order_no": order.order_no},
    }
    if owner.device_id:
        entries["device_ids"] = {"device_uuid": owner.device_id}
    for table, image in entries.items():
        keys = triggers.trigger_keys("application", log(spark, (table, "c", 0, None, image)), src)
        assert order.id in {r.order_id for r in keys.collect()}, table


def stream_of(spark, folder, changes):
    changes.coalesce(1).write.mode("append").parquet(folder)
    return feed.scan_changes(spark, folder)


def test_stream_rebuilds_and_a_replay_changes_nothing(spark, tables, tmp_path):
    _, src = tables
    table = KeyedTable(spark, str(tmp_path / "user"), TARGET_KEYS["user"])
    job = rebuild.RebuildJob("user", lambda: src, table, HASH)
    changed = log(spark, ("user", "u", 0, {"id": 11}, {"id": 11}), ("user", "u", 1, {"id": 12}, {"id": 12}), ("user", "u", 2, {"id": 11}, {"id": 11}))
    stream = stream_of(spark, str(tmp_path / "in"), changed)
    rebuild.start(job, stream, str(tmp_path / "cp"), None).awaitTermination()
    once = rows(table.read())
    assert once and set(once) <= set(rows(outputs.user_output(src, "all", HASH)))
    job.run_batch(changed, 0)
    assert rows(table.read()) == once
    more = log(spark, ("user", "c", 3, None, {"id": 13}))
    rebuild.start(job, stream_of(spark, str(tmp_path / "in"), more), str(tmp_path / "cp"), None).awaitTermination()
    assert len(table.read().collect()) > len(once) or set(once) <= set(rows(table.read()))


def test_cards_keep_their_ids(spark, tables, tmp_path):
    _, src = tables
    table = KeyedTable(spark, str(tmp_path / "cards"), TARGET_KEYS["user_bankcard"])
    job = rebuild.RebuildJob("user_bankcard", lambda: src, table, HASH)
    card = src["user_bank_info"].filter("deleted = 0 AND length(trim(bank_account)) > 0").orderBy("id").first()
    change = log(spark, ("user_bank_info", "u", 0, {"id": card.id, "user_id": card.user_id}, {"id": card.id, "user_id": card.user_id}))
    job.run_batch(change, 0)
    before = rows(table.read())
    job.run_batch(change, 1)
    assert before and rows(table.read()) == before


def test_deletes(spark, tables, tmp_path):
    _, src = tables
    card = src["user_bank_info"].filter("deleted = 0 AND length(trim(bank_account)) > 0").orderBy("id").first()
    change = log(spark, ("user_bank_info", "u", 0, {"id": card.id, "user_id": card.user_id}, {"id": card.id, "user_id": card.user_id}))
    without = src.using(user_bank_info=src["user_bank_info"].filter(F.col("user_id") != card.user_id))
    gone = log(spark, ("user_bank_info", "d", 1, {"id": card.id, "user_id": card.user_id}, None))
    for propagate in (False, True):
        table = KeyedTable(spark, str(tmp_path / f"cards{propagate}"), TARGET_KEYS["user_bankcard"])
        rebuild.RebuildJob("user_bankcard", lambda: src, table, HASH, propagate_deletes=propagate).run_batch(change, 0)
        kept = table.read().count()
        assert kept > 0
        rebuild.RebuildJob("user_bankcard", lambda: without, table, HASH, propagate_deletes=propagate).run_batch(gone, 1)
        assert table.read().count() == (0 if propagate else kept)


def test_profile_job_rests_between_rebuilds(spark, tables, tmp_path):
    _, src = tables
    table = KeyedTable(spark, str(tmp_path / "info"), ["user_id"])
    queue = KeyedTable(spark, str(tmp_path / "queue"), ["user_id"])
    job = rebuild.ProfileJob(lambda: src, table, queue, HASH)
    job.run_batch(log(spark, ("user", "c", 0, None, {"id": 11}), ("user_personal_info", "u", 3, {"user_id": 11}, {"user_id": 11})), 0)
    assert rows(queue.read()) == [(11, at(0))]
    job.run_batch(log(spark, ("user_personal_info", "u", 9, {"user_id": 11}, {"user_id": 11})), 1)
    assert rows(queue.read()) == [(11, at(0))]
    for _ in range(2):
        job.run_batch(log(spark, ("user_personal_info", "u", 12, {"user_id": 11}, {"user_id": 11})), 2)
        assert rows(queue.read()) == [(11, at(12))]
    assert [r.user_id for r in table.read().collect()] == [100000011]
