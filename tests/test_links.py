"""Identity edges that follow changes must equal a bulk load of the tables as they are then."""

import pytest
from pyspark.sql import functions as F

from catalog import queries as catalog
from tests.conftest import FOLDER, rows
from tests.test_streams import log
from tokenloom.plans.edges import LINK_KEY, keyed_edges
from tokenloom.settings import Workspace
from tokenloom.sources.schemas import TARGET_KEYS
from tokenloom.sources.sinks import KeyedTable
from tokenloom.streaming import links as link_jobs


@pytest.fixture
def kept(spark, tables, tmp_path):
    """(tables, links, target) after a bulk load."""
    links = KeyedTable(spark, str(tmp_path / "links"), LINK_KEY)
    target = KeyedTable(spark, str(tmp_path / "id_mapping"), TARGET_KEYS["id_mapping"])
    link_jobs.load_links(tables[1], links, target)
    return tables[1], links, target


def follow(kept, now, change, batch_id=1):
    _, links, target = kept
    link_jobs.LinkJob(lambda: now, target, links).run_batch(change, batch_id)
    after = rows(target.read())
    assert after == rows(keyed_edges(now))
    return after


def test_bulk_load_equals_the_edges(kept):
    src, links, target = kept
    assert rows(target.read()) == rows(keyed_edges(src))
    assert links.read().agg(F.min("n")).first()[0] >= 1


def test_a_pair_goes_with_its_last_statement(spark, kept):
    """Two users state the same pair; it stays until the second one stops, and a user's own pairs go with its statements."""
    src, links, target = kept
    one, two = (r["id"] for r in links.read().filter("owner LIKE 'user:%'").select(F.substring("owner", 6, 20).cast("long").alias("id")).distinct().orderBy("id").limit(2).collect())
    first = src["user"].filter(F.col("id") == one).first()
    alike = lambda c: F.when(F.col("id") == two, F.lit(first[c])).otherwise(F.col(c))
    twins = src["user"].withColumns({c: alike(c) for c in ("mobile", "app_code", "device_id")})
    moved = {"id": two, "device_id": src["user"].filter(F.col("id") == two).first().device_id}
    both = src.using(user=twins)
    before = follow(kept, both, log(spark, ("user", "u", 0, moved, {"id": two, "device_id": first.device_id})))
    owners = links.read().groupBy("low", "high", "app_id").agg(F.count("*").alias("n")).filter("n > 1")
    assert owners.count() >= 1

    def without(*ids):
        change = log(spark, *[(t, "d", k, {"user_id": u, "id": 1}, None) for t in ("user_order", "user_bank_info") for k, u in enumerate(ids)])
        return both.using(**{t: src[t].filter(~F.col("user_id").isin(*ids)) for t in ("user_order", "user_bank_info")}), change

    half = follow(kept, *without(one), 2)
    after = follow(kept, *without(one, two), 3)
    assert len(after) < len(half) < len(before)
    assert follow(kept, *without(one, two), 3) == after  # the same batch again
    back = log(spark, *[(t, "c", k, None, {"user_id": u, "id": 1}) for t in ("user_order", "user_bank_info") for k, u in enumerate((one, two))])
    assert follow(kept, both, back, 4) == before


def test_users_move_between_devices_and_apps(spark, kept):
    src, _, _ = kept
    people = src["user"].filter("device_id IS NOT NULL").orderBy("id").limit(6).collect()
    moved = {p.id: people[k - 1].device_id for k, p in enumerate(people)}
    named = F.create_map(*(F.lit(x) for pair in moved.items() for x in pair))
    now = src["user"].withColumn("device_id", F.coalesce(named[F.col("id")], F.col("device_id")))
    now = now.withColumn("app_code", F.when(F.col("id") == people[0].id, "7").otherwise(F.col("app_code")))
    change = log(spark, *[("user", "u", k, {"id": p.id, "device_id": p.device_id}, {"id": p.id, "device_id": moved[p.id]}) for k, p in enumerate(people)])
    follow(kept, src.using(user=now), change)


def test_devices_and_tokens_change(spark, kept):
    src, _, target = kept
    device = src["device_ids"].filter("aaid IS NOT NULL AND device_uuid IN (SELECT 'dev-' || id FROM range(1, 400))").orderBy("id").first()
    devices = src["device_ids"].filter(F.col("device_uuid") != device.device_uuid)
    follow(kept, src.using(device_ids=devices), log(spark, ("device_ids", "d", 0, {"device_uuid": device.device_uuid}, None)))
    known = src["vt_token_cache"].filter("status = 1 AND vt_type IN (1, 2, 3, 4)").groupBy("vt_type").agg(F.min("raw_value").alias("raw_value")).collect()
    same = [(F.col("vt_type") == k.vt_type) & (F.col("raw_value") == k.raw_value) for k in known]
    hit = same[0] | same[1] | same[2] | same[3] if len(same) == 4 else pytest.fail("a kind without tokens")
    tokens = src["vt_token_cache"].withColumn("token", F.when(hit, F.concat(F.lit("new-"), "raw_value")).otherwise(F.col("token")))
    now = src.using(device_ids=devices, vt_token_cache=tokens)
    after = follow(kept, now, log(spark, *[("vt_token_cache", "u", k, None, {"vt_type": v.vt_type, "raw_value": v.raw_value}) for k, v in enumerate(known)]), 2)
    assert any(r[0].startswith("new-") for r in after)
    lost = now.using(vt_token_cache=tokens.filter(~hit))
    after = follow(kept, lost, log(spark, *[("vt_token_cache", "d", k, {"vt_type": v.vt_type, "raw_value": v.raw_value}, None) for k, v in enumerate(known)]), 3)
    assert not any(r[0].startswith("new-") for r in after)


def test_an_empty_batch_changes_nothing(spark, kept):
    src, links, target = kept
    before, parts = rows(target.read()), rows(links.read())
    assert follow(kept, src, log(spark, ("user_order", "u", 0, {"user_id": -1}, {"user_id": -1}))) == before
    assert rows(links.read()) == parts


def test_the_registered_query_has_edges_to_drop_and_to_add(spark):
    c = catalog.Context(spark, FOLDER)
    before, after = set(rows(keyed_edges(catalog._earlier(c)).drop("event_time"))), set(rows(keyed_edges(c.src).drop("event_time")))
    assert before - after and after - before


def test_a_batch_reads_only_the_parts_it_needs(spark, kept):
    """Links and edges of other owners are cut before history is grouped."""
    src, links, _ = kept
    some = spark.createDataFrame([("user:1",)], "owner string")
    plan = links.read(keys=some)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate") < plan.index("LeftSemi")
