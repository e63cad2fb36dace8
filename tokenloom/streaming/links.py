"""Identity edges that follow changes.

An edge may rest on many statements: orders, registrations and cards of users, and devices. Every owner of statements (a user
or a device) has its own part in the table of links: for each pair its best statement and how many there are. A change replaces the parts of
the owners it touches. For the pairs that are in an old or a new part the winner is taken anew over all their owners, and a pair that
no owner states any more leaves the output, in both directions.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.functions.codes import VT_TYPES
from tokenloom.functions.text import blank_to_null, has_text, normalize_mobile
from tokenloom.plans.edges import LINK_KEY, PAIR_KEY, best_links, device_owner, device_pairs, directed, linked_pairs, owned_links, user_owner, user_pairs
from tokenloom.settings import DEFAULT, Settings, Workspace
from tokenloom.sources.keyed import only
from tokenloom.sources.sinks import KeyedTable
from tokenloom.sources.tables import Sources
from tokenloom.streaming.rebuild import Keep, dictionary_rows, for_users
from tokenloom.streaming.triggers import touched

# The tables that identity edges are drawn from.
LINK_TABLES = ["user", "user_order", "user_bank_info", "user_personal_info", "device_ids", "vt_token_cache"]


def _distinct(parts: list[DataFrame], key: str) -> DataFrame:
    return reduce(DataFrame.unionByName, [p.select(F.col(p.columns[0]).alias(key)) for p in parts]).dropna().distinct()


def _holders(values: DataFrame, kind: str, rows: DataFrame, value, key: str) -> DataFrame:
    """Keys of the rows that hold a changed dictionary value of a kind."""
    wanted = values.filter(F.col("vt_type") == VT_TYPES[kind]).select(F.col("value").alias("wanted_value")).distinct()
    named = rows.select(F.col(key), value.alias("held_value"))
    return named.join(wanted, F.col("held_value") == F.col("wanted_value"), "left_semi").select(key)


def stale_owners(changes: DataFrame, sources: Sources, keep: Keep) -> tuple[DataFrame, DataFrame]:
    """(user_id) and (device_uuid) whose statements a set of changes may alter."""
    users, devices = sources["user"], sources["device_ids"]
    values = touched(changes, "vt_token_cache", vt_type="vt_type", raw="raw_value").select("vt_type", blank_to_null("raw").alias("value"))
    values = keep(values.filter("value IS NOT NULL"))
    own = keep(_distinct([touched(changes, "user", id="id")], "user_id"))
    device_ids = _distinct(
        [
            touched(changes, "device_ids", device="device_uuid"),
            touched(changes, "user", device="device_id"),
            only(users, "id", own).select("device_id"),
            _holders(values, "gaid_idfa", devices, blank_to_null("aaid"), "device_uuid"),
            _holders(values, "gaid_idfa", devices, blank_to_null("idfa"), "device_uuid"),
        ],
        "device_uuid",
    )
    device_ids = keep(device_ids.filter(has_text("device_uuid")))
    user_ids = _distinct(
        [
            own,
            *(touched(changes, table, id="user_id") for table in ("user_order", "user_bank_info", "user_personal_info")),
            only(users, "device_id", device_ids).select("id"),
            _holders(values, "mobile", users, normalize_mobile("mobile"), "id"),
            _holders(values, "gaid_idfa", users, blank_to_null("gps_adid"), "id"),
            _holders(values, "gaid_idfa", users, blank_to_null("idfa"), "id"),
            _holders(values, "bank_account", sources["user_bank_info"], blank_to_null("bank_account"), "user_id"),
            _holders(values, "id_number", sources["user_personal_info"], blank_to_null("bvn"), "user_id"),
        ],
        "user_id",
    )
    return keep(user_ids), device_ids


def links_of(users: DataFrame, devices: DataFrame, sources: Sources, keep: Keep, settings: Settings = DEFAULT) -> DataFrame:
    """The parts of some users and devices, from the tables cut to them."""
    own = for_users(sources, users, keep)
    own = own.using(user_order=only(sources["user_order"], "user_id", users))
    seen = keep(only(sources["device_ids"], "device_uuid", devices))
    ad_ids = seen.select(F.explode(F.array(blank_to_null("aaid"), blank_to_null("idfa"))).alias("raw_value")).dropna().distinct()
    ad_ids = ad_ids.withColumn("vt_type", F.lit(VT_TYPES["gaid_idfa"]))
    held = sources.using(
        device_ids=seen, user=only(sources["user"], "device_id", devices), vt_token_cache=dictionary_rows(sources["vt_token_cache"], keep(ad_ids))
    )
    return owned_links(user_pairs(own, settings).unionByName(device_pairs(held, settings)))


def load_links(sources: Sources, links: KeyedTable, target: KeyedTable, batch_id: int = 0, settings: Settings = DEFAULT) -> None:
    """A bulk load: the parts of all owners, and the edges they give."""
    links.upsert(owned_links(linked_pairs(sources, settings)), batch_id)
    target.upsert(directed(best_links(links.read(before=batch_id + 1))), batch_id)


class LinkJob:
    """What a change stream does with each micro-batch. A batch that runs again starts from the parts as they were before it."""

    def __init__(self, sources_now: Callable[[], Sources], target: KeyedTable, links: KeyedTable, settings: Settings = DEFAULT):
        self.sources_now, self.target, self.links, self.settings = sources_now, target, links, settings

    def run_batch(self, batch: DataFrame, batch_id: int) -> None:
        sources = self.sources_now()
        with Workspace(batch.sparkSession) as work:
            users, devices = stale_owners(batch, sources, work.keep)
            owners = users.select(user_owner(F.col("user_id")).alias("owner")).union(devices.select(device_owner(F.col("device_uuid"))))
            owners = work.keep(owners)
            new = work.keep(links_of(users, devices, sources, work.keep, self.settings))
            stored = self.links.read(before=batch_id, keys=owners)
            old = new.limit(0) if stored is None else work.keep(stored)
            self.links.apply(new, old.select(*LINK_KEY), batch_id)
            pairs = work.keep(old.select(*PAIR_KEY).union(new.select(*PAIR_KEY)).distinct())
            every = self.links.read(before=batch_id + 1, keys=pairs)
            best = work.keep(best_links(every))
            gone = pairs.join(best, PAIR_KEY, "left_anti")
            ends = F.explode(F.array(F.struct(F.col("low").alias("id"), F.col("high").alias("mapping_id")), F.struct(F.col("high").alias("id"), F.col("low").alias("mapping_id"))))
            self.target.apply(directed(best), gone.select("app_id", ends.alias("e")).select("e.id", "app_id", "e.mapping_id"), batch_id)
