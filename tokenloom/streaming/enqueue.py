"""From source changes to the users whose profile must be rebuilt."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.functions.codes import VT_TYPES
from tokenloom.functions.text import has_text
from tokenloom.operators.lookups import sharers_of_adid, users_of_bvn, users_of_contact
from tokenloom.operators.predicates import changed
from tokenloom.settings import DEFAULT
from tokenloom.sources.changes import start_time
from tokenloom.streaming.shared import Dirty

# Seconds a user rests after being queued, by what changed.
WAIT_SECONDS = {
    "user": 10,
    "user_personal_info": 10,
    "user_work_related": 10,
    "user_emergency_contact": 10,
    "risk_user_credit_callback": 30,
    "vt_token_cache": 60,
    "adjust_callback_record": 60,
}
# The only user columns whose update matters.
WATCHED_USER_COLUMNS = ("app_code", "device_id", "adid", "create_time")


def enqueue_dirty(changes: DataFrame, sources, grouped: bool = False) -> DataFrame | Dirty:
    """(user_id, ts, wait_s) for every user a change touches.

    Changes of a shared value (an advertising id, a dictionary entry) touch all users with it. Each one
    counts, as which of them lets a user through depends on that user's stamp; changes of a value
    at the same moment are one. With ``grouped`` the changes of an advertising id and its users stay apart, for a reader
    that need not see each pair of them.
    """
    created, updated = F.col("op") == "c", F.col("op") == "u"

    def of(table: str, condition: Column) -> DataFrame:
        rows = changes.filter((F.col("source_table") == table) & (created | updated) & condition)
        return rows.withColumn("wait_s", F.lit(WAIT_SECONDS[table]))

    def users(rows: DataFrame, user_id: Column) -> DataFrame:
        return rows.select(user_id.alias("user_id"), "ts", "wait_s")

    always = F.lit(True)
    parts = [users(of("user", created | changed(*WATCHED_USER_COLUMNS)), F.col("after.id"))]

    moved = updated & ~F.col("before.user_id").eqNullSafe(F.col("after.user_id"))
    parts += [users(of("user_personal_info", moved), F.col("before.user_id"))]
    for table in ("user_personal_info", "user_work_related", "user_emergency_contact", "risk_user_credit_callback"):
        parts.append(users(of(table, always), F.col("after.user_id")))

    values = of("vt_token_cache", has_text("after.raw_value")).select("ts", "wait_s", "after.vt_type", "after.raw_value")
    for kind, find, table in (
        ("id_number", users_of_bvn, "user_personal_info"),
        ("emergency_contact", users_of_contact, "user_emergency_contact"),
    ):
        rows = values.filter(F.col("vt_type") == VT_TYPES[kind]).drop("vt_type")
        parts.append(find(rows, sources[table]).select("user_id", "ts", "wait_s"))

    adjust = of("adjust_callback_record", has_text("after.adid") & (created | changed("tracker_name")))
    adjust = adjust.select("ts", "wait_s", "after.adid")
    shared, members = sharers_of_adid(adjust, sources["user"])
    own = reduce(DataFrame.unionByName, parts)
    found = Dirty(own.filter("user_id IS NOT NULL"), shared, members.filter("user_id IS NOT NULL"))
    return found if grouped else found.rows()


def merge_queue_shards(shards: list[DataFrame], queue: DataFrame | None = None) -> DataFrame:
    """One queue out of several, the latest stamp per user."""
    parts = shards if queue is None else [*shards, queue]
    stamps = reduce(DataFrame.unionByName, [p.select("user_id", "updated_at") for p in parts])
    return stamps.groupBy("user_id").agg(F.max("updated_at").alias("updated_at"))


def drop_backlog(queue: DataFrame, start_ms: int, zone: str = DEFAULT.zone) -> DataFrame:
    """Entries from before the bulk load began, which the bulk load covers, are dropped."""
    return queue.filter(F.col("updated_at") >= start_time(start_ms, zone))
