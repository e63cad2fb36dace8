"""The newest row per key, and the per-key aggregates that feed the wide tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.functions.documents import CONTACTS_TYPE, contact_object
from tokenloom.functions.text import has_text
from tokenloom.operators.predicates import default_bankcard, has_order_no, live_bankcard, paid_callback


def latest_by(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    columns: list[str] | None = None,
    where: Column | None = None,
) -> DataFrame:
    """One row per key: the one with the greatest ``order`` columns, NULL being the smallest.

    An aggregate rather than a ranking window: each task keeps one row per key before the
    exchange, so a key that owns most of the rows costs no more than any other.
    """
    if where is not None:
        df = df.filter(where)
    wanted = [c for c in (columns or df.columns) if c not in keys]
    newest = F.max_by(F.struct(*wanted), F.struct(*order)).alias("newest")
    return df.groupBy(*keys).agg(newest).select(*keys, "newest.*")


PROFILE_COLUMNS = [
    "bvn", "first_name", "sur_name", "date_of_birth", "education_level", "gender",
    "living_address_state", "living_address_city", "living_address_first_line",
    "living_address_second_line", "number_of_children", "marriage",
]
ADJUST_COLUMNS = [
    "network_name", "tracker_name", "campaign_tracker", "campaign_name", "creative_name",
    "adgroup_tracker", "creative_tracker", "adgroup_name",
]


def profile_latest(profiles: DataFrame) -> DataFrame:
    return latest_by(profiles, ["user_id"], ["id"], PROFILE_COLUMNS)


def bvn_latest(profiles: DataFrame) -> DataFrame:
    """The newest BVN that is there, which may be older than the newest profile."""
    return latest_by(profiles, ["user_id"], ["id"], ["bvn"], has_text("bvn"))


def default_card_latest(cards: DataFrame) -> DataFrame:
    columns = ["bank_code", "bank_holder", "bank_account"]
    return latest_by(cards, ["user_id"], ["id"], columns, default_bankcard())


def device_latest(devices: DataFrame) -> DataFrame:
    columns = ["session_uuid", "aaid"]
    return latest_by(devices, ["device_uuid"], ["id"], columns, has_text("device_uuid"))


def credit_latest(credits: DataFrame) -> DataFrame:
    return latest_by(credits, ["user_id"], ["create_time", "id"], ["credit_limit"])


def product_latest(orders: DataFrame) -> DataFrame:
    keyed = F.col("user_id").isNotNull() & has_text("product_id")
    return latest_by(orders, ["user_id", "product_id"], ["order_time", "id"], ["amount_max"], keyed)


def work_latest(work: DataFrame) -> DataFrame:
    columns = ["work_type", "occupation", "company_name", "monthly_income"]
    return latest_by(work, ["user_id"], ["id"], columns)


def bankcard_by_account(cards: DataFrame) -> DataFrame:
    trimmed = cards.filter(live_bankcard()).withColumn("bank_account", F.trim("bank_account"))
    return trimmed.groupBy("bank_account").agg(F.max("id").alias("bank_id"))


def adjust_latest(callbacks: DataFrame, columns: list[str] | None = None) -> DataFrame:
    named = F.coalesce(F.col("adid") != "", F.lit(False))
    return latest_by(callbacks, ["adid"], ["id"], columns or ADJUST_COLUMNS, named)


def app_latest(apps: DataFrame) -> DataFrame:
    return latest_by(apps, ["app_code"], ["id"], ["id", "app_name", "version"])


def device_profile(devices: DataFrame, network: DataFrame) -> DataFrame:
    """Per device: newest session, newest ad id, and the newest IP seen on the device itself or in
    its newest session.

    Either-or matching of network rows would be a nested loop over raw rows. Reducing the network
    rows to the newest per device and per session first gives the same IP with equi joins whose
    right sides hold one row per key, so nothing fans out.
    """
    seen = network.filter(has_text("ip")).select("device_uuid", "session_uuid", F.struct("create_time", "id", "ip").alias("seen"))
    newest = F.max("seen")
    by_device = seen.filter(has_text("device_uuid")).groupBy("device_uuid").agg(newest.alias("device_seen"))
    by_session = (
        seen.filter(has_text("session_uuid"))
        .groupBy(F.col("session_uuid").alias("seen_session"))
        .agg(newest.alias("session_seen"))
    )
    known = device_latest(devices)
    in_session = known.select("device_uuid", "session_uuid").join(
        by_session, F.col("session_uuid") == F.col("seen_session"), "inner"
    )
    facts = (
        known.join(by_device, "device_uuid", "full_outer")
        .join(in_session.select("device_uuid", "session_seen"), "device_uuid", "left")
    )
    return facts.select(
        "device_uuid",
        F.col("session_uuid").alias("session_id"),
        "aaid",
        F.greatest("device_seen", "session_seen")["ip"].alias("registration_ip"),
    )


def approval_latest_by_order(callbacks: DataFrame) -> DataFrame:
    timed = callbacks.filter(F.col("callback_time").isNotNull() & has_order_no())
    return timed.groupBy("order_no").agg(F.max("callback_time").alias("reviewed_time"))


def paid_latest_by_order(repays: DataFrame) -> DataFrame:
    return repays.filter(paid_callback()).groupBy("order_no").agg(F.max("callback_time").alias("last_paid_time"))


def paid_latest_by_order_period(repays: DataFrame) -> DataFrame:
    paid = repays.filter(paid_callback())
    return paid.groupBy("order_no", "current_period").agg(F.max("callback_time").alias("paid_at"))


def overdue_by_order(installments: DataFrame) -> DataFrame:
    worst = F.max(F.coalesce("is_overdue", F.lit(0)))
    return installments.groupBy("user_order_id").agg(worst.alias("is_overdue"))


def user_by_adid(users: DataFrame) -> DataFrame:
    return users.filter(has_text("adid")).groupBy("adid").agg(F.max("id").alias("user_id"))


def contacts_by_user(contacts: DataFrame, mobile: str = "mobile") -> DataFrame:
    """Per user one array of contacts, ordered by contact id. ``mobile`` names the finished
    number or token. The array is the output value itself."""
    entry = contact_object("contact_name", mobile, "contact_relationship")
    ordered = F.sort_array(F.collect_list(F.struct(F.col("id"), entry.alias("entry"))))
    array = F.transform(ordered, lambda c: c["entry"]).cast(CONTACTS_TYPE)
    return contacts.groupBy("user_id").agg(array.alias("emergency_contacts"))
