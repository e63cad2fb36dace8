"""Which output rows a set of changes makes stale."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.functions.codes import VT_TYPES
from tokenloom.functions.text import blank_to_null, has_text
from tokenloom.operators.lookups import users_of_adid
from tokenloom.operators.predicates import live_bankcard

# The tables whose changes matter to an output.
TRIGGER_TABLES = {
    "user": ["user", "adjust_callback_record"],
    "user_bankcard": ["user_bank_info", "vt_token_cache"],
    "user_product": ["user_order"],
    "application": [
        "user_order", "user", "user_bank_info", "user_personal_info", "device_ids",
        "user_repay", "risk_user_approval_callback", "user_order_installment",
    ],
    "loan": ["user_order_installment", "user_order", "user_repay"],
}


def touched(changes: DataFrame, table: str, **columns: str) -> DataFrame:
    """Distinct values of some columns in the old and new images of a table's changed rows; a
    missing image gives NULLs. Only these columns of the images are read."""
    def image(side: str) -> Column:
        return F.struct(*[F.col(f"{side}.{c}").alias(name) for name, c in columns.items()])

    rows = changes.filter(F.col("source_table") == table)
    return rows.select(F.inline(F.array(image("before"), image("after")))).distinct()


def _union(parts: list[DataFrame], keys: list[str]) -> DataFrame:
    every = reduce(DataFrame.unionByName, [p.select(*keys) for p in parts])
    return every.dropna(subset=keys).distinct()


def user_keys(changes: DataFrame, sources) -> DataFrame:
    own = touched(changes, "user", user_id="id")
    by_adid = users_of_adid(touched(changes, "adjust_callback_record", adid="adid"), sources["user"])
    return _union([own, by_adid], ["user_id"])


def bankcard_keys(changes: DataFrame, sources) -> DataFrame:
    """A changed dictionary value refreshes every live card with that account."""
    own = touched(changes, "user_bank_info", bank_id="id")
    values = touched(changes, "vt_token_cache", vt_type="vt_type", account="raw_value")
    values = values.filter(F.col("vt_type") == VT_TYPES["bank_account"]).select(blank_to_null("account").alias("account"))
    cards = sources["user_bank_info"].filter(live_bankcard()).select(F.col("id").alias("bank_id"), F.trim("bank_account").alias("account"))
    return _union([own, cards.join(values.distinct(), "account", "left_semi")], ["bank_id"])


def product_keys(changes: DataFrame, sources=None) -> DataFrame:
    keys = touched(changes, "user_order", user_id="user_id", product_id="product_id")
    return _union([keys.filter(has_text("product_id"))], ["user_id", "product_id"])


def _orders_where(sources, keys: DataFrame, column: str) -> DataFrame:
    orders = sources["user_order"].select(F.col("id").alias("order_id"), F.col(column).alias("match"))
    wanted = keys.select(F.col(keys.columns[0]).alias("match")).filter("match IS NOT NULL").distinct()
    return orders.join(wanted, "match", "left_semi").select("order_id")


def application_keys(changes: DataFrame, sources) -> DataFrame:
    """Orders are looked up in the whole order table, so an order that never changed while the
    stream ran is found as well."""
    users = _union(
        [
            touched(changes, "user", user_id="id"),
            touched(changes, "user_bank_info", user_id="user_id"),
            touched(changes, "user_personal_info", user_id="user_id"),
            _owners(sources, touched(changes, "device_ids", device_uuid="device_uuid")),
        ],
        ["user_id"],
    )
    numbers = _union(
        [
            touched(changes, "user_repay", order_no="order_no"),
            touched(changes, "risk_user_approval_callback", order_no="order_no"),
        ],
        ["order_no"],
    )
    return _union(
        [
            touched(changes, "user_order", order_id="id"),
            touched(changes, "user_order_installment", order_id="user_order_id"),
            _orders_where(sources, users, "user_id"),
            _orders_where(sources, numbers.filter(has_text("order_no")), "order_no"),
        ],
        ["order_id"],
    )


def _owners(sources, devices: DataFrame) -> DataFrame:
    users = sources["user"].select(F.col("id").alias("user_id"), F.col("device_id").alias("device_uuid"))
    return users.join(devices.filter(has_text("device_uuid")), "device_uuid", "left_semi").select("user_id")


def loan_keys(changes: DataFrame, sources) -> DataFrame:
    parts = sources["user_order_installment"].select(F.col("id").alias("installment_id"), F.col("user_order_id").alias("order_id"), "current_period")
    by_order = parts.join(touched(changes, "user_order", order_id="id"), "order_id", "left_semi")
    paid = touched(changes, "user_repay", order_no="order_no", current_period="current_period").filter(has_text("order_no"))
    orders = sources["user_order"].select(F.col("id").alias("order_id"), "order_no")
    paid_parts = orders.join(paid, "order_no", "inner").select("order_id", "current_period").distinct()
    by_payment = parts.join(paid_parts, ["order_id", "current_period"], "left_semi")
    own = touched(changes, "user_order_installment", installment_id="id")
    return _union([own, by_order, by_payment], ["installment_id"])


# Outputs whose scope stands in the changed rows of one table.
IN_IMAGE = {"user_bankcard": ("user_bank_info", ["user_id"]), "user_product": ("user_order", ["user_id", "product_id"])}

TRIGGER_KEYS = {
    "user": user_keys,
    "user_bankcard": bankcard_keys,
    "user_product": product_keys,
    "application": application_keys,
    "loan": loan_keys,
}


def coalesced(output: str, changes: DataFrame, sources, trigger_s: int) -> DataFrame:
    """What a stream that runs every ``trigger_s`` seconds would rebuild, told from a log of changes: one row per trigger and scope key of an output
    whose keys stand in the row images, with the number of changes it stands for. Equal keys of a trigger cost one rebuild."""
    table, columns = IN_IMAGE[output]
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    number = F.floor(F.timestamp_diff("SECOND", epoch, F.col("ts")) / F.lit(trigger_s)).cast("bigint")
    image = F.coalesce(F.col("after"), F.col("before"))
    keys = [image[c].alias(c) for c in columns]
    rows = changes.filter(F.col("source_table") == table).select(number.alias("trigger_no"), *keys).dropna(subset=columns)
    if "product_id" in columns:
        rows = rows.filter(has_text("product_id"))
    return rows.groupBy("trigger_no", *columns).agg(F.count(F.lit(1)).alias("changes"))


def trigger_keys(output: str, changes: DataFrame, sources) -> DataFrame:
    return TRIGGER_KEYS[output](changes, sources)
