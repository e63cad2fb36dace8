"""Left joins to tables with one row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.functions.codes import OK
from tokenloom.functions.text import blank_to_null, has_text, normalize_mobile, spread_null_key
from tokenloom.operators.latest import adjust_latest, device_profile


def lookup_text(left: DataFrame, right: DataFrame, key: str, right_key: str, row_key: str) -> DataFrame:
    """Left join on a text key that is often NULL. Rows without a key are spread over the tasks of
    the join and match nothing. How a key held by very many rows is split is left to adaptive
    execution, which may cut the left side because the right one has a single row per key."""
    probe = left.withColumns(
        {"probe_key": spread_null_key(key, row_key), "probe_ok": F.col(key).isNotNull()}
    )
    build = right.withColumnRenamed(right_key, "build_key")
    matches = (F.col("probe_key") == F.col("build_key")) & F.col("probe_ok")
    return probe.join(build, matches, "left").drop("probe_key", "probe_ok", "build_key")


def ok_tokens(dictionary: DataFrame, vt_type: int) -> DataFrame:
    """Usable tokens of one kind; (vt_type, raw_value) is unique in a dictionary."""
    usable = (F.col("vt_type") == vt_type) & (F.col("status") == OK) & F.col("raw_value").isNotNull()
    return dictionary.filter(usable).select("raw_value", "token")


def join_token(df: DataFrame, dictionary: DataFrame, vt_type: int, raw: str, token: str, row_key: str) -> DataFrame:
    tokens = ok_tokens(dictionary, vt_type).withColumnRenamed("token", token)
    return lookup_text(df, tokens, raw, "raw_value", row_key)


def join_adjust(users: DataFrame, callbacks: DataFrame, columns: list[str] | None = None) -> DataFrame:
    newest = adjust_latest(callbacks, columns).withColumnRenamed("adid", "adjust_adid")
    keyed = users.withColumn("adid_key", F.nullif(F.col("adid"), F.lit("")))
    return lookup_text(keyed, newest, "adid_key", "adjust_adid", "id").drop("adid_key")


def join_device(users: DataFrame, devices: DataFrame, network: DataFrame) -> DataFrame:
    """Adds session_id, aaid and registration_ip of the user's device."""
    facts = device_profile(devices, network).withColumnRenamed("device_uuid", "known_device")
    keyed = users.withColumn("device_key", F.when(has_text("device_id"), F.col("device_id")))
    return lookup_text(keyed, facts, "device_key", "known_device", "id").drop("device_key")


def registration_ip(users: DataFrame, devices: DataFrame, network: DataFrame) -> DataFrame:
    found = join_device(users.select("id", "device_id"), devices, network)
    return found.filter(F.col("registration_ip").isNotNull()).select(
        F.col("id").alias("user_id"), F.col("registration_ip").alias("ip")
    )


def anti_join_untokenised(values: DataFrame, dictionary: DataFrame) -> DataFrame:
    """The (vt_type, raw_value) pairs without a usable token."""
    good = dictionary.filter((F.col("status") == OK) & has_text("token"))
    return values.join(good.select("vt_type", "raw_value"), ["vt_type", "raw_value"], "left_anti")


def users_of_bvn(values: DataFrame, profiles: DataFrame) -> DataFrame:
    """Users with one of the given BVNs; ``values`` has raw_value and any columns to carry."""
    keyed = profiles.filter(F.col("user_id").isNotNull() & has_text("bvn"))
    keyed = keyed.select("user_id", F.trim("bvn").alias("match"))
    return _carry(values, "raw_value", keyed)


def users_of_adid(values: DataFrame, users: DataFrame) -> DataFrame:
    return _carry(values, "adid", _adids(users))


def sharers_of_adid(values: DataFrame, users: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The two sides of ``users_of_adid``, for a value that very many users have: what was asked of each value, and its users."""
    probe, asked = _sides(values, "adid", _adids(users))
    return probe.withColumnRenamed("match", "value"), asked.withColumnRenamed("match", "value")


def _adids(users: DataFrame) -> DataFrame:
    return users.filter(F.col("adid").isNotNull()).select(F.col("id").alias("user_id"), F.trim("adid").alias("match"))


def users_of_contact(values: DataFrame, contacts: DataFrame) -> DataFrame:
    keyed = contacts.filter(F.col("user_id").isNotNull() & has_text("contact_number"))
    keyed = keyed.select("user_id", normalize_mobile("contact_number").alias("match"))
    return _carry(values, "raw_value", keyed)


def _carry(values: DataFrame, key: str, keyed: DataFrame) -> DataFrame:
    probe, asked = _sides(values, key, keyed)
    return probe.join(asked, "match", "inner").drop("match")


def _sides(values: DataFrame, key: str, keyed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The table is cut to the values asked for before it moves; then both sides are made distinct, as
    repeated changes of one value, or repeated rows of one user, must not multiply."""
    others = [c for c in values.columns if c != key]
    probe = values.select(*others, blank_to_null(key).alias("match")).filter("match IS NOT NULL").distinct()
    return probe, keyed.join(probe.select("match").distinct(), "match", "left_semi").distinct()
