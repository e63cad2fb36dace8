"""Wide tables: every output row with its raw values and the tokens known for them.

Bulk loads and incremental rebuilds call the same functions; a rebuild only hands in restricted
sources.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.functions.codes import VT_TYPES, application_no, application_risk_status, loan_no, loan_status
from tokenloom.functions.documents import repayment_plan_json
from tokenloom.functions.money import money_minor, money_sum_minor
from tokenloom.functions.text import first_text, full_name, has_text, normalize_mobile
from tokenloom.functions.times import epoch_ms, positive_ms, start_date
from tokenloom.operators.latest import (
    app_latest,
    approval_latest_by_order,
    bvn_latest,
    contacts_by_user,
    credit_latest,
    default_card_latest,
    latest_by,
    overdue_by_order,
    paid_latest_by_order,
    paid_latest_by_order_period,
    product_latest,
    profile_latest,
    work_latest,
)
from tokenloom.operators.lookups import join_adjust, join_device, join_token
from tokenloom.operators.predicates import has_order_no, live_bankcard, loan_order
from tokenloom.settings import DEFAULT, Settings


def assemble_user(sources, settings: Settings = DEFAULT) -> DataFrame:
    users = sources["user"].select("id", "app_code", "mobile", "device_id", "adid", "create_time", "update_time")
    users = users.withColumns(
        {"reg_time": epoch_ms("create_time", settings.zone), "mobile_norm": normalize_mobile("mobile")}
    )
    users = join_token(users, sources["vt_token_cache"], VT_TYPES["mobile"], "mobile_norm", "mobile_token", "id")
    return join_adjust(users, sources["adjust_callback_record"])


def assemble_bankcard(sources) -> DataFrame:
    cards = sources["user_bank_info"].filter(live_bankcard()).select(
        "id", "user_id", "bank_code", F.trim("bank_account").alias("bank_account_raw"), "is_default"
    )
    return join_token(cards, sources["vt_token_cache"], VT_TYPES["bank_account"], "bank_account_raw", "bank_account_token", "id")


def contact_tokens(sources) -> DataFrame:
    """Contact rows with their international number and the token known for it."""
    contacts = sources["user_emergency_contact"].withColumn("contact_norm", normalize_mobile("contact_number"))
    return join_token(contacts, sources["vt_token_cache"], VT_TYPES["emergency_contact"], "contact_norm", "contact_token", "id")


def contacts_json_by_user(sources) -> DataFrame:
    contacts = contact_tokens(sources).withColumn("mobile", first_or("contact_token", "contact_norm"))
    return contacts_by_user(contacts)


def first_or(token: str, raw: str):
    return F.when(has_text(token), F.col(token)).otherwise(F.col(raw))


def profile_numbers(sources) -> DataFrame:
    """The ID number of each newest profile that has one, and the token known for it."""
    numbers = profile_latest(sources["user_personal_info"]).select("user_id", F.trim("bvn").alias("bvn_raw")).filter(has_text("bvn_raw"))
    return join_token(numbers, sources["vt_token_cache"], VT_TYPES["id_number"], "bvn_raw", "id_number_token", "user_id")


def assemble_user_info(sources, contacts: DataFrame | None = None) -> DataFrame:
    """One row per user with all profile facts; the document itself is built by the output.

    Lookups by advertising and device id go first, while the rows are narrow; all other parts
    share the user id, so the user rows move once for them together.
    """
    users = sources["user"].select("id", "app_code", "device_id", "adid", "create_time")
    users = join_adjust(users, sources["adjust_callback_record"], ["tracker_name"])
    users = join_device(users, sources["device_ids"], sources["device_network"])
    users = users.select(F.col("id").alias("user_id"), "app_code", "create_time", "tracker_name", "registration_ip")

    apps = app_latest(sources["app_config"]).drop("id")
    profile = profile_latest(sources["user_personal_info"])
    numbers = profile_numbers(sources)

    if contacts is None:
        contacts = contacts_json_by_user(sources)
    joined = users.join(apps, "app_code", "left")
    for part in (
        profile.drop("bvn"),
        numbers,
        work_latest(sources["user_work_related"]),
        credit_latest(sources["risk_user_credit_callback"]),
        contacts,
    ):
        joined = joined.join(part, "user_id", "left")
    return joined.withColumn("full_name", full_name("first_name", "sur_name"))


def assemble_product(sources, settings: Settings = DEFAULT) -> DataFrame:
    amount = money_minor("amount_max", settings.money_scale)
    return product_latest(sources["user_order"]).select(
        "user_id", "product_id", amount.alias("credit_amount_minor"), amount.alias("unpaid_amount_minor")
    )


def user_identity(sources) -> DataFrame:
    """Everything an order or an edge takes from its user, one row per user.

    All four tokens depend on the user alone, so they are looked up here, on rows that are few
    and narrow, and never on orders.
    """
    dictionary = sources["vt_token_cache"]
    users = sources["user"].select("id", "mobile", "device_id", "gps_adid", "idfa")
    users = users.withColumn("mobile_norm", normalize_mobile("mobile"))
    users = join_device(users, sources["device_ids"], sources["device_network"])
    users = users.withColumn("gaid_idfa_raw", first_text("gps_adid", "idfa", "aaid"))
    users = join_token(users, dictionary, VT_TYPES["mobile"], "mobile_norm", "mobile_token", "id")
    users = join_token(users, dictionary, VT_TYPES["gaid_idfa"], "gaid_idfa_raw", "gaid_idfa_token", "id")
    users = users.select(
        F.col("id").alias("user_id"),
        F.col("device_id").alias("device_uuid"),
        "session_id",
        "mobile_norm",
        "gaid_idfa_raw",
        "mobile_token",
        "gaid_idfa_token",
    )

    bvn = bvn_latest(sources["user_personal_info"]).select("user_id", F.trim("bvn").alias("bvn_raw"))
    bvn = join_token(bvn, dictionary, VT_TYPES["id_number"], "bvn_raw", "id_number_token", "user_id")

    card = default_card_latest(sources["user_bank_info"]).select(
        "user_id",
        "bank_code",
        F.col("bank_holder").alias("bank_account_name"),
        F.trim("bank_account").alias("bank_account_raw"),
    )
    card = join_token(card, dictionary, VT_TYPES["bank_account"], "bank_account_raw", "bank_account_token", "user_id")
    return users.join(bvn, "user_id", "left").join(card, "user_id", "left")


def application_rows(sources) -> DataFrame:
    """One row per order: its own columns, its payment facts, its user's identity, all still raw.

    Facts keyed by order id and order number join first; the user's facts, which are the widest,
    join last. Documents and amounts are worked out after the joins, so they never move.
    """
    orders = sources["user_order"].filter(has_order_no()).withColumnRenamed("id", "order_id")
    overdue = overdue_by_order(sources["user_order_installment"]).withColumnRenamed("user_order_id", "order_id")
    return (
        orders.join(overdue, "order_id", "left")
        .join(approval_latest_by_order(sources["risk_user_approval_callback"]), "order_no", "left")
        .join(paid_latest_by_order(sources["user_repay"]), "order_no", "left")
        .join(user_identity(sources), "user_id", "inner")
        .withColumnRenamed("order_id", "id")
    )


def application_facts(rows: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    scale = settings.money_scale
    limit, received = money_minor("amount_max", scale), money_minor("received", scale)
    facts = {
        "application_no": application_no("app_code", "order_no"),
        "credit_limit_minor": limit,
        "loan_amount_minor": limit,
        "principal_minor": received,
        "total_amount_minor": money_minor("repayment", scale),
        "disbursed_amount_minor": received,
        "risk_status": application_risk_status("risk_order_status", F.coalesce("is_overdue", F.lit(0))),
        "repayment_plan_json": repayment_plan_json(scale),
    }
    raw = ("is_overdue", "amount_max", "received", "repayment", "poundage")
    return rows.withColumns(facts).drop(*raw).withColumnRenamed("order_no", "sn")


def assemble_application(sources, settings: Settings = DEFAULT) -> DataFrame:
    return application_facts(application_rows(sources), settings)


def loan_rows(sources) -> DataFrame:
    """One row per installment of an order that became a loan, still raw.

    A missing period is shown as 1 but matches no payment, which the extra join condition says;
    joining on the shown period leaves the rows grouped the way the keyed output needs them.
    """
    orders = sources["user_order"].filter(has_order_no() & loan_order()).select(
        F.col("id").alias("order_id"),
        "order_no",
        F.trim("app_code").alias("app_code"),
        "risk_order_status",
        "order_time",
        "disburse_time",
        "settled_time",
    )
    parts = sources["user_order_installment"].join(orders, F.col("user_order_id") == F.col("order_id"), "inner")
    parts = parts.withColumns(
        {"period": F.coalesce("current_period", F.lit(1)), "has_period": F.col("current_period").isNotNull()}
    )
    paid = paid_latest_by_order_period(sources["user_repay"]).select(
        F.col("order_no").alias("paid_order_no"), F.col("current_period").alias("paid_period"), "paid_at"
    )
    matches = (F.col("order_no") == F.col("paid_order_no")) & (F.col("period") == F.col("paid_period")) & F.col("has_period")
    return parts.join(paid, matches, "left").drop("paid_order_no", "paid_period", "has_period", "order_id", "user_order_id")


def loan_facts(rows: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    scale = settings.money_scale
    return rows.select(
        "id",
        "order_no",
        "period",
        "app_code",
        loan_no("order_no", "period").alias("loan_no"),
        application_no("app_code", "order_no").alias("application_no"),
        F.lit(0).alias("roll_sequence"),
        start_date("disburse_time", "order_time", "create_time").alias("start_date"),
        F.col("repayment_time").cast("date").alias("due_date"),
        F.col("repayment_time").cast("date").alias("due_date_final"),
        money_minor("received", scale).alias("principal_minor"),
        money_minor("interests", scale).alias("interest_minor"),
        money_minor("poundage_fees", scale).alias("admin_fee_minor"),
        money_minor("penalty_amount", scale).alias("penalty_amount_minor"),
        F.lit(0).cast("bigint").alias("reduction_amount_minor"),
        money_sum_minor("amt_due", "penalty_amount", scale).alias("total_amount_minor"),
        money_minor("repaid_amount", scale).alias("paid_amount_minor"),
        positive_ms(epoch_ms("paid_at", settings.zone)).alias("paid_time_ms"),
        F.col("settled_time").cast("date").alias("paid_off_date"),
        loan_status("risk_order_status", F.coalesce("is_overdue", F.lit(0)), "repaid_amount").alias("risk_status"),
    )


def assemble_loan(sources, settings: Settings = DEFAULT) -> DataFrame:
    return loan_facts(loan_rows(sources), settings)


def last_per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """Of several wide rows for one target key, the one with the highest source id."""
    return latest_by(df, keys, ["id"], df.columns)
