"""The seven outputs. ``phase`` picks the rows whose tokens are all known (``hit``), those that
still need the tokenizer (``miss``), or both in one pass (``all``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.functions.channels import map_utm_source
from tokenloom.functions.codes import BUSINESS_LINE, PRODUCT_SCHEMES, SCHEME_ID, SCHEME_RATES, VT_TYPES
from tokenloom.functions.documents import info_json
from tokenloom.functions.ids import IdLayout, with_snowflake_ids
from tokenloom.functions.text import has_text, null_to_blank
from tokenloom.functions.times import created_ms_from_date, epoch_ms, lock_expire_ms
from tokenloom.operators.latest import contacts_by_user
from tokenloom.operators.predicates import token_miss, token_ready
from tokenloom.operators.projection import offset_id, with_constants
from tokenloom.operators.tokenize import Tokenizer, ask_once, asks_in_batches, fill_tokens, lacking_values, tokenize_columns
from tokenloom.plans.assemble import (
    application_facts,
    application_rows,
    assemble_bankcard,
    assemble_product,
    assemble_user,
    assemble_user_info,
    contact_tokens,
    last_per_key,
    loan_facts,
    loan_rows,
    profile_numbers,
)
from tokenloom.plans.edges import keyed_edges
from tokenloom.settings import DEFAULT, Settings

PHASES = ("hit", "miss", "all")
# token column -> raw column, per output
USER_TOKENS = {"mobile_token": "mobile_norm"}
INFO_TOKENS = {"id_number_token": "bvn_raw"}
CARD_TOKENS = {"bank_account_token": "bank_account_raw"}
APPLICATION_TOKENS = {
    "mobile_token": "mobile_norm",
    "id_number_token": "bvn_raw",
    "bank_account_token": "bank_account_raw",
}
KIND_OF = {
    "mobile_token": VT_TYPES["mobile"],
    "id_number_token": VT_TYPES["id_number"],
    "bank_account_token": VT_TYPES["bank_account"],
    "gaid_idfa_token": VT_TYPES["gaid_idfa"],
    "contact_token": VT_TYPES["emergency_contact"],
}


def _select_phase(
    wide: DataFrame,
    phase: str,
    ready: Column,
    pairs: dict[str, str],
    tokenizer: Tokenizer | None,
    also: dict[str, str] | None = None,
    row_key: str = "id",
    answers: DataFrame | None = None,
) -> DataFrame:
    """The rows of a phase, tokens filled in. ``also`` are tokens whose absence alone does not make
    a row a miss: the hit phase writes NULL for them, the other phases ask the tokenizer. ``answers`` are those of a
    tokenizer that was asked before."""
    if phase not in PHASES:
        raise ValueError(f"phase must be one of {PHASES}")
    if phase == "hit":
        return wide.filter(ready)
    if tokenizer is None:
        raise ValueError("rows without tokens need a tokenizer")
    miss = token_miss(pairs)
    wide = wide.filter(miss if phase == "miss" else ready | miss)
    columns = _columns(pairs | (also or {}))
    filled = tokenize_columns(wide, columns, tokenizer, row_key) if answers is None else fill_tokens(wide, columns, answers, row_key)
    return filled.filter(ready)


def _columns(pairs: dict[str, str]) -> dict[str, tuple[str, int]]:
    return {token: (raw, KIND_OF[token]) for token, raw in pairs.items()}


def user_output(sources, phase: str = "hit", tokenizer: Tokenizer | None = None, settings: Settings = DEFAULT) -> DataFrame:
    wide = assemble_user(sources, settings)
    rows = _select_phase(wide, phase, token_ready(["mobile_token"]), USER_TOKENS, tokenizer)
    rows = last_per_key(rows.withColumn("app_id", F.col("app_code").cast("int")), ["mobile_token", "app_id"])
    user_id = offset_id("id", settings.id_offset)
    return rows.select(
        user_id.alias("user_id"),
        "app_id",
        user_id.alias("group_user_id"),
        user_id.alias("info_user_id"),
        F.col("mobile_token").alias("mobile"),
        F.lit(0).cast("bigint").alias("closed_time"),
        null_to_blank("device_id").alias("reg_device_uuid"),
        F.coalesce("reg_time", F.lit(0).cast("bigint")).alias("reg_time"),
        F.lit(0).cast("tinyint").alias("test_flag"),
        map_utm_source("network_name", "tracker_name").alias("utm_source"),
        F.col("campaign_tracker").alias("utm_medium"),
        F.col("campaign_name").alias("utm_campaign"),
        F.col("creative_name").alias("utm_content"),
        F.col("adgroup_tracker").alias("utm_term"),
        F.col("creative_tracker").alias("campaign_id"),
        F.col("campaign_tracker").alias("ad_group_id"),
        F.col("adgroup_tracker").alias("advertiser_id"),
    )


def user_info_output(sources, phase: str = "hit", tokenizer: Tokenizer | None = None, settings: Settings = DEFAULT) -> DataFrame:
    """Contact numbers are always tokenised, in both phases, before they enter the document. A service is asked once, for
    the numbers of contacts and of profiles together."""
    contacts, answers = contact_tokens(sources), None
    numbers = _columns({"contact_token": "contact_norm"})
    if tokenizer is not None and asks_in_batches(tokenizer):
        requests = [lacking_values(contacts, numbers, "id")]
        if phase != "hit":
            known = sources["user"].select(F.col("id").alias("user_id"))
            requests.append(lacking_values(profile_numbers(sources).join(known, "user_id", "left_semi"), _columns(INFO_TOKENS), "user_id"))
        answers = ask_once(requests, tokenizer)
        contacts = fill_tokens(contacts, numbers, answers, "id")
    elif tokenizer is not None:
        contacts = tokenize_columns(contacts, numbers, tokenizer)
    contacts = contacts_by_user(contacts, "contact_token")
    wide = assemble_user_info(sources, contacts)
    ready = token_ready([], {"id_number_token": "bvn_raw"})
    rows = _select_phase(wide, phase, ready, INFO_TOKENS, tokenizer, row_key="user_id", answers=answers)
    projected = rows.select(
        offset_id("user_id", settings.id_offset).alias("user_id"),
        F.when(has_text("bvn_raw"), F.col("id_number_token")).otherwise("").alias("id_number"),
        null_to_blank("full_name").alias("full_name"),
        info_json(settings.zone).alias("info"),
    )
    blanks = with_constants(projected, {"password": "", "live_image": "", "id_card": ""})
    return blanks.select("user_id", "id_number", "full_name", "password", "live_image", "id_card", "info")


def bankcard_rows(sources, phase: str = "hit", tokenizer: Tokenizer | None = None, settings: Settings = DEFAULT) -> DataFrame:
    """The card output without its generated id."""
    wide = assemble_bankcard(sources)
    rows = _select_phase(wide, phase, token_ready(["bank_account_token"]), CARD_TOKENS, tokenizer)
    rows = last_per_key(rows, ["user_id", "bank_account_token"])
    return rows.select(
        offset_id("user_id", settings.id_offset).alias("group_user_id"),
        null_to_blank("bank_code").alias("bank_code"),
        F.col("bank_account_token").alias("bank_account_number"),
        F.coalesce("is_default", F.lit(0)).cast("tinyint").alias("is_default"),
    )


def bankcard_output(
    sources,
    start_ms: int,
    phase: str = "hit",
    tokenizer: Tokenizer | None = None,
    settings: Settings = DEFAULT,
    layout: IdLayout | None = None,
    partitions: int | None = None,
) -> DataFrame:
    rows = bankcard_rows(sources, phase, tokenizer, settings)
    numbered = with_snowflake_ids(rows, ["group_user_id", "bank_account_number"], start_ms, layout, partitions)
    return numbered.select("id", "group_user_id", "bank_code", "bank_account_number", "is_default")


def product_output(sources, settings: Settings = DEFAULT) -> DataFrame:
    rows = assemble_product(sources, settings)
    zero = (0, "bigint")
    filled = with_constants(rows, {"schemes": PRODUCT_SCHEMES, "is_open": (1, "tinyint"), "locked_amount": zero, "available_amount": zero})
    return filled.select(
        offset_id("user_id", settings.id_offset).alias("group_user_id"),
        "product_id",
        "schemes",
        "is_open",
        F.col("credit_amount_minor").alias("credit_amount"),
        F.col("unpaid_amount_minor").alias("unpaid_amount"),
        "locked_amount",
        "available_amount",
    )


def application_output(sources, phase: str = "hit", tokenizer: Tokenizer | None = None, settings: Settings = DEFAULT) -> DataFrame:
    wide = application_rows(sources)
    ready = token_ready(["mobile_token", "bank_account_token"], {"id_number_token": "bvn_raw"})
    # all values belong to the user, so answers come back by user and orders move once for them
    rows = _select_phase(wide, phase, ready, APPLICATION_TOKENS, tokenizer, also={"gaid_idfa_token": "gaid_idfa_raw"}, row_key="user_id")
    # tokens follow from the user, so (mobile, user, sn) repeats exactly where (user, order_no) does
    rows = application_facts(last_per_key(rows, ["user_id", "order_no"]), settings)
    zone, user_id = settings.zone, offset_id("user_id", settings.id_offset)
    created = epoch_ms("order_time", zone)
    return rows.select(
        "application_no",
        F.col("mobile_token").alias("mobile"),
        F.lit(BUSINESS_LINE).alias("bid"),
        F.col("app_code").cast("int").alias("app_id"),
        F.lit("1").alias("app_version"),
        user_id.alias("user_id"),
        user_id.alias("group_user_id"),
        "sn",
        F.lit(0).cast("tinyint").alias("is_test"),
        F.coalesce("re_loan", F.lit(0)).cast("tinyint").alias("is_first_apply"),
        F.lit(0).cast("tinyint").alias("is_auto_apply"),
        F.when(has_text("bvn_raw"), F.col("id_number_token")).otherwise("").alias("id_number"),
        F.when(has_text("gaid_idfa_raw"), F.col("gaid_idfa_token")).alias("gaid_idfa"),
        null_to_blank("device_uuid").alias("device_uuid"),
        "session_id",
        null_to_blank("bank_code").alias("bank_code"),
        null_to_blank("bank_account_name").alias("bank_account_name"),
        F.col("bank_account_token").alias("bank_account_number"),
        "product_id",
        F.lit(SCHEME_ID).alias("product_scheme_id"),
        F.lit("1.0").alias("product_calculator_version"),
        F.lit(SCHEME_RATES).alias("product_scheme_param"),
        F.coalesce("period_days", F.lit(7)).alias("term"),
        F.coalesce("period_count", F.lit(1)).alias("periods"),
        F.lit(1).cast("tinyint").alias("repayment_method"),
        F.col("repayment_plan_json").alias("repayment_plan"),
        F.col("credit_limit_minor").alias("credit_limit"),
        F.col("loan_amount_minor").alias("loan_amount"),
        F.col("principal_minor").alias("principal"),
        F.col("total_amount_minor").alias("total_amount"),
        F.col("disbursed_amount_minor").alias("disbursed_amount"),
        created.alias("created_time"),
        created.alias("submited_time"),
        epoch_ms("reviewed_time", zone).alias("reviewed_time"),
        epoch_ms("disburse_time", zone).alias("disbursed_time"),
        epoch_ms("last_paid_time", zone).alias("last_paid_time"),
        epoch_ms("settled_time", zone).alias("paid_off_time"),
        lock_expire_ms("order_time", zone).alias("lock_expire_time"),
        F.lit("").alias("coupon_code"),
        F.col("risk_status").cast("tinyint").alias("status"),
    )


def loan_output(sources, settings: Settings = DEFAULT) -> DataFrame:
    rows = loan_facts(last_per_key(loan_rows(sources), ["order_no", "period", "app_code"]), settings)
    return rows.select(
        "loan_no",
        "application_no",
        F.col("period").cast("tinyint").alias("period"),
        F.col("roll_sequence").cast("tinyint").alias("roll_sequence"),
        "start_date",
        "due_date",
        "due_date_final",
        F.col("principal_minor").alias("principal"),
        F.col("interest_minor").alias("interest"),
        F.col("admin_fee_minor").alias("admin_fee"),
        F.col("penalty_amount_minor").alias("penalty_amount"),
        F.col("reduction_amount_minor").alias("reduction_amount"),
        F.col("total_amount_minor").alias("total_amount"),
        F.col("paid_amount_minor").alias("paid_amount"),
        F.col("paid_time_ms").alias("paid_time"),
        "paid_off_date",
        created_ms_from_date("start_date", settings.zone).alias("created_time"),
        F.col("risk_status").cast("tinyint").alias("status"),
    )


def id_mapping_output(sources, settings: Settings = DEFAULT) -> DataFrame:
    return keyed_edges(sources, settings)
