"""Column types of the source tables, and the checked shape of the target tables."""

from __future__ import annotations

from dataclasses import dataclass

# Columns of the operational tables.
SOURCE_SCHEMAS = {
    "user": "id bigint, app_code string, mobile string, device_id string, adid string, gps_adid string,"
    " idfa string, create_time timestamp_ntz, update_time timestamp_ntz",
    "user_personal_info": "id bigint, user_id bigint, bvn string, first_name string, sur_name string,"
    " date_of_birth date, education_level int, gender int, living_address_state string,"
    " living_address_city string, living_address_first_line string, living_address_second_line string,"
    " number_of_children int, marriage int",
    "user_bank_info": "id bigint, user_id bigint, bank_code string, bank_holder string,"
    " bank_account string, is_default int, deleted int",
    "user_work_related": "id bigint, user_id bigint, work_type string, occupation string,"
    " company_name string, monthly_income string",
    "user_emergency_contact": "id bigint, user_id bigint, contact_name string, contact_number string,"
    " contact_relationship int",
    "device_ids": "id bigint, device_uuid string, session_uuid string, aaid string, idfa string,"
    " create_time timestamp_ntz, update_time timestamp_ntz",
    "device_network": "id bigint, device_uuid string, session_uuid string, ip string,"
    " create_time timestamp_ntz",
    "adjust_callback_record": "id bigint, adid string, network_name string, tracker_name string,"
    " campaign_tracker string, campaign_name string, creative_name string, adgroup_tracker string,"
    " creative_tracker string, adgroup_name string, create_time timestamp_ntz",
    "app_config": "id bigint, app_code string, app_name string, version string",
    "risk_user_credit_callback": "id bigint, user_id bigint, credit_limit string, create_time timestamp_ntz",
    "user_order": "id bigint, order_no string, user_id bigint, app_code string, product_id string,"
    " period_days int, period_count int, re_loan int, amount_max string, received string,"
    " repayment string, poundage string, order_time timestamp_ntz, disburse_time timestamp_ntz,"
    " settled_time timestamp_ntz, last_repayment_time timestamp_ntz, risk_order_status int",
    "user_order_installment": "id bigint, user_order_id bigint, current_period int, received string,"
    " interests string, poundage_fees string, penalty_amount string, amt_due string,"
    " repaid_amount string, repayment_time timestamp_ntz, is_overdue int, create_time timestamp_ntz",
    "user_repay": "order_no string, current_period int, status int, callback_time timestamp_ntz",
    "risk_user_approval_callback": "order_no string, callback_time timestamp_ntz",
    "vt_token_cache": "id bigint, vt_type int, raw_value string, token string, masking string,"
    " status int, retry_count int, last_error string",
    "user_info_dirty": "user_id bigint, updated_at timestamp_ntz",
}


@dataclass(frozen=True)
class Field:
    name: str
    type: str
    chars: int | None = None
    required: bool = True
    unsigned: bool = False
    default: str | int | None = None
    allowed: tuple[str, ...] = ()


def _text(name, chars, **kw):
    return Field(name, "string", chars, **kw)


def _count(name, **kw):
    return Field(name, "bigint", unsigned=True, **kw)


def _small(name, **kw):
    return Field(name, "tinyint", **kw)


# The target tables, their column order, widths, defaults and keys.
EDGE_TYPES = ("mobile", "gaid_idfa", "device_uuid", "bank_account", "id_number", "id2")

TARGETS: dict[str, list[Field]] = {
    "user": [
        _count("user_id"), Field("app_id", "int", unsigned=True), _count("group_user_id"),
        _count("info_user_id"), _text("mobile", 28), _count("closed_time", default=0),
        _text("reg_device_uuid", 191), _count("reg_time"), _small("test_flag", default=0),
        _text("utm_source", 191, required=False), _text("utm_medium", 191, required=False),
        _text("utm_campaign", 191, required=False), _text("utm_content", 191, required=False),
        _text("utm_term", 191, required=False), _text("campaign_id", 191, required=False),
        _text("ad_group_id", 191, required=False), _text("advertiser_id", 191, required=False),
    ],
    "user_info": [
        _count("user_id"), _text("id_number", 28, default=""), _text("full_name", 255, default=""),
        _text("password", 191, default=""), _text("live_image", 191, default=""),
        _text("id_card", 191, default=""), _text("info", None),
    ],
    "user_bankcard": [
        Field("id", "bigint"), _count("group_user_id"), _text("bank_code", 64),
        _text("bank_account_number", 64), _small("is_default", unsigned=True, default=0),
    ],
    "user_product": [
        _count("group_user_id"), _text("product_id", 32), _text("schemes", None),
        _small("is_open", unsigned=True, default=0), _count("credit_amount", default=0),
        _count("unpaid_amount", default=0), _count("locked_amount", default=0),
        _count("available_amount", default=0),
    ],
    "application": [
        _text("application_no", 36), _text("mobile", 28), _text("bid", 10),
        Field("app_id", "int", unsigned=True), _text("app_version", 36, required=False),
        _count("user_id"), _count("group_user_id"), _text("sn", 36),
        _small("is_test", unsigned=True, default=0), _small("is_first_apply", unsigned=True, default=0),
        _small("is_auto_apply", unsigned=True, default=0), _text("id_number", 28),
        _text("gaid_idfa", 36, required=False), _text("device_uuid", 36),
        _text("session_id", 36, required=False), _text("bank_code", 36),
        _text("bank_account_name", 128), _text("bank_account_number", 28), _text("product_id", 64),
        _text("product_scheme_id", 64), _text("product_calculator_version", 32),
        _text("product_scheme_param", None, required=False), Field("term", "int", unsigned=True),
        Field("periods", "int", unsigned=True, default=1), _small("repayment_method", default=1),
        _text("repayment_plan", None), _count("credit_limit", default=0), _count("loan_amount"),
        _count("principal"), _count("total_amount", default=0), _count("disbursed_amount", default=0),
        _count("created_time"), _count("submited_time", required=False),
        _count("reviewed_time", required=False), _count("disbursed_time", required=False),
        _count("last_paid_time", required=False), _count("paid_off_time", required=False),
        _count("lock_expire_time", required=False), Field("due_date", "date", required=False),
        Field("due_date_final", "date"), _text("coupon_code", 36, required=False), _small("status"),
    ],
    "loan": [
        _text("loan_no", 36), _text("application_no", 36), _small("period", unsigned=True, default=1),
        _small("roll_sequence", unsigned=True, default=0), Field("start_date", "date"),
        Field("due_date", "date"), Field("due_date_final", "date"), _count("principal"),
        _count("interest"), _count("admin_fee"), Field("roll_fee", "bigint", default=0),
        _count("penalty_amount"), _count("reduction_amount"), _count("total_amount"),
        _count("paid_amount", default=0), Field("roll_paid_amount", "bigint", default=0),
        _count("paid_time", required=False), Field("paid_off_date", "date", required=False),
        _count("created_time"), _small("status", default=0),
    ],
    "id_mapping": [
        _text("id", 36), Field("app_id", "int", unsigned=True), _text("mapping_id", 36),
        _text("type", None, allowed=EDGE_TYPES), _count("event_time"),
    ],
}

TARGET_KEYS = {
    "user": ["mobile", "app_id", "closed_time"],
    "user_info": ["user_id"],
    "user_bankcard": ["group_user_id", "bank_account_number"],
    "user_product": ["group_user_id", "product_id"],
    "application": ["mobile", "group_user_id", "sn"],
    "loan": ["application_no", "period", "roll_sequence"],
    "id_mapping": ["id", "app_id", "mapping_id"],
}
