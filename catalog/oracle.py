"""The same results in DuckDB SQL, written from the rules alone and sharing no code with the library."""

from __future__ import annotations

import re

from tokenloom.functions.codes import PRODUCT_SCHEMES, SCHEME_RATES
from tokenloom.sources.fixtures import BASE_TABLES, CHANGE_SQL, FIXTURE_SQL, in_dialect

BASE = {name: name for name in BASE_TABLES}


def has(c: str) -> str:
    return f"({c} IS NOT NULL AND trim({c}) <> '')"


def none(c: str) -> str:
    return f"({c} IS NULL OR trim({c}) = '')"


def norm(c: str) -> str:
    t = f"trim({c})"
    return (
        f"CASE WHEN {none(c)} THEN NULL WHEN starts_with({t}, '+') THEN {t} WHEN starts_with({t}, '234') THEN '+' || {t} "
        f"WHEN starts_with({t}, '0') THEN '+234' || substr({t}, 2) ELSE '+234' || {t} END"
    )


def amount(c: str) -> str:
    return f"try_cast(nullif(trim({c}), '') AS decimal(20,2))"


def minor(c: str) -> str:
    return f"cast(coalesce(round({amount(c)}, 0), 0) AS bigint)"


def ms(c: str) -> str:
    return f"(epoch_us({c}) // 1000 - 3600000)"


def token(kind, raw: str) -> str:
    return f"substr(sha256(concat({kind}, ':', {raw})), 1, 28)"


def utm(network: str, tracker: str) -> str:
    t = f"lower(coalesce(nullif(trim({network}), ''), nullif(trim({tracker}), '')))"
    return (
        f"CASE WHEN {t} LIKE '%unattributed%' THEN NULL WHEN {t} LIKE '%organic%' THEN 'organic' WHEN {t} LIKE '%google%' THEN 'google' "
        f"WHEN {t} LIKE '%tiktok%' THEN 'tiktok' WHEN {t} LIKE '%facebook%' OR {t} LIKE '%instagram%' OR {t} LIKE '%messenger%' THEN 'facebook' "
        f"WHEN {t} LIKE '%kuai%' OR {t} LIKE '%kwai%' THEN 'kwai' ELSE {t} END"
    )


def install(tracker: str) -> str:
    t = f"lower(trim({tracker}))"
    return (
        f"CASE WHEN {none(tracker)} OR {t} LIKE '%unattributed%' THEN NULL WHEN {t} LIKE '%organic%' THEN 'ORGANIC' WHEN {t} LIKE '%google%' THEN 'GG' "
        f"WHEN {t} LIKE '%apple%' THEN 'ASA' WHEN {t} LIKE '%tiktok%' THEN 'TT' "
        f"WHEN {t} LIKE '%facebook%' OR {t} LIKE '%instagram%' OR {t} LIKE '%messenger%' THEN 'FB' "
        f"WHEN {t} LIKE '%sms%' THEN 'SMS' WHEN {t} LIKE '%kuai%' THEN 'KW' ELSE trim({tracker}) END"
    )


def app_status(status: str, overdue: str) -> str:
    return (
        f"cast(CASE {status} WHEN 2 THEN 3 WHEN 4 THEN 5 WHEN 6 THEN 13 WHEN 8 THEN 15 WHEN 10 THEN CASE WHEN {overdue} = 1 THEN 23 ELSE 20 END "
        "WHEN 11 THEN 23 WHEN 40 THEN 25 WHEN 20 THEN 27 WHEN 30 THEN 27 WHEN 50 THEN 27 ELSE 1 END AS int)"
    )


def loan_status(status: str, overdue: str, repaid: str) -> str:
    value = f"coalesce({amount(repaid)}, 0)"
    return (
        f"cast(CASE WHEN {status} = 10 AND coalesce({overdue}, 0) = 1 THEN 23 WHEN {status} = 10 AND {value} = 0 THEN 20 WHEN {status} = 10 THEN 24 "
        f"WHEN {status} = 11 THEN 23 WHEN {status} = 40 THEN 25 WHEN {status} IN (20, 30, 50) THEN 27 ELSE 20 END AS int)"
    )


def app_no(app: str, order: str) -> str:
    return f"concat('ng0', trim({app}), '-', {order})"


def loan_no(order: str, period: str) -> str:
    return f"concat('ng-', {order}, '-', lpad(cast(coalesce({period}, 1) AS varchar), 2, '0'), '000')"


def words(a: str, b: str) -> str:
    return f"trim(concat(coalesce({a}, ''), ' ', coalesce({b}, '')))"


def salary(c: str) -> str:
    t = f"replace(trim({c}), ',', '')"
    return f"CASE WHEN regexp_full_match({t}, '[0-9]{{1,19}}') THEN cast({t} AS decimal(20,0)) END"


def credit(c: str) -> str:
    return f"CASE WHEN regexp_full_match({c}, '[0-9]{{1,19}}') THEN cast({c} AS decimal(20,0)) END"


def mask(c: str) -> str:
    return f"CASE WHEN length({c}) >= 8 THEN left({c}, 5) || '****' || right({c}, 4) ELSE '***' END"


def latest(source: str, keys: str, order: str, where: str = "true") -> str:
    return f"SELECT * FROM {source} WHERE {where} QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY {order}) = 1"


LIVE = f"deleted = 0 AND {has('bank_account')}"
PAID = f"status = 2 AND callback_time IS NOT NULL AND {has('order_no')}"

PLAN = f"""cast(json_object('roll_sequence', 0, 'period', 1, 'principal', {minor('o.received')}, 'disbursed_amount', {minor('o.received')},
 'interest', 0, 'admin_fee', {minor('o.poundage')}, 'service_fee', 0, 'tax_fee', 0, 'reduction_amount', 0, 'total_amount', {minor('o.repayment')},
 'term', coalesce(o.period_days, 7), 'start_date', strftime(o.order_time, '%Y-%m-%d'), 'due_date', strftime(o.last_repayment_time, '%Y-%m-%d'), 'roll_allowed', 0) AS varchar)"""


def info(contacts: str) -> str:
    return f"""cast(json_object('birthday', strftime(i.date_of_birth, '%Y-%m-%d'), 'job_type', i.work_type, 'education', i.education_level, 'gender', i.gender,
 'registration_ip', i.registration_ip, 'salary', {salary('i.monthly_income')}, 'loan_purpose', NULL, 'face_similarity', NULL, 'pay_cycle', NULL, 'salary_yearly', NULL,
 'credit_limit', {credit('i.credit_limit')}, 'company', nullif(trim(i.company_name), ''), 'install_source', {install('i.tracker_name')},
 'registration_time', {ms('i.create_time')} // 1000, 'email', NULL, 'ocr', NULL, 'profession', i.occupation,
 'app', json_object('name', i.app_name, 'version', i.version, 'app_id', i.app_code), 'emergency_contacts', coalesce({contacts}, '[]'::json), 'salary_day', NULL,
 'address', json_object('province', i.living_address_state, 'city', i.living_address_city, 'district', NULL,
 'detail', nullif({words('i.living_address_first_line', 'i.living_address_second_line')}, ''), 'village', NULL),
 'salary_fortnightly', NULL, 'salary_daily', NULL, 'salary_monthly', 1, 'children_num', i.number_of_children, 'religion', NULL, 'marital', i.marriage,
 'full_name', nullif({words('i.first_name', 'i.sur_name')}, ''), 'salary_weekly', NULL, 'survey', NULL, 'salary_type', NULL) AS varchar)"""


def contacts(mobile: str) -> str:
    return (
        "SELECT c.user_id, to_json(list({'name': nullif(trim(c.contact_name), ''), 'mobile': " + mobile
        + ", 'relation': c.contact_relationship} ORDER BY c.id)) AS contacts FROM (SELECT *, "
        + norm("contact_number") + " AS contact_norm FROM src_user_emergency_contact) c "
        "LEFT JOIN dictionary d ON d.vt_type = 5 AND d.status = 1 AND d.raw_value = c.contact_norm GROUP BY c.user_id"
    )


def directed(a_kind, a, b_kind, b, app, time, source) -> str:
    both = f"{has(a)} AND {has(b)} AND trim({a}) <> trim({b})"
    one = "SELECT trim({x}) AS id, cast({app} AS int) AS app_id, trim({y}) AS mapping_id, '{kind}' AS type, {time} AS event_time FROM {source} WHERE {both}"
    return " UNION ALL ".join(
        one.format(x=x, y=y, kind=kind, app=app, time=time, source=source, both=both) for x, y, kind in ((a, b, a_kind), (b, a, b_kind))
    )


EDGE_BRANCHES = [
    *[directed(x, f"a.{cx}", y, f"a.{cy}", "a.app_code", ms("a.order_time"), "st_app a") for x, cx, y, cy in (
        ("mobile", "mobile_token", "gaid_idfa", "gaid_idfa_token"), ("mobile", "mobile_token", "bank_account", "bank_account_token"),
        ("mobile", "mobile_token", "id_number", "id_number_token"), ("mobile", "mobile_token", "device_uuid", "device_uuid"),
        ("device_uuid", "device_uuid", "gaid_idfa", "gaid_idfa_token"))],
    directed("mobile", "u.mobile_token", "device_uuid", "u.device_id", "u.app_code", "u.reg_time", "st_user u"),
    directed("mobile", "u.mobile_token", "id_number", "i.id_number_token", "u.app_code", "u.reg_time", "st_user u JOIN st_info i ON i.user_id = u.id"),
    directed("mobile", "u.mobile_token", "bank_account", "b.bank_account_token", "u.app_code", ms("u.update_time"), "st_card b JOIN st_user u ON u.id = b.user_id"),
    directed("device_uuid", "d.device_uuid", "gaid_idfa", "v.token", "u.app_code", ms("coalesce(d.update_time, d.create_time)"),
             "src_device_ids d JOIN src_user u ON u.device_id = d.device_uuid JOIN dictionary v ON v.vt_type = 2 AND v.status = 1 "
             "AND v.raw_value = coalesce(nullif(trim(d.aaid), ''), nullif(trim(d.idfa), ''))"),
]

SEEDS = f"""SELECT 1 AS vt_type, {norm('mobile')} AS raw_value FROM src_user
 UNION SELECT 2, trim(gps_adid) FROM src_user UNION SELECT 2, trim(idfa) FROM src_user UNION SELECT 2, trim(aaid) FROM src_device_ids UNION SELECT 2, trim(idfa) FROM src_device_ids
 UNION SELECT 3, trim(bank_account) FROM src_user_bank_info WHERE {LIVE} UNION SELECT 4, trim(bvn) FROM src_user_personal_info
 UNION SELECT 5, {norm('contact_number')} FROM src_user_emergency_contact"""

TOKEN_OR_HASH = "coalesce(nullif(trim({t}), ''), CASE WHEN {h} THEN {k} END)"


def filled(column: str, raw: str, kind: int) -> str:
    return TOKEN_OR_HASH.format(t=column, h=has(raw), k=token(kind, f"trim({raw})"))


APP_READY = f"{has('mobile_token')} AND {has('bank_account_token')} AND ({none('bvn_raw')} OR {has('id_number_token')})"
APP_MISS = (
    f"(({none('mobile_token')} AND {has('mobile_norm')}) OR ({none('id_number_token')} AND {has('bvn_raw')}) "
    f"OR ({none('bank_account_token')} AND {has('bank_account_raw')}))"
)
USER_MISS = f"({none('mobile_token')} AND {has('mobile_norm')})"
INFO_MISS = f"({none('id_number_token')} AND {has('bvn_raw')})"
CARD_MISS = f"({none('bank_account_token')} AND {has('bank_account_raw')})"

CTES = {f"src_{name}": in_dialect(sql, "duckdb").format(**BASE) for name, sql in FIXTURE_SQL.items()}
CTES["src_changes"] = CHANGE_SQL.format(**BASE)
CTES |= {
    "seeds": f"SELECT DISTINCT vt_type, raw_value FROM ({SEEDS}) WHERE {has('raw_value')} AND length(raw_value) <= 128",
    "dictionary_values": "SELECT vt_type, raw_value, NULL AS fixed FROM seeds UNION ALL "
    "SELECT 1, unnest([repeat('x', 129), 'a' || chr(9) || 'b', 'a' || chr(10) || 'b', 'twin', 'twin' || chr(0)]), 0",
    "dictionary_states": "SELECT *, sha256(concat(vt_type, ':', raw_value)) AS digest, coalesce(fixed, CASE left(sha256(concat(vt_type, ':', raw_value)), 1) WHEN '0' THEN 0 WHEN '1' THEN 2 ELSE 1 END) AS status FROM dictionary_values",
    "dictionary": f"""SELECT cast('0x' || left(digest, 15) AS bigint) AS id, cast(vt_type AS int) AS vt_type, raw_value, CASE WHEN status = 1 THEN left(digest, 28) END AS token,
 CASE WHEN status = 1 THEN {mask('raw_value')} END AS masking, cast(status AS int) AS status, cast(CASE WHEN status = 2 THEN 1 ELSE 0 END AS int) AS retry_count,
 CASE WHEN status = 2 THEN 'fixture' END AS last_error FROM dictionary_states""",
    "w_profile": latest("src_user_personal_info", "user_id", "id DESC"),
    "w_bvn": latest("src_user_personal_info", "user_id", "id DESC", has("bvn")),
    "w_card": latest("src_user_bank_info", "user_id", "id DESC", f"{LIVE} AND is_default = 1"),
    "w_device": latest("src_device_ids", "device_uuid", "id DESC", has("device_uuid")),
    "w_credit": latest("src_risk_user_credit_callback", "user_id", "create_time DESC, id DESC"),
    "w_product": latest("src_user_order", "user_id, product_id", "order_time DESC, id DESC", f"user_id IS NOT NULL AND {has('product_id')}"),
    "w_work": latest("src_user_work_related", "user_id", "id DESC"),
    "w_adjust": latest("src_adjust_callback_record", "adid", "id DESC", "adid <> ''"),
    "seen_ip": f"""SELECT u.id AS user_id, n.ip, n.create_time, n.id FROM src_user u JOIN src_device_network n ON n.device_uuid = u.device_id WHERE {has('n.ip')} AND {has('u.device_id')}
 UNION ALL SELECT u.id, n.ip, n.create_time, n.id FROM src_user u JOIN w_device d ON d.device_uuid = u.device_id JOIN src_device_network n ON n.session_uuid = d.session_uuid WHERE {has('n.ip')} AND {has('d.session_uuid')}""",
    "w_ip": latest("seen_ip", "user_id", "create_time DESC, id DESC"),
    "a_approval": f"SELECT order_no, max(callback_time) AS reviewed_time FROM src_risk_user_approval_callback WHERE callback_time IS NOT NULL AND {has('order_no')} GROUP BY order_no",
    "a_paid": f"SELECT order_no, max(callback_time) AS last_paid_time FROM src_user_repay WHERE {PAID} GROUP BY order_no",
    "a_paid_period": f"SELECT order_no, current_period, max(callback_time) AS paid_at FROM src_user_repay WHERE {PAID} GROUP BY order_no, current_period",
    "a_overdue": "SELECT user_order_id, max(coalesce(is_overdue, 0)) AS is_overdue FROM src_user_order_installment GROUP BY user_order_id",
    "contacts_staged": contacts("coalesce(d.token, c.contact_norm)"),
    "contacts_final": contacts(f"coalesce(d.token, {token(5, 'c.contact_norm')})").replace(f"coalesce(d.token, {token(5, 'c.contact_norm')})", f"CASE WHEN c.contact_norm IS NOT NULL THEN coalesce(d.token, {token(5, 'c.contact_norm')}) END"),
    "st_user": f"""SELECT u.id, u.app_code, u.mobile, u.device_id, u.adid, u.create_time, u.update_time, {ms('u.create_time')} AS reg_time, a.network_name, a.tracker_name, a.campaign_tracker, a.campaign_name,
 a.creative_name, a.adgroup_tracker, a.creative_tracker, a.adgroup_name, u.mobile_norm, m.token AS mobile_token
 FROM (SELECT *, {norm('mobile')} AS mobile_norm FROM src_user) u LEFT JOIN w_adjust a ON u.adid <> '' AND a.adid = u.adid LEFT JOIN dictionary m ON m.vt_type = 1 AND m.status = 1 AND m.raw_value = u.mobile_norm""",
    "st_card": f"""SELECT b.id, b.user_id, b.bank_code, trim(b.bank_account) AS bank_account_raw, d.token AS bank_account_token, b.is_default
 FROM src_user_bank_info b LEFT JOIN dictionary d ON d.vt_type = 3 AND d.status = 1 AND d.raw_value = trim(b.bank_account) WHERE {LIVE}""",
    "st_info": f"""SELECT u.id AS user_id, u.app_code, u.create_time, adj.tracker_name, ip.ip AS registration_ip, ac.app_name, ac.version, p.* EXCLUDE (id, user_id, bvn), nullif(trim(p.bvn), '') AS bvn_raw, d.token AS id_number_token,
 wr.work_type, wr.occupation, wr.company_name, wr.monthly_income, cc.credit_limit, {words('p.first_name', 'p.sur_name')} AS full_name
 FROM src_user u LEFT JOIN w_profile p ON p.user_id = u.id LEFT JOIN w_work wr ON wr.user_id = u.id LEFT JOIN src_app_config ac ON ac.app_code = u.app_code
 LEFT JOIN dictionary d ON d.vt_type = 4 AND d.status = 1 AND d.raw_value = trim(p.bvn) LEFT JOIN w_credit cc ON cc.user_id = u.id
 LEFT JOIN w_adjust adj ON u.adid <> '' AND adj.adid = u.adid LEFT JOIN w_ip ip ON ip.user_id = u.id""",
    "st_product": f"SELECT user_id, product_id, {minor('amount_max')} AS credit_amount_minor, {minor('amount_max')} AS unpaid_amount_minor FROM w_product",
    "app_base": f"""SELECT o.*, u.device_id AS device_uuid, di.session_uuid AS session_id, {norm('u.mobile')} AS mobile_norm, trim(p.bvn) AS bvn_raw, trim(ub.bank_account) AS bank_account_raw,
 coalesce(nullif(trim(u.gps_adid), ''), nullif(trim(u.idfa), ''), nullif(trim(di.aaid), '')) AS gaid_idfa_raw, ub.bank_code, ub.bank_holder AS bank_account_name,
 ra.reviewed_time, lp.last_paid_time, coalesce(ov.is_overdue, 0) AS overdue
 FROM src_user_order o JOIN src_user u ON u.id = o.user_id LEFT JOIN w_bvn p ON p.user_id = o.user_id LEFT JOIN w_card ub ON ub.user_id = o.user_id
 LEFT JOIN w_device di ON di.device_uuid = u.device_id LEFT JOIN a_approval ra ON ra.order_no = o.order_no LEFT JOIN a_paid lp ON lp.order_no = o.order_no
 LEFT JOIN a_overdue ov ON ov.user_order_id = o.id WHERE {has('o.order_no')}""",
    "st_app": f"""SELECT o.id, o.user_id, {app_no('o.app_code', 'o.order_no')} AS application_no, o.order_no AS sn, o.app_code, o.product_id, o.period_days, o.period_count, o.re_loan, o.order_time, o.reviewed_time,
 o.disburse_time, o.settled_time, o.last_paid_time, o.last_repayment_time, o.risk_order_status, {minor('o.amount_max')} AS credit_limit_minor, {minor('o.amount_max')} AS loan_amount_minor,
 {minor('o.received')} AS principal_minor, {minor('o.repayment')} AS total_amount_minor, {minor('o.received')} AS disbursed_amount_minor, {app_status('o.risk_order_status', 'o.overdue')} AS risk_status,
 {PLAN} AS repayment_plan_json, o.device_uuid, o.session_id, o.mobile_norm, o.gaid_idfa_raw, m.token AS mobile_token, g.token AS gaid_idfa_token, o.bvn_raw, n.token AS id_number_token,
 o.bank_code, o.bank_account_name, o.bank_account_raw, b.token AS bank_account_token
 FROM app_base o LEFT JOIN dictionary m ON m.vt_type = 1 AND m.status = 1 AND m.raw_value = o.mobile_norm LEFT JOIN dictionary g ON g.vt_type = 2 AND g.status = 1 AND g.raw_value = o.gaid_idfa_raw
 LEFT JOIN dictionary n ON n.vt_type = 4 AND n.status = 1 AND n.raw_value = o.bvn_raw LEFT JOIN dictionary b ON b.vt_type = 3 AND b.status = 1 AND b.raw_value = o.bank_account_raw""",
    "st_loan": f"""SELECT i.id, o.order_no, coalesce(i.current_period, 1) AS period, trim(o.app_code) AS app_code, {loan_no('o.order_no', 'i.current_period')} AS loan_no, {app_no('o.app_code', 'o.order_no')} AS application_no,
 cast(0 AS int) AS roll_sequence, coalesce(cast(o.disburse_time AS date), cast(o.order_time AS date), cast(i.create_time AS date)) AS start_date, cast(i.repayment_time AS date) AS due_date,
 cast(i.repayment_time AS date) AS due_date_final, {minor('i.received')} AS principal_minor, {minor('i.interests')} AS interest_minor, {minor('i.poundage_fees')} AS admin_fee_minor,
 {minor('i.penalty_amount')} AS penalty_amount_minor, cast(0 AS bigint) AS reduction_amount_minor,
 cast(coalesce(round({amount('i.amt_due')} + {amount('i.penalty_amount')}, 0), 0) AS bigint) AS total_amount_minor, {minor('i.repaid_amount')} AS paid_amount_minor,
 CASE WHEN {ms('r.paid_at')} > 0 THEN {ms('r.paid_at')} END AS paid_time_ms, cast(o.settled_time AS date) AS paid_off_date, {loan_status('o.risk_order_status', 'i.is_overdue', 'i.repaid_amount')} AS risk_status
 FROM src_user_order_installment i JOIN src_user_order o ON o.id = i.user_order_id LEFT JOIN a_paid_period r ON r.order_no = o.order_no AND r.current_period = i.current_period
 WHERE {has('o.order_no')} AND o.risk_order_status IS NOT NULL AND o.risk_order_status NOT IN (0, 2, 4, 6, 8)""",
    "edges": " UNION ALL ".join(EDGE_BRANCHES),
    "bundle": f"SELECT u.id AS user_id, trim(p.bvn) AS bvn_raw, {words('p.first_name', 'p.sur_name')} AS expected_full_name, d.token AS id_number_token FROM src_user u LEFT JOIN w_profile p ON p.user_id = u.id LEFT JOIN dictionary d ON d.vt_type = 4 AND d.status = 1 AND d.raw_value = trim(p.bvn)",
}


# --- outputs -------------------------------------------------------------------------------------

def user_sql(rows: str) -> str:
    return f"""SELECT id + 100000000 AS user_id, cast(app_code AS int) AS app_id, id + 100000000 AS group_user_id, id + 100000000 AS info_user_id, mobile_token AS mobile, cast(0 AS bigint) AS closed_time,
 coalesce(device_id, '') AS reg_device_uuid, coalesce(reg_time, 0) AS reg_time, cast(0 AS tinyint) AS test_flag, {utm('network_name', 'tracker_name')} AS utm_source, campaign_tracker AS utm_medium,
 campaign_name AS utm_campaign, creative_name AS utm_content, adgroup_tracker AS utm_term, creative_tracker AS campaign_id, campaign_tracker AS ad_group_id, adgroup_tracker AS advertiser_id
 FROM ({rows}) QUALIFY row_number() OVER (PARTITION BY mobile_token, cast(app_code AS int) ORDER BY id DESC) = 1"""


USER_FILLED = f"SELECT * REPLACE ({filled('mobile_token', 'mobile_norm', 1)} AS mobile_token) FROM st_user"
USER_HIT = f"SELECT * FROM st_user WHERE {has('mobile_token')}"


def info_sql(rows: str) -> str:
    return f"""SELECT i.user_id + 100000000 AS user_id, CASE WHEN {none('i.bvn_raw')} THEN '' ELSE i.id_number_token END AS id_number, coalesce(i.full_name, '') AS full_name, '' AS password, '' AS live_image, '' AS id_card,
 {info('c.contacts')} AS info FROM ({rows}) i LEFT JOIN contacts_final c ON c.user_id = i.user_id"""


INFO_FILLED = f"SELECT * REPLACE ({filled('id_number_token', 'bvn_raw', 4)} AS id_number_token) FROM st_info"
INFO_HIT = f"SELECT * FROM st_info WHERE {none('bvn_raw')} OR {has('id_number_token')}"


def card_sql(rows: str) -> str:
    return f"""SELECT user_id + 100000000 AS group_user_id, coalesce(bank_code, '') AS bank_code, bank_account_token AS bank_account_number, cast(coalesce(is_default, 0) AS tinyint) AS is_default
 FROM ({rows}) QUALIFY row_number() OVER (PARTITION BY user_id, bank_account_token ORDER BY id DESC) = 1"""


CARD_FILLED = f"SELECT * REPLACE ({filled('bank_account_token', 'bank_account_raw', 3)} AS bank_account_token) FROM st_card"
CARD_HIT = f"SELECT * FROM st_card WHERE {has('bank_account_token')}"


def app_sql(rows: str) -> str:
    return f"""SELECT application_no, mobile_token AS mobile, 'ng01' AS bid, cast(app_code AS int) AS app_id, '1' AS app_version, user_id + 100000000 AS user_id, user_id + 100000000 AS group_user_id, sn, cast(0 AS tinyint) AS is_test,
 cast(coalesce(re_loan, 0) AS tinyint) AS is_first_apply, cast(0 AS tinyint) AS is_auto_apply, CASE WHEN {none('bvn_raw')} THEN '' ELSE id_number_token END AS id_number,
 CASE WHEN {has('gaid_idfa_raw')} THEN gaid_idfa_token END AS gaid_idfa, coalesce(device_uuid, '') AS device_uuid, session_id, coalesce(bank_code, '') AS bank_code, coalesce(bank_account_name, '') AS bank_account_name,
 bank_account_token AS bank_account_number, product_id, 'PROD-002-D7' AS product_scheme_id, '1.0' AS product_calculator_version, '{SCHEME_RATES}' AS product_scheme_param, coalesce(period_days, 7) AS term, coalesce(period_count, 1) AS periods,
 cast(1 AS tinyint) AS repayment_method, repayment_plan_json AS repayment_plan, credit_limit_minor AS credit_limit, loan_amount_minor AS loan_amount, principal_minor AS principal, total_amount_minor AS total_amount, disbursed_amount_minor AS disbursed_amount,
 {ms('order_time')} AS created_time, {ms('order_time')} AS submited_time, {ms('reviewed_time')} AS reviewed_time, {ms('disburse_time')} AS disbursed_time, {ms('last_paid_time')} AS last_paid_time, {ms('settled_time')} AS paid_off_time,
 {ms('order_time')} + 604800000 AS lock_expire_time, '' AS coupon_code, cast(risk_status AS tinyint) AS status FROM ({rows}) QUALIFY row_number() OVER (PARTITION BY mobile_token, user_id, sn ORDER BY id DESC) = 1"""


APP_HIT = f"SELECT * FROM st_app WHERE {APP_READY}"
APP_FILLED = f"""SELECT * REPLACE ({filled('mobile_token', 'mobile_norm', 1)} AS mobile_token, {filled('id_number_token', 'bvn_raw', 4)} AS id_number_token,
 {filled('bank_account_token', 'bank_account_raw', 3)} AS bank_account_token, {filled('gaid_idfa_token', 'gaid_idfa_raw', 2)} AS gaid_idfa_token), {APP_MISS} AS was_miss FROM st_app"""

PRODUCT = f"""SELECT user_id + 100000000 AS group_user_id, product_id, '{PRODUCT_SCHEMES}' AS schemes, cast(1 AS tinyint) AS is_open, credit_amount_minor AS credit_amount, unpaid_amount_minor AS unpaid_amount,
 cast(0 AS bigint) AS locked_amount, cast(0 AS bigint) AS available_amount FROM st_product"""


def loan_sql(where: str = "true") -> str:
    return f"""SELECT loan_no, application_no, cast(period AS tinyint) AS period, cast(roll_sequence AS tinyint) AS roll_sequence, start_date, due_date, due_date_final, principal_minor AS principal, interest_minor AS interest, admin_fee_minor AS admin_fee,
 penalty_amount_minor AS penalty_amount, reduction_amount_minor AS reduction_amount, total_amount_minor AS total_amount, paid_amount_minor AS paid_amount, paid_time_ms AS paid_time, paid_off_date,
 greatest(coalesce({ms('cast(start_date AS timestamp)')}, 0), 0) AS created_time, cast(risk_status AS tinyint) AS status FROM st_loan WHERE {where}
 QUALIFY row_number() OVER (PARTITION BY application_no, period, roll_sequence ORDER BY id DESC) = 1"""


KEYED_EDGES = "SELECT id, app_id, mapping_id, type, event_time FROM edges QUALIFY row_number() OVER (PARTITION BY id, app_id, mapping_id ORDER BY event_time DESC, type DESC) = 1"


def resolve(sql: str) -> str:
    """The statement with the WITH clause it needs."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for word in re.findall(r"[a-z_]\w*", text):
            if word in CTES and word not in needed:
                visit(CTES[word])
                if word not in needed:
                    needed.append(word)

    visit(sql)
    if not needed:
        return sql
    parts = ",\n".join(f"{name} AS ({CTES[name]})" for name in needed)
    if sql.startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {parts},\n{sql[len('WITH RECURSIVE '):]}"
    return f"WITH {parts}\n{sql}"
