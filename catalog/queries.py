"""Every operator as a query over the test tables, next to the DuckDB statement it must equal."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import oracle as o
from catalog.oracle import has, ms, none, norm
from tokenloom.functions import channels, codes, documents, money, text, times
from tokenloom.functions.ids import free_start_ms, id_time_ms, spread_layout, with_snowflake_ids
from tokenloom.operators import conform, dictionary as dic, latest, lookups, predicates as pred, upsert
from tokenloom.operators.contacts import tokenize_contacts_json
from tokenloom.operators.projection import offset_id, with_constants
from tokenloom.operators.tokenize import (
    HashTokenizer,
    Tokenizer,
    difference_rows,
    ended_counts,
    found_counts,
    preload,
    preload_summary,
    progress_stats,
    reconcile_dictionary,
    reconcile_summary,
    reconcile_verdict,
    summary_of,
    tokenize_or_lookup,
    tokenize_values,
)
from tokenloom.plans import assemble, digests, edges, outputs, verify
from tokenloom.settings import Workspace, shuffles_dropped
from tokenloom.sources.changes import change_image, select_changes
from tokenloom.sources.fixtures import fixture_changes, fixture_sources
from tokenloom.sources.keyed import keyed_sources, only, write_keyed
from tokenloom.sources.observed import CountsWritten, RowsWritten
from tokenloom.sources.schemas import TARGET_KEYS
from tokenloom.sources.sinks import KeyedTable
from tokenloom.sources.tables import Sources, typed_view
from tokenloom.streaming import debounce as deb, enqueue, rebuild, triggers
from tokenloom.streaming.links import LinkJob, load_links

ZONE = "Africa/Lagos"
KIND = codes.VT_TYPES


class Context:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.src = fixture_sources(spark, folder)

    @property
    def dictionary(self) -> DataFrame:
        return self.src["vt_token_cache"]

    @property
    def changes(self) -> DataFrame:
        return fixture_changes(self.spark, self.folder)


QUERIES: dict[str, tuple[Callable[[Context], DataFrame], str | None]] = {}


def add(name: str, run: Callable[[Context], DataFrame], sql: str | None = None) -> None:
    QUERIES[name] = (run, sql)


def column(name: str, table: str, expression, sql: str, key: str = "id") -> None:
    """A scalar function over a whole table."""
    add(
        name,
        lambda c: c.src[table].select(key, expression().alias("value")),
        f"SELECT {key}, {sql} AS value FROM {'dictionary' if table == 'vt_token_cache' else 'src_' + table}",
    )


# --- scalar functions ----------------------------------------------------------------------------
column("f01_normalize_mobile", "user", lambda: text.normalize_mobile("mobile"), norm("mobile"))
column("f02_map_utm_source", "adjust_callback_record", lambda: channels.map_utm_source("network_name", "tracker_name"), o.utm("network_name", "tracker_name"))
column("f03_map_install_source", "adjust_callback_record", lambda: channels.map_install_source("tracker_name"), o.install("tracker_name"))
column("f04_money_minor", "user_order", lambda: money.money_minor("amount_max"), o.minor("amount_max"))
column(
    "f05_money_sum_minor", "user_order_installment", lambda: money.money_sum_minor("amt_due", "penalty_amount"),
    f"cast(coalesce(round({o.amount('amt_due')} + {o.amount('penalty_amount')}, 0), 0) AS bigint)",
)
column("f06_application_no", "user_order", lambda: codes.application_no("app_code", "order_no"), o.app_no("app_code", "order_no"))
column("f07_loan_no", "user_repay", lambda: codes.loan_no("order_no", "current_period"), o.loan_no("order_no", "current_period"), key="order_no")
add(
    "f08_application_risk_status",
    lambda c: c.src["user_order"].join(latest.overdue_by_order(c.src["user_order_installment"]), F.col("id") == F.col("user_order_id"), "left")
    .select("id", codes.application_risk_status("risk_order_status", "is_overdue").alias("value")),
    f"SELECT s.id, {o.app_status('s.risk_order_status', 'v.is_overdue')} AS value FROM src_user_order s LEFT JOIN a_overdue v ON v.user_order_id = s.id",
)
add(
    "f09_loan_status",
    lambda c: c.src["user_order_installment"].join(c.src["user_order"].select(F.col("id").alias("order_id"), "risk_order_status"), F.col("user_order_id") == F.col("order_id"))
    .select("id", codes.loan_status("risk_order_status", "is_overdue", "repaid_amount").alias("value")),
    f"SELECT i.id, {o.loan_status('s.risk_order_status', 'i.is_overdue', 'i.repaid_amount')} AS value FROM src_user_order_installment i JOIN src_user_order s ON s.id = i.user_order_id",
)
column("f10_epoch_ms", "device_network", lambda: times.epoch_ms("create_time", ZONE), ms("create_time"))
column("f11_positive_ms", "user_repay", lambda: times.positive_ms(times.epoch_ms("callback_time", ZONE)), f"CASE WHEN {ms('callback_time')} > 0 THEN {ms('callback_time')} END", key="order_no")
column("f12_lock_expire_ms", "user_order", lambda: times.lock_expire_ms("order_time", ZONE), f"{ms('order_time')} + 604800000")
column("f13_start_date", "user_order", lambda: times.start_date("disburse_time", "order_time"), "coalesce(cast(disburse_time AS date), cast(order_time AS date))")
column(
    "f14_created_ms_from_date", "user_order", lambda: times.created_ms_from_date(F.col("settled_time").cast("date"), ZONE),
    f"greatest(coalesce({ms('cast(cast(settled_time AS date) AS timestamp)')}, 0), 0)",
)
column("f15_parse_salary", "user_work_related", lambda: money.parse_salary("monthly_income").cast("string"), f"cast({o.salary('monthly_income')} AS varchar)")
column("f16_parse_credit_limit", "risk_user_credit_callback", lambda: money.parse_credit_limit("credit_limit").cast("string"), f"cast({o.credit('credit_limit')} AS varchar)")
add(
    "f17_full_name_address",
    lambda c: c.src["user_personal_info"].select("id", text.full_name("first_name", "sur_name").alias("full_name"), text.address_detail("living_address_first_line", "living_address_second_line").alias("detail")),
    f"SELECT id, {o.words('first_name', 'sur_name')} AS full_name, {o.words('living_address_first_line', 'living_address_second_line')} AS detail FROM src_user_personal_info",
)
column("f18_ad_id", "user", lambda: text.first_text("gps_adid", "idfa"), "coalesce(nullif(trim(gps_adid), ''), nullif(trim(idfa), ''))")
add(
    "f19_vt_type_name_code",
    lambda c: c.dictionary.select("id", text.null_to_blank(codes.vt_type_name("vt_type")).alias("name"), codes.vt_type_code(codes.vt_type_name("vt_type")).alias("code")),
    "SELECT id, CASE vt_type WHEN 1 THEN 'mobile' WHEN 2 THEN 'gaid_idfa' WHEN 3 THEN 'bank_account' WHEN 4 THEN 'id_number' WHEN 5 THEN 'emergency_contact' END AS name, vt_type AS code FROM dictionary",
)
column("f20_looks_like_phone", "vt_token_cache", lambda: text.looks_like_phone("raw_value"), "(regexp_matches(trim(raw_value), '^(\\+|0|234)') OR regexp_full_match(trim(raw_value), '[0-9]{7,16}'))")
column("f21_mask_value", "vt_token_cache", lambda: text.mask_value("raw_value"), o.mask("raw_value"))
column("f22_date_text", "user_order", lambda: times.date_text("order_time"), "strftime(order_time, '%Y-%m-%d')")
add(
    "f23_text_probes",
    lambda c: c.dictionary.select(
        "id", F.char_length("raw_value").alias("chars"), F.octet_length("raw_value").alias("bytes"), text.has_nul("raw_value").alias("nul"),
        text.has_tab_or_newline("raw_value").alias("control"), text.strip_nul("raw_value").alias("clean"), text.preview("raw_value").alias("shown"), text.raw_hex("raw_value").alias("hexed")),
    "SELECT id, cast(length(raw_value) AS int) AS chars, cast(strlen(raw_value) AS int) AS bytes, contains(raw_value, chr(0)) AS nul, contains(raw_value, chr(9)) OR contains(raw_value, chr(10)) AS control, "
    "replace(raw_value, chr(0), '') AS clean, left(raw_value, 80) AS shown, hex(raw_value) AS hexed FROM dictionary",
)
def _id_facts(rows: DataFrame, start_ms: int) -> DataFrame:
    """What must hold for ids: none twice, the sequence and worker bits in range, no time before the start."""
    layout = spread_layout()
    worker = F.shiftright("id", layout.sequence_bits).bitwiseAND(F.lit((1 << layout.worker_bits) - 1))
    good = (worker >= layout.worker_base) & (id_time_ms("id", layout) >= start_ms) & (F.col("id") > 0)
    return rows.agg(
        F.count(F.lit(1)).alias("ids"), F.count_distinct("id").alias("distinct_ids"), F.count(F.when(~good, 1)).alias("out_of_range")
    )


ID_START = 1_700_000_000_000


def _chained(runs: list[Callable[[int], DataFrame]]) -> DataFrame:
    """The ids of several runs, each starting after the last one of the runs before it."""
    done = runs[0](ID_START)
    for run in runs[1:]:
        done = done.unionByName(run(free_start_ms(done, ID_START)))
    return done


add(
    "f24_snowflake_id",
    lambda c: _id_facts(
        _chained(
            [lambda start: with_snowflake_ids(c.src["user_bank_info"].select(F.col("id").alias("card_id")), ["card_id"], start).select("id")] * 2
        ),
        ID_START,
    ),
    "SELECT 2 * count(*) AS ids, 2 * count(*) AS distinct_ids, 0 AS out_of_range FROM src_user_bank_info",
)

# --- projections and predicates ------------------------------------------------------------------
column("p01_offset_id", "user", lambda: offset_id("id"), "id + 100000000")
add(
    "p02_with_constants",
    lambda c: with_constants(c.src["user"].select("id"), {"closed_time": (0, "bigint"), "bid": "ng01", "rates": codes.SCHEME_RATES}),
    f"SELECT id, cast(0 AS bigint) AS closed_time, 'ng01' AS bid, '{codes.SCHEME_RATES}' AS rates FROM src_user",
)
add(
    "p03_blank_null",
    lambda c: c.src["user"].select("id", text.blank_to_null("gps_adid").alias("nulled"), text.null_to_blank("device_id").alias("blanked")),
    "SELECT id, nullif(trim(gps_adid), '') AS nulled, coalesce(device_id, '') AS blanked FROM src_user",
)
add(
    "p04_filter_token_ready",
    lambda c: assemble.assemble_application(c.src).filter(pred.token_ready(["mobile_token", "bank_account_token"], {"id_number_token": "bvn_raw"})).select("id"),
    f"SELECT id FROM st_app WHERE {o.APP_READY}",
)
add(
    "p05_filter_token_miss",
    lambda c: assemble.assemble_application(c.src).filter(pred.token_miss(outputs.APPLICATION_TOKENS)).select("id"),
    f"SELECT id FROM st_app WHERE {o.APP_MISS}",
)
for name, table, condition, sql in (
    ("p06_filter_live_bankcards", "user_bank_info", pred.live_bankcard, o.LIVE),
    ("p07_filter_default_bankcards", "user_bank_info", pred.default_bankcard, f"{o.LIVE} AND is_default = 1"),
    ("p08_filter_valid_orders", "user_order", pred.has_order_no, has("order_no")),
    ("p09_filter_loan_orders", "user_order", pred.loan_order, "risk_order_status NOT IN (0, 2, 4, 6, 8)"),
):
    add(name, lambda c, table=table, condition=condition: c.src[table].filter(condition()).select("id"), f"SELECT id FROM src_{table} WHERE {sql}")
add(
    "p10_filter_paid_callbacks",
    lambda c: c.src["user_repay"].filter(pred.paid_callback()).select("order_no", "current_period", "callback_time"),
    f"SELECT order_no, current_period, callback_time FROM src_user_repay WHERE {o.PAID}",
)
add(
    "p11_changed",
    lambda c: c.changes.filter((F.col("op") == "u") & pred.changed("device_id", "tracker_name")).select("position"),
    "SELECT event_id AS position FROM src_changes WHERE op = 'u' AND (before_device_id IS DISTINCT FROM after_device_id OR before_tracker_name IS DISTINCT FROM after_tracker_name)",
)
add(
    "p12_conform_violations",
    lambda c: conform.violations(conform.conform(outputs.loan_output(c.src), "loan"), "loan"),
    f"SELECT 'loan' AS target, 'due_date' AS \"column\", 'not_null' AS rule, count(*) AS cnt FROM ({o.loan_sql()}) WHERE due_date IS NULL UNION ALL "
    f"SELECT 'loan', 'due_date_final', 'not_null', count(*) FROM ({o.loan_sql()}) WHERE due_date IS NULL",
)
add(
    "p12_quarantine_loan",
    lambda c: conform.split_conformed(outputs.loan_output(c.src), "loan")[1].select("application_no", "period", "roll_sequence", "broken_rules"),
    f"SELECT application_no, period, roll_sequence, ['due_date.not_null', 'due_date_final.not_null'] AS broken_rules FROM ({o.loan_sql()}) WHERE due_date IS NULL",
)
add(
    "p12_conformed_loan",
    lambda c: conform.split_conformed(outputs.loan_output(c.src), "loan")[0].select("application_no", "period", "roll_sequence", "due_date"),
    f"SELECT application_no, period, roll_sequence, due_date FROM ({o.loan_sql()}) WHERE due_date IS NOT NULL",
)
add(
    "p12_conform_application",
    lambda c: conform.conform(outputs.application_output(c.src), "application"),
    f"SELECT *, cast(NULL AS date) AS due_date, cast(NULL AS date) AS due_date_final FROM ({o.app_sql(o.APP_HIT)})",
)
add(
    "p13_typed_view",
    lambda c: typed_view(c.src["user_order_installment"].select(*[F.col(x).cast("string").alias(x) for x in ("id", "user_order_id", "current_period", "is_overdue", "create_time")]), "id bigint, user_order_id bigint, current_period int, is_overdue int, create_time timestamp_ntz"),
    "SELECT id, user_order_id, current_period, is_overdue, create_time FROM src_user_order_installment",
)

# --- newest rows ---------------------------------------------------------------------------------
PROFILE = ", ".join(latest.PROFILE_COLUMNS)
ADJUST = ", ".join(latest.ADJUST_COLUMNS)
add("w01_profile_latest", lambda c: latest.profile_latest(c.src["user_personal_info"]), f"SELECT user_id, {PROFILE} FROM w_profile")
add("w02_bvn_latest", lambda c: latest.bvn_latest(c.src["user_personal_info"]), "SELECT user_id, bvn FROM w_bvn")
add("w03_default_card_latest", lambda c: latest.default_card_latest(c.src["user_bank_info"]), "SELECT user_id, bank_code, bank_holder, bank_account FROM w_card")
add("w04_device_latest", lambda c: latest.device_latest(c.src["device_ids"]), "SELECT device_uuid, session_uuid, aaid FROM w_device")
add("w05_credit_latest", lambda c: latest.credit_latest(c.src["risk_user_credit_callback"]), "SELECT user_id, credit_limit FROM w_credit")
REG_IP = (lambda c: lookups.registration_ip(c.src["user"], c.src["device_ids"], c.src["device_network"]), "SELECT user_id, ip FROM w_ip")
add("w06_registration_ip_latest", *REG_IP)
add("w07_product_latest", lambda c: latest.product_latest(c.src["user_order"]), "SELECT user_id, product_id, amount_max FROM w_product")
add("w08_work_latest", lambda c: latest.work_latest(c.src["user_work_related"]), "SELECT user_id, work_type, occupation, company_name, monthly_income FROM w_work")
add("w09_bankcard_by_account", lambda c: latest.bankcard_by_account(c.src["user_bank_info"]), f"SELECT trim(bank_account) AS bank_account, max(id) AS bank_id FROM src_user_bank_info WHERE {o.LIVE} GROUP BY 1")
ADJUST_LATEST = (lambda c: latest.adjust_latest(c.src["adjust_callback_record"]), f"SELECT adid, {ADJUST} FROM w_adjust")
add("w10_adjust_latest", *ADJUST_LATEST)

# --- joins ---------------------------------------------------------------------------------------
add("j01_join_token", lambda c: assemble.assemble_bankcard(c.src).select("id", "bank_account_raw", "bank_account_token"), "SELECT id, bank_account_raw, bank_account_token FROM st_card")
add(
    "j02_join_adjust",
    lambda c: lookups.join_adjust(c.src["user"].select("id", "adid"), c.src["adjust_callback_record"]),
    f"SELECT u.id, u.adid, {ADJUST} FROM src_user u LEFT JOIN (SELECT adid AS a_adid, {ADJUST} FROM w_adjust) a ON u.adid <> '' AND a_adid = u.adid",
)
add("j03_assemble_user", lambda c: assemble.assemble_user(c.src), "SELECT * FROM st_user")
add(
    "j04_assemble_user_info",
    lambda c: assemble.assemble_user_info(c.src).drop("bvn").withColumn("emergency_contacts", documents.to_json_text(F.col("emergency_contacts"))),
    "SELECT i.*, cast(c.contacts AS varchar) AS emergency_contacts FROM st_info i LEFT JOIN contacts_staged c ON c.user_id = i.user_id",
)
add("j05_assemble_application", lambda c: assemble.assemble_application(c.src), "SELECT * FROM st_app")
add("j06_assemble_loan", lambda c: assemble.assemble_loan(c.src), "SELECT * FROM st_loan")
add("j07_registration_ip", *REG_IP)
CHANGED_USERS = "SELECT row_id AS user_id FROM src_changes WHERE source_table = 'user' UNION SELECT u.id FROM src_changes c JOIN src_user u ON trim(u.adid) = trim(c.adid) WHERE c.source_table = 'adjust_callback_record'"
add(
    "j08_lookup_join",
    lambda c: lookups.join_adjust(
        rebuild.for_users(c.src, triggers.user_keys(c.changes, c.src), Workspace(c.spark).keep)["user"].select("id", "app_code", "adid"), c.src["adjust_callback_record"], ["network_name", "tracker_name"]
    ),
    f"SELECT s.id, s.app_code, s.adid, s.network_name, s.tracker_name FROM st_user s JOIN ({CHANGED_USERS}) k ON k.user_id = s.id",
)


def _keyed(c: Context) -> Sources:
    folder = Workspace(c.spark).folder
    write_keyed(Sources({n: lambda n=n: c.src[n] for n in ("user", "user_bank_info")}), folder, 32)
    return keyed_sources(c.spark, folder)


add(
    "s3_lookup_source",
    lambda c: only(_keyed(c)["user_bank_info"], "user_id", triggers.user_keys(c.changes, c.src)).select("id", "user_id", "bank_account"),
    f"SELECT b.id, b.user_id, b.bank_account FROM src_user_bank_info b WHERE b.user_id IN (SELECT user_id FROM ({CHANGED_USERS}))",
)
CHANGED_ORDERS = (
    "SELECT s.id AS order_id FROM src_user_order s JOIN (SELECT row_id AS user_id FROM src_changes WHERE source_table = 'user' UNION SELECT before_user_id FROM src_changes WHERE source_table = 'user_personal_info' AND op = 'u' "
    "UNION SELECT after_user_id FROM src_changes WHERE source_table = 'user_personal_info') k ON k.user_id = s.user_id"
)
add("j09_change_to_order", lambda c: triggers.application_keys(c.changes, c.src), CHANGED_ORDERS)
add(
    "j10_anti_join_untokenised",
    lambda c: lookups.anti_join_untokenised(dic.source_values(c.src), c.dictionary),
    f"SELECT cast(vt_type AS int) AS vt_type, raw_value FROM seeds s WHERE NOT EXISTS (SELECT 1 FROM dictionary d WHERE d.vt_type = s.vt_type AND d.raw_value = s.raw_value AND d.status = 1 AND {has('d.token')})",
)
add("j11_adjust_latest_by_max_id", *ADJUST_LATEST)
BVN_USERS = f"SELECT DISTINCT d.raw_value AS bvn, p.user_id FROM dictionary d JOIN src_user_personal_info p ON trim(p.bvn) = trim(d.raw_value) WHERE d.vt_type = 4 AND {has('p.bvn')}"
add(
    "j12_users_of_bvn",
    lambda c: lookups.users_of_bvn(c.dictionary.filter("vt_type = 4").select("raw_value", F.col("raw_value").alias("bvn")), c.src["user_personal_info"]),
    BVN_USERS,
)
add(
    "j12_users_of_adid",
    lambda c: lookups.users_of_adid(c.src["adjust_callback_record"].select("adid", F.col("adid").alias("seen")), c.src["user"]),
    "SELECT DISTINCT a.adid AS seen, u.id AS user_id FROM src_adjust_callback_record a JOIN src_user u ON trim(u.adid) = trim(a.adid)",
)
add(
    "j12_users_of_contact",
    lambda c: lookups.users_of_contact(c.dictionary.filter("vt_type = 5").select("raw_value", F.col("raw_value").alias("number")), c.src["user_emergency_contact"]),
    f"SELECT DISTINCT d.raw_value AS number, e.user_id FROM dictionary d JOIN src_user_emergency_contact e ON {norm('e.contact_number')} = trim(d.raw_value) WHERE d.vt_type = 5",
)
add("j13_join_source_target", lambda c: verify.join_source_target(verify.incremental_bundle(c.src), _target(c)).select("user_id", "expected_full_name", "target_full_name"),
    "SELECT b.user_id, b.expected_full_name, t.full_name AS target_full_name FROM bundle b LEFT JOIN target_info t ON t.user_id = b.user_id + 100000000")


def _target(c: Context) -> DataFrame:
    """A target with rows left out and rows out of date: what a load of the newest BVN's owners
    wrote, minus users whose newest profile has no first name, names as of their first profile."""
    first = latest.latest_by(c.src["user_personal_info"].withColumn("older", -F.col("id")), ["user_id"], ["older"], ["first_name", "sur_name"])
    return first.filter(F.col("first_name").isNotNull()).select(offset_id("user_id").alias("user_id"), text.full_name("first_name", "sur_name").alias("full_name"))


o.CTES["target_info"] = (
    f"SELECT user_id + 100000000 AS user_id, {o.words('first_name', 'sur_name')} AS full_name FROM (SELECT * FROM src_user_personal_info QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY id) = 1) WHERE first_name IS NOT NULL"
)
EDGE_COUNTS = "SELECT id, app_id, mapping_id, type, event_time, count(*) AS n FROM edges GROUP BY ALL"
add("j14_edge_joins", lambda c: edges.row_count(c.src), "SELECT count(*) AS id_mapping_cnt FROM edges")


def _edges_of(kind: str) -> Callable[[Context], DataFrame]:
    """The edges that one kind of row states, joined to the identifiers of its user or device."""
    if kind == "device":
        return lambda c: edges.stated_edges(edges.device_pairs(c.src, every_time=True))
    return lambda c: edges.stated_edges(edges.user_pairs(c.src, every_time=True, stated_by=(kind,)))


for _kind, _branches in {"order": slice(0, 5), "user": slice(5, 7), "card": slice(7, 8), "device": slice(8, 9)}.items():
    add(f"j14_edges_by_{_kind}", _edges_of(_kind), f"SELECT id, app_id, mapping_id, type, event_time, count(*) AS n FROM ({' UNION ALL '.join(o.EDGE_BRANCHES[_branches])}) GROUP BY ALL")

# --- aggregates ----------------------------------------------------------------------------------
add("a01_approval_latest_by_order", lambda c: latest.approval_latest_by_order(c.src["risk_user_approval_callback"]), "SELECT * FROM a_approval")
add("a02_paid_latest_by_order", lambda c: latest.paid_latest_by_order(c.src["user_repay"]), "SELECT * FROM a_paid")
add("a03_paid_latest_by_order_period", lambda c: latest.paid_latest_by_order_period(c.src["user_repay"]), "SELECT * FROM a_paid_period")
add("a04_overdue_by_order", lambda c: latest.overdue_by_order(c.src["user_order_installment"]), "SELECT * FROM a_overdue")
add("a05_user_by_adid", lambda c: latest.user_by_adid(c.src["user"]), f"SELECT adid, max(id) AS user_id FROM src_user WHERE {has('adid')} GROUP BY adid")
add(
    "a06_contacts_json_by_user",
    lambda c: assemble.contacts_json_by_user(c.src).select("user_id", documents.to_json_text(F.col("emergency_contacts")).alias("contacts")),
    "SELECT user_id, cast(contacts AS varchar) AS contacts FROM contacts_staged",
)
add("a07_dict_stats", lambda c: dic.dict_stats(c.dictionary), "SELECT vt_type, status, count(*) AS cnt FROM dictionary GROUP BY ALL")
add("a08_dict_ok_count", lambda c: dic.dict_ok_count(c.dictionary), "SELECT vt_type, count(*) FILTER (status = 1 AND token <> '') AS ok_cnt FROM dictionary GROUP BY 1")
GAP = f"status = 0 AND {has('raw_value')} AND length(raw_value) <= 128"
add(
    "a09_pending_gap",
    lambda c: dic.pending_gap(c.dictionary),
    f"SELECT vt_type, count(*) FILTER (status = 0) AS pending_all, count(*) FILTER (status = 0 AND {none('raw_value')}) AS empty_raw, count(*) FILTER (status = 0 AND length(raw_value) > 128) AS too_long, count(*) FILTER ({GAP}) AS claimable FROM dictionary GROUP BY 1",
)
add(
    "a10_distinct_user_keys",
    lambda c: verify.distinct_keys(assemble.assemble_user(c.src), ["mobile_token", "app_code"], pred.token_ready(["mobile_token"])),
    f"SELECT count(*) AS cnt FROM (SELECT DISTINCT mobile_token, app_code FROM st_user WHERE {has('mobile_token')})",
)
add(
    "a10_distinct_card_keys",
    lambda c: verify.distinct_keys(assemble.assemble_bankcard(c.src), ["user_id", "bank_account_token"], pred.token_ready(["bank_account_token"])),
    f"SELECT count(*) AS cnt FROM (SELECT DISTINCT user_id, bank_account_token FROM st_card WHERE {has('bank_account_token')})",
)


def _wide(c: Context) -> dict[str, DataFrame]:
    return {
        "user": assemble.assemble_user(c.src),
        "user_info": assemble.assemble_user_info(c.src),
        "user_bankcard": assemble.assemble_bankcard(c.src),
        "application": assemble.assemble_application(c.src),
    }


def _missing(c: Context) -> DataFrame:
    w = _wide(c)
    return verify.missing_token_report(w["user"], w["user_bankcard"], w["user_info"], w["application"])


add(
    "a11_missing_token_report",
    _missing,
    f"SELECT 'user' AS tbl, count(*) AS missing_token FROM st_user WHERE {o.USER_MISS} UNION ALL SELECT 'user_bankcard', count(*) FROM st_card WHERE {o.CARD_MISS} UNION ALL SELECT 'user_info', count(*) FROM st_info WHERE {o.INFO_MISS} "
    f"UNION ALL SELECT 'application_mobile', count(*) FROM st_app WHERE {none('mobile_token')} UNION ALL SELECT 'application_id_number', count(*) FROM st_app WHERE {none('id_number_token')} UNION ALL SELECT 'application_bank', count(*) FROM st_app WHERE {none('bank_account_token')}",
)
add(
    "a12_row_count_report",
    lambda c: verify.row_count_report({"user": assemble.assemble_user(c.src), "bankcard": assemble.assemble_bankcard(c.src), "user_info": assemble.assemble_user_info(c.src), "user_product": assemble.assemble_product(c.src), "application": assemble.assemble_application(c.src), "loan": assemble.assemble_loan(c.src)}),
    "SELECT (SELECT count(*) FROM st_user) AS user_cnt, (SELECT count(*) FROM st_card) AS bankcard_cnt, (SELECT count(*) FROM st_info) AS user_info_cnt, (SELECT count(*) FROM st_product) AS user_product_cnt, (SELECT count(*) FROM st_app) AS application_cnt, (SELECT count(*) FROM st_loan) AS loan_cnt",
)
OVERSIZE = "SELECT vt_type, status, count(*) AS cnt, cast(max(length(raw_value)) AS int) AS max_chars, cast(max(strlen(raw_value)) AS int) AS max_bytes FROM dictionary WHERE length(raw_value) > 128 GROUP BY ALL"
add("a13_oversize_report", lambda c: dic.oversize_report(c.dictionary), OVERSIZE)
add("a13_oversize_mobiles", lambda c: dic.oversize_mobiles(c.src["user"]), f"SELECT count(*) AS cnt, cast(max(length(n)) AS int) AS max_chars FROM (SELECT {norm('mobile')} AS n FROM src_user) WHERE length(n) > 128")
add(
    "a14_nul_duplicates",
    lambda c: dic.nul_duplicates(c.dictionary),
    "SELECT vt_type, replace(raw_value, chr(0), '') AS raw_clean, count(*) AS dup_cnt, string_agg(cast(id AS varchar), ',' ORDER BY id) AS ids, string_agg(cast(status AS varchar), ',' ORDER BY id) AS statuses FROM dictionary GROUP BY 1, 2 HAVING count(*) > 1 ORDER BY dup_cnt DESC, 1, 2 LIMIT 20",
)


def _shard(c: Context, table: str) -> DataFrame:
    """A queue shard: the newest change per user of one table."""
    rows = c.changes.filter(F.col("source_table") == table)
    return rows.groupBy(F.col("after.user_id").alias("user_id")).agg(F.max("ts").alias("updated_at"))


SHARDS = ("user", "user_personal_info", "user_emergency_contact", "risk_user_credit_callback")
add(
    "a15_merge_queue_shards",
    lambda c: enqueue.merge_queue_shards([_shard(c, t) for t in SHARDS], _shard(c, "adjust_callback_record")),
    "SELECT after_user_id AS user_id, max(ts) AS updated_at FROM src_changes WHERE source_table IN ('user', 'user_personal_info', 'user_emergency_contact', 'risk_user_credit_callback', 'adjust_callback_record') GROUP BY 1",
)
add("a16_nul_padded", lambda c: dic.nul_padded(c.dictionary), "SELECT vt_type, count(*) AS cnt FROM dictionary WHERE contains(raw_value, chr(0)) GROUP BY 1")
add("a16_control_chars", lambda c: dic.control_chars(c.dictionary), "SELECT vt_type, count(*) AS cnt FROM dictionary WHERE status = 0 AND (contains(raw_value, chr(9)) OR contains(raw_value, chr(10))) GROUP BY 1")

# --- top lists, set operations -------------------------------------------------------------------
add(
    "o1_latest_queued_users",
    lambda c: verify.dirty_sample(c.src["user_info_dirty"], verify.incremental_bundle(c.src)).select("user_id", "updated_at"),
    "SELECT q.user_id, q.updated_at FROM src_user_info_dirty q JOIN src_user u ON u.id = q.user_id ORDER BY q.updated_at DESC, q.user_id DESC LIMIT 20",
)
add(
    "o2_longest_mobiles",
    lambda c: dic.longest_mobiles(c.src["user"]),
    f"SELECT id, cast(length(mobile) AS int) AS src_chars, left(mobile, 80) AS mobile_preview, {norm('mobile')} AS mobile_norm, cast(length({norm('mobile')}) AS int) AS norm_chars FROM src_user WHERE {has('mobile')} ORDER BY norm_chars DESC, id LIMIT 10",
)
add("o2_longest_pending", lambda c: dic.longest_pending(c.dictionary), "SELECT id, cast(length(raw_value) AS int) AS chars, left(raw_value, 80) AS raw_preview FROM dictionary WHERE vt_type = 1 AND status = 0 ORDER BY chars DESC, id LIMIT 10")
add("o3_pending_batch", lambda c: dic.pending_batch(c.dictionary, 50).select("id", "vt_type", "raw_value"), f"SELECT id, vt_type, raw_value FROM dictionary WHERE {GAP} ORDER BY id LIMIT 50")
add("u1_union_triggers", lambda c: triggers.user_keys(c.changes, c.src), f"SELECT DISTINCT user_id FROM ({CHANGED_USERS})")
AD_IDS = "SELECT trim(gps_adid) AS v FROM src_user UNION SELECT trim(idfa) FROM src_user UNION SELECT trim(aaid) FROM src_device_ids UNION SELECT trim(idfa) FROM src_device_ids"
add("u2_distinct_ad_ids", lambda c: dic.distinct_ad_ids(c.src), f"SELECT v AS raw_value FROM ({AD_IDS}) WHERE {has('v')}")
add("u3_edge_union", lambda c: edges.edge_rows(c.src), EDGE_COUNTS)

# --- documents -----------------------------------------------------------------------------------
STAGED_INFO = f"SELECT i.user_id, {o.info('c.contacts')} AS info FROM st_info i LEFT JOIN contacts_staged c ON c.user_id = i.user_id"
add("n1_info_json", lambda c: assemble.assemble_user_info(c.src).select("user_id", documents.info_json(ZONE).alias("info")), STAGED_INFO)
add("n2_repayment_plan_json", lambda c: c.src["user_order"].select("id", documents.repayment_plan_json().alias("plan")), f"SELECT o.id, {o.PLAN} AS plan FROM src_user_order o")
add("n3_scheme_json", lambda c: outputs.product_output(c.src).select("group_user_id", "product_id", "schemes"), f"SELECT group_user_id, product_id, schemes FROM ({o.PRODUCT})")
CONTACT_ROWS = "array<struct<name:string,mobile:string,relation:int>>"


def _contact_documents(c: Context) -> DataFrame:
    """Staged profile documents with their contacts tokenised, contacts read back as rows."""
    staged = assemble.assemble_user_info(c.src).select("user_id", documents.info_json(ZONE).alias("info"))
    done = tokenize_contacts_json(staged, "info", HashTokenizer(), "user_id")
    parsed = F.from_json("info", f"struct<emergency_contacts:{CONTACT_ROWS},salary_monthly:int>")
    rows = done.select("user_id", parsed.alias("p"))
    return rows.select("user_id", "p.salary_monthly", F.posexplode("p.emergency_contacts").alias("pos", "contact")).select("user_id", "salary_monthly", "pos", "contact.*")


add(
    "n4_tokenize_contacts_json",
    _contact_documents,
    f"""SELECT user_id, 1 AS salary_monthly, cast(row_number() OVER (PARTITION BY user_id ORDER BY id) - 1 AS int) AS pos, nullif(trim(contact_name), '') AS name,
 CASE WHEN n IS NOT NULL THEN {o.token(5, 'n')} END AS mobile, contact_relationship AS relation FROM (SELECT *, {norm('contact_number')} AS n FROM src_user_emergency_contact)""",
)
add(
    "n5_merge_contacts",
    lambda c: c.src["user_order"].join(
        assemble.contacts_json_by_user(c.src).select("user_id", documents.to_json_text(F.col("emergency_contacts")).alias("contacts")), "user_id", "left"
    ).select("id", documents.merge_contacts(documents.repayment_plan_json(), F.col("contacts")).alias("merged")),
    f"SELECT o.id, left({o.PLAN}, length({o.PLAN}) - 1) || ',\"emergency_contacts\":' || coalesce(cast(c.contacts AS varchar), '[]') || '}}' AS merged FROM src_user_order o LEFT JOIN contacts_staged c ON o.user_id = c.user_id",
)

# --- dictionary and tokenizer --------------------------------------------------------------------


class BatchHash(Tokenizer):
    """The hash tokenizer as a service would be called: in batches, from Python."""

    def call(self, vt_type, values):
        import hashlib

        return [hashlib.sha256(f"{vt_type}:{v}".encode()).hexdigest()[:28] for v in values], None


class TurnedHash(HashTokenizer):
    """A hash whose answers partly changed since the dictionary was filled."""

    def column(self, vt_type, raw):
        token = super().column(vt_type, raw)
        first = F.left(token, F.lit(1))
        return F.when(first == "2", F.reverse(token)).when(first == "3", "").otherwise(token)


ALL_SEEDS = "SELECT cast(vt_type AS int) AS vt_type, raw_value FROM seeds"
DICT_COLUMNS = "id, vt_type, raw_value, token, masking, status, retry_count, last_error"
add("t1_seed_dictionary", lambda c: dic.seed_dictionary(c.src).select("vt_type", "raw_value", "status"), f"SELECT *, 0 AS status FROM ({ALL_SEEDS})")
add(
    "s6_insert_ignore",
    lambda c: dic.insert_ignore(c.dictionary.filter("status = 1"), dic.source_values(c.src), dic.KEY),
    f"SELECT * FROM ({ALL_SEEDS}) s WHERE NOT EXISTS (SELECT 1 FROM dictionary d WHERE d.status = 1 AND d.vt_type = s.vt_type AND d.raw_value = s.raw_value)",
)
TOO_LONG = "status IN (0, 2) AND length(raw_value) > 128"
OVERSIZE_MARKED = (
    f"SELECT id, vt_type, raw_value, token, masking, cast(CASE WHEN {TOO_LONG} THEN 2 ELSE status END AS int) AS status, cast(retry_count + CASE WHEN {TOO_LONG} THEN 1 ELSE 0 END AS int) AS retry_count, "
    f"CASE WHEN {TOO_LONG} THEN 'raw_value too long (>128)' ELSE last_error END AS last_error FROM dictionary"
)
add("t2_mark_oversize", lambda c: dic.mark_oversize(c.dictionary), OVERSIZE_MARKED)
add("t3_select_work_fast", lambda c: dic.select_work(c.dictionary), f"SELECT vt_type, raw_value FROM dictionary WHERE {GAP}")
add("t3_select_work_retry", lambda c: dic.select_work(c.dictionary, retry_failed=True), f"SELECT vt_type, raw_value FROM dictionary WHERE {GAP.replace('status = 0', 'status = 2')}")
add(
    "t3_select_work_stream",
    lambda c: dic.select_work(c.dictionary, "stream", sources=c.src),
    f"SELECT * FROM ({ALL_SEEDS}) s WHERE NOT EXISTS (SELECT 1 FROM dictionary d WHERE d.vt_type = s.vt_type AND d.raw_value = s.raw_value AND d.status = 1)",
)
add(
    "t4_tokenize_values_batched",
    lambda c: tokenize_values(dic.source_values(c.src), BatchHash(), batch=500).select("vt_type", "raw_value", "token", "status"),
    f"SELECT *, {o.token('vt_type', 'raw_value')} AS token, 1 AS status FROM ({ALL_SEEDS})",
)
add(
    "t5_hash_tokenizer",
    lambda c: tokenize_values(dic.source_values(c.src), HashTokenizer("salt-")).select("vt_type", "raw_value", "token", "masking", "status"),
    f"SELECT *, substr(sha256(concat('salt-', vt_type, ':', raw_value)), 1, 28) AS token, {o.mask('raw_value')} AS masking, 1 AS status FROM ({ALL_SEEDS})",
)
add(
    "t6_tokenize_or_lookup",
    lambda c: tokenize_or_lookup(assemble.assemble_user(c.src), "mobile_norm", "mobile_token", KIND["mobile"], HashTokenizer()).select("id", "mobile_token"),
    f"SELECT id, mobile_token FROM ({o.USER_FILLED})",
)
DONE = "status = 0 AND length(raw_value) <= 128 AND trim(raw_value) <> ''"
PRELOADED = (
    f"SELECT id, vt_type, raw_value, CASE WHEN {DONE} THEN {o.token('vt_type', 'raw_value')} ELSE token END AS token, CASE WHEN {DONE} THEN {o.mask('raw_value')} ELSE masking END AS masking, "
    f"cast(CASE WHEN {DONE} THEN 1 ELSE status END AS int) AS status, cast(CASE WHEN {DONE} THEN 0 ELSE retry_count END AS int) AS retry_count, CASE WHEN {DONE} THEN NULL ELSE last_error END AS last_error FROM ({OVERSIZE_MARKED})"
)
add("t7_preload", lambda c: preload(c.dictionary, HashTokenizer()), PRELOADED)
add(
    "t7_preload_summary",
    lambda c: preload_summary(c.dictionary, preload(c.dictionary, HashTokenizer())).select("vt_type", "work", "done", "remaining", "failed_rows", "percent", "state"),
    f"SELECT b.vt_type, work, work AS done, cast(0 AS bigint) AS remaining, failed_rows, CASE WHEN work > 0 THEN 100.0::double ELSE 0.0::double END AS percent, CASE WHEN failed_rows > 0 THEN 'FAILED' ELSE 'DONE' END AS state "
    f"FROM (SELECT vt_type, count(*) FILTER ({GAP}) AS work FROM dictionary GROUP BY 1) b JOIN (SELECT vt_type, count(*) FILTER (status = 2) AS failed_rows FROM ({PRELOADED}) GROUP BY 1) a ON a.vt_type = b.vt_type",
)
RECONCILED = """SELECT *, CASE WHEN left(token, 1) = '3' THEN 'LOST' WHEN left(token, 1) = '2' AND reverse(token) <> token THEN 'CHANGED' ELSE 'MATCH' END AS class FROM dictionary WHERE status = 1"""
add("t8_reconcile_dictionary", lambda c: reconcile_dictionary(c.dictionary, TurnedHash()).select("id", "class"), f"SELECT id, class FROM ({RECONCILED})")
add("t8_reconcile_summary", lambda c: reconcile_summary(reconcile_dictionary(c.dictionary, TurnedHash())), f"SELECT class, count(*) AS cnt FROM ({RECONCILED}) GROUP BY 1")
add(
    "t8_reconcile_verdict",
    lambda c: reconcile_verdict(reconcile_summary(reconcile_dictionary(c.dictionary, HashTokenizer()))),
    "SELECT count(*) AS total, cast(0 AS bigint) AS wrong, 'PASS' AS result FROM dictionary WHERE status = 1",
)
add(
    "s11_difference_rows",
    lambda c: difference_rows(reconcile_dictionary(c.dictionary, TurnedHash())).select("class", "id", "vt_type", "raw_hex", "db_token"),
    f"SELECT class, id, vt_type, hex(raw_value) AS raw_hex, token AS db_token FROM ({RECONCILED}) WHERE class <> 'MATCH'",
)


def _results(c: Context) -> DataFrame:
    """Token results for rows that are not good yet: pending ones succeed, failed ones fail again."""
    open_rows = c.dictionary.filter((F.col("status") != 1) & (F.char_length("raw_value") <= 128))
    good = F.col("status") == 0
    return open_rows.select(
        "id", "vt_type", "raw_value", F.when(good, F.md5("raw_value")).alias("token"), F.when(good, F.lit("***")).alias("masking"),
        F.when(good, 1).otherwise(2).alias("status"), F.when(~good, F.repeat(F.lit("e"), F.lit(600))).alias("error"),
    )


APPLIED = f"""SELECT id, vt_type, raw_value, CASE WHEN hit AND status = 0 THEN md5(raw_value) ELSE token END AS token, CASE WHEN hit AND status = 0 THEN '***' ELSE masking END AS masking,
 cast(CASE WHEN hit AND status = 0 THEN 1 ELSE status END AS int) AS status, cast(CASE WHEN hit AND status = 0 THEN 0 WHEN hit THEN retry_count + 1 ELSE retry_count END AS int) AS retry_count,
 CASE WHEN hit AND status = 0 THEN NULL WHEN hit THEN repeat('e', 500) ELSE last_error END AS last_error FROM (SELECT *, status <> 1 AND length(raw_value) <= 128 AS hit FROM dictionary)"""
add("s7_upsert_dict", lambda c: dic.upsert_dict(c.dictionary, _results(c)), APPLIED)
add("s8_upsert_dict_failed", lambda c: dic.upsert_dict(c.dictionary, _results(c).filter("status = 2")).filter("status = 2"), f"SELECT * FROM ({APPLIED}) WHERE status = 2")
add("s9_update_dict_by_id", lambda c: dic.update_dict_by_id(c.dictionary, _results(c).drop("vt_type", "raw_value")), APPLIED)
add(
    "s10_replace_dict_rows",
    lambda c: dic.replace_dict_rows(c.dictionary, _results(c).filter("status = 1")),
    "SELECT id, vt_type, raw_value, CASE WHEN hit THEN md5(raw_value) ELSE token END AS token, CASE WHEN hit THEN '***' ELSE masking END AS masking, cast(CASE WHEN hit THEN 1 ELSE status END AS int) AS status, "
    "cast(CASE WHEN hit THEN 0 ELSE retry_count END AS int) AS retry_count, CASE WHEN hit THEN NULL ELSE last_error END AS last_error FROM (SELECT *, status = 0 AND length(raw_value) <= 128 AS hit FROM dictionary)",
)
add(
    "s4_upsert_rows",
    lambda c: upsert.upsert_rows(c.src["user_info_dirty"], _shard(c, "user"), ["user_id"]),
    "SELECT q.user_id, coalesce(s.m, q.updated_at) AS updated_at FROM src_user_info_dirty q LEFT JOIN (SELECT after_user_id, max(ts) AS m FROM src_changes WHERE source_table = 'user' GROUP BY 1) s ON s.after_user_id = q.user_id",
)
add(
    "s5_key_violations",
    lambda c: upsert.key_violations(c.src["user_repay"], ["order_no", "current_period"]),
    "SELECT order_no, current_period, count(*) AS n FROM src_user_repay GROUP BY ALL HAVING count(*) > 1 OR order_no IS NULL OR current_period IS NULL",
)
add(
    "r7_dedupe_last",
    lambda c: upsert.dedupe_last(c.changes.select("source_table", F.col("after.id").alias("id"), "op", "ts", "position"), ["source_table", "id"], ["position"]),
    "SELECT source_table, row_id AS id, op, ts, event_id AS position FROM src_changes QUALIFY row_number() OVER (PARTITION BY source_table, row_id ORDER BY event_id DESC) = 1",
)

# --- changes -------------------------------------------------------------------------------------
DIRTY = f"""SELECT row_id AS user_id, ts, 10 AS wait_s FROM src_changes WHERE source_table = 'user' AND (op = 'c' OR before_device_id IS DISTINCT FROM after_device_id)
 UNION ALL SELECT before_user_id, ts, 10 FROM src_changes WHERE source_table = 'user_personal_info' AND op = 'u' AND before_user_id IS DISTINCT FROM after_user_id
 UNION ALL SELECT after_user_id, ts, 10 FROM src_changes WHERE source_table IN ('user_personal_info', 'user_emergency_contact')
 UNION ALL SELECT after_user_id, ts, 30 FROM src_changes WHERE source_table = 'risk_user_credit_callback'
 UNION ALL SELECT DISTINCT p.user_id, c.ts, 60 FROM src_changes c JOIN src_user_personal_info p ON trim(p.bvn) = trim(c.raw_value) WHERE c.source_table = 'vt_token_cache' AND c.vt_type = 4
 UNION ALL SELECT DISTINCT e.user_id, c.ts, 60 FROM src_changes c JOIN src_user_emergency_contact e ON {norm('e.contact_number')} = trim(c.raw_value) WHERE c.source_table = 'vt_token_cache' AND c.vt_type = 5
 UNION ALL SELECT DISTINCT u.id, c.ts, 60 FROM src_changes c JOIN src_user u ON trim(u.adid) = trim(c.adid) WHERE c.source_table = 'adjust_callback_record' AND (c.op = 'c' OR c.before_tracker_name IS DISTINCT FROM c.after_tracker_name)"""
add("r5_enqueue_dirty", lambda c: enqueue.enqueue_dirty(c.changes, c.src), DIRTY)
o.CTES["dirty_events"] = f"SELECT user_id, date_trunc('millisecond', ts) AS ts, min(wait_s) AS wait_s FROM ({DIRTY}) GROUP BY ALL"
add(
    "r4_debounce",
    lambda c: deb.debounce(enqueue.enqueue_dirty(c.changes, c.src, grouped=True), keep=Workspace(c.spark).keep),
    "WITH RECURSIVE passed AS (SELECT user_id, min(ts) AS ts FROM dirty_events GROUP BY user_id UNION ALL SELECT e.user_id, min(e.ts) FROM passed p JOIN dirty_events e ON e.user_id = p.user_id AND e.ts >= p.ts + to_seconds(greatest(e.wait_s, 0.001)) GROUP BY e.user_id, p.ts) SELECT user_id, ts FROM passed",
)
add(
    "r9_drop_backlog",
    lambda c: enqueue.drop_backlog(c.src["user_info_dirty"], 1_706_600_000_000),
    "SELECT user_id, updated_at FROM src_user_info_dirty WHERE epoch_ms(updated_at) - 3600000 >= 1706600000000",
)
add("r1_trigger_user", lambda c: triggers.trigger_keys("user", c.changes, c.src), f"SELECT DISTINCT user_id FROM ({CHANGED_USERS})")
add("r1_trigger_application", lambda c: triggers.trigger_keys("application", c.changes, c.src), CHANGED_ORDERS)


def order_changes(c: Context) -> DataFrame:
    """Changes of orders, payments, installments and cards, as the tables themselves state them:
    every disbursed order was updated once, every overdue installment and paid callback came in."""
    def log(df: DataFrame, table: str, op: str, ts: str, **image) -> DataFrame:
        after = change_image(**image)
        return df.select(F.lit(table).alias("source_table"), F.lit(op).alias("op"), F.col(ts).alias("ts"), F.lit(0).cast("bigint").alias("position"), F.when(F.lit(op) == "u", after).alias("before"), after.alias("after"))

    s = c.src
    parts = [
        log(s["user_order"].filter("disburse_time IS NOT NULL AND settled_time IS NULL"), "user_order", "u", "disburse_time", id=F.col("id"), user_id=F.col("user_id"), product_id=F.col("product_id"), order_no=F.col("order_no")),
        log(s["user_order_installment"].filter("is_overdue = 1"), "user_order_installment", "u", "create_time", id=F.col("id"), user_order_id=F.col("user_order_id"), current_period=F.col("current_period")),
        log(s["user_repay"].filter("status = 2 AND callback_time IS NOT NULL"), "user_repay", "c", "callback_time", order_no=F.col("order_no"), current_period=F.col("current_period")),
        log(s["user_bank_info"].filter("deleted = 0 AND is_default = 0").withColumn("ts", F.lit("2024-03-01 00:00:00").cast("timestamp_ntz")), "user_bank_info", "u", "ts", id=F.col("id"), user_id=F.col("user_id")),
    ]
    return reduce(DataFrame.unionByName, parts)


ORDER_CHANGED = "SELECT id FROM src_user_order WHERE disburse_time IS NOT NULL AND settled_time IS NULL"
LOAN_KEYS = f"""SELECT id FROM src_user_order_installment WHERE is_overdue = 1 UNION SELECT i.id FROM src_user_order_installment i JOIN ({ORDER_CHANGED}) s ON s.id = i.user_order_id
 UNION SELECT i.id FROM src_user_order_installment i JOIN src_user_order s ON s.id = i.user_order_id JOIN src_user_repay r ON r.order_no = s.order_no AND r.current_period = i.current_period WHERE r.status = 2 AND r.callback_time IS NOT NULL AND {has('r.order_no')}"""
ORDER_KEYS = f"""{ORDER_CHANGED} UNION SELECT user_order_id FROM src_user_order_installment WHERE is_overdue = 1
 UNION SELECT s.id FROM src_user_order s JOIN src_user_repay r ON r.order_no = s.order_no WHERE r.status = 2 AND r.callback_time IS NOT NULL AND {has('r.order_no')}
 UNION SELECT s.id FROM src_user_order s JOIN src_user_bank_info b ON b.user_id = s.user_id WHERE b.deleted = 0 AND b.is_default = 0"""
CARD_OWNERS = "SELECT user_id FROM src_user_bank_info WHERE deleted = 0 AND is_default = 0"
SINCE_MS = 803_347_200_000  # the middle of the orders
add(
    "s2_changes_since",
    lambda c: select_changes(order_changes(c), ["user_order", "user_repay"], "timestamp", SINCE_MS, ZONE).select("source_table", "op", "ts", F.col("after.id").alias("id"), F.col("after.order_no").alias("order_no")),
    f"SELECT 'user_order' AS source_table, 'u' AS op, disburse_time AS ts, id, order_no FROM src_user_order WHERE disburse_time IS NOT NULL AND settled_time IS NULL AND {ms('disburse_time')} >= {SINCE_MS} "
    f"UNION ALL SELECT 'user_repay', 'c', callback_time, NULL, order_no FROM src_user_repay WHERE status = 2 AND callback_time IS NOT NULL AND {ms('callback_time')} >= {SINCE_MS}",
)
TRIGGER_S = 3600
add(
    "r3_coalesced_rebuilds",
    lambda c: triggers.coalesced("user_bankcard", order_changes(c).unionByName(order_changes(c)), c.src, TRIGGER_S),
    f"SELECT (epoch_us(timestamp '2024-03-01 00:00:00') // 1000000 // {TRIGGER_S}) AS trigger_no, user_id, cast(2 * count(*) AS bigint) AS changes FROM ({CARD_OWNERS}) GROUP BY user_id",
)
add(
    "r6_changes_after_handoff",
    lambda c: triggers.coalesced("user_product", select_changes(order_changes(c), None, "timestamp", SINCE_MS, ZONE), c.src, TRIGGER_S),
    f"SELECT epoch_us(disburse_time) // 1000000 // {TRIGGER_S} AS trigger_no, user_id, product_id, count(*) AS changes FROM src_user_order WHERE id IN ({ORDER_CHANGED}) AND {has('product_id')} AND {ms('disburse_time')} >= {SINCE_MS} GROUP BY ALL",
)
add("r1_trigger_loan", lambda c: triggers.trigger_keys("loan", order_changes(c), c.src), f"SELECT id AS installment_id FROM ({LOAN_KEYS})")
add("r1_trigger_product", lambda c: triggers.trigger_keys("user_product", order_changes(c), c.src), f"SELECT DISTINCT user_id, product_id FROM src_user_order WHERE id IN ({ORDER_CHANGED}) AND {has('product_id')}")
add("r1_trigger_bankcard", lambda c: triggers.trigger_keys("user_bankcard", order_changes(c), c.src), "SELECT id AS bank_id FROM src_user_bank_info WHERE deleted = 0 AND is_default = 0")

# --- the seven outputs ---------------------------------------------------------------------------
HASH = HashTokenizer()
add("q1_user_bulk_hit", lambda c: outputs.user_output(c.src), o.user_sql(o.USER_HIT))
add("q1_user_bulk_miss", lambda c: outputs.user_output(c.src, "miss", HASH), o.user_sql(f"SELECT * REPLACE ({o.filled('mobile_token', 'mobile_norm', 1)} AS mobile_token) FROM st_user WHERE {o.USER_MISS}"))
add(
    "q1_user_incremental",
    lambda c: rebuild.rebuild_rows("user", triggers.user_keys(c.changes, c.src), c.src, HASH),
    o.user_sql(f"SELECT * FROM ({o.USER_FILLED}) WHERE {has('mobile_token')} AND mobile_norm IN (SELECT mobile_norm FROM st_user WHERE id IN (SELECT user_id FROM ({CHANGED_USERS})))"),
)
add("q2_user_info_bulk_hit", lambda c: outputs.user_info_output(c.src, "hit", HASH), o.info_sql(o.INFO_HIT))
add("q2_user_info_bulk_miss", lambda c: outputs.user_info_output(c.src, "miss", HASH), o.info_sql(f"SELECT * REPLACE ({o.filled('id_number_token', 'bvn_raw', 4)} AS id_number_token) FROM st_info WHERE {o.INFO_MISS}"))
add(
    "q2_user_info_incremental",
    lambda c: rebuild.rebuild_rows("user_info", enqueue.enqueue_dirty(c.changes, c.src, grouped=True).users(), c.src, HASH),
    o.info_sql(f"SELECT * FROM ({o.INFO_FILLED}) WHERE user_id IN (SELECT user_id FROM dirty_events)"),
)
add("q3_user_bankcard_bulk_hit", lambda c: outputs.bankcard_rows(c.src), o.card_sql(o.CARD_HIT))
add("q3_user_bankcard_bulk_miss", lambda c: outputs.bankcard_rows(c.src, "miss", HASH), o.card_sql(f"SELECT * REPLACE ({o.filled('bank_account_token', 'bank_account_raw', 3)} AS bank_account_token) FROM st_card WHERE {o.CARD_MISS}"))
add(
    "q3_user_bankcard_incremental",
    lambda c: rebuild.rebuild_rows("user_bankcard", triggers.bankcard_keys(order_changes(c), c.src), c.src, HASH),
    o.card_sql(f"SELECT * FROM ({o.CARD_FILLED}) WHERE user_id IN ({CARD_OWNERS})"),
)
add(
    "q3_user_bankcard_with_ids",
    lambda c: _id_facts(
        _chained(
            [
                lambda start: outputs.bankcard_output(c.src, start, "hit").select("id"),
                lambda start: outputs.bankcard_output(c.src, start, "miss", HASH).select("id"),
                lambda start: with_snowflake_ids(outputs.bankcard_rows(c.src, "all", HASH), ["group_user_id", "bank_account_number"], start).select("id"),
            ]
        ),
        ID_START,
    ),
    f"SELECT n AS ids, n AS distinct_ids, 0 AS out_of_range FROM (SELECT (SELECT count(*) FROM ({o.card_sql(o.CARD_HIT)}))"
    f" + (SELECT count(*) FROM ({o.card_sql(f'SELECT * FROM st_card WHERE {o.CARD_MISS}')})) + (SELECT count(*) FROM ({o.card_sql(o.CARD_FILLED)})) AS n)",
)
add("q4_user_product_bulk", lambda c: outputs.product_output(c.src), o.PRODUCT)
add(
    "q4_user_product_incremental",
    lambda c: rebuild.rebuild_rows("user_product", triggers.product_keys(order_changes(c)), c.src),
    f"SELECT p.* FROM ({o.PRODUCT}) p WHERE (group_user_id - 100000000, product_id) IN (SELECT (user_id, product_id) FROM src_user_order WHERE id IN ({ORDER_CHANGED}))",
)
add("q5_application_bulk_hit", lambda c: outputs.application_output(c.src), o.app_sql(o.APP_HIT))
add("q5_application_bulk_miss", lambda c: outputs.application_output(c.src, "miss", HASH), o.app_sql(f"SELECT * FROM ({o.APP_FILLED}) WHERE was_miss AND {o.APP_READY}"))
add(
    "q5_application_incremental",
    lambda c: rebuild.rebuild_rows("application", triggers.application_keys(order_changes(c), c.src), c.src, HASH),
    o.app_sql(f"SELECT * FROM ({o.APP_FILLED}) WHERE {o.APP_READY} AND id IN ({ORDER_KEYS})"),
)
# the same rows when a service is asked in batches, once for all token columns
add("t6_user_by_service", lambda c: outputs.user_output(c.src, "all", BatchHash()), o.user_sql(f"SELECT * FROM ({o.USER_FILLED}) WHERE {has('mobile_token')}"))
add("t6_user_info_by_service", lambda c: outputs.user_info_output(c.src, "all", BatchHash()), o.info_sql(o.INFO_FILLED))
add("t6_application_by_service", lambda c: outputs.application_output(c.src, "all", BatchHash()), o.app_sql(f"SELECT * FROM ({o.APP_FILLED}) WHERE {o.APP_READY}"))
add("q6_loan_bulk", lambda c: outputs.loan_output(c.src), o.loan_sql())
add(
    "q6_loan_incremental",
    lambda c: rebuild.rebuild_rows("loan", triggers.loan_keys(order_changes(c), c.src), c.src),
    o.loan_sql(f"order_no IN (SELECT s.order_no FROM src_user_order s JOIN src_user_order_installment i ON i.user_order_id = s.id WHERE i.id IN ({LOAN_KEYS}))"),
)
add("q7_id_mapping", lambda c: outputs.id_mapping_output(c.src), o.KEYED_EDGES)


def _earlier(c: Context) -> Sources:
    """The tables before the changes of ``order_changes``: of the changed orders every other one was not there and the rest were a month
    younger, and the changed cards had the account of another pair of users."""
    changed = F.col("disburse_time").isNotNull() & F.col("settled_time").isNull()
    orders = c.src["user_order"].filter(~(changed & (F.col("id") % 2 == 0)))
    orders = orders.withColumn("order_time", F.when(changed, F.col("order_time") + F.expr("INTERVAL 30 DAYS")).otherwise(F.col("order_time")))
    account = F.concat(F.lit(" "), (1_000_000_000 + F.col("user_id") - F.col("user_id") % 2 + 2).cast("string"))
    moved = (F.col("deleted") == 0) & (F.col("is_default") == 0)
    cards = c.src["user_bank_info"].withColumn("bank_account", F.when(moved, account).otherwise(F.col("bank_account")))
    return c.src.using(user_order=orders, user_bank_info=cards)


def _followed_links(c: Context) -> DataFrame:
    folder = Workspace(c.spark).folder
    links = KeyedTable(c.spark, f"{folder}/links", edges.LINK_KEY)
    target = KeyedTable(c.spark, f"{folder}/id_mapping", TARGET_KEYS["id_mapping"])
    load_links(_earlier(c), links, target)
    LinkJob(lambda: c.src, target, links).run_batch(order_changes(c), 1)
    return target.read()


add("q7_id_mapping_incremental", _followed_links, o.KEYED_EDGES)



def _fewer_orders(c: Context) -> Sources:
    """The tables after every other changed order was deleted."""
    changed = F.col("disburse_time").isNotNull() & F.col("settled_time").isNull()
    return c.src.using(user_order=c.src["user_order"].filter(~(changed & (F.col("id") % 2 == 0))))


def _products_loaded(c: Context) -> KeyedTable:
    target = KeyedTable(c.spark, f"{Workspace(c.spark).folder}/user_product", TARGET_KEYS["user_product"])
    target.upsert(outputs.product_output(c.src), 0)
    return target


def _gone_products(c: Context) -> DataFrame:
    keep = Workspace(c.spark).keep
    scope = keep(triggers.product_keys(order_changes(c)).select("user_id", "product_id").distinct())
    stored = rebuild.stored_for("user_product", _products_loaded(c), 1, scope, keep)
    return rebuild.gone_rows("user_product", stored, rebuild.rebuild_scope("user_product", scope, _fewer_orders(c), keep=keep), scope)


def _products_after_deletes(c: Context) -> DataFrame:
    target = _products_loaded(c)
    rebuild.RebuildJob("user_product", lambda: _fewer_orders(c), target, propagate_deletes=True).run_batch(order_changes(c), 1)
    return target.read()


o.CTES["fewer_orders"] = f"SELECT * FROM src_user_order WHERE NOT coalesce(id IN ({ORDER_CHANGED}) AND id % 2 = 0, false)"
o.CTES["w_product_fewer"] = o.CTES["w_product"].replace("src_user_order", "fewer_orders")
o.CTES["st_product_fewer"] = o.CTES["st_product"].replace("w_product", "w_product_fewer")
PRODUCT_FEWER = o.PRODUCT.replace("st_product", "st_product_fewer")
add("r10_gone_rows", _gone_products, f"SELECT group_user_id, product_id FROM ({o.PRODUCT}) EXCEPT SELECT group_user_id, product_id FROM ({PRODUCT_FEWER})")
add("r10_target_after_deletes", _products_after_deletes, PRODUCT_FEWER)

# --- checks --------------------------------------------------------------------------------------
def folded(x: str) -> str:
    return f"lower(trim(coalesce({x}, '')))"


add(
    "v1_staging_vs_bundle",
    lambda c: verify.staging_vs_bundle(assemble.assemble_user_info(c.src), verify.incremental_bundle(c.src)),
    f"SELECT count(*) FILTER ({folded('s.full_name')} <> {folded('b.expected_full_name')}) AS mismatch_cnt, CASE WHEN count(*) FILTER ({folded('s.full_name')} <> {folded('b.expected_full_name')}) = 0 THEN 'PASS' ELSE 'FAIL' END AS result FROM st_info s JOIN bundle b ON b.user_id = s.user_id",
)
add(
    "v1_all_columns",
    lambda c: verify.all_column_differences(outputs.user_output(c.src, "all", HASH), outputs.user_output(c.src, "hit").unionByName(outputs.user_output(c.src, "miss", HASH))),
    f"SELECT *, 'left' AS side FROM ({o.user_sql(o.USER_HIT)}) WHERE false",
)


def _all_rows(c: Context, output: str, keep: rebuild.Keep | None = None) -> DataFrame:
    """A rebuild whose scope is everything, as a change stream would do it."""
    keys = {
        "user": c.src["user"].select(F.col("id").alias("user_id")),
        "user_info": c.src["user"].select(F.col("id").alias("user_id")),
        "user_bankcard": c.src["user_bank_info"].select("user_id"),
        "user_product": c.src["user_order"].select("user_id", "product_id"),
        "application": c.src["user_order"].select("user_id", "order_no"),
        "loan": c.src["user_order"].select("order_no"),
    }[output]
    return rebuild.rebuild_scope(output, keys.dropna().distinct(), c.src, HASH, keep=keep)


def _bulk_rows(c: Context, output: str) -> DataFrame:
    """What the bulk load writes, both phases."""
    phased = {"user": outputs.user_output, "user_info": outputs.user_info_output, "user_bankcard": outputs.bankcard_rows, "application": outputs.application_output}
    if output in phased:
        return phased[output](c.src, "hit", HASH).unionByName(phased[output](c.src, "miss", HASH))
    return (outputs.product_output if output == "user_product" else outputs.loan_output)(c.src)


def _profile_differences(c: Context) -> DataFrame:
    """A bulk load in which the newest user has an outdated name, against a rebuild of all users, every column."""
    work = Workspace(c.spark)
    loaded = work.keep(_bulk_rows(c, "user_info"))
    newest = loaded.agg(F.max("user_id").alias("newest"))
    stale = loaded.join(newest, F.col("user_id") == F.col("newest"), "left").withColumn("full_name", F.when(F.col("newest").isNotNull(), F.concat(F.lit("old "), "full_name")).otherwise(F.col("full_name")))
    return digests.digest_differences(work, work.keep(stale.drop("newest")), work.keep(_all_rows(c, "user_info")), TARGET_KEYS["user_info"])


def _rebuild_summary(c: Context) -> DataFrame:
    """One output after the other: what a rebuild keeps goes when its rows are written, and these go when they are compared."""
    lines, schema = [], None
    for output in ("user", "user_bankcard", "user_product", "application", "loan"):
        with Workspace(c.spark) as work, shuffles_dropped(c.spark):
            with Workspace(c.spark) as cut:
                again = work.keep(_all_rows(c, output, cut.keep))
            loaded = work.keep(_bulk_rows(c, output))
            found = digests.difference_summary(digests.digest_differences(work, loaded, again, TARGET_KEYS[output]), output)
            lines += found.collect()
            schema = found.schema
    return c.spark.createDataFrame(lines, schema)


INFO_ALL = o.info_sql(o.INFO_FILLED)
NEWEST_INFO = f"(SELECT max(user_id) FROM ({INFO_ALL}))"
add(
    "v1_rebuild_differences",
    _profile_differences,
    f"SELECT *, 'right' AS side, cast(1 AS bigint) AS extra FROM ({INFO_ALL}) WHERE user_id = {NEWEST_INFO} UNION ALL SELECT * REPLACE ('old ' || full_name AS full_name), 'left', 1 FROM ({INFO_ALL}) WHERE user_id = {NEWEST_INFO}",
)
BULK_AND_REBUILD = {
    "user": (f"SELECT * FROM ({o.user_sql(o.USER_HIT)}) UNION ALL SELECT * FROM ({o.user_sql(f'SELECT * FROM ({o.USER_FILLED}) WHERE id IN (SELECT id FROM st_user WHERE {o.USER_MISS})')})", o.user_sql(f"SELECT * FROM ({o.USER_FILLED}) WHERE {has('mobile_token')}")),
    "user_bankcard": (o.card_sql(f"SELECT * FROM ({o.CARD_FILLED}) WHERE {has('bank_account_token')}"),) * 2,
    "user_product": (o.PRODUCT, o.PRODUCT),
    "application": (
        f"SELECT * FROM ({o.app_sql(o.APP_HIT)}) UNION ALL SELECT * FROM ({o.app_sql(f'SELECT * FROM ({o.APP_FILLED}) WHERE was_miss AND {o.APP_READY}')})",
        o.app_sql(f"SELECT * FROM ({o.APP_FILLED}) WHERE {o.APP_READY}"),
    ),
    "loan": (o.loan_sql(), o.loan_sql()),
}
add(
    "v1_rebuild_summary",
    _rebuild_summary,
    "SELECT *, CASE WHEN only_left + only_right = 0 THEN 'PASS' ELSE 'FAIL' END AS result FROM ("
    + " UNION ALL ".join(
        f"SELECT '{name}' AS tbl, (SELECT count(*) FROM ((SELECT * FROM ({a})) EXCEPT ALL (SELECT * FROM ({b})))) AS only_left, (SELECT count(*) FROM ((SELECT * FROM ({b})) EXCEPT ALL (SELECT * FROM ({a})))) AS only_right"
        for name, (a, b) in BULK_AND_REBUILD.items()
    )
    + ")",
)
add("v2_sink_filtered_count", lambda c: verify.sink_filtered_count(verify.incremental_bundle(c.src)), f"SELECT count(*) AS sink_filtered_cnt FROM bundle WHERE {has('bvn_raw')} AND {none('id_number_token')}")
HINT = f"CASE WHEN {none('b.bvn_raw')} THEN 'ok_no_bvn' WHEN {has('b.id_number_token')} THEN 'ok_token' ELSE 'sink_filtered' END"
LAST_QUEUED = "SELECT q.* FROM src_user_info_dirty q JOIN src_user u ON u.id = q.user_id ORDER BY updated_at DESC, user_id DESC LIMIT 20"
add(
    "v3_dirty_sample_check",
    lambda c: verify.dirty_sample_check(c.src["user_info_dirty"], verify.incremental_bundle(c.src), _target(c).withColumn("user_id", F.col("user_id") - 100_000_000)),
    f"SELECT q.user_id, q.updated_at AS dirty_at, b.expected_full_name, t.full_name AS staging_full_name, CASE WHEN t.user_id IS NULL THEN 'no_staging' WHEN {folded('t.full_name')} = {folded('b.expected_full_name')} THEN 'match' ELSE 'mismatch' END AS chk, "
    f"{HINT} AS sink_hint FROM ({LAST_QUEUED}) q JOIN bundle b ON b.user_id = q.user_id LEFT JOIN target_info t ON t.user_id = q.user_id + 100000000",
)
add(
    "v3_sample_eligibility",
    lambda c: verify.sample_eligibility(c.src["user_info_dirty"], verify.incremental_bundle(c.src)),
    f"SELECT q.user_id, q.user_id + 100000000 AS tgt_user_id, b.expected_full_name, CASE WHEN {none('b.bvn_raw')} OR {has('b.id_number_token')} THEN 1 ELSE 0 END AS sink_eligible_without_udf, q.updated_at AS dirty_updated_at FROM ({LAST_QUEUED}) q JOIN bundle b ON b.user_id = q.user_id",
)
add(
    "v4_explain_user",
    lambda c: verify.explain_users(c.src["user"].select(F.col("id").alias("user_id")), c.src["user_info_dirty"], verify.incremental_bundle(c.src), assemble.assemble_user_info(c.src)),
    f"SELECT 'bundle_lookup' AS layer, user_id, expected_full_name AS value, CASE WHEN {none('bvn_raw')} THEN 'yes_no_bvn' WHEN {has('id_number_token')} THEN 'yes_has_token' ELSE 'needs_vt_tokenize_or_miss' END AS status FROM bundle "
    "UNION ALL SELECT 'dirty_queue', u.id, strftime(q.updated_at, '%Y-%m-%d'), CASE WHEN q.user_id IS NULL THEN 'not_queued' ELSE 'queued' END FROM src_user u LEFT JOIN src_user_info_dirty q ON q.user_id = u.id "
    f"UNION ALL SELECT 'staging_vs_bundle', b.user_id, s.full_name, CASE WHEN s.user_id IS NULL THEN 'no_staging_row' WHEN {folded('s.full_name')} = {folded('b.expected_full_name')} THEN 'match' ELSE 'mismatch' END FROM bundle b LEFT JOIN st_info s ON s.user_id = b.user_id",
)
COMPARED = f"""SELECT b.user_id, b.expected_full_name, t.full_name AS target_full_name, CASE WHEN {has('b.bvn_raw')} AND {none('b.id_number_token')} THEN 'FILTERED' WHEN t.user_id IS NULL THEN 'MISSING'
 WHEN {folded('t.full_name')} = {folded('b.expected_full_name')} THEN 'PASS' ELSE 'STALE' END AS outcome FROM bundle b LEFT JOIN target_info t ON t.user_id = b.user_id + 100000000"""
add("v5_compare_with_target", lambda c: verify.compare_with_target(verify.incremental_bundle(c.src), _target(c)), COMPARED)
add(
    "v5_compare_summary",
    lambda c: verify.compare_summary(verify.compare_with_target(verify.incremental_bundle(c.src), _target(c))),
    "SELECT count(*) FILTER (outcome = 'PASS') AS pass_cnt, count(*) FILTER (outcome = 'STALE') AS stale_cnt, count(*) FILTER (outcome = 'MISSING') AS missing_cnt, count(*) FILTER (outcome = 'FILTERED') AS filtered_cnt, "
    f"CASE WHEN count(*) FILTER (outcome IN ('STALE', 'MISSING')) = 0 THEN 'PASS' ELSE 'FAIL' END AS result FROM ({COMPARED})",
)


def _expected(c: Context) -> DataFrame:
    return verify.table_counts({"user": outputs.user_output(c.src), "user_bankcard": outputs.bankcard_rows(c.src), "loan": outputs.loan_output(c.src)}, "expected_cnt")


def _actual(c: Context) -> DataFrame:
    return verify.table_counts({"user": outputs.user_output(c.src, "all", HASH), "user_bankcard": outputs.bankcard_rows(c.src), "loan": assemble.assemble_loan(c.src)}, "actual_cnt")


EXPECTED = f"SELECT 'user' AS tbl, count(*) AS n FROM ({o.user_sql(o.USER_HIT)}) UNION ALL SELECT 'user_bankcard', count(*) FROM ({o.card_sql(o.CARD_HIT)}) UNION ALL SELECT 'loan', count(*) FROM ({o.loan_sql()})"
USER_ALL = f"SELECT * FROM ({o.USER_FILLED}) WHERE {has('mobile_token')}"
ACTUAL = f"SELECT 'user' AS tbl, count(*) AS n FROM ({o.user_sql(USER_ALL)}) UNION ALL SELECT 'user_bankcard', count(*) FROM ({o.card_sql(o.CARD_HIT)}) UNION ALL SELECT 'loan', count(*) FROM st_loan"
add(
    "v6_count_check",
    lambda c: verify.count_check(_expected(c), _actual(c)),
    f"SELECT e.tbl, e.n AS wanted_cnt, a.n AS actual_cnt, a.n - e.n AS diff, CASE WHEN a.n - e.n BETWEEN -10 AND 100 AND e.n > 0 THEN 'PASS' ELSE 'FAIL' END AS result FROM ({EXPECTED}) e JOIN ({ACTUAL}) a ON a.tbl = e.tbl",
)
add(
    "v6_count_check_baseline",
    lambda c: verify.count_check(_expected(c), _actual(c), "baseline_delta", _expected(c).withColumnRenamed("expected_cnt", "baseline_cnt"), min_percent=40.0),
    f"SELECT e.tbl, e.n * 2 AS wanted_cnt, a.n AS actual_cnt, a.n - e.n * 2 AS diff, CASE WHEN a.n * 100 >= e.n * 2 * 40 AND e.n > 0 THEN 'PASS' ELSE 'FAIL' END AS result FROM ({EXPECTED}) e JOIN ({ACTUAL}) a ON a.tbl = e.tbl",
)
PHASES = f"""SELECT 'user' AS tbl, (SELECT count(*) FROM (SELECT DISTINCT mobile_token, app_code FROM st_user WHERE {has('mobile_token')})) AS hit_cnt, (SELECT count(*) FROM (SELECT DISTINCT mobile_token, app_code FROM st_user WHERE {has('mobile_token')})) AS phase1_cnt,
 (SELECT count(*) FROM st_user WHERE {o.USER_MISS}) AS miss_cnt
 UNION ALL SELECT 'user_info', count(*) FILTER ({has('id_number_token')}), count(*) FILTER ({none('bvn_raw')} OR {has('id_number_token')}), count(*) FILTER ({o.INFO_MISS}) FROM st_info
 UNION ALL SELECT 'user_bankcard', (SELECT count(*) FROM (SELECT DISTINCT user_id, bank_account_token FROM st_card WHERE {has('bank_account_token')})), (SELECT count(*) FROM (SELECT DISTINCT user_id, bank_account_token FROM st_card WHERE {has('bank_account_token')})),
 (SELECT count(*) FROM st_card WHERE {o.CARD_MISS})
 UNION ALL SELECT 'application', count(*) FILTER ({has('mobile_token')} AND {has('id_number_token')} AND {has('bank_account_token')}), count(*) FILTER ({o.APP_READY}), count(*) FILTER ({o.APP_MISS}) FROM st_app"""
add("v7_phase_counts", lambda c: verify.phase_counts(_wide(c)), PHASES)
add(
    "v7_phase1_done",
    lambda c: verify.phase1_done(verify.phase_counts(_wide(c)), verify.table_counts({"user": outputs.user_output(c.src), "application": outputs.application_output(c.src)}, "actual_cnt")).select("tbl", "miss_cnt", "actual_cnt", "start_phase2"),
    f"SELECT p.tbl, p.miss_cnt, a.n AS actual_cnt, coalesce(p.miss_cnt > 0 AND p.hit_cnt - a.n BETWEEN 0 AND 10, false) AS start_phase2 FROM ({PHASES}) p LEFT JOIN (SELECT 'user' AS tbl, count(*) AS n FROM ({o.user_sql(o.USER_HIT)}) UNION ALL SELECT 'application', count(*) FROM ({o.app_sql(o.APP_HIT)})) a ON a.tbl = p.tbl",
)
add(
    "v8_sync_progress",
    lambda c: verify.sync_progress(_expected(c).withColumnRenamed("expected_cnt", "actual_cnt"), _actual(c), _expected(c), 30.0),
    f"SELECT e.tbl, e.n AS expected_cnt, a.n AS actual_cnt, a.n - e.n AS delta, round(a.n * 100.0 / e.n, 2)::double AS percent, round((a.n - e.n) * 60.0 / 30, 1)::double AS rate_per_min FROM ({EXPECTED}) e JOIN ({ACTUAL}) a ON a.tbl = e.tbl",
)


class Loaded:
    """All seven outputs written in their phases, with the counts that the writes took and those of the stored rows. A table goes when its
    rows are counted."""

    def __init__(self, c: Context):
        self.spark, self.counted, self.found = c.spark, [], {}
        phased = {"user": outputs.user_output, "user_info": outputs.user_info_output, "user_bankcard": outputs.bankcard_rows, "application": outputs.application_output}
        single = {"user_product": outputs.product_output, "loan": outputs.loan_output, "id_mapping": outputs.id_mapping_output}
        for name in TARGET_KEYS:
            with Workspace(c.spark) as work, shuffles_dropped(c.spark):
                table = KeyedTable(c.spark, f"{work.folder}/{name}", TARGET_KEYS[name])
                phases = [lambda phase=phase: phased[name](c.src, phase, HASH) for phase in ("hit", "miss")] if name in phased else [lambda: single[name](c.src)]
                for batch, make in enumerate(phases):
                    rows = RowsWritten()
                    table.upsert(rows.watch(make()), batch)
                    self.counted.append((name, batch, rows.count))
                self.found[name] = verify.table_counts({name: table.read(columns=[])}, "n").first()["n"]

    def _listed(self, totals: dict[str, int], column: str) -> DataFrame:
        return self.spark.createDataFrame(list(totals.items()), f"tbl string, {column} bigint")

    def counts(self, phases: int) -> DataFrame:
        """Rows written per output, by its first phase alone or by all."""
        totals = {name: sum(n for tbl, batch, n in self.counted if tbl == name and batch < phases) for name in TARGET_KEYS}
        return self._listed(totals, "actual_cnt")

    def stored(self, column: str) -> DataFrame:
        """Rows per stored output."""
        return self._listed(self.found, column)


def _count_check_all(c: Context) -> DataFrame:
    loaded = Loaded(c)
    return verify.count_check(loaded.counts(1).withColumnRenamed("actual_cnt", "expected_cnt"), loaded.stored("actual_cnt"))


def _progress_written(c: Context) -> DataFrame:
    loaded = Loaded(c)
    return verify.sync_progress(loaded.counts(1), loaded.counts(2), loaded.stored("expected_cnt"), 30.0)


OUTPUT_COUNTS = {
    "user": (o.user_sql(o.USER_HIT), BULK_AND_REBUILD["user"][0]),
    "user_info": (o.info_sql(o.INFO_HIT), o.info_sql(o.INFO_FILLED)),
    "user_bankcard": (o.card_sql(o.CARD_HIT), BULK_AND_REBUILD["user_bankcard"][0]),
    "user_product": (o.PRODUCT, o.PRODUCT),
    "application": (o.app_sql(o.APP_HIT), BULK_AND_REBUILD["application"][0]),
    "loan": (o.loan_sql(), o.loan_sql()),
    "id_mapping": (o.KEYED_EDGES, o.KEYED_EDGES),
}
HIT_N, ALL_N = [" UNION ALL ".join(f"SELECT '{name}' AS tbl, count(*) AS n FROM ({both[at]})" for name, both in OUTPUT_COUNTS.items()) for at in (0, 1)]
add(
    "v6_count_check_all",
    _count_check_all,
    f"SELECT e.tbl, e.n AS wanted_cnt, a.n AS actual_cnt, a.n - e.n AS diff, CASE WHEN a.n - e.n BETWEEN -10 AND 100 AND e.n > 0 THEN 'PASS' ELSE 'FAIL' END AS result FROM ({HIT_N}) e JOIN ({ALL_N}) a ON a.tbl = e.tbl",
)
add(
    "v8_progress_written",
    _progress_written,
    f"SELECT a.tbl, a.n AS expected_cnt, a.n AS actual_cnt, a.n - e.n AS delta, 100.0::double AS percent, round((a.n - e.n) * 60.0 / 30, 1)::double AS rate_per_min FROM ({HIT_N}) e JOIN ({ALL_N}) a ON a.tbl = e.tbl",
)


def _progress(c: Context) -> DataFrame:
    """A run over the dictionary that took half a minute, told from the counts that its two writes took."""
    work = Workspace(c.spark)
    found, ended = [CountsWritten("vt_type", KIND.values(), counts) for counts in (found_counts(), ended_counts())]
    seeded = work.keep(found.watch(c.dictionary))
    work.keep(ended.watch(preload(seeded, HashTokenizer())))
    return progress_stats(summary_of(found.rows(c.spark), ended.rows(c.spark)), 30.0)


add(
    "t9_progress_stats",
    _progress,
    f"SELECT b.vt_type, work, ok_rows, with_token, failed_rows, remaining, claimed, work - remaining AS done, CASE WHEN work > 0 THEN round((work - remaining) * 100.0 / work, 1) ELSE 0.0 END::double AS percent, CASE WHEN failed_rows > 0 OR (ok_rows > 0 AND with_token = 0) THEN 'FAILED' ELSE 'DONE' END AS state, "
    f"round((work - remaining) * 60.0 / 30, 1)::double AS rate_per_min FROM (SELECT vt_type, count(*) FILTER ({GAP}) AS work FROM dictionary GROUP BY 1) b JOIN (SELECT vt_type, count(*) FILTER (status = 1) AS ok_rows, count(*) FILTER (status = 1 AND {has('token')}) AS with_token, "
    f"count(*) FILTER (status = 2) AS failed_rows, count(*) FILTER ({GAP}) AS remaining, count(*) FILTER (status = 9) AS claimed FROM ({PRELOADED}) GROUP BY 1) a ON a.vt_type = b.vt_type",
)


def _diagnostics(c: Context) -> DataFrame:
    """The counting diagnostics of the dictionary as one list."""
    d = c.dictionary
    gap = dic.pending_gap(d)
    gaps = [gap.select(F.lit(name).alias("check"), "vt_type", F.col(name).alias("cnt")) for name in ("pending_all", "too_long", "claimable")]
    others = {"oversize": dic.oversize_report(d), "nul_padded": dic.nul_padded(d), "control_chars": dic.control_chars(d)}
    return reduce(DataFrame.unionByName, gaps + [df.select(F.lit(n).alias("check"), "vt_type", "cnt") for n, df in others.items()])


add(
    "v9_dictionary_diagnostics",
    _diagnostics,
    " UNION ALL ".join(
        [f"SELECT '{n}' AS \"check\", vt_type, count(*) FILTER ({w}) AS cnt FROM dictionary GROUP BY 2" for n, w in (("pending_all", "status = 0"), ("too_long", "status = 0 AND length(raw_value) > 128"), ("claimable", GAP))]
        + ["SELECT 'oversize', vt_type, count(*) FROM dictionary WHERE length(raw_value) > 128 GROUP BY vt_type, status", "SELECT 'nul_padded', vt_type, count(*) FROM dictionary WHERE contains(raw_value, chr(0)) GROUP BY 2",
           "SELECT 'control_chars', vt_type, count(*) FROM dictionary WHERE status = 0 AND (contains(raw_value, chr(9)) OR contains(raw_value, chr(10))) GROUP BY 2"]
    ),
)
