"""The operational tables derived from the star-schema test tables.

The statements run unchanged on Spark and on DuckDB; the names in braces are the tables they read.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.functions.codes import FAILED, OK, PENDING
from tokenloom.functions.text import mask_value
from tokenloom.operators.dictionary import seed_dictionary
from tokenloom.sources.changes import change_image
from tokenloom.sources.schemas import SOURCE_SCHEMAS
from tokenloom.sources.tables import Sources, typed_view

BASE_TABLES = ("customer", "orders", "lineitem", "events", "nation")

# rows written once per value of k; each dialect has its own way to say it
REPEAT = {
    "spark": lambda low: f"LATERAL VIEW explode(array({low}, {low + 1})) kk AS k",
    "duckdb": lambda low: f"CROSS JOIN (SELECT unnest([{low}, {low + 1}]) AS k) kk",
}

FIXTURE_SQL = {
    "user": """SELECT c_custkey AS id, cast(1 + c_custkey % 3 AS string) AS app_code,
 CASE c_custkey % 6 WHEN 0 THEN concat('0', lpad(cast(8000000000 + c_custkey AS string),10,'0'))
  WHEN 1 THEN concat('234', cast(8000000000 + c_custkey AS string))
  WHEN 2 THEN concat('+234', cast(8000000000 + c_custkey AS string))
  WHEN 3 THEN concat(' ', cast(8000000000 + c_custkey AS string), ' ')
  WHEN 4 THEN CASE WHEN c_custkey % 30 = 4 THEN '  ' ELSE cast(8000000000 + c_custkey AS string) END
  ELSE CASE WHEN c_custkey % 30 = 5 THEN NULL ELSE concat('0', cast(8000000000 + c_custkey - 5 AS string)) END END AS mobile,
 CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE concat('dev-', cast(c_custkey % 997 AS string)) END AS device_id,
 CASE WHEN c_custkey % 7 = 0 THEN '' ELSE concat('adid-', cast(c_custkey % 149 AS string)) END AS adid,
 CASE WHEN c_custkey % 4 = 0 THEN NULL WHEN c_custkey % 4 = 1 THEN ' ' ELSE concat('gps-', cast(c_custkey AS string)) END AS gps_adid,
 CASE WHEN c_custkey % 4 = 1 THEN concat('idfa-', cast(c_custkey AS string)) END AS idfa,
 TIMESTAMP '2024-01-01 00:00:00' + (c_custkey % 86400) * INTERVAL '1' SECOND AS create_time,
 TIMESTAMP '2024-02-01 00:00:00' + (c_custkey % 86400) * INTERVAL '1' SECOND AS update_time
FROM {customer}""",
    "user_personal_info": """SELECT c_custkey * 2 + k AS id, c_custkey AS user_id,
 CASE WHEN (c_custkey + k) % 9 = 0 THEN '  ' WHEN (c_custkey + k) % 9 = 1 THEN NULL ELSE concat(' 22', lpad(cast(c_custkey AS string),9,'0')) END AS bvn,
 CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE concat('First', cast(c_custkey AS string)) END AS first_name,
 CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE concat('Sur', cast(k AS string)) END AS sur_name,
 DATE '1980-01-01' AS date_of_birth, cast(c_nationkey % 5 AS int) AS education_level, cast(c_custkey % 2 AS int) AS gender,
 c_mktsegment AS living_address_state, concat('City', cast(c_nationkey AS string)) AS living_address_city,
 CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE concat(cast(c_custkey AS string), ' Main St') END AS living_address_first_line,
 cast(NULL AS string) AS living_address_second_line, cast(c_custkey % 4 AS int) AS number_of_children, cast(c_custkey % 3 AS int) AS marriage
FROM {customer} {from_0} WHERE k = 0 OR c_custkey % 2 = 0""",
    "user_bank_info": """SELECT c_custkey * 2 + k AS id, c_custkey AS user_id, lpad(cast(c_nationkey AS string),3,'0') AS bank_code,
 c_name AS bank_holder, CASE WHEN c_custkey % 19 = 0 THEN ' ' ELSE concat(' ', lpad(cast(1000000000 + (c_custkey - c_custkey % 2) AS string),10,'0')) END AS bank_account,
 cast(CASE WHEN c_custkey % 23 = 0 THEN 0 ELSE 1 END AS int) AS is_default, cast(CASE WHEN (c_custkey + k) % 10 = 0 THEN 1 ELSE 0 END AS int) AS deleted
FROM {customer} {from_0} WHERE k = 0 OR c_custkey % 3 = 0""",
    "user_work_related": """SELECT c_custkey AS id, c_custkey AS user_id, c_mktsegment AS work_type, concat('Occ', cast(c_nationkey AS string)) AS occupation,
 CASE WHEN c_custkey % 6 = 0 THEN ' ' ELSE c_name END AS company_name,
 CASE c_custkey % 5 WHEN 0 THEN '150,000' WHEN 1 THEN ' 90000 ' WHEN 2 THEN '5k' WHEN 3 THEN '' ELSE NULL END AS monthly_income
FROM {customer} WHERE c_custkey % 8 <> 0""",
    "user_emergency_contact": """SELECT c_custkey * 2 + k AS id, c_custkey AS user_id, CASE WHEN k = 1 THEN ' ' ELSE concat('Contact', cast(c_custkey AS string)) END AS contact_name,
 CASE WHEN c_custkey % 12 = 0 THEN '' WHEN k = 1 THEN concat('0', cast(7000000000 + c_custkey AS string)) ELSE cast(7000000000 + c_custkey AS string) END AS contact_number,
 cast(1 + k AS int) AS contact_relationship
FROM {customer} {from_0} WHERE c_custkey % 3 <> 0""",
    "device_ids": """SELECT event_id AS id, concat('dev-', cast(user_id AS string)) AS device_uuid, concat('sess-', cast(event_id % 501 AS string)) AS session_uuid,
 CASE WHEN event_id % 3 = 0 THEN NULL ELSE concat('aaid-', cast(user_id AS string)) END AS aaid, CASE WHEN event_id % 5 = 0 THEN concat('didfa-', cast(user_id AS string)) END AS idfa,
 ts AS create_time, CASE WHEN event_id % 2 = 0 THEN ts + INTERVAL '1' DAY END AS update_time
FROM {events} WHERE event_type = 'signup'""",
    "device_network": """SELECT event_id AS id, CASE WHEN event_id % 2 = 0 THEN concat('dev-', cast(user_id AS string)) END AS device_uuid,
 CASE WHEN event_id % 2 = 1 THEN concat('sess-', cast(event_id % 501 AS string)) END AS session_uuid,
 CASE WHEN event_id % 10 = 0 THEN '' ELSE concat('10.0.', cast(event_id % 250 AS string), '.', cast(user_id % 250 AS string)) END AS ip, ts AS create_time
FROM {events} WHERE event_type IN ('view','click')""",
    "adjust_callback_record": """SELECT event_id AS id, concat('adid-', cast(user_id % 149 AS string)) AS adid,
 CASE WHEN event_id % 4 = 0 THEN ' ' ELSE CASE event_id % 9 WHEN 0 THEN 'Organic' WHEN 1 THEN 'Google Ads ACI' WHEN 2 THEN 'TikTok SAN' WHEN 3 THEN 'Facebook Installs' WHEN 4 THEN 'Instagram Installs' WHEN 5 THEN 'Kwai for Business' WHEN 6 THEN 'Unattributed' WHEN 7 THEN 'KuaiShou' ELSE ' PartnerX ' END END AS network_name,
 CASE event_id % 8 WHEN 0 THEN 'organic' WHEN 1 THEN 'google-uac' WHEN 2 THEN 'Apple Search Ads' WHEN 3 THEN 'SMS blast' WHEN 4 THEN 'kuai-1' WHEN 5 THEN '' WHEN 6 THEN 'Messenger' ELSE 'Other' END AS tracker_name,
 concat('ct-', cast(event_id % 20 AS string)) AS campaign_tracker, concat('cn-', cast(event_id % 20 AS string)) AS campaign_name, concat('cr-', cast(event_id % 30 AS string)) AS creative_name,
 concat('at-', cast(event_id % 40 AS string)) AS adgroup_tracker, concat('crt-', cast(event_id % 30 AS string)) AS creative_tracker, concat('an-', cast(event_id % 40 AS string)) AS adgroup_name, ts AS create_time
FROM {events} WHERE event_type IN ('purchase','error')""",
    "app_config": """SELECT n_nationkey AS id, cast(n_nationkey AS string) AS app_code, n_name AS app_name, concat('1.', cast(n_nationkey AS string)) AS version
FROM {nation} WHERE n_nationkey IN (1, 2)""",
    "risk_user_credit_callback": """SELECT event_id AS id, user_id, CASE WHEN event_id % 6 = 0 THEN 'n/a' ELSE cast(1000 + event_id % 9000 AS string) END AS credit_limit, ts AS create_time
FROM {events} WHERE event_type = 'purchase'""",
    "user_order": """SELECT o_orderkey AS id, CASE WHEN o_orderkey % 101 = 0 THEN ' ' ELSE concat('26', lpad(cast(o_orderkey AS string),10,'0')) END AS order_no,
 o_custkey AS user_id, cast(1 + o_custkey % 3 AS string) AS app_code, CASE WHEN o_orderkey % 211 = 0 THEN NULL ELSE o_orderpriority END AS product_id,
 cast(CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE 14 END AS int) AS period_days, cast(NULL AS int) AS period_count, cast(o_orderkey % 2 AS int) AS re_loan,
 CASE WHEN o_orderkey % 37 = 0 THEN '' ELSE cast(cast(o_totalprice AS decimal(20,2)) AS string) END AS amount_max,
 cast(cast(o_totalprice AS decimal(20,2)) - 10.25 AS string) AS received, cast(cast(o_totalprice AS decimal(20,2)) AS string) AS repayment,
 CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE '12.50' END AS poundage, o_orderdate AS order_time,
 CASE WHEN o_orderstatus <> 'P' THEN o_orderdate + INTERVAL '1' DAY END AS disburse_time, CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL '9' DAY END AS settled_time,
 o_orderdate + INTERVAL '7' DAY AS last_repayment_time,
 cast(CASE o_orderkey % 13 WHEN 0 THEN 0 WHEN 1 THEN 2 WHEN 2 THEN 4 WHEN 3 THEN 6 WHEN 4 THEN 8 WHEN 5 THEN 10 WHEN 6 THEN 10 WHEN 7 THEN 11 WHEN 8 THEN 20 WHEN 9 THEN 30 WHEN 10 THEN 40 WHEN 11 THEN 50 ELSE NULL END AS int) AS risk_order_status
FROM {orders}""",
    "user_order_installment": """SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS user_order_id, cast(CASE WHEN l_linenumber = 1 THEN NULL ELSE l_linenumber END AS int) AS current_period,
 cast(cast(max(l_extendedprice) AS decimal(20,2)) AS string) AS received, CASE WHEN l_orderkey % 5 = 0 THEN '' ELSE cast(cast(max(l_tax) * 100 AS decimal(20,2)) AS string) END AS interests,
 CASE WHEN l_orderkey % 6 = 0 THEN NULL ELSE '10.50' END AS poundage_fees, CASE WHEN l_orderkey % 4 = 0 THEN '' ELSE '5.49' END AS penalty_amount,
 cast(cast(max(l_extendedprice) AS decimal(20,2)) AS string) AS amt_due, CASE WHEN l_orderkey % 3 = 0 THEN ' ' WHEN l_orderkey % 3 = 1 THEN '0.00' ELSE '99.50' END AS repaid_amount,
 CASE WHEN l_orderkey % 50 = 0 THEN NULL ELSE max(l_shipdate) END AS repayment_time, cast(CASE WHEN max(l_quantity) > 40 THEN 1 WHEN max(l_quantity) < 5 THEN NULL ELSE 0 END AS int) AS is_overdue, min(l_shipdate) AS create_time
FROM {lineitem} GROUP BY l_orderkey, l_linenumber""",
    "user_repay": """SELECT CASE WHEN l_orderkey % 101 = 0 THEN ' ' ELSE concat('26', lpad(cast(l_orderkey AS string),10,'0')) END AS order_no, l_linenumber AS current_period,
 cast(CASE WHEN l_returnflag = 'N' THEN 1 ELSE 2 END AS int) AS status, CASE WHEN l_suppkey % 15 = 0 THEN NULL ELSE l_shipdate + INTERVAL '3' DAY END AS callback_time FROM {lineitem}""",
    "risk_user_approval_callback": """SELECT concat('26', lpad(cast(o_orderkey AS string),10,'0')) AS order_no, o_orderdate + k * INTERVAL '1' HOUR AS callback_time
FROM {orders} {from_1} WHERE o_orderstatus <> 'P'""",
    "user_info_dirty": "SELECT user_id, max(ts) AS updated_at FROM {events} GROUP BY user_id",
}

# the changes every event stands for, as flat columns
CHANGE_SQL = """SELECT event_id, ts,
 CASE event_type WHEN 'signup' THEN 'user' WHEN 'view' THEN 'user_personal_info' WHEN 'click' THEN 'user_emergency_contact'
  WHEN 'purchase' THEN 'risk_user_credit_callback' ELSE CASE WHEN event_id % 3 = 0 THEN 'vt_token_cache' ELSE 'adjust_callback_record' END END AS source_table,
 CASE WHEN event_id % 4 = 0 THEN 'c' ELSE 'u' END AS op,
 CASE WHEN event_type = 'signup' THEN user_id ELSE event_id END AS row_id,
 CASE WHEN event_type = 'view' AND event_id % 7 = 0 THEN user_id + 1 ELSE user_id END AS before_user_id,
 user_id AS after_user_id,
 CASE WHEN event_id % 3 = 0 THEN 'dev-old' ELSE concat('dev-', cast(user_id AS string)) END AS before_device_id,
 concat('dev-', cast(user_id AS string)) AS after_device_id,
 concat(' adid-', cast(user_id % 149 AS string)) AS adid,
 CASE WHEN event_id % 5 = 0 THEN 'Other' END AS before_tracker_name,
 'Other' AS after_tracker_name,
 cast(CASE WHEN event_id % 2 = 0 THEN 4 ELSE 5 END AS int) AS vt_type,
 CASE WHEN event_id % 2 = 0 THEN concat('22', lpad(cast(user_id AS string),9,'0')) ELSE concat('+234', cast(7000000000 + user_id AS string)) END AS raw_value
FROM {events}"""

TOKEN_CHARS = 28
ODD_VALUES = {"long": "x" * 129, "tab": "a\tb", "newline": "a\nb", "plain": "twin", "padded": "twin\u0000"}


def fixture_token(vt_type: Column, raw: Column) -> Column:
    return F.sha2(F.concat(vt_type.cast("string"), F.lit(":"), raw), 256)


def fixture_dictionary(seeded: DataFrame) -> DataFrame:
    """A dictionary with every state in it, from seeded (vt_type, raw_value) pairs."""
    digest = F.col("digest")
    states = F.create_map(F.lit("0"), F.lit(PENDING), F.lit("1"), F.lit(FAILED))
    odd_values = F.array(*[F.lit(v) for v in ODD_VALUES.values()])
    odd = seeded.sparkSession.range(1).select(
        F.lit(1).alias("vt_type"), F.explode(odd_values).alias("raw_value"), F.lit(PENDING).alias("fixed_status")
    )
    status = F.coalesce("fixed_status", F.try_element_at(states, F.left("digest", F.lit(1))), F.lit(OK))
    rows = (
        seeded.select("vt_type", "raw_value", F.lit(None).cast("int").alias("fixed_status"))
        .unionByName(odd)
        .withColumn("digest", fixture_token(F.col("vt_type"), F.col("raw_value")))
        .withColumn("status", status)
    )
    ok, failed = F.col("status") == OK, F.col("status") == FAILED
    return typed_view(
        rows.select(
            F.conv(F.left(digest, F.lit(15)), 16, 10).alias("id"),
            "vt_type",
            "raw_value",
            F.when(ok, F.left(digest, F.lit(TOKEN_CHARS))).alias("token"),
            F.when(ok, mask_value("raw_value")).alias("masking"),
            "status",
            F.when(failed, 1).otherwise(0).alias("retry_count"),
            F.when(failed, "fixture").alias("last_error"),
        ),
        SOURCE_SCHEMAS["vt_token_cache"],
    )


def in_dialect(sql: str, dialect: str) -> str:
    repeat = REPEAT[dialect]
    return sql.replace("{from_0}", repeat(0)).replace("{from_1}", repeat(1))


def base_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{folder}/{name}.parquet") for name in BASE_TABLES}


@lru_cache(maxsize=4)
def _sources_of(spark: SparkSession, application: str, folder: str) -> Sources:
    base = base_tables(spark, folder)

    def maker(name: str):
        return lambda: typed_view(spark.sql(in_dialect(FIXTURE_SQL[name], "spark"), **base), SOURCE_SCHEMAS[name])

    derived = Sources({name: maker(name) for name in FIXTURE_SQL})

    def dictionary() -> DataFrame:
        return fixture_dictionary(seed_dictionary(derived)).persist(StorageLevel.MEMORY_AND_DISK)

    return Sources({name: lambda name=name: derived[name] for name in derived} | {"vt_token_cache": dictionary})


def fixture_sources(spark: SparkSession, folder: str) -> Sources:
    """The dictionary is a stored table in real life and read by most jobs, so it is derived once
    per session and folder; everything else is derived where it is used."""
    return _sources_of(spark, spark.sparkContext.applicationId, folder)


def fixture_changes(spark: SparkSession, folder: str) -> DataFrame:
    """The change log of the fixtures, in the shape change feeds are read in."""
    flat = spark.sql(CHANGE_SQL, **base_tables(spark, folder))
    before = change_image(
        id=F.col("row_id"), user_id=F.col("before_user_id"), device_id=F.col("before_device_id"),
        adid=F.col("adid"), tracker_name=F.col("before_tracker_name"),
        vt_type=F.col("vt_type"), raw_value=F.col("raw_value"),
    )
    after = change_image(
        id=F.col("row_id"), user_id=F.col("after_user_id"), device_id=F.col("after_device_id"),
        adid=F.col("adid"), tracker_name=F.col("after_tracker_name"),
        vt_type=F.col("vt_type"), raw_value=F.col("raw_value"),
    )
    return flat.select(
        "source_table",
        "op",
        F.col("ts").cast("timestamp_ntz").alias("ts"),
        F.col("event_id").alias("position"),
        F.when(F.col("op") == "u", before).alias("before"),
        after.alias("after"),
    )
