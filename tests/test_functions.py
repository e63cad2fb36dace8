"""Golden tables of the column functions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tokenloom.functions import channels, codes, documents, ids, money, text, times


def values(spark, inputs, expression, schema="a string"):
    df = spark.createDataFrame([(i, *(x if isinstance(x, tuple) else (x,))) for i, x in enumerate(inputs)], f"i int, {schema}")
    return [r.v for r in df.select("i", expression.alias("v")).orderBy("i").collect()]


def check(spark, table, expression, schema="a string"):
    assert values(spark, list(table), expression, schema) == list(table.values())


def test_normalize_mobile(spark):
    check(spark, {None: None, "": None, "  ": None, "+1 ": "+1", "2348": "+2348", "08": "+2348", "8": "+2348", "0": "+234", " 0801": "+234801", "0+1": "+234+1"}, text.normalize_mobile("a"))


def test_mobile_with_a_tab_keeps_it(spark):
    check(spark, {"\t8": "+234\t8"}, text.normalize_mobile("a"))


def test_utm_source(spark):
    table = {
        ("Unattributed", None): None, ("Organic", None): "organic", ("Instagram Installs", "x"): "facebook", ("KuaiShou", None): "kwai",
        (" PartnerX ", None): "partnerx", (" ", "google-uac"): "google", (None, None): None, ("", " "): None,
    }
    check(spark, table, channels.map_utm_source("a", "b"), "a string, b string")


def test_install_source(spark):
    check(spark, {"google-uac": "GG", "Apple Search Ads": "ASA", "SMS blast": "SMS", "kuai-1": "KW", " Other ": "Other", " ": None, None: None, "unattributed": None}, channels.map_install_source("a"))


def test_money(spark):
    check(spark, {" 2.50 ": 3, "": 0, None: 0, "-2.5": -3, "abc": 0, "1.49": 1}, money.money_minor("a"))
    check(spark, {"1.25": 125}, money.money_minor("a", 100))
    check(spark, {("10", "5.49"): 15, ("10", ""): 0, ("0.3", "0.3"): 1, (None, "1"): 0}, money.money_sum_minor("a", "b"), "a string, b string")


def test_numbers_in_text(spark):
    assert [None if v is None else int(v) for v in values(spark, ["150,000", "5k", "", None, "9" * 19, "9" * 20, " 7 "], money.parse_salary("a"))] == [150000, None, None, None, int("9" * 19), None, 7]
    assert [None if v is None else int(v) for v in values(spark, ["12", "n/a", " 1", "9" * 19], money.parse_credit_limit("a"))] == [12, None, None, int("9" * 19)]


def test_statuses(spark):
    check(spark, {(10, 1): 23, (10, 0): 20, (10, None): 20, (2, 0): 3, (50, 1): 27, (None, 1): 1, (99, 0): 1}, codes.application_risk_status("a", "b"), "a int, b int")
    table = {(10, 0, "0"): 20, (10, 0, "99.5"): 24, (10, 1, "1"): 23, (10, None, " "): 20, (40, 0, ""): 25, (None, 0, "1"): 20, (11, 0, ""): 23}
    check(spark, table, codes.loan_status("a", "b", "c"), "a int, b int, c string")


def test_document_numbers(spark):
    check(spark, {("1", "26"): "ng01-26", (" 2 ", "x"): "ng02-x"}, codes.application_no("a", "b"), "a string, b string")
    check(spark, {("26", 3): "ng-26-03000", ("26", None): "ng-26-01000"}, codes.loan_no("a", "b"), "a string, b int")


def test_looks_like_phone(spark):
    check(spark, {"+1": True, "0x": True, "234": True, "1234567": True, "123456": False, "tok_ab": False, None: False, "": False, "1" * 17: False}, text.looks_like_phone("a"))


def test_mask_value(spark):
    check(spark, {None: "***", "1234567": "***", "12345678": "12345****5678"}, text.mask_value("a"))


def test_epoch_ms_does_not_see_the_session_zone(spark):
    """The session zone skips 02:30 on this day; Lagos does not."""
    moment = F.lit("2024-03-10 02:30:00.250").cast("timestamp_ntz")
    assert spark.range(1).select(times.epoch_ms(moment, "Africa/Lagos")).first()[0] == 1710034200250
    early = F.lit("1969-12-31 23:00:00").cast("timestamp_ntz")
    assert spark.range(1).select(times.epoch_ms(early, "UTC")).first()[0] == -3600000


def test_created_ms_is_never_negative(spark):
    days = {None: 0, dt.date(1960, 1, 1): 0, dt.date(2024, 1, 1): 1704063600000}
    check(spark, days, times.created_ms_from_date("a", "Africa/Lagos"), "a date")


def test_merge_contacts(spark):
    table = {(None, "[1]"): '{"emergency_contacts":[1]}', (" {} ", None): '{"emergency_contacts":[]}', ('{"a":1}', " "): '{"a":1,"emergency_contacts":[]}', ("text", "[1]"): "text"}
    check(spark, table, documents.merge_contacts("a", "b"), "a string, b string")


def test_snowflake_ids_are_unique_repeatable_and_carry_their_fields(spark):
    layout = ids.IdLayout(datacenter=3)
    df = spark.range(20000).withColumnRenamed("id", "k")
    made = ids.with_snowflake_ids(df, ["k"], 1_700_000_000_000, layout, 8)
    first = {r.k: r.id for r in made.collect()}
    assert first == {r.k: r.id for r in ids.with_snowflake_ids(df.repartition(5), ["k"], 1_700_000_000_000, layout, 8).collect()}
    assert len(set(first.values())) == 20000
    for i in first.values():
        assert (i >> 22) + layout.epoch_ms >= 1_700_000_000_000
        assert i >> 17 & 31 == 3
        assert 16 <= (i >> 12 & 31) < 24


def test_snowflake_limits(spark):
    with pytest.raises(ValueError):
        ids.IdLayout(datacenter_bits=10, worker_bits=10, sequence_bits=12)
    with pytest.raises(ValueError):
        ids.IdLayout(datacenter=32)
    with pytest.raises(ValueError):
        ids.with_snowflake_ids(spark.range(1), ["id"], 0, ids.IdLayout(), 17)
    spark.conf.set("spark.sql.shuffle.partitions", "20")
    with pytest.raises(ValueError):  # the user's number of tasks is not lowered in silence
        ids.with_snowflake_ids(spark.range(1), ["id"], 0, ids.IdLayout())
    spark.conf.set("spark.sql.shuffle.partitions", "4")
