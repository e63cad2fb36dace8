"""The token dictionary: seeding, keyed updates, work selection and diagnostics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenloom.functions.codes import CLAIMED, FAILED, OK, PENDING, VT_TYPES
from tokenloom.functions.text import (
    blank_to_null,
    has_nul,
    has_tab_or_newline,
    has_text,
    normalize_mobile,
    preview,
    strip_nul,
)
from tokenloom.operators.lookups import anti_join_untokenised
from tokenloom.operators.predicates import live_bankcard
from tokenloom.settings import DEFAULT

KEY = ["vt_type", "raw_value"]
MAX_CHARS = DEFAULT.raw_max_chars
TOO_LONG = f"raw_value too long (>{MAX_CHARS})"
ERROR_CHARS = 500


def distinct_ad_ids(sources) -> DataFrame:
    """One pass over each table: its ad-id columns become rows."""

    def ids(df: DataFrame, *columns: str) -> DataFrame:
        return df.select(F.explode(F.array(*[blank_to_null(c) for c in columns])).alias("raw_value"))

    both = ids(sources["user"], "gps_adid", "idfa").unionByName(ids(sources["device_ids"], "aaid", "idfa"))
    return both.filter("raw_value IS NOT NULL").distinct()


def source_values(sources, types: list[str] | None = None) -> DataFrame:
    """Distinct (vt_type, raw_value) pairs found in the source tables."""
    selects = {
        "mobile": lambda: sources["user"].select(normalize_mobile("mobile").alias("raw_value")),
        "gaid_idfa": lambda: distinct_ad_ids(sources),
        "bank_account": lambda: sources["user_bank_info"].filter(live_bankcard()).select(F.trim("bank_account").alias("raw_value")),
        "id_number": lambda: sources["user_personal_info"].select(blank_to_null("bvn").alias("raw_value")),
        "emergency_contact": lambda: sources["user_emergency_contact"].select(normalize_mobile("contact_number").alias("raw_value")),
    }
    parts = [
        selects[name]().select(F.lit(VT_TYPES[name]).alias("vt_type"), "raw_value")
        for name in types or selects
    ]
    every = reduce(DataFrame.unionByName, parts)
    usable = F.char_length("raw_value").between(1, MAX_CHARS)
    return every.filter(usable).distinct()


def seed_dictionary(sources, dictionary: DataFrame | None = None, types: list[str] | None = None) -> DataFrame:
    """New pending rows: source values the dictionary does not have yet."""
    found = source_values(sources, types)
    if dictionary is not None:
        found = insert_ignore(dictionary, found, KEY)
    return found.withColumn("status", F.lit(PENDING))


def insert_ignore(dictionary: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """The rows of ``new`` to append: one per key that is not stored yet."""
    return new.dropDuplicates(key).join(dictionary.select(*key), key, "left_anti")


def with_next_ids(new: DataFrame, dictionary: DataFrame, keep) -> DataFrame:
    """Rows for the dictionary with ids that follow its largest one without gaps, times, and no retries.

    Ids go by kind and value. The rows are put in ranges and written by ``keep``; every range is numbered on its own,
    after the rows of the ranges before it.
    """
    ranged = keep(new.repartitionByRange(*KEY).withColumn("range", F.spark_partition_id()))
    counts = ranged.groupBy("range").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1))  # a row per range
    offsets = counts.select("range", F.coalesce(before, F.lit(0)).alias("rows_before"))
    last = dictionary.agg(F.coalesce(F.max("id"), F.lit(0)).alias("last_id")).first().last_id
    number = F.row_number().over(Window.partitionBy("range").orderBy(*KEY))
    numbered = ranged.withColumn("number", number).join(offsets, "range")
    values = {"id": F.lit(last) + F.col("rows_before") + F.col("number"), "retry_count": F.lit(0)}
    now = F.current_timestamp().cast("timestamp_ntz")
    values |= {name: now for name in ("created_at", "updated_at") if name in dictionary.columns}
    types = dict(dictionary.dtypes)
    return numbered.select(*new.columns, *(v.cast(types.get(name, "bigint")).alias(name) for name, v in values.items()))


def upsert_dict(dictionary: DataFrame, results: DataFrame) -> DataFrame:
    """Applies token results (vt_type, raw_value, token, masking, status, error), one per key:
    good ones set the token and clear the error, failed ones count a retry and keep the token."""
    r = results.select(
        *KEY,
        F.col("token").alias("new_token"),
        F.col("masking").alias("new_masking"),
        F.col("status").alias("new_status"),
        F.col("error").alias("new_error"),
    )
    r = r.filter(F.char_length("raw_value") <= MAX_CHARS)
    return _apply(dictionary.join(r, KEY, "full_outer"), dictionary.columns)


def update_dict_by_id(dictionary: DataFrame, results: DataFrame) -> DataFrame:
    """The same for results (id, token, masking, status, error); unknown ids change nothing."""
    r = results.select(
        "id",
        F.col("token").alias("new_token"),
        F.col("masking").alias("new_masking"),
        F.col("status").alias("new_status"),
        F.col("error").alias("new_error"),
    )
    return _apply(dictionary.join(r, "id", "left"), dictionary.columns)


def _apply(joined: DataFrame, columns: list[str]) -> DataFrame:
    good = F.coalesce(F.col("new_status") == OK, F.lit(False))
    failed = F.coalesce(F.col("new_status") == FAILED, F.lit(False))

    def choose(on_good: Column, on_failed: Column, name: str) -> Column:
        return F.when(good, on_good).when(failed, on_failed).otherwise(F.col(name))

    retries = F.coalesce("retry_count", F.lit(0))
    rules = {
        "token": choose(F.col("new_token"), F.col("token"), "token"),
        "masking": choose(F.col("new_masking"), F.col("masking"), "masking"),
        "status": choose(F.lit(OK), F.lit(FAILED), "status"),
        "retry_count": choose(F.lit(0), retries + 1, "retry_count"),
        "last_error": choose(F.lit(None), F.left("new_error", F.lit(ERROR_CHARS)), "last_error"),
    }
    return joined.select(*[rules[c].alias(c) if c in rules else F.col(c) for c in columns])


def replace_dict_rows(dictionary: DataFrame, results: DataFrame) -> DataFrame:
    """Old rows out, new rows in, as one new version. ``results`` has id and the new row."""
    kept = dictionary.join(results.select("id"), "id", "left_anti")
    fresh = results.filter(F.char_length("raw_value") <= MAX_CHARS).withColumns(
        {"status": F.lit(OK), "retry_count": F.lit(0), "last_error": F.lit(None).cast("string")}
    )
    return kept.unionByName(fresh.select(*dictionary.columns))


def mark_oversize(dictionary: DataFrame) -> DataFrame:
    open_row = F.col("status").isin(PENDING, FAILED)
    bad = F.coalesce(open_row & (F.char_length("raw_value") > MAX_CHARS), F.lit(False))
    return dictionary.withColumns(
        {
            "status": F.when(bad, F.lit(FAILED)).otherwise(F.col("status")),
            "retry_count": F.when(bad, F.col("retry_count") + 1).otherwise(F.col("retry_count")),
            "last_error": F.when(bad, F.lit(TOO_LONG)).otherwise(F.col("last_error")),
        }
    )


def claimable() -> Column:
    return has_text("raw_value") & (F.char_length("raw_value") <= MAX_CHARS)


def select_work(dictionary: DataFrame, mode: str = "fast", retry_failed: bool = False, sources=None, types: list[str] | None = None) -> DataFrame:
    """(vt_type, raw_value) pairs to tokenise: dictionary rows still open, or with mode ``stream``
    the source values that have no usable token."""
    if mode == "stream" and not retry_failed:
        return anti_join_untokenised(source_values(sources, types), dictionary).select(*KEY)
    wanted = F.col("status") == (FAILED if retry_failed else PENDING)
    if types:
        wanted = wanted & F.col("vt_type").isin(*[VT_TYPES[t] for t in types])
    return dictionary.filter(wanted & claimable()).select(*KEY)


def pending_batch(dictionary: DataFrame, n: int, status: int = PENDING) -> DataFrame:
    """The first ``n`` open rows by id."""
    return dictionary.filter((F.col("status") == status) & claimable()).orderBy("id").limit(n)


def reset_claims(dictionary: DataFrame) -> DataFrame:
    freed = F.when(F.col("status") == CLAIMED, F.lit(PENDING)).otherwise(F.col("status"))
    return dictionary.withColumn("status", freed)


def dict_stats(dictionary: DataFrame) -> DataFrame:
    return dictionary.groupBy("vt_type", "status").agg(F.count(F.lit(1)).alias("cnt"))


def dict_ok_count(dictionary: DataFrame) -> DataFrame:
    good = F.when((F.col("status") == OK) & (F.col("token") != ""), 1)
    return dictionary.groupBy("vt_type").agg(F.count(good).alias("ok_cnt"))


def _count_if(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def pending_gap(dictionary: DataFrame) -> DataFrame:
    pending = F.col("status") == PENDING
    return dictionary.groupBy("vt_type").agg(
        _count_if(pending).alias("pending_all"),
        _count_if(pending & ~has_text("raw_value")).alias("empty_raw"),
        _count_if(pending & (F.char_length("raw_value") > MAX_CHARS)).alias("too_long"),
        _count_if(pending & claimable()).alias("claimable"),
    )


def oversize_report(dictionary: DataFrame) -> DataFrame:
    return (
        dictionary.filter(F.char_length("raw_value") > MAX_CHARS)
        .groupBy("vt_type", "status")
        .agg(
            F.count(F.lit(1)).alias("cnt"),
            F.max(F.char_length("raw_value")).alias("max_chars"),
            F.max(F.octet_length("raw_value")).alias("max_bytes"),
        )
    )


def nul_duplicates(dictionary: DataFrame, top: int = 20) -> DataFrame:
    """Values that differ only by NUL characters. Repeats are counted first, so lists are only
    built for the few values that repeat."""
    cleaned = dictionary.withColumn("raw_clean", strip_nul("raw_value"))
    repeated = (
        cleaned.groupBy("vt_type", "raw_clean")
        .agg(F.count(F.lit(1)).alias("dup_cnt"))
        .filter("dup_cnt > 1")
        .orderBy(F.desc("dup_cnt"), "vt_type", "raw_clean")
        .limit(top)
    )
    rows = cleaned.join(F.broadcast(repeated), ["vt_type", "raw_clean"], "inner")
    ordered = F.sort_array(F.collect_list(F.struct("id", "status")))
    listed = rows.groupBy("vt_type", "raw_clean", "dup_cnt").agg(ordered.alias("members"))
    text = {
        name: F.array_join(F.col(f"members.{name}").cast("array<string>"), ",") for name in ("id", "status")
    }
    return listed.select("vt_type", "raw_clean", "dup_cnt", text["id"].alias("ids"), text["status"].alias("statuses"))


def nul_padded(dictionary: DataFrame) -> DataFrame:
    return dictionary.filter(has_nul("raw_value")).groupBy("vt_type").agg(F.count(F.lit(1)).alias("cnt"))


def control_chars(dictionary: DataFrame) -> DataFrame:
    odd = (F.col("status") == PENDING) & has_tab_or_newline("raw_value")
    return dictionary.filter(odd).groupBy("vt_type").agg(F.count(F.lit(1)).alias("cnt"))


def longest_mobiles(users: DataFrame, top: int = 10) -> DataFrame:
    number = normalize_mobile("mobile")
    return (
        users.filter(has_text("mobile"))
        .select(
            "id",
            F.char_length("mobile").alias("src_chars"),
            preview("mobile").alias("mobile_preview"),
            number.alias("mobile_norm"),
            F.char_length(number).alias("norm_chars"),
        )
        .orderBy(F.desc("norm_chars"), "id")
        .limit(top)
    )


def longest_pending(dictionary: DataFrame, vt_type: int = VT_TYPES["mobile"], top: int = 10) -> DataFrame:
    pending = dictionary.filter((F.col("vt_type") == vt_type) & (F.col("status") == PENDING))
    return (
        pending.select("id", F.char_length("raw_value").alias("chars"), preview("raw_value").alias("raw_preview"))
        .orderBy(F.desc("chars"), "id")
        .limit(top)
    )


def oversize_mobiles(users: DataFrame) -> DataFrame:
    number = users.select(normalize_mobile("mobile").alias("number"))
    chars = F.char_length("number")
    return number.filter(chars > MAX_CHARS).agg(F.count(F.lit(1)).alias("cnt"), F.max(chars).alias("max_chars"))
