"""Checks between sources, wide tables, targets and the dictionary, as DataFrames."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.functions.codes import VT_TYPES
from tokenloom.functions.text import full_name, has_text
from tokenloom.functions.times import date_text
from tokenloom.operators.latest import profile_latest
from tokenloom.operators.lookups import join_token
from tokenloom.operators.predicates import token_miss, token_ready
from tokenloom.operators.projection import offset_id
from tokenloom.plans.outputs import APPLICATION_TOKENS, CARD_TOKENS, INFO_TOKENS, USER_TOKENS
from tokenloom.settings import DEFAULT, Settings


def _count_if(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def _folded(c: str) -> Column:
    """Names compare without regard to case or outer spaces."""
    return F.lower(F.trim(F.coalesce(F.col(c), F.lit(""))))


def incremental_bundle(sources) -> DataFrame:
    """What a rebuild expects per user: name, BVN and its stored token."""
    profile = profile_latest(sources["user_personal_info"])
    facts = profile.select("user_id", F.trim("bvn").alias("bvn_raw"), full_name("first_name", "sur_name").alias("expected_full_name"))
    facts = join_token(facts, sources["vt_token_cache"], VT_TYPES["id_number"], "bvn_raw", "id_number_token", "user_id")
    users = sources["user"].select(F.col("id").alias("user_id"))
    return users.join(facts, "user_id", "left").withColumn("expected_full_name", F.coalesce("expected_full_name", F.lit("")))


def staging_vs_bundle(staging: DataFrame, bundle: DataFrame) -> DataFrame:
    both = staging.select("user_id", "full_name").join(bundle.select("user_id", "expected_full_name"), "user_id", "inner")
    counted = both.agg(_count_if(_folded("full_name") != _folded("expected_full_name")).alias("mismatch_cnt"))
    return counted.withColumn("result", F.when(F.col("mismatch_cnt") == 0, "PASS").otherwise("FAIL"))


def all_column_differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows present on one side only, counting repeats, with the side that has them."""
    right = right.select(*left.columns)
    return (
        left.exceptAll(right).withColumn("side", F.lit("left"))
        .unionByName(right.exceptAll(left).withColumn("side", F.lit("right")))
    )


def _writable() -> Column:
    return token_ready([], {"id_number_token": "bvn_raw"})


def sink_filtered_count(bundle: DataFrame) -> DataFrame:
    return bundle.agg(_count_if(~_writable()).alias("sink_filtered_cnt"))


def _sink_hint() -> Column:
    return F.when(~has_text("bvn_raw"), "ok_no_bvn").when(has_text("id_number_token"), "ok_token").otherwise("sink_filtered")


def dirty_sample(queue: DataFrame, bundle: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` users queued last, with what is expected of them."""
    latest = queue.join(bundle.select("user_id"), "user_id", "left_semi").orderBy(F.desc("updated_at"), F.desc("user_id")).limit(n)
    return latest.join(bundle, "user_id", "inner").withColumn("sink_hint", _sink_hint())


def dirty_sample_check(queue: DataFrame, bundle: DataFrame, staging: DataFrame, n: int = 20) -> DataFrame:
    stored = staging.select("user_id", F.col("full_name").alias("staging_full_name"), F.lit(True).alias("staged"))
    check = (
        F.when(F.col("staged").isNull(), "no_staging")
        .when(_folded("staging_full_name") == _folded("expected_full_name"), "match")
        .otherwise("mismatch")
    )
    return (
        dirty_sample(queue, bundle, n)
        .join(stored, "user_id", "left")
        .select("user_id", F.col("updated_at").alias("dirty_at"), "expected_full_name", "staging_full_name", check.alias("chk"), "sink_hint")
    )


def sample_eligibility(queue: DataFrame, bundle: DataFrame, n: int = 20, settings: Settings = DEFAULT) -> DataFrame:
    return dirty_sample(queue, bundle, n).select(
        "user_id",
        offset_id("user_id", settings.id_offset).alias("tgt_user_id"),
        "expected_full_name",
        F.when(_writable(), 1).otherwise(0).alias("sink_eligible_without_udf"),
        F.col("updated_at").alias("dirty_updated_at"),
    )


def explain_users(asked: DataFrame, queue: DataFrame, bundle: DataFrame, staging: DataFrame) -> DataFrame:
    """Three lines on each asked user: what is expected, the day a rebuild was queued, and what the
    bulk load has."""
    asked = asked.select("user_id")
    expected = bundle.join(asked, "user_id", "left_semi")
    hint = (
        F.when(~has_text("bvn_raw"), "yes_no_bvn")
        .when(has_text("id_number_token"), "yes_has_token")
        .otherwise("needs_vt_tokenize_or_miss")
    )
    lookup = expected.select(
        F.lit("bundle_lookup").alias("layer"), "user_id", F.col("expected_full_name").alias("value"), hint.alias("status")
    )

    waiting = asked.join(queue, "user_id", "left").select(
        F.lit("dirty_queue").alias("layer"),
        "user_id",
        date_text("updated_at").alias("value"),
        F.when(F.col("updated_at").isNull(), "not_queued").otherwise("queued").alias("status"),
    )

    stored = staging.select("user_id", "full_name", F.lit(True).alias("staged"))
    check = (
        F.when(F.col("staged").isNull(), "no_staging_row")
        .when(_folded("full_name") == _folded("expected_full_name"), "match")
        .otherwise("mismatch")
    )
    compared = expected.join(stored, "user_id", "left").select(
        F.lit("staging_vs_bundle").alias("layer"), "user_id", F.col("full_name").alias("value"), check.alias("status")
    )
    return lookup.unionByName(waiting).unionByName(compared)


def explain_user(user_id: int, queue: DataFrame, bundle: DataFrame, staging: DataFrame) -> DataFrame:
    asked = bundle.sparkSession.range(user_id, user_id + 1).select(F.col("id").alias("user_id"))
    one = F.col("user_id") == user_id
    return explain_users(asked, queue.filter(one), bundle.filter(one), staging.filter(one))


def join_source_target(expected: DataFrame, target: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    found = target.select(
        (F.col("user_id") - settings.id_offset).alias("user_id"), F.col("full_name").alias("target_full_name"), F.lit(True).alias("in_target")
    )
    return expected.join(found, "user_id", "left")


def compare_with_target(expected: DataFrame, target: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Every expected user against the target: PASS, STALE, MISSING, or filtered on purpose."""
    outcome = (
        F.when(~_writable(), "FILTERED")
        .when(F.col("in_target").isNull(), "MISSING")
        .when(_folded("target_full_name") == _folded("expected_full_name"), "PASS")
        .otherwise("STALE")
    )
    return join_source_target(expected, target, settings).select("user_id", "expected_full_name", "target_full_name", outcome.alias("outcome"))


def compare_summary(compared: DataFrame) -> DataFrame:
    def n(outcome: str) -> Column:
        return _count_if(F.col("outcome") == outcome)

    counts = compared.agg(
        n("PASS").alias("pass_cnt"), n("STALE").alias("stale_cnt"), n("MISSING").alias("missing_cnt"), n("FILTERED").alias("filtered_cnt")
    )
    clean = (F.col("stale_cnt") == 0) & (F.col("missing_cnt") == 0)
    return counts.withColumn("result", F.when(clean, "PASS").otherwise("FAIL"))


def table_counts(tables: dict[str, DataFrame], name: str) -> DataFrame:
    counts = [df.agg(F.count(F.lit(1)).alias(name)).select(F.lit(t).alias("tbl"), name) for t, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def count_check(
    expected: DataFrame,
    actual: DataFrame,
    mode: str = "absolute",
    baseline: DataFrame | None = None,
    max_deficit: int = 10,
    max_surplus: int = 100,
    min_percent: float | None = None,
) -> DataFrame:
    """Counts per table against what was expected. ``baseline_delta`` adds the count from before
    the load. A percentage replaces the two tolerances."""
    if mode not in ("absolute", "baseline_delta"):
        raise ValueError("mode must be absolute or baseline_delta")
    rows = expected.join(actual, "tbl", "left")
    wanted = F.col("expected_cnt")
    if mode == "baseline_delta" and baseline is not None:
        rows = rows.join(baseline, "tbl", "left")
        wanted = wanted + F.coalesce("baseline_cnt", F.lit(0))
    rows = rows.withColumns({"wanted_cnt": wanted, "diff": F.col("actual_cnt") - wanted})
    if min_percent is None:
        reached = F.col("diff").between(-max_deficit, max_surplus)
    else:
        reached = F.col("actual_cnt") * 100 >= F.col("wanted_cnt") * min_percent
    reached = F.coalesce(reached & (F.col("wanted_cnt") > 0), F.lit(False))
    return rows.select("tbl", "wanted_cnt", "actual_cnt", "diff", F.when(reached, "PASS").otherwise("FAIL").alias("result"))


def phase_counts(wide: dict[str, DataFrame]) -> DataFrame:
    """Per table: rows with all tokens, rows the first phase writes, rows left for the second."""
    rules = {
        "user": (token_ready(["mobile_token"]), token_ready(["mobile_token"]), token_miss(USER_TOKENS), ["mobile_token", "app_code"]),
        "user_info": (token_ready(["id_number_token"]), _writable(), token_miss(INFO_TOKENS), None),
        "user_bankcard": (token_ready(["bank_account_token"]), token_ready(["bank_account_token"]), token_miss(CARD_TOKENS), ["user_id", "bank_account_token"]),
        "application": (
            token_ready(list(APPLICATION_TOKENS)),
            token_ready(["mobile_token", "bank_account_token"], {"id_number_token": "bvn_raw"}),
            token_miss(APPLICATION_TOKENS),
            None,
        ),
    }
    lines = []
    for table, df in wide.items():
        hit, first, miss, key = rules[table]
        if key is None:
            counted = df.agg(_count_if(hit).alias("hit_cnt"), _count_if(first).alias("phase1_cnt"), _count_if(miss).alias("miss_cnt"))
        else:
            # several rows may share a target key: one row per key first, then a plain count
            per_key = df.groupBy(*key).agg(
                F.max(F.when(hit, 1).otherwise(0)).cast("bigint").alias("hits"), F.count(F.when(miss, 1)).alias("misses")
            )
            hits = F.coalesce(F.sum("hits"), F.lit(0))
            counted = per_key.agg(hits.alias("hit_cnt"), hits.alias("phase1_cnt"), F.coalesce(F.sum("misses"), F.lit(0)).alias("miss_cnt"))
        lines.append(counted.select(F.lit(table).alias("tbl"), "hit_cnt", "phase1_cnt", "miss_cnt"))
    return reduce(DataFrame.unionByName, lines)


def phase1_done(phases: DataFrame, actual: DataFrame, max_deficit: int = 10) -> DataFrame:
    """Tables whose first phase is written while rows still wait for the second."""
    done = (F.col("miss_cnt") > 0) & (F.col("hit_cnt") - F.col("actual_cnt")).between(0, max_deficit)
    return phases.join(actual, "tbl", "left").withColumn("start_phase2", F.coalesce(done, F.lit(False)))


def sync_progress(before: DataFrame, now: DataFrame, expected: DataFrame, seconds: float) -> DataFrame:
    """Per table: rows since the last look, percent done, rows per minute."""
    rows = expected.join(now, "tbl", "left").join(before.withColumnRenamed("actual_cnt", "before_cnt"), "tbl", "left")
    delta = F.col("actual_cnt") - F.col("before_cnt")
    return rows.select(
        "tbl",
        "expected_cnt",
        "actual_cnt",
        delta.alias("delta"),
        F.when(F.col("expected_cnt") > 0, F.round(F.col("actual_cnt") * 100.0 / F.col("expected_cnt"), 2)).alias("percent"),
        F.round(delta * 60.0 / F.lit(seconds), 1).alias("rate_per_min"),
    )


def missing_token_report(user: DataFrame, bankcard: DataFrame, user_info: DataFrame, application: DataFrame) -> DataFrame:
    """Rows that lack each token, one pass per table."""
    one = [
        (user, {"user": has_text("mobile_norm") & ~has_text("mobile_token")}),
        (bankcard, {"user_bankcard": has_text("bank_account_raw") & ~has_text("bank_account_token")}),
        (user_info, {"user_info": has_text("bvn_raw") & ~has_text("id_number_token")}),
        (
            application,
            {
                "application_mobile": ~has_text("mobile_token"),
                "application_id_number": ~has_text("id_number_token"),
                "application_bank": ~has_text("bank_account_token"),
            },
        ),
    ]
    lines = []
    for df, rules in one:
        counts = df.agg(*[_count_if(rule).alias(name) for name, rule in rules.items()])
        stacked = F.array(*[F.struct(F.lit(name).alias("tbl"), F.col(name).alias("missing_token")) for name in rules])
        lines.append(counts.select(F.inline(stacked)))
    return reduce(DataFrame.unionByName, lines)


def row_count_report(tables: dict[str, DataFrame]) -> DataFrame:
    """All counts in one row: a count per table, added up sideways."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("cnt")).select(
            *[(F.col("cnt") if t == name else F.lit(0).cast("bigint")).alias(f"{t}_cnt") for t in tables]
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts).agg(*[F.sum(f"{t}_cnt").alias(f"{t}_cnt") for t in tables])


def distinct_keys(df: DataFrame, keys: list[str], where: Column | None = None) -> DataFrame:
    rows = df if where is None else df.filter(where)
    return rows.select(*keys).distinct().agg(F.count(F.lit(1)).alias("cnt"))
