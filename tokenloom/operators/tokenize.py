"""Turning values into tokens through a pluggable tokenizer."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.functions.codes import CLAIMED, FAILED, OK, PENDING
from tokenloom.functions.text import as_column, blank_to_null, has_text, mask_value, raw_hex
from tokenloom.operators.dictionary import ERROR_CHARS, KEY, MAX_CHARS, claimable, mark_oversize, select_work, upsert_dict
from tokenloom.operators.lookups import lookup_text
from tokenloom.settings import checkpointed

BATCH = 50_000
RESULT_SCHEMA = "vt_type int, raw_value string, token string, masking string, status int, error string"
TOKEN_CHARS = 28


class Tokenizer:
    """``column`` for tokenizers that are plain expressions, else ``call`` for batches.

    ``call`` returns one token per value, in order, and optionally as many masked values. It must
    give the same token for the same value every time: a lost task repeats its batches.
    """

    def column(self, vt_type: Column, raw: Column) -> Column | None:
        return None

    def call(self, vt_type: int, values: list[str]) -> tuple[list[str], list[str | None] | None]:
        raise NotImplementedError


class HashTokenizer(Tokenizer):
    """A keyed hash. Outside tests the key must be secret: hashes of phone numbers made without
    one can be reversed by trying all numbers."""

    def __init__(self, key: str = ""):
        self.key = key

    def column(self, vt_type: Column, raw: Column) -> Column:
        text = F.concat(F.lit(self.key), vt_type.cast("string"), F.lit(":"), raw)
        return F.left(F.sha2(text, 256), F.lit(TOKEN_CHARS))


class DictionaryTokenizer(Tokenizer):
    """Knows nothing beyond the dictionary: values not in it stay without a token."""

    def column(self, vt_type: Column, raw: Column) -> Column:
        return F.lit(None).cast("string")


class TokenCountMismatch(RuntimeError):
    pass


def response_to_rows(vt_type: int, values: list[str], tokens: list[str], masking: list[str | None] | None) -> pd.DataFrame:
    """Pairs the k-th token with the k-th value; missing masks are NULL."""
    if len(tokens) != len(values):
        raise TokenCountMismatch(f"asked for {len(values)} tokens, received {len(tokens)}")
    masks = list(masking or [])[: len(values)]
    masks += [None] * (len(values) - len(masks))
    return pd.DataFrame(
        {"vt_type": vt_type, "raw_value": values, "token": tokens, "masking": masks, "status": OK, "error": None}
    )


def _call_batch(tokenizer: Tokenizer, vt_type: int, values: list[str], retries: int, pause: float) -> pd.DataFrame:
    """All of the batch or none of it; a batch that keeps failing becomes failed rows."""
    error = "no attempt made"
    for attempt in range(1, retries + 1):
        try:
            return response_to_rows(vt_type, values, *tokenizer.call(vt_type, values))
        except Exception as failure:  # the service decides what it raises
            error = str(failure)[:ERROR_CHARS]
            if attempt < retries:
                time.sleep(pause * attempt)
    return pd.DataFrame(
        {"vt_type": vt_type, "raw_value": values, "token": None, "masking": None, "status": FAILED, "error": error}
    )


def _batch_caller(tokenizer: Tokenizer, size: int, retries: int, pause: float) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    columns = ["vt_type", "raw_value", "token", "masking", "status", "error"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting: dict[int, list[str]] = {}
        for frame in frames:
            for vt_type, values in frame.groupby("vt_type")["raw_value"]:
                pool = waiting.setdefault(int(vt_type), [])
                pool.extend(values)
                while len(pool) >= size:
                    batch, pool[:] = pool[:size], pool[size:]
                    yield _call_batch(tokenizer, int(vt_type), batch, retries, pause)[columns]
        for vt_type, pool in waiting.items():
            if pool:
                yield _call_batch(tokenizer, vt_type, pool, retries, pause)[columns]

    return run


def tokenize_values(
    values: DataFrame,
    tokenizer: Tokenizer,
    batch: int = BATCH,
    retries: int = 3,
    pause: float = 0.5,
    calls_at_once: int | None = None,
) -> DataFrame:
    """One result row per distinct (vt_type, raw_value). Failures are rows with status 2.

    ``calls_at_once`` bounds how many tasks call the service together.
    """
    values = values.select(F.col("vt_type").cast("int").alias("vt_type"), "raw_value").distinct()
    token = tokenizer.column(F.col("vt_type"), F.col("raw_value"))
    if token is not None:
        known = F.col("token").isNotNull()
        return values.withColumn("token", token).select(
            *KEY,
            "token",
            F.when(known, mask_value("raw_value")).alias("masking"),
            F.when(known, OK).otherwise(FAILED).alias("status"),
            F.when(~known, "value is not in the dictionary").alias("error"),
        )
    if calls_at_once is not None:
        values = values.repartition(calls_at_once, *KEY)
    return values.mapInPandas(_batch_caller(tokenizer, batch, retries, pause), RESULT_SCHEMA)


def _insist(token: Column, raw: Column) -> Column:
    message = F.concat(F.lit("no token for value "), mask_value(raw))
    return F.when(has_text(token), token).otherwise(F.raise_error(message).cast("string"))


def tokenize_or_lookup(
    df: DataFrame,
    raw: str,
    token: str,
    vt_type: int,
    tokenizer: Tokenizer,
    row_key: str = "id",
    **call_options,
) -> DataFrame:
    """Keeps the stored token where there is one, else tokenises the raw value; blank gives NULL.

    A value the tokenizer gives no token for fails the job, except that a ``DictionaryTokenizer``
    leaves NULL. Each distinct value is sent once, however many rows hold it.
    """
    stored = F.when(has_text(token), F.col(token))
    value = blank_to_null(raw)
    made = tokenizer.column(F.lit(vt_type), value)
    if made is not None:
        if not isinstance(tokenizer, DictionaryTokenizer):
            made = _insist(made, value)
        fresh = F.when(value.isNotNull(), made)
        return df.withColumn(token, F.when(stored.isNotNull(), stored).otherwise(fresh))

    df = df.withColumn("lacking", F.when(stored.isNull(), value))
    unknown = df.filter("lacking IS NOT NULL").select(F.lit(vt_type).alias("vt_type"), F.col("lacking").alias("raw_value"))
    results = checkpointed(tokenize_values(unknown, tokenizer, **call_options))
    found = results.select(F.col("raw_value").alias("asked"), F.col("token").alias("answer"))
    joined = lookup_text(df, found, "lacking", "asked", row_key)
    answered = F.when(F.col("lacking").isNotNull(), _insist(F.col("answer"), F.col("lacking")))
    return joined.withColumn(token, F.coalesce(stored, answered)).drop("lacking", "answer")


# token column -> (raw column, kind)
Columns = dict[str, tuple[str, int]]


def _lacking(token: str, raw: str) -> Column:
    """The raw value that has to be asked for, if any."""
    return F.when(~has_text(token), blank_to_null(raw))


def lacking_values(df: DataFrame, columns: Columns, row_key: str) -> DataFrame:
    """(row_key, slot, vt_type, raw_value) for every token column without a stored token; rows that share ``row_key`` share their values."""
    asked = [
        F.struct(F.lit(slot).alias("slot"), F.lit(kind).alias("vt_type"), _lacking(token, raw).alias("raw_value"))
        for slot, (token, (raw, kind)) in enumerate(columns.items())
    ]
    rows = df.select(F.col(row_key).alias("row_key"), F.explode(F.array(*asked)).alias("asked"))
    return rows.select("row_key", "asked.*").filter("raw_value IS NOT NULL").distinct()


def ask_once(requests: list[DataFrame], tokenizer: Tokenizer, **call_options) -> DataFrame:
    """(vt_type, value_hash, answer) for the values of all ``requests``: each value is sent once, whatever columns hold it. What is kept
    of a value is its hash."""
    values = reduce(DataFrame.unionByName, [r.select("vt_type", "raw_value") for r in requests])
    answers = tokenize_values(values, tokenizer, **call_options)
    return checkpointed(answers.select("vt_type", F.sha2("raw_value", 256).alias("value_hash"), F.col("token").alias("answer")))


def fill_tokens(df: DataFrame, columns: Columns, answers: DataFrame, row_key: str) -> DataFrame:
    """``df`` with its token columns filled from ``answers``. Answers meet narrow rows; the wide rows move once, by ``row_key``.
    A value without an answer fails the job."""
    asked = lacking_values(df, columns, row_key).withColumn("value_hash", F.sha2("raw_value", 256))
    found = asked.join(answers, ["vt_type", "value_hash"], "left").withColumn("answer", _insist(F.col("answer"), F.col("raw_value")))
    fresh = [F.max(F.when(F.col("slot") == slot, F.col("answer"))).alias(f"fresh_{slot}") for slot in range(len(columns))]
    rows = df.join(found.groupBy(F.col("row_key").alias(row_key)).agg(*fresh), row_key, "left")
    filled = {token: F.coalesce(F.when(has_text(token), F.col(token)), F.col(f"fresh_{slot}")) for slot, token in enumerate(columns)}
    return rows.withColumns(filled).select(*df.columns)


def asks_in_batches(tokenizer: Tokenizer) -> bool:
    return tokenizer.column(F.lit(0), F.lit("")) is None


def tokenize_columns(df: DataFrame, columns: Columns, tokenizer: Tokenizer, row_key: str = "id", **call_options) -> DataFrame:
    """``tokenize_or_lookup`` for several columns, with one pass of the tokenizer over the values of all."""
    if not asks_in_batches(tokenizer):
        for token, (raw, kind) in columns.items():
            df = tokenize_or_lookup(df, raw, token, kind, tokenizer, row_key)
        return df
    return fill_tokens(df, columns, ask_once([lacking_values(df, columns, row_key)], tokenizer, **call_options), row_key)


def preload(
    dictionary: DataFrame,
    tokenizer: Tokenizer,
    retry_failed: bool = False,
    sources=None,
    mode: str = "fast",
    types: list[str] | None = None,
    **call_options,
) -> DataFrame:
    """The dictionary after all its open values went through the tokenizer once."""
    marked = mark_oversize(dictionary)
    work = select_work(marked, mode, retry_failed, sources, types)
    results = tokenize_values(work, tokenizer, **call_options)
    if asks_in_batches(tokenizer):
        results = checkpointed(results)
    return upsert_dict(marked, results)


def found_counts() -> dict[str, Column]:
    """What is counted of a dictionary before a run."""
    return {"work": (F.col("status") == PENDING) & claimable(), "rows": F.lit(True)}


def ended_counts() -> dict[str, Column]:
    """What is counted of a dictionary after a run."""
    ok = F.col("status") == OK
    return {
        "ok_rows": ok,
        "with_token": ok & has_text("token"),
        "failed_rows": F.col("status") == FAILED,
        "remaining": (F.col("status") == PENDING) & claimable(),
        "claimed": F.col("status") == CLAIMED,
    }


def preload_summary(before: DataFrame, after: DataFrame) -> DataFrame:
    """Per kind: work found, done, failed, remaining, percent, and the final state. A kind fails
    if a value failed, or if rows are marked good without holding a token."""

    def counted(df: DataFrame, counts: dict[str, Column]) -> DataFrame:
        return df.groupBy("vt_type").agg(*[F.count(F.when(condition, 1)).alias(name) for name, condition in counts.items()])

    return summary_of(counted(before, found_counts()), counted(after, ended_counts()))


def summary_of(found: DataFrame, ended: DataFrame) -> DataFrame:
    """The summary from counts per kind, however they were taken."""
    found = found.filter("rows > 0").drop("rows")
    ended = ended.join(found.select("vt_type"), "vt_type", "left_semi")
    done = F.col("work") - F.col("remaining")
    lost = (F.col("ok_rows") > 0) & (F.col("with_token") == 0)
    return (
        found.join(ended, "vt_type", "full_outer")
        .na.fill(0)
        .withColumns(
            {
                "done": done,
                "percent": F.when(F.col("work") > 0, F.round(done * 100.0 / F.col("work"), 1)).otherwise(F.lit(0.0)),
                "state": F.when((F.col("failed_rows") > 0) | lost, "FAILED").otherwise("DONE"),
            }
        )
    )


def progress_stats(summary: DataFrame, seconds: float) -> DataFrame:
    rate = F.round(F.col("done") * 60.0 / F.lit(max(seconds, 0.001)), 1)
    return summary.withColumn("rate_per_min", rate)


RECONCILE_CLASSES = ("MATCH", "CHANGED", "NEW", "LOST", "MASKING_ONLY", "API_ERROR")


def _trimmed(c: str) -> Column:
    return F.trim(F.coalesce(as_column(c), F.lit("")))


def reconcile_dictionary(
    dictionary: DataFrame,
    tokenizer: Tokenizer,
    include_blank_tokens: bool = False,
    compare_masking: bool = False,
    **call_options,
) -> DataFrame:
    """Every good dictionary row with the token the tokenizer gives for it now, and a class."""
    rows = dictionary.filter((F.col("status") == OK) & (F.col("raw_value") != "") & (F.char_length("raw_value") <= MAX_CHARS))
    if not include_blank_tokens:
        rows = rows.filter(has_text("token"))
    answers = tokenize_values(rows.select(*KEY), tokenizer, **call_options).select(
        *KEY,
        F.col("token").alias("api_token"),
        F.col("masking").alias("api_masking"),
        F.col("status").alias("api_status"),
        F.col("error").alias("api_error"),
    )
    stored, now = _trimmed("token"), _trimmed("api_token")
    masks_differ = _trimmed("masking") != _trimmed("api_masking")
    kind = (
        F.when(F.col("api_status") == FAILED, "API_ERROR")
        .when((stored == "") & (now != ""), "NEW")
        .when((stored != "") & (now == ""), "LOST")
        .when(stored != now, "CHANGED")
    )
    if compare_masking:
        kind = kind.when(masks_differ, "MASKING_ONLY")
    return rows.join(answers, KEY, "left").withColumn("class", kind.otherwise("MATCH"))


def reconcile_summary(reconciled: DataFrame) -> DataFrame:
    return reconciled.groupBy("class").agg(F.count(F.lit(1)).alias("cnt"))


def reconcile_verdict(summary: DataFrame) -> DataFrame:
    wrong = F.sum(F.when(~F.col("class").isin("MATCH", "MASKING_ONLY"), F.col("cnt")).otherwise(0))
    total = F.sum("cnt")
    return summary.agg(
        F.coalesce(total, F.lit(0)).alias("total"),
        F.coalesce(wrong, F.lit(0)).alias("wrong"),
        F.when(F.coalesce(wrong, F.lit(0)) == 0, "PASS").otherwise("FAIL").alias("result"),
    )


def difference_rows(reconciled: DataFrame) -> DataFrame:
    """The log of differences; raw values appear as hex only."""
    return reconciled.filter(F.col("class") != "MATCH").select(
        F.current_timestamp().alias("logged_at"),
        "class",
        "id",
        "vt_type",
        raw_hex("raw_value").alias("raw_hex"),
        F.col("token").alias("db_token"),
        "api_token",
        F.col("masking").alias("db_masking"),
        "api_masking",
    )
