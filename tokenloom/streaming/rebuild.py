"""Rebuilding whole output rows for stale keys, with the functions of the bulk load.

Sources are cut down to what the stale rows need by semi joins. Rows that share a target key with a
stale row come along, so the same row wins the key as in a bulk load.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tokenloom.functions.ids import IdLayout, with_snowflake_ids
from tokenloom.functions.text import has_text, normalize_mobile
from tokenloom.operators.dictionary import KEY, source_values
from tokenloom.operators.tokenize import Tokenizer
from tokenloom.operators.upsert import keep_existing
from tokenloom.plans import outputs
from tokenloom.settings import DEFAULT, Settings, Workspace
from tokenloom.sources.keyed import only
from tokenloom.sources.schemas import TARGET_KEYS
from tokenloom.sources.sinks import KeyedTable
from tokenloom.sources.tables import Sources
from tokenloom.streaming.debounce import debounce
from tokenloom.streaming.enqueue import enqueue_dirty
from tokenloom.streaming.triggers import touched, trigger_keys


Keep = Callable[[DataFrame], DataFrame]


def for_users(sources: Sources, user_ids: DataFrame, keep: Keep) -> Sources:
    """All tables a user's own facts come from, cut down to some users."""
    user_ids = keep(user_ids)
    users = keep(only(sources["user"], "id", user_ids))
    cut = {"user": users}
    for table in ("user_personal_info", "user_bank_info", "user_work_related", "user_emergency_contact", "risk_user_credit_callback"):
        cut[table] = only(sources[table], "user_id", user_ids)
    owned = users.filter(has_text("device_id")).select("device_id").distinct()
    cut["device_ids"] = only(sources["device_ids"], "device_uuid", owned)
    sessions = cut["device_ids"].filter(has_text("session_uuid")).select("session_uuid").distinct()
    network = sources["device_network"]
    cut["device_network"] = only(network, "device_uuid", owned).unionByName(only(network, "session_uuid", sessions))
    adids = users.filter(has_text("adid")).select("adid").distinct()
    cut["adjust_callback_record"] = only(sources["adjust_callback_record"], "adid", adids)
    # those that several joins of an output read are cut once
    for table in ("user_personal_info", "user_bank_info", "user_emergency_contact", "device_ids"):
        cut[table] = keep(cut[table])
    restricted = sources.using(**cut)
    return restricted.using(vt_token_cache=keep(dictionary_rows(sources["vt_token_cache"], keep(source_values(restricted)))))


def dictionary_rows(dictionary: DataFrame, values: DataFrame) -> DataFrame:
    """The entries of some (vt_type, raw_value)."""
    return only(dictionary, "raw_value", values.select("raw_value")).join(values, KEY, "left_semi")


def for_user_rows(sources: Sources, user_ids: DataFrame, keep: Keep) -> Sources:
    """Users with a stale row and those with the same phone number."""
    numbered = sources["user"].withColumn("mobile_norm", normalize_mobile("mobile"))
    numbers = only(numbered, "id", user_ids).select("mobile_norm").filter("mobile_norm IS NOT NULL").distinct()
    peers = numbered.join(numbers, "mobile_norm", "left_semi").select(F.col("id").alias("user_id"))
    return for_users(sources, peers, keep)


def _orders_and_their_facts(sources: Sources, orders: DataFrame) -> dict[str, DataFrame]:
    numbers = orders.filter(has_text("order_no")).select("order_no").distinct()
    return {
        "user_order": orders,
        "user_repay": only(sources["user_repay"], "order_no", numbers),
        "risk_user_approval_callback": only(sources["risk_user_approval_callback"], "order_no", numbers),
        "user_order_installment": only(sources["user_order_installment"], "user_order_id", orders.select("id")),
    }


def for_applications(sources: Sources, scope: DataFrame, keep: Keep) -> Sources:
    orders = keep(only(sources["user_order"], "user_id", scope.select("user_id")).join(scope, ["user_id", "order_no"], "left_semi"))
    return for_users(sources, scope.select("user_id").distinct(), keep).using(**_orders_and_their_facts(sources, orders))


def for_loans(sources: Sources, scope: DataFrame, keep: Keep) -> Sources:
    orders = keep(only(sources["user_order"], "order_no", scope))
    return sources.using(**_orders_and_their_facts(sources, orders))


# What one rebuild covers, in source columns.
SCOPE = {
    "user": ["user_id"],
    "user_info": ["user_id"],
    "user_bankcard": ["user_id"],
    "user_product": ["user_id", "product_id"],
    "application": ["user_id", "order_no"],
    "loan": ["order_no"],
}


def scope_of(output: str, keys: DataFrame, sources: Sources, changes: DataFrame | None = None) -> DataFrame:
    """Whatever may share a target key with a stale row. Row images of ``changes`` add what the
    tables no longer hold."""
    names = SCOPE[output]
    if output == "user_bankcard":
        found = only(sources["user_bank_info"], "id", keys)
        gone = ("user_bank_info", names)
    elif output == "application":
        found = only(sources["user_order"], "id", keys)
        gone = ("user_order", names)
    elif output == "loan":
        order_ids = only(sources["user_order_installment"], "id", keys).select("user_order_id").distinct()
        found = only(sources["user_order"], "id", order_ids)
        gone = ("user_order", names)
    else:
        return keys.select(*names).distinct()
    scope = found.select(*names)
    if changes is not None:
        scope = scope.unionByName(touched(changes, gone[0], **{c: c for c in gone[1]}))
    return scope.dropna(subset=names).distinct()


def rebuild_scope(
    output: str, scope: DataFrame, sources: Sources, tokenizer: Tokenizer | None = None, settings: Settings = DEFAULT, keep: Keep | None = None
) -> DataFrame:
    """The output rows of a scope, as a bulk load would write them. Cards come without an id.

    ``keep`` writes what several joins read; without one it goes to a workspace that stays, as the result is lazy.
    """
    keep = keep or Workspace(scope.sparkSession).keep
    if output == "user":
        return outputs.user_output(for_user_rows(sources, scope, keep), "all", tokenizer, settings)
    if output == "user_info":
        return outputs.user_info_output(for_users(sources, scope, keep), "all", tokenizer, settings)
    if output == "user_bankcard":
        return outputs.bankcard_rows(for_users(sources, scope, keep), "all", tokenizer, settings)
    if output == "user_product":
        orders = only(sources["user_order"], "user_id", scope.select("user_id")).join(scope, SCOPE[output], "left_semi")
        return outputs.product_output(sources.using(user_order=orders), settings)
    if output == "application":
        return outputs.application_output(for_applications(sources, scope, keep), "all", tokenizer, settings)
    if output == "loan":
        return outputs.loan_output(for_loans(sources, scope, keep), settings)
    raise ValueError(f"no rebuild for {output}")


def rebuild_rows(output: str, keys: DataFrame, sources: Sources, tokenizer: Tokenizer | None = None, settings: Settings = DEFAULT) -> DataFrame:
    keep = Workspace(keys.sparkSession).keep
    return rebuild_scope(output, keep(scope_of(output, keys, sources)), sources, tokenizer, settings, keep)


def keys_in_scope(output: str, target: DataFrame, scope: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """The keys of those rows of ``target`` that lie within a scope."""
    pk, offset = TARGET_KEYS[output], settings.id_offset
    # an order number stands between the fixed ends of a loan number
    order_no = F.substr(F.col("loan_no"), F.lit(4), F.char_length("loan_no") - 9) if output == "loan" else None
    stored = {
        "user": lambda: {"user_id": F.col("user_id") - offset},
        "user_info": lambda: {"user_id": F.col("user_id") - offset},
        "user_bankcard": lambda: {"user_id": F.col("group_user_id") - offset},
        "user_product": lambda: {"user_id": F.col("group_user_id") - offset, "product_id": F.col("product_id")},
        "application": lambda: {"user_id": F.col("group_user_id") - offset, "order_no": F.col("sn")},
        "loan": lambda: {"order_no": order_no},
    }[output]()
    named = target.select(*pk, *[column.alias(f"scope_{name}") for name, column in stored.items()])
    wanted = scope.select(*[F.col(name).alias(f"scope_{name}") for name in stored])
    return named.join(wanted, wanted.columns, "left_semi").select(*pk)


def gone_rows(output: str, target: DataFrame, rebuilt: DataFrame, scope: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Stored keys within a scope that its rebuild no longer gives."""
    pk = TARGET_KEYS[output]
    return keys_in_scope(output, target, scope, settings).join(rebuilt.select(*pk), pk, "left_anti")


def stored_for(output: str, table: KeyedTable, before: int, scope: DataFrame, keep: Keep, settings: Settings = DEFAULT) -> DataFrame | None:
    """The stored rows of all keys that ever had a row within a scope. The history gives these keys from the few columns that name them; only
    their rows are read whole and grouped. A key whose newest row left the scope is among them, so no older row of it comes back."""
    history = table.history(before)
    if history is None:
        return None
    return table.read(before=before, keys=keep(keys_in_scope(output, history, scope, settings).distinct()))


class RebuildJob:
    """What a change stream does with each micro-batch."""

    def __init__(
        self,
        output: str,
        sources_now: Callable[[], Sources],
        target: KeyedTable,
        tokenizer: Tokenizer | None = None,
        settings: Settings = DEFAULT,
        propagate_deletes: bool = False,
        id_layout: IdLayout | None = None,
    ):
        self.output, self.sources_now, self.target = output, sources_now, target
        self.tokenizer, self.settings = tokenizer, settings
        self.propagate_deletes, self.id_layout = propagate_deletes, id_layout

    def scope(self, batch: DataFrame, sources: Sources) -> DataFrame:
        return scope_of(self.output, trigger_keys(self.output, batch, sources), sources, batch)

    def run_batch(self, batch: DataFrame, batch_id: int) -> None:
        """Many changes of one key in a batch cost one rebuild. Running a batch again is harmless:
        its rows come from the tables as they are now and replace those of the first run."""
        sources = self.sources_now()
        with Workspace(batch.sparkSession) as work:
            self.rebuild(sources, work.keep(self.scope(batch, sources)), batch_id, work.keep)

    def rebuild(self, sources: Sources, scope: DataFrame, batch_id: int, keep: Keep) -> None:
        rows = rebuild_scope(self.output, scope, sources, self.tokenizer, self.settings, keep)
        if self.output == "user_bankcard":
            rows = keep(rows)
            known = self.target.read(before=batch_id, keys=rows.select(*TARGET_KEYS["user_bankcard"]))
            rows = self._with_ids(rows, known, batch_id)
        stored = stored_for(self.output, self.target, batch_id, scope, keep, self.settings) if self.propagate_deletes else None
        if stored is None:
            self.target.upsert(rows, batch_id)
            return
        rows = keep(rows)
        self.target.apply(rows, gone_rows(self.output, stored, rows, scope, self.settings), batch_id)

    def _with_ids(self, rows: DataFrame, stored: DataFrame | None, batch_id: int) -> DataFrame:
        """New cards get new ids, known cards keep theirs. Ids start after all that the table ever held, and a
        batch that runs again starts where it did before."""
        pk = TARGET_KEYS["user_bankcard"]
        start_ms = self.target.id_start_ms(batch_id, self.id_layout)
        rows = with_snowflake_ids(rows, pk, start_ms, self.id_layout)
        rows = rows.select("id", "group_user_id", "bank_code", "bank_account_number", "is_default")
        return rows if stored is None else keep_existing(rows, stored, pk, "id")


class ProfileJob(RebuildJob):
    """The profile output: changes queue their users, and a user rests between two rebuilds.

    The queue table is the memory of who was rebuilt when. A batch that runs again starts from the
    queue as it was before that batch, so it lets the same users through.
    """

    def __init__(self, sources_now: Callable[[], Sources], target: KeyedTable, queue: KeyedTable, tokenizer: Tokenizer, **options):
        super().__init__("user_info", sources_now, target, tokenizer, **options)
        self.queue = queue

    def run_batch(self, batch: DataFrame, batch_id: int) -> None:
        sources = self.sources_now()
        with Workspace(batch.sparkSession) as work:
            events = work.keep(enqueue_dirty(batch, sources))
            users = events.select("user_id").distinct()
            passed = debounce(events, self.queue.read(before=batch_id, keys=users), work.keep)
            stamps = work.keep(passed.groupBy("user_id").agg(F.max("ts").alias("updated_at")))
            self.rebuild(sources, stamps.select("user_id"), batch_id, work.keep)
            self.queue.upsert(stamps, batch_id)


def start(job: RebuildJob, changes: DataFrame, checkpoint: str, interval: str | None = "5 seconds") -> StreamingQuery:
    """Follows a change stream; with ``interval`` None it takes what is there and stops."""
    trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
    return (
        changes.writeStream.foreachBatch(job.run_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
