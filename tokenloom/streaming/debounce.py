"""Letting a user through again only after a rest.

An event passes if its user was never stamped, or was last stamped at least ``wait_s`` seconds
before; it then becomes the stamp. Events that do not pass are dropped, not delayed. Times count in milliseconds, a
wait is at least one; events of a user at one moment are one, with the shortest of their waits.

Events that many users share are looked at once for all of them. A *run* is an event that passes whatever the events before it did, with
those up to the next such event; what passes of a run depends on nothing outside it. A user's own event can change that only within
the longest wait of a run. So a user is looked at with its own events and the runs near them; of all other runs the user has what any user has.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenloom.functions.times import epoch_ms
from tokenloom.settings import checkpointed
from tokenloom.streaming.shared import Dirty, array_of, dealt, in_arrays

Keep = Callable[[DataFrame], DataFrame]

#: A user's events are looked at in stretches of at least this long, so no task holds more of one user.
BLOCK_MS = 3_600_000
#: Runs and own events meet in stretches of at least this long.
MEET_MS = 60_000
_COLUMNS = ("user_id", "ms", "wait", "stored")


def _to_ms(df: DataFrame) -> DataFrame:
    """Times as milliseconds on their own clock, which is all a difference needs."""
    return df.withColumn("ms", epoch_ms("ts", "UTC"))


def _from_ms(column: str):
    whole = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return whole + F.make_dt_interval(secs=(F.col(column) / F.lit(1000).cast("decimal(4,0)")).cast("decimal(18,6)"))


def _blocks(ms: Column, length: int) -> Column:
    return F.floor(ms / F.lit(length)).cast("bigint")


def _with_begins(rows: DataFrame, longest: int, length: int) -> DataFrame:
    """One row per user and moment: whether it ``begins`` (it passes whatever the events before it did, or is a stored
    stamp), and whether it is ``open`` (an event that does not begin may follow it, or it is one).

    The last ``longest`` milliseconds of a block also stand at the head of the next one, where they
    are only looked back at.
    """
    near_end = F.col("ms") >= (_blocks(F.col("ms"), length) + 1) * F.lit(length) - F.lit(longest)
    block = _blocks(F.col("ms"), length)
    placed = rows.withColumn("block", F.explode(F.when(near_end, F.array(block, block + 1)).otherwise(F.array(block))))
    placed = placed.withColumn("guest", ~F.col("block").eqNullSafe(block)).repartition("user_id", "block")
    moments = placed.groupBy("user_id", "block", "ms").agg(
        F.min("wait").alias("wait"), F.max("stored").alias("stored"), F.max("guest").alias("guest")
    )
    in_time = Window.partitionBy("user_id", "block").orderBy("ms")
    rested = F.col("ms") - F.lag("ms").over(in_time) >= F.col("wait")
    marked = moments.withColumn("begins", F.col("stored") | F.coalesce(rested, F.lit(True)))
    marked = marked.withColumn("ends", F.coalesce(F.lead("begins").over(in_time), ~near_end))
    return marked.filter(~F.col("guest")).withColumn("open", ~(F.col("begins") & F.col("ends"))).drop("guest", "ends")


def _jumps(opened: DataFrame, longest: int, length: int) -> DataFrame:
    """(user_id, ms, to): the event that passes next if the one at ``ms`` did, unless that begins anyway.

    An event j may follow the stamp i if ms_j - wait_j >= ms_i; the first of those is a running minimum over both kinds of
    moments in falling order. Events that do not begin are less than ``longest`` apart, so the next one lies within twice that
    and is found in the block of i, where the head of the following block is a guest.
    """
    event = F.struct("ms", "begins")

    def place(block: Column, key: Column, following: Column, is_stamp: bool) -> Column:
        return F.struct(block.alias("block"), key.alias("key"), following.alias("next"), F.lit(is_stamp).alias("is_stamp"))

    block, due = F.col("block"), F.col("ms") - F.col("wait")
    own = [place(block, F.col("ms"), F.when(F.lit(False), event), True), place(block, due, event, False)]
    in_head = F.col("ms") < block * F.lit(length) + F.lit(2 * longest)
    places = F.when(in_head, F.array(*own, place(block - 1, due, event, False))).otherwise(F.array(*own))
    falling = Window.partitionBy("user_id", "block").orderBy(F.desc("key")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    found = opened.select("user_id", "ms", F.explode(places).alias("at")).select("user_id", "ms", "at.*")
    found = found.withColumn("to", F.min("next").over(falling)).filter("is_stamp AND NOT to.begins")
    return found.select("user_id", "ms", F.col("to.ms").alias("to"))


def _placed(events: DataFrame) -> DataFrame:
    """Events (user_id, ts, wait_s) as rows of ``_COLUMNS``."""
    rows = _to_ms(events).withColumns({"wait": F.greatest(F.col("wait_s") * F.lit(1000).cast("bigint"), F.lit(1)), "stored": F.lit(False)})
    return rows.select(*_COLUMNS)


def _stamps(queue: DataFrame, users: DataFrame) -> DataFrame:
    """The stored stamps of some users as rows of ``_COLUMNS``."""
    stamps = queue.join(users, "user_id", "left_semi")
    stamps = _to_ms(stamps.select("user_id", F.col("updated_at").alias("ts")))
    return stamps.withColumns({"wait": F.lit(1).cast("bigint"), "stored": F.lit(True)}).select(*_COLUMNS)


def _longest(rows: DataFrame) -> int:
    return rows.agg(F.coalesce(F.max("wait"), F.lit(1))).first()[0]


def _passes(marked: DataFrame, longest: int, length: int, keep: Keep) -> DataFrame:
    """(user_id, ms) of the marked events that pass."""
    passed = marked.filter("begins AND NOT stored").select("user_id", "ms")
    opened = marked.filter("open")
    jumps = keep(_jumps(opened, longest, length))
    reached = opened.filter("begins").select("user_id", "ms")
    while not jumps.isEmpty():
        found = keep(reached.join(jumps, ["user_id", "ms"]).select("user_id", F.col("to").alias("ms")))
        passed, reached = passed.unionByName(found), reached.unionByName(found)
        further = jumps.select("user_id", F.col("ms").alias("to"), F.col("to").alias("then"))
        jumps = keep(jumps.join(further, ["user_id", "to"]).select("user_id", "ms", F.col("then").alias("to")))
    return passed


def debounce(events: DataFrame | Dirty, queue: DataFrame | None = None, keep: Keep = checkpointed) -> DataFrame:
    """The events (user_id, ts, wait_s) that pass, given the stamps in ``queue``.

    An event whose wait is over since the event before it passes whatever that one did. From there on
    each event that passes names the next one, so the rest is found by following these jumps, twice as far
    each time: as many joins as the longest chain has binary digits, on keys that occur once. A user with very many events is
    spread over tasks by time. Of the queue only the users at hand are read. ``keep`` holds what is made on the way; the result reads it.
    Events that users share may come as ``Dirty``.
    """
    if isinstance(events, Dirty):
        return _debounce_shared(events, queue, keep)
    rows = _placed(events)
    if queue is not None:
        rows = rows.unionByName(_stamps(queue, events.select("user_id").distinct()))
    rows = keep(rows)
    longest = _longest(rows)
    length = max(BLOCK_MS, 2 * longest)
    passed = _passes(keep(_with_begins(rows, longest, length)), longest, length, keep)
    return passed.select("user_id", _from_ms("ms").alias("ts"))


def _in_runs(marked: DataFrame) -> DataFrame:
    """(value, ms, wait, run): the events of values, each with the moment its run begins, which may lie blocks before."""
    block = ["user_id", "block"]
    began = F.when(F.col("begins"), F.col("ms"))
    in_block = Window.partitionBy(*block).orderBy("ms").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = Window.partitionBy("user_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = marked.groupBy(*block).agg(F.max(began).alias("last")).select(*block, F.max("last").over(earlier).alias("before"))
    rows = marked.withColumn("here", F.max(began).over(in_block)).join(blocks, block)
    return rows.select(F.col("user_id").alias("value"), "ms", "wait", F.coalesce("here", "before").alias("run"))


def _near_runs(own: DataFrame, members: DataFrame, listed: DataFrame, longest: int) -> DataFrame:
    """(user_id, value, run): the runs of a user's value that one of its own events is within the longest wait of."""
    length = max(MEET_MS, 2 * longest)
    first, last = F.col("run") - F.lit(longest), F.col("end") + F.lit(longest)
    runs = listed.groupBy("value", "run").agg(F.max("ms").alias("end"))
    runs = runs.withColumn("stretch", F.explode(F.sequence(_blocks(first, length), _blocks(last, length))))
    moments = own.filter("ms IS NOT NULL").select("user_id", "ms").distinct().join(members, "user_id")
    moments = moments.withColumn("stretch", _blocks(F.col("ms"), length))
    return moments.join(runs, ["value", "stretch"]).filter(F.col("ms").between(first, last)).select("user_id", "value", "run").distinct()


def _debounce_shared(events: Dirty, queue: DataFrame | None, keep: Keep) -> DataFrame:
    members = keep(events.members)
    shared = keep(_placed(events.shared.withColumnRenamed("value", "user_id"))).withColumnRenamed("user_id", "value")
    events = Dirty(keep(events.own), shared, members)
    own = _placed(events.own)
    if queue is not None:
        own = own.unionByName(_stamps(queue, events.users()))
    # users of several values, and events without a time, are as if they were their own
    values = keep(members.groupBy("user_id").agg(F.min("value").alias("value"), F.count(F.lit(1)).alias("held")))
    single = values.filter("held = 1").select("value", "user_id")
    several = members.join(values.filter("held > 1"), "user_id", "left_semi")
    for some, who in ((shared, several), (shared.filter("ms IS NULL"), single)):
        own = own.unionByName(some.join(who, "value").select(*_COLUMNS))
    own = keep(own)
    longest = max(_longest(own), _longest(shared))
    length = max(BLOCK_MS, 2 * longest)

    timed = shared.filter("ms IS NOT NULL").withColumnRenamed("value", "user_id")
    marked = keep(_with_begins(timed, longest, length))
    listed = keep(_in_runs(marked))
    passed = _passes(marked, longest, length, keep).withColumnRenamed("user_id", "value")
    passed = keep(passed.join(listed, ["value", "ms"]).select("value", "run", "ms", _from_ms("ms").alias("ts")))

    near = keep(_near_runs(own, single, listed, longest))
    at_hand = near.join(listed, ["value", "run"]).select("user_id", "ms", "wait", F.lit(False).alias("stored"))
    marked = keep(_with_begins(own.unionByName(at_hand), longest, length))
    by_user = _passes(marked, longest, length, keep).select("user_id", _from_ms("ms").alias("ts"))
    return by_user.unionByName(_beyond(passed, near, single, keep))


def _beyond(passed: DataFrame, near: DataFrame, members: DataFrame, keep: Keep) -> DataFrame:
    """(user_id, ts): what passes of the runs that no own event is near."""
    arrays = keep(in_arrays(passed, F.col("ts")))
    mixed = keep(near.select("user_id", "value").distinct())
    plain = dealt(arrays, members.join(mixed, "user_id", "left_anti")).select("user_id", F.explode("items").alias("ts"))
    gone = near.join(passed, ["value", "run"]).select("user_id", "value", array_of("ts"), "ts")
    # a user's arrays, each with the moments of it that are left out
    parts = mixed.join(arrays.select("value", "array"), "value").withColumn("ts", F.lit(None).cast("timestamp_ntz"))
    parts = parts.select("user_id", "value", "array", "ts").unionByName(gone)
    parts = parts.groupBy("user_id", "value", "array").agg(F.collect_list("ts").alias("gone"))
    rest = arrays.hint("merge").join(parts, ["value", "array"])
    return plain.unionByName(rest.select("user_id", F.explode(F.array_except("items", "gone")).alias("ts")))
