"""Wall-clock times of the business zone. Nothing here reads the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tokenloom.functions.text import ColumnLike, as_column

DAY_MS = 86_400_000


def epoch_ms(ts: ColumnLike, zone: str) -> Column:
    """Milliseconds since 1970 UTC of a zone-less time that was read off a clock in ``zone``.

    The time since 1970 is an interval; a thousand times it, in seconds, is the answer.
    """
    utc = F.convert_timezone(F.lit(zone), F.lit("UTC"), as_column(ts).cast("timestamp_ntz"))
    since = utc - F.lit("1970-01-01").cast("timestamp_ntz")
    return (since * 1000).cast("interval second").cast("bigint")


def positive_ms(ms: Column) -> Column:
    return F.when(ms > 0, ms)


def lock_expire_ms(ts: ColumnLike, zone: str, days: int = 7) -> Column:
    return epoch_ms(ts, zone) + days * DAY_MS


def start_date(*times: ColumnLike) -> Column:
    return F.coalesce(*[as_column(t).cast("date") for t in times])


def created_ms_from_date(day: ColumnLike, zone: str) -> Column:
    """Midnight of the day in ``zone``; never negative, and 0 for a missing day."""
    midnight = epoch_ms(as_column(day).cast("timestamp_ntz"), zone)
    return F.greatest(F.coalesce(midnight, F.lit(0)), F.lit(0)).cast("bigint")


def date_text(ts: ColumnLike) -> Column:
    return as_column(ts).cast("date").cast("string")
