"""Row conditions of the sync rules.

Conditions on tokens and changes are true or false, never NULL, so they may be negated. The others
are plain comparisons for filters, where NULL drops the row, so that scans can use them.
"""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from tokenloom.functions.codes import NOT_A_LOAN
from tokenloom.functions.text import has_text


def token_ready(required: list[str], optional: dict[str, str] | None = None) -> Column:
    """All required tokens are there; an optional one (token -> raw) only if its raw value is."""
    conditions = [has_text(token) for token in required]
    conditions += [~has_text(raw) | has_text(token) for token, raw in (optional or {}).items()]
    return reduce(and_, conditions)


def token_miss(pairs: dict[str, str]) -> Column:
    """Some token (token -> raw) is missing although there is a raw value."""
    return reduce(or_, [has_text(raw) & ~has_text(token) for token, raw in pairs.items()])


def _filled(c: str) -> Column:
    return F.trim(c) != ""


def live_bankcard() -> Column:
    return (F.col("deleted") == 0) & _filled("bank_account")


def default_bankcard() -> Column:
    return live_bankcard() & (F.col("is_default") == 1)


def has_order_no() -> Column:
    return _filled("order_no")


def loan_order() -> Column:
    return ~F.col("risk_order_status").isin(*NOT_A_LOAN)


def paid_callback() -> Column:
    return (F.col("status") == 2) & F.col("callback_time").isNotNull() & has_order_no()


def changed(*columns: str, before: str = "before", after: str = "after") -> Column:
    """Some watched column differs between the two row images, NULL being a value."""
    pairs = [(F.col(f"{before}.{c}"), F.col(f"{after}.{c}")) for c in columns]
    return reduce(or_, [~old.eqNullSafe(new) for old, new in pairs])
