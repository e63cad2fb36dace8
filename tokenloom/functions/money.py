"""Amounts and numbers that arrive as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tokenloom.functions.text import ColumnLike, as_column, blank_to_null

AMOUNT = "decimal(20,2)"


def _amount(c: ColumnLike) -> Column:
    return blank_to_null(c).try_cast(AMOUNT)


def _whole(amount: Column, scale: int) -> Column:
    if scale != 1:
        amount = amount * F.lit(scale)
    return F.coalesce(F.round(amount, 0), F.lit(0)).cast("bigint")


def money_minor(c: ColumnLike, scale: int = 1) -> Column:
    """Whole units, halves away from zero; text that is no number counts as 0."""
    return _whole(_amount(c), scale)


def money_sum_minor(a: ColumnLike, b: ColumnLike, scale: int = 1) -> Column:
    """Adds first, rounds after; one missing addend makes the sum 0."""
    return _whole(_amount(a) + _amount(b), scale)


def money_value(c: ColumnLike) -> Column:
    return F.coalesce(_amount(c), F.lit(0).cast(AMOUNT))


def _digits(text: Column) -> Column:
    return F.when(text.rlike("^[0-9]{1,19}$"), text.try_cast("decimal(20,0)"))


def parse_salary(c: ColumnLike) -> Column:
    return _digits(F.replace(F.trim(as_column(c)), F.lit(","), F.lit("")))


def parse_credit_limit(c: ColumnLike) -> Column:
    return _digits(as_column(c).cast("string"))
