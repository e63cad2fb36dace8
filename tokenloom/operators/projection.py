"""Column rewrites shared by the outputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.functions.text import ColumnLike, as_column
from tokenloom.settings import DEFAULT


def offset_id(c: ColumnLike, offset: int = DEFAULT.id_offset) -> Column:
    return as_column(c) + F.lit(offset)


def with_constants(df: DataFrame, constants: dict[str, object]) -> DataFrame:
    """Adds fixed columns; a (value, type) pair sets the type."""
    columns = {}
    for name, value in constants.items():
        value, kind = value if isinstance(value, tuple) else (value, None)
        columns[name] = F.lit(value) if kind is None else F.lit(value).cast(kind)
    return df.withColumns(columns)
