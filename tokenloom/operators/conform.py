"""Target rows as the target tables want them, and a report of what they would refuse."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.functions.text import as_column
from tokenloom.sources.schemas import TARGETS, Field


def _value(field: Field, columns: list[str]) -> Column:
    value = F.col(field.name).cast(field.type) if field.name in columns else F.lit(None).cast(field.type)
    if field.required and field.default is not None:
        value = F.coalesce(value, F.lit(field.default).cast(field.type))
    return value.alias(field.name)


def conform(df: DataFrame, target: str) -> DataFrame:
    """Columns, order, types and NOT NULL defaults of a target table."""
    return df.select(*[_value(field, df.columns) for field in TARGETS[target]])


def with_due_dates(applications: DataFrame, last_repayment_time: str) -> DataFrame:
    """The due dates the application table requires, from the last repayment time."""
    day = as_column(last_repayment_time).cast("date")
    return applications.withColumns({"due_date": day, "due_date_final": day})


def _broken(field: Field) -> dict[str, Column]:
    value = F.col(field.name)
    rules = {}
    if field.required:
        rules["not_null"] = value.isNull()
    if field.chars is not None:
        rules[f"max_chars_{field.chars}"] = F.char_length(value) > field.chars
    if field.unsigned:
        rules["unsigned"] = value < 0
    if field.allowed:
        rules["allowed"] = ~value.isin(*field.allowed)
    return rules


def _rules(target: str) -> list[tuple[str, Column]]:
    """Every rule of a target table by name, in the order of its columns."""
    return [(f"{f.name}.{rule}", broken) for f in TARGETS[target] for rule, broken in _broken(f).items()]


def with_rule_bits(df: DataFrame, target: str) -> DataFrame:
    """Conformed rows with ``rule_bits``: for each rule in order '1' if the row breaks it, else '0'. All rules in one pass."""
    bits = [F.when(broken, "1").otherwise("0") for _, broken in _rules(target)]
    return conform(df, target).withColumn("rule_bits", F.concat(*bits))


def split_conformed(df: DataFrame, target: str) -> tuple[DataFrame, DataFrame]:
    """Rows that the target takes, and those it would refuse with the names of the rules they break (``broken_rules``).

    Both are filters over the same bits. Write the rows once with ``with_rule_bits`` and split what was written where making them is dear.
    """
    return split_bits(with_rule_bits(df, target), target)


def split_bits(marked: DataFrame, target: str) -> tuple[DataFrame, DataFrame]:
    names = [name for name, _ in _rules(target)]
    numbered = F.array(*[F.when(F.substr("rule_bits", F.lit(at + 1), F.lit(1)) == "1", F.lit(name)) for at, name in enumerate(names)])
    kept = marked.filter(~F.contains("rule_bits", F.lit("1"))).drop("rule_bits")
    refused = marked.filter(F.contains("rule_bits", F.lit("1"))).withColumn("broken_rules", F.array_compact(numbered)).drop("rule_bits")
    return kept, refused


def violations(df: DataFrame, target: str) -> DataFrame:
    """How many rows break which rule of which column, from one pass over conformed rows."""
    rules = [(f.name, rule, broken) for f in TARGETS[target] for rule, broken in _broken(f).items()]
    counts = df.agg(*[F.count(F.when(broken, 1)).alias(f"r{i}") for i, (_, _, broken) in enumerate(rules)])
    lines = F.array(
        *[
            F.struct(F.lit(column).alias("column"), F.lit(rule).alias("rule"), F.col(f"r{i}").alias("cnt"))
            for i, (column, rule, _) in enumerate(rules)
        ]
    )
    return counts.select(F.inline(lines)).filter("cnt > 0").select(F.lit(target).alias("target"), "column", "rule", "cnt")
