"""Validation rules as data: a code and the condition that raises it.

A rule fires only where its condition is TRUE; NULL counts as "did not fire".

Which rules fire on a row is one number, a bit per rule: that is what filters
and counts read. The list of codes is made of it, for the rows that are shown.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIRED = "failed_rules"
MOST_RULES = 63


class Rule(NamedTuple):
    code: str
    fires: Column


def fired(rules: Sequence[Rule]) -> Column:
    """A long with bit i set where rule i fires.

    Some thirty rules in one generated method are more than the JVM compiles;
    ``session.prepare`` has Spark leave whole-stage code there, and compile
    the rules in small methods.
    """
    rules = list(rules)
    if len(rules) > MOST_RULES:
        raise ValueError(f"at most {MOST_RULES} rules fit one number, not {len(rules)}")
    mask = F.lit(0).cast("long")
    for i, rule in enumerate(rules):
        bit = F.when(rule.fires, F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long"))
        mask = mask.bitwiseOR(bit)
    return mask


def codes_of(mask: str, rules: Sequence[Rule]) -> Column:
    """The codes of the set bits of the column ``mask``, in the order of the rules.

    Give a column that is computed before: it is named twice, so the optimizer
    leaves it where it is, and most rows have no bit to decode.
    """
    codes = F.array(*[F.lit(rule.code) for rule in rules]).cast("array<string>")
    none = F.array().cast("array<string>")
    decoded = F.filter(codes, lambda _, i: F.getbit(F.col(mask), i) == 1)
    return F.when(F.col(mask) == 0, none).otherwise(decoded)


def with_reasons(df: DataFrame, column: str, rules: Sequence[Rule]) -> DataFrame:
    """``df`` with the number of the rules that fire and ``column``, the list of their codes."""
    rules = list(rules)
    return df.withColumn(FIRED, fired(rules)).withColumn(column, codes_of(FIRED, rules))


def failing(df: DataFrame, column: str) -> Column:
    """TRUE for rows with a reason; an absent list counts as empty."""
    if FIRED in df.columns:
        return F.coalesce(F.col(FIRED) != 0, F.lit(False))
    return F.coalesce(F.size(column) > 0, F.lit(False))


def reasons(rules: Iterable[Rule]) -> Column:
    """The codes of all rules that fire as one expression, for any number of rules."""
    slots = [F.when(rule.fires, F.lit(rule.code)) for rule in rules]
    if not slots:
        return F.array().cast("array<string>")
    return F.filter(F.array(*slots), lambda code: code.isNotNull())


def add_reasons(df: DataFrame, column: str, rules: Iterable[Rule]) -> DataFrame:
    """Append the codes of more rules to a list that may be null."""
    present = F.coalesce(F.col(column), F.array().cast("array<string>"))
    return df.withColumn(column, F.concat(present, reasons(rules)))
