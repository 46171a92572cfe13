"""Declared row constraints with an action.

An expectation holds where its condition is TRUE; a NULL condition is a
violation.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Literal, NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class Expectation(NamedTuple):
    name: str
    condition: Column
    action: Literal["fail", "drop"]

    @property
    def holds(self) -> Column:
        return F.coalesce(self.condition, F.lit(False))


def demand(condition: Column, message: str) -> Column:
    """TRUE where the condition is TRUE; ends the query with the message elsewhere."""
    failed = F.raise_error(F.lit(message)).cast("boolean")
    return F.when(condition, F.lit(True)).otherwise(failed)


def apply_expectations(
    df: DataFrame,
    expectations: Sequence[Expectation],
    observe_as: str | Observation | None = None,
    where: Column | None = None,
) -> DataFrame:
    """Rows that meet every expectation; a violated "fail" ends the query.

    ``where`` chooses the rows that are judged and kept; a filter before this
    call would not do: the optimizer may move the checks below a join, where
    the rows that the filter removes are still there. So choice and checks are
    one CASE, which it moves as a whole or not at all.

    ``observe_as`` counts the violations while the rows pass by: give an
    ``Observation`` for a batch, a name for a stream.
    """
    checks = [Expectation(*e) for e in expectations]
    unknown = {e.action for e in checks} - {"fail", "drop"}
    if unknown:
        raise ValueError(f"unknown expectation actions: {sorted(unknown)}")
    if observe_as is not None:
        judged = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
        counts = [F.count_if(judged & ~e.holds).alias(e.name) for e in checks]
        df = df.observe(observe_as, F.count_if(judged).alias("n_rows"), *counts)
    # Fail checks come first, so that a row due to be dropped can still fail.
    branches = [(~F.coalesce(where, F.lit(False)), F.lit(False))] if where is not None else []
    for e in checks:
        if e.action == "fail":
            failed = F.raise_error(F.lit(f"expectation violated: {e.name}")).cast("boolean")
            branches.append((~e.holds, failed))
    kept = F.lit(True)
    for e in checks:
        if e.action == "drop":
            kept = kept & e.holds
    case = F
    for condition, outcome in branches:
        case = case.when(condition, outcome)
    return df.filter(case.otherwise(kept) if branches else kept)


def expectation_counts(df: DataFrame, expectations: Sequence[Expectation]) -> DataFrame:
    """Violations per expectation, all counted in one pass over the rows."""
    checks = [Expectation(*e) for e in expectations]
    counts = df.agg(*[F.count_if(~e.holds).alias(e.name) for e in checks])
    return counts.unpivot([], [e.name for e in checks], "expectation", "n_violations")
