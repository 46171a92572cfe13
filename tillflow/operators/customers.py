"""Customer profiles: type, flag, dead letters, cleaned rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tillflow.functions import domains as d
from tillflow.functions.clock import AsOf, instant
from tillflow.functions.customer_rules import customer_rules
from tillflow.functions.reasons import FIRED, codes_of, failing, fired
from tillflow.operators.expectations import Expectation, apply_expectations
from tillflow.sources.schemas import CUSTOMER_CLEANED, CUSTOMER_FIELDS, CUSTOMER_TYPES, RESCUED

REASONS = "dq_failure_reasons"


def _typed(name: str) -> Column:
    if name in CUSTOMER_TYPES:
        return F.col(name).try_cast(CUSTOMER_TYPES[name]).alias(name)
    return F.col(name)


def cast_customers(df: DataFrame, as_of: AsOf = None, also: Sequence[str] = ()) -> DataFrame:
    """The profile columns in their types; unreadable text becomes null."""
    return df.select(
        *map(_typed, CUSTOMER_FIELDS), instant(as_of).alias("ingestion_time"), RESCUED, *also
    )


def flag_customers(raw: DataFrame, as_of: AsOf = None, also: Sequence[str] = ()) -> DataFrame:
    """Typed columns and all reasons against the row; nothing is dropped.

    The rules read the raw text, and the row is stamped anew with ``as_of``.
    The reasons are there as a number as well, which tables don't keep.
    """
    rules = customer_rules()
    judged = raw.select(
        *map(_typed, CUSTOMER_FIELDS),
        instant(as_of).alias("ingestion_time"),
        RESCUED,
        fired(rules).alias(FIRED),
        *also,
    )
    known = [c for c in judged.columns if c not in (FIRED, *also)]
    return judged.select(*known, codes_of(FIRED, rules).alias(REASONS), *also, FIRED)


def customer_dead_letters(flagged: DataFrame) -> DataFrame:
    bad = flagged.filter(failing(flagged, REASONS)).drop(FIRED)
    return bad.withColumn("is_corrupted", F.lit(True))


def customers_cleaned(flagged: DataFrame) -> DataFrame:
    """Rows without reasons, in the columns of the cleaned table."""
    kept = flagged.filter(~failing(flagged, REASONS))
    return kept.select(*CUSTOMER_CLEANED.fieldNames())


def _filled(name: str) -> Column:
    return F.col(name).isNotNull() & (F.trim(name) != "")


def customer_expectations(as_of: AsOf = None) -> list[Expectation]:
    """What a cleaned profile has to meet; reads the list of reasons as well."""
    today = F.to_date(instant(as_of))
    earliest = F.lit(d.EARLIEST_BIRTH_DATE).cast("date")
    birth = F.col("birth_date")
    return [
        Expectation("valid_id", F.col("customer_id").isNotNull(), "fail"),
        Expectation("completed_profile", _filled("first_name") & _filled("last_name"), "drop"),
        Expectation("realistic_age", birth.isNull() | birth.between(earliest, today), "drop"),
        Expectation("no_upstream_failures", F.size(REASONS) == 0, "fail"),
    ]


def guarded_customers(
    flagged: DataFrame,
    as_of: AsOf = None,
    observe_as: str | Observation | None = None,
    also: Sequence[str] = (),
) -> DataFrame:
    """The cleaned table: rows without reasons that meet all expectations."""
    candidates = ~failing(flagged, REASONS)
    kept = apply_expectations(flagged, customer_expectations(as_of), observe_as, where=candidates)
    return kept.select(*CUSTOMER_CLEANED.fieldNames(), *also)
