"""Point-of-sale line items: decode, type, flag, split.

Every function is DataFrame in, DataFrame out, narrow (no shuffle), and works
on batch and streaming input alike.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.functions import domains as d
from tillflow.functions.clock import AsOf, instant
from tillflow.functions.pos_rules import pos_rules
from tillflow.functions.reasons import failing, with_reasons
from tillflow.sources.schemas import (
    POS_CLEAN,
    POS_FIELDS,
    POS_LATE,
    POS_PAYLOAD,
    POS_QUARANTINE,
    POS_TYPES,
)

REASONS = "error_reason"
ROUTES = ("quarantine", "late", "clean")


def decode_pos(payloads: DataFrame, as_of: AsOf = None, keep_raw: bool = False) -> DataFrame:
    """JSON payloads in ``value`` (bytes or text) to the bronze columns.

    Payloads that are no JSON object give a row of nulls. Their text is in no
    field then; ``keep_raw`` adds it as the column ``payload``.
    """
    text = F.col("value").cast("string")
    raw = [text.alias("payload")] if keep_raw else []
    return payloads.select(
        F.from_json(text, POS_PAYLOAD).alias("record"),
        instant(as_of).alias("ingested_time"),
        *raw,
    ).select("record.*", "ingested_time", *(["payload"] if keep_raw else []))


def cast_pos(df: DataFrame) -> DataFrame:
    """Typed twins ``<field>_casted`` beside the raw text; unreadable text gives null."""
    return df.select(
        "*",
        *[F.col(name).try_cast(kind).alias(f"{name}_casted") for name, kind in POS_TYPES.items()],
    )


def with_delay(df: DataFrame, against: AsOf = None) -> DataFrame:
    """``ingestion_delay_seconds``: whole seconds from event to arrival, null if unreadable.

    ``against`` replaces the arrival time as the end of the delay.
    """
    arrival = F.col("ingested_time") if against is None else instant(against)
    event = F.col("event_time").try_cast("timestamp")
    return df.withColumn(
        "ingestion_delay_seconds", F.unix_timestamp(arrival) - F.unix_timestamp(event)
    )


def with_lateness(
    df: DataFrame, threshold: int = d.LATE_AFTER_SECONDS, against: AsOf = None
) -> DataFrame:
    """Adds the delay and ``is_late``: strictly over the threshold; false if unknown."""
    late = F.col("ingestion_delay_seconds") > threshold
    return with_delay(df, against).withColumn("is_late", F.coalesce(late, F.lit(False)))


def flag_pos(df: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Typed twins and all reasons against the row, as a number and a list; nothing is dropped."""
    return with_reasons(cast_pos(df), REASONS, pos_rules(as_of))


def quarantine(flagged: DataFrame) -> DataFrame:
    """Rows with at least one reason: raw text, reasons, flag."""
    bad = flagged.filter(failing(flagged, REASONS)).withColumn("is_corrupted", F.lit(True))
    return bad.select(*POS_QUARANTINE.fieldNames())


def _typed(checked: DataFrame, also: Sequence[str]) -> DataFrame:
    """Typed twins under their plain names."""
    fields = [
        F.col(f"{name}_casted").alias(name) if name in POS_TYPES else F.col(name)
        for name in POS_FIELDS
    ]
    return checked.select(*fields, "ingested_time", "is_late", "ingestion_delay_seconds", *also)


def valid(flagged: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    """Rows without reasons (an absent list counts as empty), typed; ``also`` keeps more columns."""
    return _typed(flagged.filter(~failing(flagged, REASONS)), also)


def late(checked: DataFrame) -> DataFrame:
    return checked.filter("is_late").select(*POS_LATE.fieldNames())


def on_time(checked: DataFrame) -> DataFrame:
    return checked.filter(~F.col("is_late")).select(*POS_CLEAN.fieldNames())


def with_route(flagged: DataFrame) -> DataFrame:
    """``route``: which of the three tables the row belongs to."""
    route = (
        F.when(failing(flagged, REASONS), F.lit("quarantine"))
        .when(F.col("is_late"), F.lit("late"))
        .otherwise(F.lit("clean"))
    )
    return flagged.withColumn("route", route)


def route_counts(flagged: DataFrame) -> DataFrame:
    """Rows per route in one pass; each task sends at most three partial counts."""
    return with_route(flagged).groupBy("route").agg(F.count("*").alias("n_rows"))


def to_keyed_json(df: DataFrame, key: str = "transaction_id") -> DataFrame:
    """``key`` and the record as JSON in ``value``; null fields stay in the JSON."""
    record = F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
    return df.select(F.col(key).alias("key"), record.alias("value"))
