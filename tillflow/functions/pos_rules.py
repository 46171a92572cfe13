"""Rules for point-of-sale line items.

Conditions on typed values read the ``<field>_casted`` columns that
``operators.pos.cast_pos`` puts beside the raw text.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import functions as F

from tillflow.functions import domains as d
from tillflow.functions.clock import AsOf, instant
from tillflow.functions.reasons import Rule
from tillflow.sources.schemas import POS_FIELDS, POS_OPTIONAL, POS_TYPES

REQUIRED_FIELDS = tuple(name for name in POS_FIELDS if name not in POS_OPTIONAL)
SHORT_FORMAT_FIELDS = ("item_unit_price", "item_quantity", "event_time")


def missing_rules(fields: Iterable[str] = REQUIRED_FIELDS) -> list[Rule]:
    return [Rule(f"MISSING_{name.upper()}", F.col(name).isNull()) for name in fields]


def strict_missing_rules() -> list[Rule]:
    """As ``missing_rules``, but guests are not accepted either."""
    return missing_rules(POS_FIELDS)


def format_rules(fields: Iterable[str] = tuple(POS_TYPES)) -> list[Rule]:
    return [
        Rule(
            f"INVALID_FORMAT_{name.upper()}",
            F.col(name).isNotNull() & F.col(f"{name}_casted").isNull(),
        )
        for name in fields
    ]


def _garbled(field: str, well_formed) -> Rule:
    raw = F.col(field)
    return Rule(
        f"GARBLED_{field.upper()}",
        raw.contains(d.REPLACEMENT_CHARACTER) | ~well_formed(raw),
    )


def _unknown(field: str, domain: tuple[str, ...]) -> Rule:
    return Rule(f"INVALID_ENUM_{field.upper()}", ~F.col(field).isin(*domain))


def business_rules(as_of: AsOf = None) -> list[Rule]:
    sequence, quantity, price = (
        F.col(f"{name}_casted") for name in ("item_sequence", "item_quantity", "item_unit_price")
    )
    event_time = F.col("event_time_casted")
    highest_price = F.lit(d.MAX_ITEM_UNIT_PRICE).cast("decimal(10,2)")
    return [
        Rule("INVALID_RANGE_ITEM_SEQUENCE", sequence <= 0),
        Rule(
            "INVALID_RANGE_ITEM_QUANTITY",
            (quantity <= 0) | (quantity > d.MAX_ITEM_QUANTITY),
        ),
        Rule("INVALID_RANGE_ITEM_UNIT_PRICE", (price <= 0) | (price > highest_price)),
        Rule("INVALID_RANGE_TAX_AMOUNT", F.col("tax_amount_casted") < 0),
        Rule("INVALID_RANGE_DISCOUNT_AMOUNT", F.col("discount_amount_casted") < 0),
        Rule("INVALID_FUTURE_EVENT_TIME", event_time > instant(as_of)),
        # The epoch itself, whatever the zone of the session.
        Rule("EPOCH_RESET_TERMINAL_REBOOT", event_time == F.timestamp_seconds(F.lit(0))),
        _garbled("customer_id", lambda c: c.rlike(d.CUSTOMER_ID_PATTERN)),
        _garbled("sku", lambda c: c.rlike(d.SKU_PATTERN)),
        _garbled("store_id", lambda c: c.isin(*d.STORE_IDS)),
        _garbled("terminal_id", lambda c: c.rlike(d.TERMINAL_ID_PATTERN)),
        _unknown("payment_type", d.PAYMENT_TYPES),
        _unknown("channel", d.CHANNELS),
        _unknown("country", d.COUNTRIES),
    ]


def pos_rules(as_of: AsOf = None) -> list[Rule]:
    """All rules of the flow in reporting order: missing, format, business."""
    return missing_rules() + format_rules() + business_rules(as_of)
