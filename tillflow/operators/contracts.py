"""Declared table contracts: column types, NOT NULL, append-only, quality tag."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tillflow.sources import schemas as s


class Contract(NamedTuple):
    name: str
    schema: StructType
    append_only: bool
    quality: str


POS_TRANSACTIONS = Contract("pos_transactions", s.POS_BRONZE, True, "bronze")
POS_QUARANTINED = Contract("pos_transactions_quarantined", s.POS_QUARANTINE, True, "bronze")
POS_CLEANED = Contract("pos_transactions_cleaned", s.POS_CLEAN, False, "silver")
POS_LATE_ARRIVALS = Contract("pos_transactions_late_arrivals", s.POS_LATE, True, "silver")
CUSTOMERS_RAW = Contract("customers_raw", s.CUSTOMER_RAW, True, "bronze")
CUSTOMERS_FLAGGED = Contract("customers_flagged", s.CUSTOMER_FLAGGED, True, "bronze")
CUSTOMERS_CLEANED = Contract("customers_cleaned", s.CUSTOMER_CLEANED, True, "silver")


def enforce_contract(df: DataFrame, contract: Contract) -> DataFrame:
    """The declared columns in their order and types; a forbidden NULL ends the query.

    A column that is missing or of another type is refused at once: values are
    never cast silently on the way into a table. The checks are part of the
    projection, so no row fails that an earlier filter removed; call this
    directly before a sink, since a count alone would not compute the columns.
    """
    given = {f.name: f.dataType for f in df.schema}
    for field in contract.schema:
        if field.name not in given:
            raise ValueError(f"{contract.name}: column {field.name} is missing")
        if given[field.name] != field.dataType:
            raise ValueError(
                f"{contract.name}: column {field.name} is {given[field.name].simpleString()},"
                f" not {field.dataType.simpleString()}"
            )
    return df.select(*[_present(field, contract.name) for field in contract.schema])


def _present(field: StructField, table: str) -> Column:
    if field.nullable:
        return F.col(field.name)
    message = F.lit(f"{table}: NULL in a NOT NULL column, {field.name}")
    failed = F.raise_error(message).cast(field.dataType)
    return F.coalesce(F.col(field.name), failed).alias(field.name)


def check_mode(contract: Contract, mode: str) -> None:
    if contract.append_only and mode != "append":
        raise ValueError(f"{contract.name} is append-only, mode {mode!r} is refused")


def table_properties(contract: Contract) -> dict[str, str]:
    """What a table's definition records of its contract."""
    return {"quality": contract.quality, "append_only": str(contract.append_only).lower()}
