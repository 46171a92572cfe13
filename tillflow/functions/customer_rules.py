"""Rules for customer profiles; all read the raw text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillflow.functions import domains as d
from tillflow.functions.reasons import Rule


def _missing(field: str) -> Rule:
    return Rule(f"miss_{field}", F.col(field).isNull())


def _invalid(field: str, well_formed: Column) -> Rule:
    return Rule(f"invalid_{field}", F.col(field).isNotNull() & ~well_formed)


def _malformed(field: str, type_name: str) -> Rule:
    raw = F.col(field)
    return Rule(f"{field}_malformed", raw.isNotNull() & raw.try_cast(type_name).isNull())


def customer_rules() -> list[Rule]:
    def matches(field: str, pattern: str) -> Rule:
        return _invalid(field, F.col(field).rlike(pattern))

    def one_of(field: str, domain: tuple[str, ...]) -> Rule:
        return _invalid(field, F.col(field).isin(*domain))

    return [
        _missing("customer_id"),
        _missing("first_name"),
        _missing("last_name"),
        _missing("email"),
        matches("email", d.EMAIL_PATTERN),
        _missing("phone"),
        matches("phone", d.PHONE_PATTERN),
        _missing("address"),
        matches("address", d.ADDRESS_PATTERN),
        _missing("city"),
        _missing("state"),
        _missing("country"),
        _missing("birth_date"),
        _malformed("birth_date", "date"),
        _missing("gender"),
        one_of("gender", d.GENDERS),
        _missing("registration_date"),
        _malformed("registration_date", "timestamp"),
        _missing("loyalty_tier"),
        one_of("loyalty_tier", d.LOYALTY_TIERS),
        _missing("is_active"),
        _malformed("is_active", "boolean"),
        _missing("updated_at"),
        _malformed("updated_at", "timestamp"),
        _missing("zip_code"),
        matches("zip_code", d.ZIP_CODE_PATTERN),
    ]
