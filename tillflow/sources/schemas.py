"""Schemas of the layers."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(10, 2)

# The keys of the point-of-sale records.
POS_FIELDS = (
    "transaction_id",
    "item_sequence",
    "customer_id",
    "event_time",
    "sku",
    "item_unit_price",
    "item_quantity",
    "discount_amount",
    "tax_amount",
    "payment_type",
    "currency",
    "country",
    "channel",
    "store_id",
    "terminal_id",
)

# The one point-of-sale field that may be absent: guests have no customer id.
POS_OPTIONAL = ("customer_id",)

# Typed fields, in the order in which their format rules report.
# Fixed values as well: the types of the tables.
POS_TYPES = {
    "item_unit_price": MONEY,
    "item_quantity": MONEY,
    "event_time": T.TimestampType(),
    "item_sequence": T.IntegerType(),
    "discount_amount": MONEY,
    "tax_amount": MONEY,
}

POS_PAYLOAD = T.StructType([T.StructField(name, T.StringType()) for name in POS_FIELDS])

POS_BRONZE = T.StructType([*POS_PAYLOAD.fields, T.StructField("ingested_time", T.TimestampType())])

POS_QUARANTINE = T.StructType(
    [
        *POS_BRONZE.fields,
        T.StructField("error_reason", T.ArrayType(T.StringType())),
        T.StructField("is_corrupted", T.BooleanType()),
    ]
)

POS_CLEAN = T.StructType(
    [
        T.StructField(name, POS_TYPES.get(name, T.StringType()), name in POS_OPTIONAL)
        for name in POS_FIELDS
    ]
    + [T.StructField("ingested_time", T.TimestampType(), False)]
)

POS_LATE = T.StructType(
    [
        *POS_CLEAN.fields,
        T.StructField("is_late", T.BooleanType(), False),
        T.StructField("ingestion_delay_seconds", T.LongType(), False),
    ]
)

# The columns of the customer files.
CUSTOMER_FIELDS = (
    "customer_id",
    "first_name",
    "last_name",
    "email",
    "phone",
    "address",
    "city",
    "state",
    "country",
    "birth_date",
    "gender",
    "registration_date",
    "loyalty_tier",
    "is_active",
    "updated_at",
    "zip_code",
)

CUSTOMER_TYPES = {
    "birth_date": T.DateType(),
    "registration_date": T.TimestampType(),
    "is_active": T.BooleanType(),
    "updated_at": T.TimestampType(),
}

RESCUED = "_rescued_data"

CUSTOMER_FILE = T.StructType([T.StructField(name, T.StringType()) for name in CUSTOMER_FIELDS])

CUSTOMER_RAW = T.StructType(
    [
        *CUSTOMER_FILE.fields,
        T.StructField("ingestion_time", T.TimestampType()),
        T.StructField(RESCUED, T.StringType()),
    ]
)

CUSTOMER_CLEANED = T.StructType(
    [
        T.StructField(name, CUSTOMER_TYPES.get(name, T.StringType()))
        for name in CUSTOMER_FIELDS
    ]
    + [
        T.StructField("ingestion_time", T.TimestampType()),
        T.StructField(RESCUED, T.StringType()),
    ]
)

CUSTOMER_FLAGGED = T.StructType(
    [
        *CUSTOMER_CLEANED.fields,
        T.StructField("dq_failure_reasons", T.ArrayType(T.StringType())),
    ]
)
