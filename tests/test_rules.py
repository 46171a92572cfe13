"""A hitting, a passing and a boundary row for every rule."""

from __future__ import annotations

import pytest

from pyspark.sql import functions as F

from tillflow.functions import domains as d
from tillflow.functions.pos_rules import REQUIRED_FIELDS
from tillflow.functions.reasons import FIRED, Rule, failing, reasons, with_reasons
from tillflow.operators import customers, pos
from tillflow.sources.schemas import CUSTOMER_FILE, POS_PAYLOAD

AS_OF = "2026-01-01 00:00:00"
GOOD = {
    "transaction_id": "TXN-1",
    "item_sequence": "1",
    "customer_id": "CUST-12345",
    "event_time": "2025-07-01T10:00:00.000Z",
    "sku": "4006381333931",
    "item_unit_price": "19.99",
    "item_quantity": "2",
    "discount_amount": "0",
    "tax_amount": "0",
    "payment_type": "CASH",
    "currency": "EUR",
    "country": "DE",
    "channel": "ONLINE",
    "store_id": "STORE-001",
    "terminal_id": "TERM-07",
}
BROKEN = d.REPLACEMENT_CHARACTER

POS_CASES = [
    ({}, []),
    ({"customer_id": None}, []),
    *[({name: None}, [f"MISSING_{name.upper()}"]) for name in REQUIRED_FIELDS],
    ({"item_unit_price": "x"}, ["INVALID_FORMAT_ITEM_UNIT_PRICE"]),
    ({"item_unit_price": "4.999"}, []),
    ({"item_unit_price": "123456789012"}, ["INVALID_FORMAT_ITEM_UNIT_PRICE"]),
    ({"item_quantity": ""}, ["INVALID_FORMAT_ITEM_QUANTITY"]),
    ({"item_quantity": " 1e1 "}, []),
    ({"event_time": "yesterday"}, ["INVALID_FORMAT_EVENT_TIME"]),
    ({"item_sequence": "3.5"}, ["INVALID_FORMAT_ITEM_SEQUENCE"]),
    ({"discount_amount": "n/a"}, ["INVALID_FORMAT_DISCOUNT_AMOUNT"]),
    ({"tax_amount": "1,4"}, ["INVALID_FORMAT_TAX_AMOUNT"]),
    ({"item_sequence": "0"}, ["INVALID_RANGE_ITEM_SEQUENCE"]),
    ({"item_quantity": "0"}, ["INVALID_RANGE_ITEM_QUANTITY"]),
    ({"item_quantity": "200"}, []),
    ({"item_quantity": "200.01"}, ["INVALID_RANGE_ITEM_QUANTITY"]),
    ({"item_unit_price": "0"}, ["INVALID_RANGE_ITEM_UNIT_PRICE"]),
    ({"item_unit_price": "200.00"}, []),
    ({"item_unit_price": "200.01"}, ["INVALID_RANGE_ITEM_UNIT_PRICE"]),
    ({"tax_amount": "-0.01"}, ["INVALID_RANGE_TAX_AMOUNT"]),
    ({"discount_amount": "-0.01"}, ["INVALID_RANGE_DISCOUNT_AMOUNT"]),
    ({"event_time": "2026-01-01T00:00:00Z"}, []),
    ({"event_time": "2026-01-01T00:00:01Z"}, ["INVALID_FUTURE_EVENT_TIME"]),
    ({"event_time": "1970-01-01T00:00:00.000Z"}, ["EPOCH_RESET_TERMINAL_REBOOT"]),
    ({"event_time": "1970-01-01T00:00:01.000Z"}, []),
    ({"customer_id": "CUST-1234"}, ["GARBLED_CUSTOMER_ID"]),
    ({"customer_id": "CUST-123456"}, ["GARBLED_CUSTOMER_ID"]),
    ({"customer_id": f"CUST-1234{BROKEN}"}, ["GARBLED_CUSTOMER_ID"]),
    ({"sku": "400638133393"}, ["GARBLED_SKU"]),
    ({"store_id": "STORE-020"}, []),
    ({"store_id": "STORE-021"}, ["GARBLED_STORE_ID"]),
    ({"terminal_id": "TERM-100"}, ["GARBLED_TERMINAL_ID"]),
    ({"terminal_id": "TERM-12\n"}, []),  # a final newline counts as the end of the text
    ({"payment_type": ""}, ["INVALID_ENUM_PAYMENT_TYPE"]),
    ({"channel": "online"}, ["INVALID_ENUM_CHANNEL"]),
    ({"country": "ES"}, ["INVALID_ENUM_COUNTRY"]),
    ({"currency": "anything"}, []),
    (
        {"sku": None, "tax_amount": "x", "item_quantity": "-1", "country": "??"},
        ["MISSING_SKU", "INVALID_FORMAT_TAX_AMOUNT", "INVALID_RANGE_ITEM_QUANTITY",
         "INVALID_ENUM_COUNTRY"],
    ),
]


def test_pos_rules(spark):
    rows = [{**GOOD, **change} for change, _ in POS_CASES]
    df = spark.createDataFrame(rows, POS_PAYLOAD).coalesce(1)
    found = [r[0] for r in pos.flag_pos(df, AS_OF).select("error_reason").collect()]
    assert found == [codes for _, codes in POS_CASES]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_moments_do_not_depend_on_the_zone(spark, zone):
    from tillflow.functions.clock import instant

    texts = {
        "2026-01-01 00:00:00": 1767225600,
        "2026-01-01": 1767225600,
        "2026-01-01T00:00:00Z": 1767225600,
        "2026-01-01 00:00:00+02:00": 1767218400,
        "2026-01-01 00:00:00 Asia/Kolkata": 1767205800,
    }
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        row = spark.range(1).select(*[instant(t).cast("long").alias(t) for t in texts]).first()
        epoch = spark.createDataFrame([{**GOOD, "event_time": "1970-01-01T00:00:00.000Z"}], POS_PAYLOAD)
        codes = pos.flag_pos(epoch, AS_OF).first()["error_reason"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert list(row) == list(texts.values())
    assert codes == ["EPOCH_RESET_TERMINAL_REBOOT"]


PROFILE = {
    "customer_id": "CUST-00001",
    "first_name": "Ada",
    "last_name": "Byron",
    "email": "ada@example.com",
    "phone": "+1-555-123-4567",
    "address": "1 Main St",
    "city": "Town",
    "state": "S",
    "country": "US",
    "birth_date": "1990-01-31",
    "gender": "F",
    "registration_date": "2024-01-01 10:00:00",
    "loyalty_tier": "Gold",
    "is_active": "true",
    "updated_at": "2024-01-02",
    "zip_code": "12345",
}
CUSTOMER_CASES = [
    ({}, []),
    *[({name: None}, [f"miss_{name}"]) for name in PROFILE],
    ({"email": "ada@example"}, ["invalid_email"]),
    ({"email": ""}, ["invalid_email"]),
    ({"phone": "5551234567"}, ["invalid_phone"]),
    ({"phone": "(555)123-4567"}, ["invalid_phone"]),
    ({"phone": "15551234567"}, []),
    ({"phone": "001-555-123-4567x89"}, []),
    ({"phone": "+1 (555) 123-4567 ext. 12"}, []),
    ({"address": "Main St"}, ["invalid_address"]),
    ({"address": "7"}, []),
    ({"birth_date": "13/45/1990"}, ["birth_date_malformed"]),
    ({"gender": "f"}, ["invalid_gender"]),
    ({"registration_date": "bad"}, ["registration_date_malformed"]),
    ({"loyalty_tier": "Tin"}, ["invalid_loyalty_tier"]),
    ({"is_active": "maybe"}, ["is_active_malformed"]),
    ({"is_active": "n"}, []),
    ({"updated_at": ""}, ["updated_at_malformed"]),
    ({"zip_code": "1234"}, ["invalid_zip_code"]),
    ({"zip_code": "12345-6789"}, []),
    ({"first_name": "  "}, []),
]


def test_customer_rules(spark):
    from pyspark.sql import functions as F

    rows = [{**PROFILE, **change} for change, _ in CUSTOMER_CASES]
    df = spark.createDataFrame(rows, CUSTOMER_FILE).coalesce(1)
    df = df.withColumn("_rescued_data", F.lit(None).cast("string"))
    flagged = customers.flag_customers(df, AS_OF)
    found = [r[0] for r in flagged.select("dq_failure_reasons").collect()]
    assert found == [codes for _, codes in CUSTOMER_CASES]


def test_delay_boundaries(spark):
    rows = [("2025-01-01T00:00:00Z", s) for s in (0, 3600, 3601)] + [("bad", 0), (None, 0)]
    df = spark.createDataFrame(rows, "event_time string, s int").coalesce(1)
    df = df.selectExpr("event_time", "timestamp_seconds(1735689600 + s) as ingested_time")
    found = pos.with_lateness(df).select("ingestion_delay_seconds", "is_late").collect()
    assert [tuple(r) for r in found] == [
        (0, False), (3600, False), (3601, True), (None, False), (None, False)
    ]


def test_decoding(spark):
    payloads = [
        '{"sku": 12, "item_unit_price": 4.50, "store_id": {"a": 1}}', "no json", "", "[1]", None
    ]
    df = spark.createDataFrame([(p,) for p in payloads], "value string").coalesce(1)
    found = pos.decode_pos(df, AS_OF, keep_raw=True).collect()
    assert (found[0]["sku"], found[0]["item_unit_price"], found[0]["store_id"]) == (
        "12", "4.5", '{"a":1}'
    )
    assert [r["payload"] for r in found] == payloads
    assert all(r["sku"] is None for r in found[1:])


def test_a_number_and_a_list_say_the_same(spark):
    rules = [Rule(f"r{i}", F.when(F.col("x") != 9, F.col("x") % (i + 2) == 0)) for i in range(63)]
    df = with_reasons(spark.range(500).select((F.col("id") * 7919).alias("x")).unionAll(
        spark.createDataFrame([(9,), (None,), (0,)], "x bigint")), "found", rules)
    both = df.select("x", FIRED, "found", reasons(rules).alias("listed")).collect()
    for r in both:
        assert r["found"] == r["listed"]
        assert r[FIRED] == sum(1 << int(code[1:]) for code in r["found"])
    everything = next(r for r in both if r["x"] == 0)
    assert len(everything["found"]) == 63 and everything[FIRED] == (1 << 63) - 1
    with pytest.raises(ValueError, match="63"):
        with_reasons(df, "more", rules + rules)
    assert with_reasons(df.select("x"), "none", []).filter(F.size("none") == 0).count() == 503


def test_filters_read_the_number(spark):
    df = with_reasons(spark.range(4).withColumnRenamed("id", "x"), "found", [Rule("odd", F.col("x") % 2 == 1)])
    assert [r["x"] for r in df.filter(failing(df, "found")).collect()] == [1, 3]
    listed = df.drop(FIRED)
    assert [r["x"] for r in listed.filter(failing(listed, "found")).collect()] == [1, 3]
