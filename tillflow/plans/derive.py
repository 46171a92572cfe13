"""Retail records derived from the given star-schema tables.

``pos_raw`` makes one point-of-sale line item of each ``lineitem`` row and
``cust_raw`` one profile change of each ``orders`` row. A hash of the keys
breaks one thing in about one percent of the rows per kind of ``fault``; all
rows of the tables are kept.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.functions import domains as d

AS_OF = "2026-01-01 00:00:00"
HISTORY_ENDS = "1999-01-01 00:00:00"
GARBLED = "Q#42" + d.REPLACEMENT_CHARACTER


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _faulty(column: Column, replacements: dict[int, str | None]) -> Column:
    """The column, replaced where the row's fault is one of the given kinds."""
    branches = None
    for fault, text in replacements.items():
        hit = F.col("fault") == fault
        branches = F.when(hit, F.lit(text)) if branches is None else branches.when(hit, F.lit(text))
    return branches.otherwise(column)


def _code(prefix: str, number: str, width: int) -> Column:
    """The number with leading zeros up to the width; longer numbers stay whole."""
    n, wide = F.expr(number).cast("bigint"), 10**width
    text = n.cast("string")
    # The formatter of the JVM reads its pattern for every row: only where a number has a sign, or is absent.
    return (
        F.when(n.between(0, wide - 1), F.concat(F.lit(prefix), F.lpad(text, width, "0")))
        .when(n >= wide, F.concat(F.lit(prefix), text))
        .otherwise(F.format_string(f"{prefix}%0{width}d", n))
    )


def _computed_once(df: DataFrame) -> DataFrame:
    """The rows behind a node that filters and projections don't pass.

    Otherwise the optimizer copies the nested cases of a column into each rule
    that reads it.
    """
    return df.select(F.inline(F.array(F.struct(*df.columns))))


def counted_once(df: DataFrame) -> DataFrame:
    """As ``_computed_once``, but the rows are counted on their way, not built and unpacked again.

    Generated code ends here as well, so that what lies behind is small enough to be compiled. A filter
    there repeats the casts it reads: put one more node between the rules and the filter.
    """
    return df.observe(f"records-{uuid.uuid4().hex}", F.count(F.lit(1)).alias("n"))


def _price(cents: str) -> Column:
    """Cents as an amount of money; by way of a decimal only where there may be a sign, or nothing."""
    n = F.expr(cents)
    whole, rest = F.expr(f"({cents}) div 100").cast("string"), (n % 100).cast("string")
    plain = F.concat(whole, F.lit("."), F.lpad(rest, 2, "0"))
    return F.when(n >= 100, plain).otherwise((n / 100).cast("decimal(10,2)").cast("string"))


def _after(moment: str, seconds: Column) -> Column:
    """So many seconds later, without the calendar."""
    return F.timestamp_micros(F.unix_micros(F.col(moment).cast("timestamp")) + seconds * 1_000_000)


def _pick(number: str, texts: tuple[str, ...]) -> Column:
    return F.element_at(F.array(*map(F.lit, texts)), F.expr(number).cast("int") + 1)


def pos_of_lines(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """Point-of-sale rows of order lines; ``lines`` may be a stream."""
    keyed = lines.join(
        orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")
    ).withColumn(
        "row_hash",
        F.expr(
            "(l_orderkey * 7919 + l_partkey * 104729 + l_suppkey * 1299709"
            " + l_linenumber * 15485863) % 1000003"
        ),
    ).withColumn("fault", F.expr("(row_hash div 100) % 100"))
    money = "cast(cast({} as decimal(10,2)) as string)"
    price = _price("100 + l_partkey * 37 % 19800")
    event_time = F.expr("concat(replace(cast(l_shipdate as string), ' ', 'T'), '.000Z')")
    delay = F.expr("if((row_hash div 10000) % 100 < 15, 3601 + row_hash % 5000, row_hash % 3601)")
    customer_id = F.when(F.expr("row_hash % 10 >= 3"), _code("CUST-", "o_custkey", 5))
    return keyed.select(
        "row_hash",
        "fault",
        _faulty(_code("TXN-", "l_orderkey", 6), {14: None}).alias("transaction_id"),
        _faulty(
            F.col("l_linenumber").cast("string"), {0: None, 15: "0", 16: "x1"}
        ).alias("item_sequence"),
        _faulty(customer_id, {1: GARBLED}).alias("customer_id"),
        _faulty(
            event_time,
            {
                2: "2025-19-39T77:00:00Z",
                3: "July 1st, half past two",
                4: "",
                5: "1970-01-01T00:00:00.000Z",
                17: "2199-01-01T00:00:00.000Z",
            },
        ).alias("event_time"),
        _faulty(
            F.expr("cast(4006381000000 + l_partkey as string)"), {6: None, 18: GARBLED}
        ).alias("sku"),
        F.when(F.col("fault") == 7, F.concat(F.lit("-"), price))
        .otherwise(_faulty(price, {8: "1999700.01", 19: "200.00", 20: "200.01"}))
        .alias("item_unit_price"),
        _faulty(
            F.expr("cast(cast(l_quantity as int) as string)"),
            {9: "99999", 10: "-1", 21: "200", 22: "201"},
        ).alias("item_quantity"),
        _faulty(F.expr(money.format("l_discount")), {23: "-0.01", 24: "n/a"}).alias(
            "discount_amount"
        ),
        _faulty(F.expr(money.format("l_tax")), {11: "-1"}).alias("tax_amount"),
        _faulty(
            _pick(
                "(row_hash div 7) % 5",
                d.PAYMENT_TYPES,
            ),
            {12: "BARTER", 13: ""},
        ).alias("payment_type"),
        _pick("l_suppkey % 6", tuple(d.CURRENCY_OF_COUNTRY[c] for c in d.COUNTRIES)).alias("currency"),
        _faulty(
            _pick("l_suppkey % 6", d.COUNTRIES), {25: "XX"}
        ).alias("country"),
        _faulty(
            _pick("row_hash % 4", d.CHANNELS),
            {26: "FAX"},
        ).alias("channel"),
        _faulty(_code("STORE-", "l_suppkey % 20 + 1", 3), {27: "STORE-021"}).alias("store_id"),
        _faulty(_code("TERM-", "l_suppkey % 100", 2), {28: "TERM-1"}).alias("terminal_id"),
        _after("l_shipdate", delay).alias("ingested_time"),
    )


def pos_raw(
    spark: SparkSession, sf_dir: str, once: Callable[[DataFrame], DataFrame] = _computed_once
) -> DataFrame:
    """Customer ids have five digits up to 99,999; longer ones are faulty, as they should be."""
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    return once(pos_of_lines(lines, orders))


def cust_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One profile change per order, in arrival order of the order dates."""
    changes = (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .withColumn("row_hash", F.expr("(o_orderkey * 7919 + o_custkey * 104729) % 1000003"))
        .withColumn("fault", F.expr("(row_hash div 100) % 100"))
    )
    order_date = F.col("o_orderdate").cast("string")
    custkey = F.col("o_custkey").cast("string")
    tier = F.element_at(
        F.create_map(
            F.lit("1"), F.lit("Platinum"), F.lit("2"), F.lit("Gold"), F.lit("3"), F.lit("Silver")
        ),
        F.substring("o_orderpriority", 1, 1),
    )
    return _computed_once(changes.select(
        "fault",
        _faulty(_code("CUST-", "o_custkey", 5), {0: None}).alias("customer_id"),
        _faulty(F.concat(F.lit("First"), custkey), {1: None, 2: "  "}).alias("first_name"),
        F.col("c_name").alias("last_name"),
        _faulty(
            F.concat(F.lit("c"), custkey, F.lit("@example.com")), {3: "not-an-email"}
        ).alias("email"),
        _faulty(
            F.concat(
                _code("+1-555-", "o_custkey % 1000", 3), _code("-", "o_orderkey % 10000", 4)
            ),
            {4: "5551234567"},
        ).alias("phone"),
        _faulty(F.concat(custkey, F.lit(" Main St")), {5: "Main St"}).alias("address"),
        _faulty(F.col("n_name"), {6: None}).alias("city"),
        F.concat(F.lit("S"), F.col("n_regionkey").cast("string")).alias("state"),
        F.lit("US").alias("country"),
        _faulty(
            F.expr(
                "concat(cast(1940 + o_custkey % 60 as string), '-0',"
                " cast(1 + o_custkey % 9 as string), '-1', cast(o_custkey % 10 as string))"
            ),
            {7: "13/45/1990", 8: "1850-01-01"},
        ).alias("birth_date"),
        _faulty(_pick("o_custkey % 2", ("M", "F")), {9: "X"}).alias("gender"),
        _faulty(order_date, {10: "bad"}).alias("registration_date"),
        _faulty(F.coalesce(tier, F.lit("Bronze")), {11: "Tin"}).alias("loyalty_tier"),
        _faulty(
            F.when(F.col("o_orderstatus") == "F", F.lit("false")).otherwise(F.lit("true")),
            {12: "maybe"},
        ).alias("is_active"),
        _faulty(order_date, {13: ""}).alias("updated_at"),
        _faulty(_code("", "o_custkey * 7 % 100000", 5), {14: "1234"}).alias("zip_code"),
        F.col("o_orderdate").cast("timestamp").alias("ingestion_time"),
        F.col("o_orderkey").alias("change_id"),
        F.lit(None).cast("string").alias("_rescued_data"),
    ))
