"""The registered queries: each operator over the records derived from the given tables."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillflow.functions.pos_rules import (
    business_rules,
    format_rules,
    missing_rules,
    strict_missing_rules,
)
from tillflow.functions.reasons import FIRED, add_reasons, reasons, with_reasons
from tillflow.operators import catalog, contracts, customers, pos
from tillflow.operators.catalog import preview
from tillflow.operators.cdc import apply_scd1, apply_scd2
from tillflow.operators.expectations import expectation_counts
from tillflow.operators.upsert import merge_upsert
from tillflow.plans.derive import AS_OF, counted_once, cust_raw, pos_raw, table
from tillflow.session import prepare
from tillflow.sources.schemas import (
    CUSTOMER_FIELDS,
    CUSTOMER_FILE,
    CUSTOMER_FLAGGED,
    CUSTOMER_RAW,
    POS_BRONZE,
    POS_FIELDS,
    RESCUED,
)
from tillflow.sources.streams import read_payloads, read_table_stream
from tillflow.streaming import customer_job, expectation_log, pos_job, sinks, supervisor

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Enough for the given tables; larger ones have a bucket for so many bytes of the files that are read.
QUERY_BUCKETS, BYTES_OF_BUCKET = 8, 32 << 20
PAYLOAD_CODEC, PAYLOADS_PER_FILE = "lz4", 250_000
KEYED = ("row_hash", "transaction_id", "item_sequence")


def _portable(df: DataFrame) -> DataFrame:
    """Types that every engine compares alike: no zones, dates, decimals or lists."""
    out = []
    for field in df.schema:
        column = F.col(field.name)
        if isinstance(field.dataType, T.TimestampType):
            column = column.cast("timestamp_ntz")
        elif isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, T.DateType):
            column = column.cast("string")
        elif isinstance(field.dataType, T.ArrayType):
            column = F.array_join(column, "|")
        out.append(column.alias(field.name))
    return df.select(*out)


def _query(make: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _portable(make(prepare(spark), sf_dir))

    run.__doc__ = make.__doc__
    QUERIES[make.__name__] = run
    return run


def _fresh(spark: SparkSession, name: str) -> str:
    """A new folder in the warehouse, which driver and executors share."""
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _buckets(rows: DataFrame) -> int:
    """Buckets for a keyed table that is made of the files of ``rows``."""
    size = int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(QUERY_BUCKETS, -(-size // BYTES_OF_BUCKET))


def _stored(rows: DataFrame, name: str) -> DataFrame:
    """Rows that are read several times, computed once into a new folder."""
    path = _fresh(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _flagged(spark: SparkSession, sf_dir: str, **how) -> DataFrame:
    return pos.flag_pos(pos.with_lateness(pos_raw(spark, sf_dir, **how)), AS_OF)


def _profiles(df: DataFrame) -> DataFrame:
    return df.drop(RESCUED, FIRED)


def _cust_flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customers.flag_customers(cust_raw(spark, sf_dir), AS_OF)


@_query
def pos_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records to keyed JSON and back to columns."""
    raw = pos_raw(spark, sf_dir)
    payloads = pos.to_keyed_json(raw.select(*POS_FIELDS, "ingested_time"))
    stamps = F.from_json("value", "ingested_time timestamp").getField("ingested_time")
    return pos.decode_pos(payloads, stamps)


@_query
def pos_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = {
        "item_unit_price": "unit_price",
        "item_quantity": "quantity",
        "event_time": "event_time",
        "item_sequence": "sequence",
        "discount_amount": "discount",
        "tax_amount": "tax",
    }
    typed = pos.cast_pos(pos_raw(spark, sf_dir))
    rows = typed.select(*KEYED, *[F.col(f"{a}_casted").alias(b) for a, b in names.items()])
    return rows.withColumn("sequence", F.col("sequence").cast("double"))


def _reasons_query(name: str, rules: Callable[[], list]) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        typed = pos.cast_pos(pos_raw(spark, sf_dir))
        return with_reasons(typed, "reasons", rules()).select(*KEYED, "reasons")

    run.__name__ = name
    _query(run)


_reasons_query("pos_reasons_missing", missing_rules)
_reasons_query("pos_reasons_strict", strict_missing_rules)
_reasons_query("pos_reasons_format", format_rules)
_reasons_query("pos_reasons_business", lambda: business_rules(AS_OF))


@_query
def pos_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three groups of rules, each appended to the list of the one before."""
    listed = pos.cast_pos(pos_raw(spark, sf_dir)).withColumn("reasons", reasons(missing_rules()))
    listed = add_reasons(listed, "reasons", format_rules())
    return add_reasons(listed, "reasons", business_rules(AS_OF)).select(*KEYED, "reasons")


@_query
def pos_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pos.quarantine(_flagged(spark, sf_dir))


@_query
def pos_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pos.valid(_flagged(spark, sf_dir))


@_query
def pos_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pos.late(pos.valid(_flagged(spark, sf_dir)))


@_query
def pos_on_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pos.on_time(pos.valid(_flagged(spark, sf_dir)))


@_query
def pos_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pos.on_time(pos.valid(_flagged(spark, sf_dir)))
    return contracts.enforce_contract(rows, contracts.POS_CLEANED)


@_query
def pos_route_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pos.route_counts(_flagged(spark, sf_dir))


def _delays(rows: DataFrame) -> DataFrame:
    # As doubles: integers with nulls are doubles to some readers only.
    delay = F.col("ingestion_delay_seconds").cast("double").alias("ingestion_delay_seconds")
    return rows.select(*KEYED, delay, "is_late")


@_query
def pos_delay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _delays(pos.with_lateness(pos_raw(spark, sf_dir)))


@_query
def pos_late_10min(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _delays(pos.with_lateness(pos_raw(spark, sf_dir), 600, against=AS_OF))


def _merge(spark: SparkSession, sf_dir: str, keys: tuple[str, ...]) -> DataFrame:
    """Half of the valid rows upserted into the other half.

    Copies of a key stay in the target, and in the source where the target
    doesn't have the key; two source rows for a known key would end the query.
    The upsert reads both sides more than once, so both are stored first.
    """
    # The filter stays behind the rules, which read typed columns that are typed once.
    flagged = counted_once(_flagged(spark, sf_dir, once=counted_once))
    rows = pos.valid(flagged, also=("row_hash",)).withColumn("old", F.expr("row_hash % 2 = 0"))
    columns = ["transaction_id", "item_sequence", "sku", "store_id", "item_unit_price", "ingested_time"]
    # Target rows lead their key, so one sort and one pass tell how many it has and which row follows them.
    rows = rows.select(*columns, "row_hash", "old").repartition(*keys)
    order = (F.desc("old"), "row_hash", "sku", "store_id", "ingested_time")
    so_far = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    rows = rows.withColumn("rn", F.row_number().over(so_far))
    rows = rows.withColumn("n_old", F.count_if("old").over(so_far))
    kept = rows.filter("old or n_old = 0 or rn = n_old + 1")
    sides = _stored(kept.select(*columns, "old"), "sides")
    target, source = sides.filter("old"), sides.filter("not old")
    return merge_upsert(target.select(*columns), source.select(*columns), keys)


@_query
def pos_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merge(spark, sf_dir, ("transaction_id",))


@_query
def pos_merge_line_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merge(spark, sf_dir, ("transaction_id", "item_sequence"))


@_query
def pos_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = ("transaction_id", "item_sequence", "sku", "ingested_time", "row_hash")
    shown = _flagged(spark, sf_dir).select(*KEYED, "sku", "ingested_time")
    return preview(shown, 20, order)


@_query
def cust_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = cust_raw(spark, sf_dir)
    typed = customers.cast_customers(raw, AS_OF)
    with_id = customers.cast_customers(raw, AS_OF, also=("change_id",))
    return _profiles(with_id.select("change_id", *typed.columns))


@_query
def cust_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _profiles(customers.flag_customers(cust_raw(spark, sf_dir), AS_OF, also=("change_id",)))


@_query
def cust_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = customers.flag_customers(cust_raw(spark, sf_dir), AS_OF, also=("change_id",))
    return _profiles(customers.customer_dead_letters(flagged))


@_query
def cust_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _profiles(customers.customers_cleaned(_cust_flagged(spark, sf_dir)))


@_query
def cust_expect_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _profiles(customers.guarded_customers(_cust_flagged(spark, sf_dir), AS_OF))


@_query
def cust_expect_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = _cust_flagged(spark, sf_dir).filter(F.size(customers.REASONS) == 0)
    return expectation_counts(kept, customers.customer_expectations(AS_OF))


def _changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Guarded profile changes, in the order of the order dates."""
    raw = cust_raw(spark, sf_dir).withColumnRenamed("ingestion_time", "changed_at")
    flagged = customers.flag_customers(raw, AS_OF, also=("changed_at",))
    kept = customers.guarded_customers(flagged, AS_OF, also=("changed_at",))
    return kept.select(*CUSTOMER_FIELDS, F.col("changed_at").alias("ingestion_time"))


@_query
def cust_scd1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the changes applied to the state that the other half made."""
    changes = _changes(spark, sf_dir)
    early = F.dayofmonth("ingestion_time") % 2 == 0
    return apply_scd1(apply_scd1(None, changes.filter(early)), changes.filter(~early))


@_query
def cust_scd2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the changes, out of order, applied to the history of the other half."""
    changes = _changes(spark, sf_dir)
    early = F.dayofmonth("ingestion_time") % 2 == 0
    return apply_scd2(apply_scd2(None, changes.filter(early)), changes.filter(~early))


@_query
def cust_scd2_tracked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions for changes of tier or activity only."""
    return apply_scd2(None, _changes(spark, sf_dir), track_cols=("loyalty_tier", "is_active"))


def _payload_job(spark: SparkSession, sf_dir: str) -> pos_job.PosConfig:
    """Payload files of all records; the arrival time travels in the payload.

    The names of the fields are more than half of a payload, so files are
    compressed. Such a file is one task's, hence the bound on its records.
    """
    root = _fresh(spark, "pos")
    rows = pos_raw(spark, sf_dir).select(*POS_FIELDS, "ingested_time")
    writer = pos.to_keyed_json(rows).select("value").write.option("compression", PAYLOAD_CODEC)
    writer.option("maxRecordsPerFile", PAYLOADS_PER_FILE).text(f"{root}/payloads")
    stamp = F.from_json("value", "ingested_time timestamp").getField("ingested_time")
    return pos_job.PosConfig(
        root,
        "text",
        {"path": f"{root}/payloads"},
        trigger=pos_job.DRAIN,
        as_of=stamp,
        buckets=_buckets(table(spark, sf_dir, "lineitem")),
    )


def _route_tables(spark: SparkSession, config: pos_job.PosConfig) -> DataFrame:
    """What the three tables of a job hold."""
    bad = sinks.read_appended(
        spark, config.path("quarantined"), contracts.POS_QUARANTINED.schema
    )
    late = sinks.read_appended(spark, config.path("late"), contracts.POS_LATE_ARRIVALS.schema)
    clean = sinks.read_keyed(spark, config.clean_table())
    tables = [("quarantine", bad), ("late", late), ("clean", clean)]
    parts = [
        df.select(
            F.lit(route).alias("route"),
            "transaction_id",
            F.col("item_sequence").cast("string").alias("item_sequence"),
            "customer_id",
            "ingested_time",
            (F.array_join("error_reason", "|") if route == "quarantine" else F.lit("")).alias(
                "reasons"
            ),
        )
        for route, df in tables
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@_query
def stream_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A drained stream of payload files into the bronze table."""
    config = _payload_job(spark, sf_dir)
    pos_job.start_bronze(spark, config).awaitTermination()
    return spark.read.schema(POS_BRONZE).parquet(config.path("bronze"))


@_query
def stream_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads to bronze to the three tables, and what the tables hold then."""
    config = _payload_job(spark, sf_dir)
    pos_job.start_bronze(spark, config).awaitTermination()
    silver = config._replace(as_of=AS_OF)
    pos_job.start_silver(spark, silver).awaitTermination()
    return _route_tables(spark, config)


def _customer_files(rows: DataFrame, path: str, names: Sequence[str]) -> None:
    """Files with a header, nulls as bare empty fields."""
    writer = rows.select(*names).write.mode("append").option("header", "true")
    blanks = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    writer.options(nullValue="", emptyValue='""', **blanks).csv(path)


@_query
def stream_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer files through both jobs in three runs; the history that results.

    The changes of a run arrive at one moment, and the last run's moment lies
    between those of the others: its changes are late.
    """
    root = _fresh(spark, "customers")
    raw = _stored(cust_raw(spark, sf_dir), "changes")
    for part in (0, 2, 1):
        arriving = raw.filter(F.col("change_id") % 3 == part)
        _customer_files(arriving, f"{root}/files", CUSTOMER_FILE.fieldNames())
        config = customer_job.CustomerConfig(
            f"{root}/files", root, f"2026-01-0{part + 1} 00:00:00", QUERY_BUCKETS
        )
        customer_job.run_customers(spark, config)
    return sinks.read_keyed(spark, config.history_table())


@_query
def cust_files_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows of files with the columns in other orders, with foreign columns and misfit lines.

    A third of the changes has two foreign columns, a third comes in reverse
    order with a comment behind the last field, a third stops after the email.
    """
    root = _fresh(spark, "files")
    names, raw = CUSTOMER_FILE.fieldNames(), cust_raw(spark, sf_dir)
    kind = F.col("change_id") % 3
    foreign = raw.filter(kind == 0).withColumn("note", F.concat(F.lit("no. "), "change_id", F.lit(', "new"')))
    foreign = foreign.withColumn("fault", F.when(F.col("fault") < 50, F.col("fault")))
    _customer_files(foreign, f"{root}/foreign", ["note", *names[8:], *names[:8], "fault"])
    quoted = [F.coalesce(F.concat(F.lit('"'), n, F.lit('"')), F.lit("")) for n in names]
    for name, chosen in (
        ("long", F.concat_ws(",", *quoted[::-1], F.concat(F.lit("see "), "change_id"))),
        ("short", F.concat_ws(",", *quoted[:4])),
    ):
        rows = raw.filter(kind == (1 if name == "long" else 2))
        # Lines as they are: one column whose name is the header.
        head = ",".join(names[::-1] if name == "long" else names)
        lines = rows.select(chosen.alias(head)).write.option("header", "true")
        lines.option("sep", "\x01").option("quote", "").csv(f"{root}/{name}")
    config = customer_job.CustomerConfig(f"{root}/*", f"{root}-out", AS_OF)
    customer_job.run_bronze(spark, config)
    found = sinks.read_appended(spark, config.path("raw"), CUSTOMER_RAW)
    rescued = F.from_json(RESCUED, "map<string,string>")
    other = F.map_filter(rescued, lambda key, _: key != "_file_path")
    return found.select(
        *names,
        "ingestion_time",
        F.array_join(
            F.transform(
                F.array_sort(F.map_entries(other)), lambda e: F.concat(e.key, F.lit("="), e.value)
            ),
            ";",
        ).alias("rescued"),
        F.coalesce(F.map_contains_key(rescued, "_file_path"), F.lit(False)).alias("has_path"),
    )


@_query
def stream_expectations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Violations per batch of a stream of flagged profiles, which arrive in three batches."""
    root = _fresh(spark, "guarded")
    raw = cust_raw(spark, sf_dir)
    for part in range(3):
        flagged = customers.flag_customers(raw.filter(F.col("change_id") % 3 == part), AS_OF)
        flagged.drop(FIRED).write.mode("append").parquet(f"{root}/flagged")
        arriving = read_table_stream(spark, f"{root}/flagged", CUSTOMER_FLAGGED)
        expectation_log.run_guarded(
            spark, arriving, f"{root}/cleaned", f"{root}/checkpoint", f"{root}/counts", AS_OF
        )
    counts = expectation_log.expectation_log(spark, f"{root}/counts")
    return counts.select("batch", "expectation", "n_judged", "n_violations")


@_query
def stream_named_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payload files drained into a table of the catalog, and once more with nothing new."""
    config = _payload_job(spark, sf_dir)
    name = f"pos_bronze_{uuid.uuid4().hex}"
    for _ in range(2):
        payloads = read_payloads(spark, config.payload_format, config.payload_options)
        rows = pos.decode_pos(payloads, config.as_of)
        checkpoint = config.path("checkpoints/named")
        pos_job.write_bronze(rows, "", checkpoint, pos_job.DRAIN, name).awaitTermination()
    return spark.table(name)


@_query
def stream_supervised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both queries at an interval, side by side under supervision, until all rows are routed."""
    config = _payload_job(spark, sf_dir)._replace(trigger="1 second")
    silver = config._replace(as_of=AS_OF)
    watched = supervisor.Supervisor(
        spark,
        {
            "bronze": lambda: pos_job.start_bronze(spark, config),
            "silver": lambda: pos_job.start_silver(spark, silver),
        },
    )
    n_rows = table(spark, sf_dir, "lineitem").count()

    def routed() -> int:
        done = 0
        for progress in watched.queries["silver"].recentProgress if "silver" in watched.queries else []:
            done += progress.numInputRows
        return done

    def until_done() -> None:
        while routed() < n_rows and not ended.wait(0.5):
            pass
        watched.stop()

    ended = threading.Event()
    looker = threading.Thread(target=until_done, daemon=True)
    looker.start()
    try:
        watched.run()
    finally:
        ended.set()
        looker.join()
    return _route_tables(spark, config)


@_query
def pos_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table that is created twice, filled twice, replaced, filled again and previewed whole."""
    name = f"{contracts.POS_CLEANED.name}_{uuid.uuid4().hex}"
    rows = _stored(pos.on_time(pos.valid(_flagged(spark, sf_dir))), "on_time")
    catalog.create_table(spark, contracts.POS_CLEANED, name)
    catalog.fill_table(rows, contracts.POS_CLEANED, name)
    catalog.create_table(spark, contracts.POS_CLEANED, name)
    catalog.fill_table(rows, contracts.POS_CLEANED, name)
    twice = spark.table(name).count()
    catalog.replace_table(spark, contracts.POS_CLEANED, name)
    emptied = spark.table(name).count()
    catalog.fill_table(rows, contracts.POS_CLEANED, name)
    dropped = f"{name}_gone"
    catalog.create_table(spark, contracts.POS_CLEANED, dropped)
    catalog.drop_table(spark, dropped)
    found = spark.table(name)
    return found.select(
        "transaction_id",
        "item_sequence",
        "sku",
        "ingested_time",
        F.lit(twice).alias("n_twice"),
        F.lit(emptied).alias("n_emptied"),
        F.lit(spark.catalog.tableExists(dropped)).alias("dropped_exists"),
    )
