"""The customer flow: files to flagged rows, flagged rows to state and history."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tillflow.functions.clock import AsOf
from tillflow.functions.reasons import FIRED
from tillflow.operators import contracts as c
from tillflow.operators.cdc import VALID_FROM, VALID_TO, apply_scd1
from tillflow.operators.customers import customer_dead_letters, flag_customers, guarded_customers
from tillflow.operators.history import scd2_patch
from tillflow.operators.upsert import merge_upsert
from tillflow.session import prepare
from tillflow.sources.schemas import CUSTOMER_CLEANED, CUSTOMER_FLAGGED, CUSTOMER_RAW, RESCUED
from tillflow.sources.streams import customer_rows, read_customer_files
from tillflow.streaming.sinks import BUCKETS, KeyedTable, append_batch, read_keyed, write_keyed

KEYS = ("customer_id",)
STATE = T.StructType([f for f in CUSTOMER_CLEANED if f.name != RESCUED])
HISTORY = T.StructType(
    [
        *STATE.fields,
        T.StructField(VALID_FROM, T.TimestampType()),
        T.StructField(VALID_TO, T.TimestampType()),
    ]
)
CUSTOMERS_STATE = c.Contract("customers_current", STATE, False, "silver")
CUSTOMERS_HISTORY = c.Contract("customers_history", HISTORY, False, "silver")
DEAD_LETTERS = c.Contract(
    "customers_dead_letters",
    T.StructType([*CUSTOMER_FLAGGED.fields, T.StructField("is_corrupted", T.BooleanType())]),
    True,
    "bronze",
)


class CustomerConfig(NamedTuple):
    """Folders lie below ``root``, which all executors share.

    Jobs into the same root, one after the other, share its tables.
    """

    files: str
    root: str
    as_of: AsOf = None
    buckets: int = BUCKETS

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def current_table(self) -> KeyedTable:
        return KeyedTable(self.path("current"), CUSTOMERS_STATE, KEYS, self.buckets)

    def history_table(self) -> KeyedTable:
        return KeyedTable(
            self.path("history"), CUSTOMERS_HISTORY, (*KEYS, VALID_FROM), self.buckets
        )


def _drain(rows: DataFrame, checkpoint: str, each) -> None:
    writer = rows.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start().awaitTermination()


def run_bronze(spark: SparkSession, config: CustomerConfig) -> None:
    """Files that are new since the last run: raw rows, flagged rows, dead letters."""

    def each(batch: DataFrame, batch_id: int) -> None:
        kept = customer_rows(batch, config.as_of).persist()
        try:
            append_batch(kept, config.path("raw"), batch_id, c.CUSTOMERS_RAW)
            flagged = flag_customers(kept, config.as_of)
            append_batch(flagged.drop(FIRED), config.path("flagged"), batch_id, c.CUSTOMERS_FLAGGED)
            dead = customer_dead_letters(flagged)
            append_batch(dead, config.path("dead_letters"), batch_id, DEAD_LETTERS)
        finally:
            kept.unpersist()

    files = read_customer_files(spark, config.files)
    _drain(files, config.path("checkpoints/bronze"), each)


def run_silver(spark: SparkSession, config: CustomerConfig) -> None:
    """Flagged rows that are new: guarded by expectations, then state and history."""

    def each(batch: DataFrame, batch_id: int) -> None:
        cleaned = guarded_customers(batch, config.as_of).persist()
        try:
            append_batch(cleaned, config.path("cleaned"), batch_id, c.CUSTOMERS_CLEANED)
            changes = cleaned.drop(RESCUED)
            write_keyed(
                changes, config.current_table(), batch_id,
                lambda now, more: apply_scd1(now, more, KEYS),
            )
            history = config.history_table()
            held: list[DataFrame] = []

            def keep(rows: DataFrame) -> DataFrame:
                held.append(rows.persist())
                return held[-1]

            patch = keep(scd2_patch(read_keyed(spark, history), changes, KEYS, keep=keep))
            write_keyed(
                patch, history, batch_id,
                lambda now, more: merge_upsert(now, more, history.keys),
            )
            for rows in held:
                rows.unpersist()
        finally:
            cleaned.unpersist()

    flagged = spark.readStream.schema(CUSTOMER_FLAGGED).parquet(config.path("flagged"))
    _drain(flagged.select(*CUSTOMER_FLAGGED.fieldNames()), config.path("checkpoints/silver"), each)


def run_customers(spark: SparkSession, config: CustomerConfig) -> None:
    """Bronze, then silver; a failed expectation ends the run before silver is written."""
    prepare(spark)
    run_bronze(spark, config)
    run_silver(spark, config)
