"""The point-of-sale flow: payloads to bronze, bronze to three tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tillflow.functions.clock import AsOf
from tillflow.operators import contracts as c
from tillflow.operators.pos import (
    ROUTES,
    decode_pos,
    flag_pos,
    late,
    on_time,
    quarantine,
    valid,
    with_lateness,
    with_route,
)
from tillflow.session import prepare
from tillflow.sources.schemas import POS_BRONZE
from tillflow.sources.streams import read_payloads, read_table_stream
from tillflow.streaming.sinks import BUCKETS, KeyedTable, append_batch, stream_id, upsert_sink
from tillflow.streaming.supervisor import Supervisor

INTERVAL = "60 seconds"
DRAIN = "available_now"


class PosConfig(NamedTuple):
    """Folders lie below ``root``, which all executors share.

    The clean table is bucketed by ``keys``; ``slot`` is what a batch of it
    overwrites (see ``sinks.KeyedTable``). A second job into the same root adds
    to the appended tables and upserts into the clean one; the two must not
    write at the same time.
    """

    root: str
    payload_format: str = "kafka"
    payload_options: Mapping[str, str] = {}
    table_options: Mapping[str, str] = {}
    trigger: str = INTERVAL
    keys: Sequence[str] = ("transaction_id",)
    as_of: AsOf = None
    buckets: int = BUCKETS
    slot: str | None = None
    bronze: str = "bronze"
    checkpoints: str = "checkpoints"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def clean_table(self) -> KeyedTable:
        return KeyedTable(
            self.path("cleaned"), c.POS_CLEANED, self.keys, self.buckets, self.slot
        )


def _triggered(writer: DataStreamWriter, trigger: str) -> DataStreamWriter:
    """``trigger`` is an interval, or ``available_now`` to drain what is there and stop."""
    if trigger == DRAIN:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger)


def write_bronze(
    df: DataFrame, path: str, checkpoint: str, trigger: str = INTERVAL, table: str | None = None
) -> StreamingQuery:
    """Appends a stream to a folder, or to a named table, each batch once."""
    writer = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    writer = _triggered(writer.format("parquet"), trigger)
    return writer.toTable(table) if table else writer.start(path)


def route_batch(
    batch: DataFrame, batch_id: int, config: PosConfig, stream: str | None = None
) -> dict[str, int]:
    """One bronze batch to the quarantine, late and clean tables; rows per route.

    The batch is flagged once, against one moment, and kept for the writes;
    rows that are lost with an executor are computed again. Rows are counted
    while the first write reads them, without a job of its own. Each sink
    takes a repeated batch of the same stream as the same batch.
    """
    stream = stream or stream_id(batch.sparkSession)
    # One moment for all reads of the batch.
    now = config.as_of if config.as_of is not None else dt.datetime.now(dt.timezone.utc)
    seen = Observation()
    counts = [F.count_if(F.col("route") == route).alias(route) for route in ROUTES]
    routed = with_route(flag_pos(with_lateness(batch), now))
    flagged = routed.observe(seen, *counts).persist()
    try:
        checked = valid(flagged)
        append_batch(
            quarantine(flagged), config.path("quarantined"), batch_id, c.POS_QUARANTINED, stream
        )
        append_batch(late(checked), config.path("late"), batch_id, c.POS_LATE_ARRIVALS, stream)
        upsert_sink(on_time(checked), config.clean_table(), batch_id, stream)
        return {route: n for route, n in seen.get.items() if n}
    finally:
        flagged.unpersist()


def start_bronze(spark: SparkSession, config: PosConfig) -> StreamingQuery:
    payloads = read_payloads(spark, config.payload_format, config.payload_options)
    rows = decode_pos(payloads, config.as_of)
    # The silver stream needs the folder to be there before a first batch is.
    empty = spark.createDataFrame([], POS_BRONZE)
    empty.write.mode("append").parquet(config.path(config.bronze))
    return write_bronze(
        rows, config.path(config.bronze), config.path(f"{config.checkpoints}/bronze"), config.trigger
    )


def start_silver(spark: SparkSession, config: PosConfig) -> StreamingQuery:
    bronze = read_table_stream(spark, config.path(config.bronze), POS_BRONZE, **config.table_options)
    writer = bronze.writeStream.foreachBatch(
        lambda batch, batch_id: route_batch(batch, batch_id, config)
    ).option("checkpointLocation", config.path(f"{config.checkpoints}/silver"))
    return _triggered(writer, config.trigger).start()


def supervised(spark: SparkSession, config: PosConfig, retries: int = 3) -> Supervisor:
    """Both queries of the flow; each is started again from its checkpoint if it fails."""
    prepare(spark)
    starts = {
        "bronze": lambda: start_bronze(spark, config),
        "silver": lambda: start_silver(spark, config),
    }
    return Supervisor(spark, starts, retries)


def run_pos(spark: SparkSession, config: PosConfig, retries: int = 0) -> None:
    """Both queries: drained one after the other, or side by side until one fails.

    An error of one ends both and is raised, after ``retries`` restarts.
    """
    if config.trigger == DRAIN:
        prepare(spark)
        for start in (start_bronze, start_silver):
            query = start(spark, config)
            try:
                query.awaitTermination()
            finally:
                query.stop()
    else:
        supervised(spark, config, retries).run()
