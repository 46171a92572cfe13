"""Where batches of a stream are written so that a repeated batch changes nothing.

A batch is known by its stream and its number: a stream that begins anew with
another checkpoint counts from 0 again, and its batches are others.

Appended tables have a folder per stream and batch, which a repeated batch
overwrites. Keyed tables are bucketed by their key, so that an upsert doesn't
shuffle them, and partitioned by slots of keys, of which a batch overwrites
those that it touches. Each row names the batch that wrote it: a slot that
has rows of the batch already is not written again.

A slot is replaced when all its files are written. A driver that dies at the
very moment of the replacement can leave a slot's files in Spark's staging
folder; where that matters, use a table format with MERGE. A keyed table has
one writer at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillflow.operators.contracts import Contract, check_mode, enforce_contract
from tillflow.operators.upsert import merge_upsert

BUCKETS = 64
WRITTEN_BY = "_written_by"
SLOT = "_slot"
NO_STREAM = "direct"


def stream_id(spark: SparkSession) -> str:
    """The id of the stream whose batch is being written; it lives as long as its checkpoint."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId") or NO_STREAM


def _exists(spark: SparkSession, pattern: str) -> bool:
    """By Spark's own file systems, so that any store works."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(pattern)
    system = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(system.globStatus(where))


def append_batch(
    df: DataFrame, path: str, batch_id: int, contract: Contract, stream: str | None = None
) -> None:
    """The batch's rows, checked against the contract, in a folder of its own.

    Columns beyond the contract are kept behind it: the table may grow by
    columns, and readers merge the schemas.
    """
    check_mode(contract, "append")
    more = [c for c in df.columns if c not in contract.schema.fieldNames()]
    if more:
        grown = contract._replace(
            schema=StructType([*contract.schema.fields, *[df.schema[c] for c in more]])
        )
        df = enforce_contract(df, grown)
    else:
        df = enforce_contract(df, contract)
    stream = stream or stream_id(df.sparkSession)
    df.write.mode("overwrite").parquet(f"{path}/stream={stream}/batch_id={batch_id}")


def read_appended(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All batches; none gives an empty table. Columns that came later are null before."""
    if not _exists(spark, f"{path}/stream=*/batch_id=*/_SUCCESS"):
        return spark.createDataFrame([], schema)
    return spark.read.option("mergeSchema", "true").parquet(path).drop("stream", "batch_id")


class KeyedTable(NamedTuple):
    """A table below ``path`` with one or more rows per key.

    ``slot`` is an expression over the keys: what a batch overwrites. By
    default it is the bucket, so a slot is one file. Keys that grow with time,
    such as running numbers, are better cut by their front: a batch then
    overwrites the newest slots only, whatever the size of the table.
    """

    path: str
    contract: Contract
    keys: Sequence[str]
    buckets: int = BUCKETS
    slot: str | None = None

    @property
    def name(self) -> str:
        """Its name in the catalog, the same for the same folder."""
        digest = hashlib.sha256(self.path.encode()).hexdigest()[:16]
        return f"{self.contract.name}_{digest}"

    def slot_of_row(self) -> Column:
        # The hash that Spark deals buckets by.
        number = F.pmod(F.hash(*self.keys), F.lit(self.buckets))
        value = number if self.slot is None else F.expr(self.slot)
        return F.concat(F.lit("s"), F.coalesce(value.cast("string"), F.lit("")))


def _opened(spark: SparkSession, table: KeyedTable) -> DataFrame:
    """The table, defined in the catalog over what its folder holds."""
    if not spark.catalog.tableExists(table.name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.contract.schema)
        keys = ", ".join(f"`{k}`" for k in table.keys)
        spark.sql(
            f"CREATE TABLE {table.name} ({columns}, {WRITTEN_BY} STRING, {SLOT} STRING)"
            " USING parquet OPTIONS (partitionOverwriteMode 'dynamic')"
            f" PARTITIONED BY ({SLOT}) CLUSTERED BY ({keys}) SORTED BY ({keys})"
            f" INTO {table.buckets} BUCKETS LOCATION '{table.path}'"
        )
        if _exists(spark, f"{table.path}/{SLOT}=*"):
            spark.sql(f"ALTER TABLE {table.name} RECOVER PARTITIONS")
    spark.catalog.refreshTable(table.name)
    return spark.table(table.name)


def read_keyed(spark: SparkSession, table: KeyedTable) -> DataFrame:
    return _opened(spark, table).drop(WRITTEN_BY, SLOT)


def write_keyed(
    df: DataFrame,
    table: KeyedTable,
    batch_id: int,
    combine: Callable[[DataFrame | None, DataFrame], DataFrame],
    stream: str | None = None,
) -> None:
    """``combine(current, batch)`` in place of the current rows of the touched slots.

    ``current`` is None where these have no rows. Both have the column of the writing batch, which ``combine`` keeps with
    each row. Either rows of the batch stay in each slot that it touches, or
    combining them once more changes nothing. ``df`` is read several times:
    persist it if it is costly. Its slots are gathered, so a slot should hold
    many keys.
    """
    check_mode(table.contract, "overwrite")
    written_by = f"{stream or stream_id(df.sparkSession)}:{batch_id}"
    current = _opened(df.sparkSession, table)
    slot = table.slot_of_row()
    touched = [r[0] for r in df.select(slot).distinct().collect()]
    if not touched:
        return
    mine = current.filter(F.col(SLOT).isin(touched) & (F.col(WRITTEN_BY) == written_by))
    done = {r[0] for r in mine.select(SLOT).distinct().collect()}
    todo = [s for s in touched if s not in done]
    if not todo:
        return
    batch = df.filter(slot.isin(todo)).withColumn(WRITTEN_BY, F.lit(written_by))
    columns = [*table.contract.schema.fieldNames(), WRITTEN_BY]
    batch = batch.select(*columns)
    held = current.filter(F.col(SLOT).isin(todo)).select(*columns)
    if held.isEmpty():
        # Dealt as the buckets are, so that a task writes few slots.
        after = combine(None, batch.repartition(table.buckets, *table.keys))
    else:
        after = combine(held, batch)
    after.select(*columns, slot.alias(SLOT)).write.insertInto(table.name, overwrite=True)


def upsert_sink(
    df: DataFrame, table: KeyedTable, batch_id: int, stream: str | None = None
) -> None:
    """Checked rows, upserted by key; the first batch is taken as it is."""

    def combine(current: DataFrame | None, batch: DataFrame) -> DataFrame:
        return merge_upsert(current, batch, table.keys)

    write_keyed(enforce_contract(df, table.contract), table, batch_id, combine, stream)
