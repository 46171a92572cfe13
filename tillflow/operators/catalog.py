"""Tables of the catalog: create, replace, drop, preview."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.operators.contracts import Contract, enforce_contract, table_properties


def _define(spark: SparkSession, contract: Contract, name: str, verb: str, fmt: str) -> None:
    # Spark's own tables take no NOT NULL columns for every format; the contract checks them.
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in contract.schema)
    tags = ", ".join(f"'{k}' = '{v}'" for k, v in table_properties(contract).items())
    spark.sql(f"{verb} {name} ({columns}) USING {fmt} TBLPROPERTIES ({tags})")


def create_table(
    spark: SparkSession, contract: Contract, name: str | None = None, fmt: str = "parquet"
) -> None:
    """An empty table with the contract's columns and tags; one that exists stays."""
    _define(spark, contract, name or contract.name, "CREATE TABLE IF NOT EXISTS", fmt)


def replace_table(
    spark: SparkSession, contract: Contract, name: str | None = None, fmt: str = "parquet"
) -> None:
    """As ``create_table``, but what was there is dropped."""
    drop_table(spark, name or contract.name)
    _define(spark, contract, name or contract.name, "CREATE TABLE", fmt)


def fill_table(df: DataFrame, contract: Contract, name: str | None = None) -> None:
    """Appends rows that meet the contract."""
    enforce_contract(df, contract).write.insertInto(name or contract.name)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def preview(df: DataFrame, n: int, order_by: Sequence[str]) -> DataFrame:
    """The first ``n`` rows by ``order_by``: the same ones each time, if it tells rows apart."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in order_by]).limit(n)
