"""What the operators share: intermediate tables, text keys, word patterns."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
BLANKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, which driver and executors share.

    Where the session names none (tests), a folder beside the warehouse.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    return named or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_intermediate"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as a table of its own and read again.

    Cuts the lineage: losing an executor afterwards costs a read, not the job.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/tillflow/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_of(column: str | Column) -> Column:
    """The text; an absent one counts as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(text, UPPER, LOWER)


def id_residue(id_col: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo; null ids give null."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus
