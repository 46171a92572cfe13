"""Stream sources: payloads, tables re-read as streams, customer files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillflow.functions.clock import AsOf, instant
from tillflow.sources.schemas import CUSTOMER_FILE, RESCUED


def read_payloads(
    spark: SparkSession, fmt: str = "kafka", options: Mapping[str, str] | None = None
) -> DataFrame:
    """The column ``value`` of a stream source, all options passed through.

    For a topic: servers, topic, ``startingOffsets`` and the TLS settings. The
    ``text`` source over a folder gives a payload per line.
    """
    given = dict(options or {})
    if fmt == "kafka":
        given.setdefault("startingOffsets", "latest")
    return spark.readStream.format(fmt).options(**given).load().select("value")


def read_table_stream(
    spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet", **options: str
) -> DataFrame:
    """Rows that are appended to a table, as a stream.

    ``options`` may bound a batch, for instance ``maxFilesPerTrigger``.
    """
    return spark.readStream.format(fmt).schema(schema).options(**options).load(path)


# A comma and its field: quoted, with doubled quotes or a backslash before special ones, or bare.
_FIELD = r',(?:"(?:[^"\\]|\\.|"")*+"[^,]*|[^,]*)'


def csv_fields(line: Column) -> Column:
    """The fields of a line; a bare empty field is null, a quoted one is empty.

    A quoted field may have commas, doubled quotes, and characters behind a
    backslash in it. A quote that isn't closed before the comma is text like
    any other; line breaks end a line also inside quotes.
    """
    # A comma in front, so that every field has one.
    raw = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(_FIELD), F.lit(0))

    def value(field: Column) -> Column:
        bare = F.substring(field, 2, 1 << 30)
        inner = F.regexp_extract(bare, r'^"(.*)"$', 1)
        unquoted = F.regexp_replace(inner, r'\\(.)|"(")', "$1$2")
        return F.when(F.rlike(bare, F.lit('^".*"$')), unquoted).when(bare != "", bare)

    return F.transform(raw, value)


def read_lines(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """Lines of text files as a stream, each file read once, with where they come from."""
    lines = spark.readStream.options(**options).text(path)
    return lines.select(
        "value",
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
    )


def by_header(
    lines: DataFrame, names: Sequence[str] = CUSTOMER_FILE.fieldNames(), rescued: str = RESCUED
) -> DataFrame:
    """The columns ``names`` of delimited ``lines`` (see ``read_lines``, one batch), as text.

    Each file's first line names its columns, in any order; they are matched
    by name, per file. What fits none of ``names`` is kept in ``rescued``, a
    JSON object: columns of other names, a name that comes again (as
    ``name#position``), fields beyond the header (``#position``), each if not
    null, and ``_file_path``. It is null where all fields fit. Columns that a
    file or a short line doesn't have are null; blank lines are skipped.

    A file's first line is the first row of its first block, and rows keep
    their order inside a partition, so it has the lowest row number there.
    """
    numbered = lines.withColumn("row", F.monotonically_increasing_id())
    first = F.min_by(F.struct("row", "value"), "row")
    heads = (
        numbered.filter("block_start = 0")
        .groupBy("file_path")
        .agg(first.alias("head"))
        .select(
            "file_path",
            F.col("head.row").alias("head_row"),
            F.transform(
                csv_fields(F.regexp_replace("head.value", "^\ufeff", "")),
                lambda n: F.trim(F.coalesce(n, F.lit(""))),
            ).alias("header"),
        )
    )
    # A row per file of the batch. By a shuffle, the lines of a file would be one task's.
    met = numbered.join(F.broadcast(heads), "file_path").filter(
        (F.col("row") != F.col("head_row")) & (F.trim("value") != "")
    )
    fields = met.select("file_path", "header", csv_fields(F.col("value")).alias("fields"))
    known = F.array(*map(F.lit, names))

    def kept_apart(value: Column, at: Column) -> Column:
        name = F.get("header", at)
        place = F.concat(F.lit("#"), (at + 1).cast("string"))
        repeated = F.array_position("header", name) != at + 1
        key = F.when(name.isNull(), place).when(repeated, F.concat(name, place)).otherwise(name)
        fits = F.array_contains(known, name) & ~repeated
        other = F.struct(key.alias("key"), value.alias("value"))
        return F.when(value.isNotNull() & ~F.coalesce(fits, F.lit(False)), other)

    misfits = F.filter(F.transform("fields", kept_apart), lambda x: x.isNotNull())
    placed = fields.select(
        *[F.get("fields", F.array_position("header", F.lit(n)).cast("int") - 1).alias(n) for n in names],
        "file_path",
        misfits.alias("misfits"),
    )
    path = F.struct(F.lit("_file_path").alias("key"), F.col("file_path").alias("value"))
    rescue = F.to_json(F.map_from_entries(F.concat("misfits", F.array(path))))
    return placed.select(*names, F.when(F.size("misfits") > 0, rescue).alias(rescued))


def read_customer_files(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """The lines of customer files, each file once; ``customer_rows`` makes columns of a batch."""
    return read_lines(spark, path, **options)


def customer_rows(lines: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Raw customer rows of a batch of lines, stamped with their arrival."""
    rows = by_header(lines)
    return rows.select(
        *CUSTOMER_FILE.fieldNames(), instant(as_of).alias("ingestion_time"), RESCUED
    )
