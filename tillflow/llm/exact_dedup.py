"""Exact deduplication by radix partitioning from the most significant byte.

Documents are split by successive bytes of their text. A digit is a run of
bytes, 64 at first and eight times as many at each following level, so that
the number of levels is the logarithm of the longest text. A group is done
when it has one member or when its text ended inside the digit; only what is
left of the other texts goes on. Equality is that of the bytes: no digest
decides anything.

Hot groups: the members of a group are counted before the shuffle, a row per
task and digit, and the documents meet the counts in a join, whose large
partitions adaptive execution splits. No group is gathered anywhere.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.llm.common import ascii_lower, stored, text_of

FIRST_DIGIT = 64
WIDENING = 8


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    first_digit: int = FIRST_DIGIT,
    widening: int = WIDENING,
) -> DataFrame:
    """A row per row of ``docs``: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when they are identical after lower-casing A-Z; of equal
    texts the row with the largest id stays.

    * A null text counts as empty; empty texts are equal to one another.
    * Rows that repeat an id and its text count in ``group_size``; exactly one
      of them is kept. Rows with one id and different texts are apart.
    * A null id is smaller than any other; ``keep_id`` is null where all of a
      group's ids are.
    * An empty table gives no rows. Other columns are not looked at.
    """
    open_rows = docs.select(
        F.col(id_col).alias("id"),
        F.lit(0).cast("long").alias("part"),
        ascii_lower(text_of(text_col)).cast("binary").alias("rest"),
    ).withColumn("sha", F.sha2("rest", 256))
    levels: list[DataFrame] = []
    width = first_digit
    while True:
        cut = open_rows.withColumn("digit", F.substring("rest", 1, width))
        # Groups of several members get a number; the rest has no partner below.
        groups = (
            cut.groupBy("part", "digit")
            .agg(F.count("*").alias("n"), F.max("id").alias("keep"))
            .filter("n > 1")
        )
        groups = stored(
            groups.withColumn("next_part", F.monotonically_increasing_id()), "radix-groups"
        )
        goes_on = F.col("n").isNotNull() & (F.length("digit") == width)
        # Always by a sorted shuffle: the texts move once, at every size alike.
        split = cut.join(groups.hint("merge"), ["part", "digit"], "left").select(
            F.col("row") if levels else F.monotonically_increasing_id().alias("row"),
            "id",
            "sha",
            "n",
            "keep",
            F.col("next_part").alias("part"),
            goes_on.alias("goes_on"),
            F.when(goes_on, F.expr(f"substring(rest, {width + 1})")).alias("rest"),
        )
        level = stored(split, "radix-level")
        levels.append(
            level.filter(~F.col("goes_on"))
            .select("row", "id", "sha", "n", "keep", "part")
            .withColumn("level", F.lit(len(levels)))
        )
        open_rows = level.filter("goes_on").select("row", "id", "part", "rest", "sha")
        if open_rows.isEmpty():
            break
        width *= widening
    done = reduce(DataFrame.unionByName, levels)
    out = [
        F.col("id").alias(id_col),
        F.when(F.col("n").isNull(), F.col("id")).otherwise(F.col("keep")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        F.col("kept"),
        F.col("sha").alias("text_sha256"),
    ]
    single = done.filter("n is null").withColumn("kept", F.lit(True))
    several = done.filter("n is not null")
    largest = F.col("id").eqNullSafe(F.col("keep"))
    smaller = several.filter(~largest).withColumn("kept", F.lit(False))
    # Of rows that repeat the largest id, the first one stays.
    stays = (
        several.filter(largest)
        .groupBy("level", "part")
        .agg(F.min("row").alias("row"))
        .select("row", F.lit(True).alias("kept"))
    )
    candidates = several.filter(largest).join(stays, "row", "left")
    candidates = candidates.withColumn("kept", F.coalesce("kept", F.lit(False)))
    return reduce(
        DataFrame.unionByName, [part.select(*out) for part in (single, smaller, candidates)]
    )
