"""A history patched where changes arrive: the versions beside them, and no others.

``cdc.apply_scd2`` orders all changes of a history anew. Here the neighbours
of each change are looked up instead: only keys and times of the history are
read for it, and of these only the stretches of time that changes fall into,
with the first and last version of the others. What comes out are the
versions to write: new ones, and those whose end or content is another now.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillflow.operators.cdc import (
    STRETCH_SECONDS,
    VALID_FROM,
    VALID_TO,
    greatest_row,
    stretch_of,
)


def _neighbours(old: DataFrame, new: DataFrame) -> DataFrame:
    """``_key``, ``_seq``, ``_new``, ``_next`` of new times, and of old ones before a new one.

    ``old`` and ``new`` have ``_key``, ``_seq`` and ``_stretch``. ``_next`` is
    the next time of the key among both.
    """
    touched = new.select("_key", "_stretch").distinct()
    points = old.withColumn("_new", F.lit(False)).unionByName(new.withColumn("_new", F.lit(True)))
    lowest = F.min(F.struct("_seq", "_new"))
    ends = points.groupBy("_key", "_stretch").agg(
        lowest.alias("_lo"), F.max(F.struct("_seq", "_new")).alias("_hi")
    )
    # A row per key and stretch: as many as the time spans, however many versions there are.
    along = W.partitionBy("_key").orderBy("_stretch")
    ends = ends.withColumn("_after", F.lead("_lo").over(along))
    inside = W.partitionBy("_key", "_stretch").orderBy("_seq")
    near = points.join(touched, ["_key", "_stretch"], "left_semi")
    near = near.withColumn("_beside", F.lead(F.struct("_seq", "_new")).over(inside))
    met = near.join(ends.select("_key", "_stretch", "_after"), ["_key", "_stretch"]).select(
        "_key", "_seq", "_new", F.coalesce("_beside", "_after").alias("_following")
    )
    # The last version of a stretch without changes may have its successor in one with some.
    apart = ends.join(touched, ["_key", "_stretch"], "left_anti").select(
        "_key", "_hi._seq", "_hi._new", F.col("_after").alias("_following")
    )
    moved = met.unionByName(apart).filter(F.col("_new") | F.col("_following._new"))
    return moved.select("_key", "_seq", "_new", F.col("_following._seq").alias("_next"))


def scd2_patch(
    history: DataFrame,
    changes: DataFrame,
    keys: Sequence[str] = ("customer_id",),
    sequence_by: str = "ingestion_time",
    tie_break: Sequence[str] = ("updated_at",),
    except_cols: Sequence[str] = (),
    stretch: int = STRETCH_SECONDS,
    keep: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """The versions that ``changes`` add to ``history``, or change in it.

    Upserted into the history by ``keys`` and ``valid_from``
    (``null_keys_match`` if keys may be NULL), they give what ``apply_scd2``
    gives; applied twice they add nothing. There are at most twice as many as
    changes. A change that meets a version of the same time takes its place if
    it is greater by ``tie_break`` and then all columns. Changes without a
    sequence can't be placed and are left out. ``stretch`` bounds the work of
    a task and never changes the result. ``keep`` may persist or store what is
    read several times, which is no larger than the changes.
    """
    keep = keep or (lambda rows: rows)
    columns = [c for c in changes.columns if c not in except_cols]
    keys = list(keys)
    kind = changes.schema[sequence_by].dataType

    def timed(rows: DataFrame, time: str) -> DataFrame:
        # As a struct, keys with NULLs in them are equal.
        return rows.withColumns({"_key": F.struct(*keys), "_seq": F.col(time)}).withColumn(
            "_stretch", stretch_of("_seq", kind, stretch)
        )

    def order(of: Column | None = None) -> Column:
        names = [*tie_break, *columns]
        return F.struct(*[F.col(c) if of is None else of[c] for c in names])

    known = changes.select(*columns).filter(F.col(sequence_by).isNotNull())
    arrived = timed(greatest_row(known, [*keys, sequence_by], tie_break, columns), sequence_by)
    arrived = keep(
        arrived.select("_key", "_seq", "_stretch", F.struct(*columns).alias("_change"))
    )
    times = timed(history, VALID_FROM)
    place = ["_key", "_seq"]
    concerned = times.join(arrived.select("_key").distinct(), "_key", "left_semi")
    old = concerned.select("_key", "_seq", "_stretch")
    # Versions that a change meets at the very same time.
    meeting = times.join(arrived.select("_key", "_seq", "_change"), place)
    greater = order(F.col("_change")) > order()
    replaced = meeting.filter(greater).select("_key", "_seq", "_change")
    new = keep(arrived.join(times.select(*place), place, "left_anti"))
    moved = keep(_neighbours(old, new.select("_key", "_seq", "_stretch")))
    opened = new.join(moved.filter("_new").select("_key", "_seq", "_next"), place).select(
        *[F.col(f"_change.{c}").alias(c) for c in columns],
        F.col("_seq").alias(VALID_FROM),
        F.col("_next").alias(VALID_TO),
    )
    closed = moved.filter("not _new").select("_key", "_seq", "_next", F.lit(True).alias("_closed"))
    notes = closed.join(replaced, place, "full")
    rewritten = times.join(notes, place).select(
        *[
            F.when(F.col("_change").isNotNull(), F.col(f"_change.{c}")).otherwise(F.col(c)).alias(c)
            for c in columns
        ],
        VALID_FROM,
        F.when(F.col("_closed"), F.col("_next")).otherwise(F.col(VALID_TO)).alias(VALID_TO),
    )
    return opened.unionByName(rewritten)
