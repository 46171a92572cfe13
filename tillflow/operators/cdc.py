"""Change data capture: the current state (type 1) and the history (type 2) of keys.

A key may have any number of changes. The current state is a maximum, which is
partly computed before the shuffle. The history needs each change's successor:
every timeline is cut into fixed stretches of time, successors are found inside
a stretch, and the first change of each later stretch is looked up in a small
table of stretches. A task never holds more than one stretch of a key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

VALID_FROM = "valid_from"
VALID_TO = "valid_to"
STRETCH_SECONDS = 30 * 24 * 3600


def greatest_row(
    rows: DataFrame, groups: Sequence[str], first: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """One row per group: the greatest by ``first``, then by all columns in order.

    A maximum over a total order doesn't depend on the order of arrival.
    """
    best = F.max(F.struct(*[F.col(c).alias(f"_{c}") for c in first], F.struct(*columns).alias("_row")))
    taken = rows.groupBy(*[F.col(g).alias(f"_group_{g}") for g in groups]).agg(best.alias("_best"))
    return taken.select(*[F.col(f"_best._row.{c}").alias(c) for c in columns])


def apply_scd1(
    target: DataFrame | None,
    changes: DataFrame,
    keys: Sequence[str] = ("customer_id",),
    sequence_by: str = "ingestion_time",
    tie_break: Sequence[str] = ("updated_at",),
    except_cols: Sequence[str] = (),
) -> DataFrame:
    """The row with the greatest sequence per key of the target and the changes.

    Late changes with a lower sequence are thus ignored. Ties are broken by
    ``tie_break``, then by all columns. A NULL sequence is below any other;
    rows with NULL keys share one key.
    """
    columns = [c for c in changes.columns if c not in except_cols]
    rows = changes.select(*columns)
    if target is not None:
        rows = target.select(*columns).unionByName(rows)
    return greatest_row(rows, keys, [sequence_by, *tie_break], columns)


def stretch_of(sequence: str, kind: T.DataType, seconds: int) -> Column:
    """The number of the stretch of time, or of numbers, that a value falls into."""
    if isinstance(kind, T.DateType | T.TimestampType | T.TimestampNTZType):
        return F.floor(F.unix_timestamp(F.col(sequence).cast("timestamp")) / seconds)
    return F.floor(F.col(sequence) / seconds)


def _beside(
    rows: DataFrame,
    keys: Sequence[str],
    sequence: str,
    stretch: Column,
    value: Column,
    forward: bool,
    name: str,
) -> DataFrame:
    """``name``: ``value`` of the next (or the last) row of the key's whole timeline."""
    # As a struct, keys with NULLs in them are equal, and the join needs no other partitioning
    # than the window has.
    cut = rows.withColumns({"_key": F.struct(*keys), "_value": value, "_stretch": stretch})
    inside = W.partitionBy("_key", "_stretch").orderBy(sequence)
    edge, step = (F.min_by, F.lead) if forward else (F.max_by, F.lag)
    edges = cut.groupBy("_key", "_stretch").agg(edge("_value", sequence).alias("_edge"))
    # A row per key and stretch: as many as the time spans, however many changes there are.
    along = W.partitionBy("_key").orderBy("_stretch")
    edges = edges.select("_key", "_stretch", step("_edge").over(along).alias("_over"))
    near = cut.select(
        *rows.columns,
        "_key",
        "_stretch",
        step("_value").over(inside).alias("_near"),
        (step(F.lit(1)).over(inside)).isNull().alias("_at_edge"),
    )
    met = near.join(edges, ["_key", "_stretch"])
    return met.select(
        *rows.columns,
        F.when(F.col("_at_edge"), F.col("_over")).otherwise(F.col("_near")).alias(name),
    )


def apply_scd2(
    history: DataFrame | None,
    changes: DataFrame,
    keys: Sequence[str] = ("customer_id",),
    sequence_by: str = "ingestion_time",
    tie_break: Sequence[str] = ("updated_at",),
    track_cols: Sequence[str] | None = None,
    except_cols: Sequence[str] = (),
    stretch: int = STRETCH_SECONDS,
) -> DataFrame:
    """All versions of each key with ``valid_from`` and ``valid_to`` (NULL: current).

    Every change opens a version and closes the one before it, wherever in the
    order it arrives; of changes with one key and sequence one is taken, by
    ``tie_break`` and then all columns. With ``track_cols``, a change that
    differs in none of these from the version before it opens none. That needs
    all changes again, so a history kept with ``track_cols`` has only the
    changes that opened a version; late changes are placed among these.

    The history is read once, joined with nothing, and all of it is ordered;
    ``history.scd2_patch`` gives only the versions that changes touch. Rows
    without a sequence cannot be placed and are left out. ``stretch`` bounds
    the work of a task and never changes the result.
    """
    columns = [c for c in changes.columns if c not in except_cols]
    keys = list(keys)
    rows = changes.select(*columns)
    if history is not None:
        rows = history.select(*columns).unionByName(rows)
    rows = greatest_row(
        rows.filter(F.col(sequence_by).isNotNull()), [*keys, sequence_by], tie_break, columns
    )
    cut = stretch_of(sequence_by, changes.schema[sequence_by].dataType, stretch)
    if track_cols is not None:
        tracked = F.struct(*track_cols)
        compared = _beside(rows, keys, sequence_by, cut, tracked, False, "_before")
        differs = F.col("_before").isNull() | ~F.col("_before").eqNullSafe(tracked)
        rows = compared.filter(differs).select(*columns)
    return _beside(rows, keys, sequence_by, cut, F.col(sequence_by), True, VALID_TO).select(
        *columns, F.col(sequence_by).alias(VALID_FROM), VALID_TO
    )
