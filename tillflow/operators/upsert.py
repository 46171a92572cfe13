"""Upsert by key with the meaning of MERGE: update all, insert all."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AMBIGUOUS = "upsert: several source rows match one target key"


def merge_upsert(
    target: DataFrame | None,
    source: DataFrame,
    keys: Sequence[str] = ("transaction_id",),
    on_ambiguous: str = "error",
    null_keys_match: bool = False,
) -> DataFrame:
    """Every target row whose key is in the source becomes a copy of that source
    row; source rows of unknown keys are added, all of them; the rest stays.

    Without a target (None) no key is known, and all source rows are added.
    Two source rows for one known key end the query. ``on_ambiguous`` may name
    a column instead: then the row with its greatest value is taken, of equal
    values the greatest by all columns. NULL keys match nothing, and pass by
    the join; ``null_keys_match`` compares them like values.

    Matching, counting and adding are one full join on the keys, so a target
    that is bucketed by them is not shuffled. The source is read twice. With
    ``on_ambiguous`` the rows to add are a second join, against the target's
    keys only.
    """
    if target is None:
        return source
    keys = list(keys)
    columns = target.columns
    present = F.lit(True)
    if not null_keys_match:
        for k in keys:
            present = present & F.col(k).isNotNull()

    def same(theirs: str) -> Column:
        found = F.lit(True)
        for k in keys:
            mine, other = F.col(k), F.col(f"{theirs}{k}")
            found = found & (mine.eqNullSafe(other) if null_keys_match else mine == other)
        return found

    def named(prefix: str) -> list[Column]:
        return [F.col(k).alias(f"{prefix}{k}") for k in keys]

    incoming = source.select(*columns)
    keyed = incoming.filter(present)
    if on_ambiguous == "error":
        counts = keyed.groupBy(*named("_count_")).agg(F.count("*").alias("_n"))
        counted = keyed.join(counts, same("_count_"))
        offered = counted.select(*named("_key_"), "_n", F.struct(*columns).alias("_new"))
    else:
        newest = F.max(F.struct(F.col(on_ambiguous).alias("_order"), *columns))
        offered = keyed.groupBy(*named("_key_")).agg(newest.alias("_new"), F.lit(1).alias("_n"))
    known = target.filter(present).withColumn("_known", F.lit(True))
    matched = known.join(offered, same("_key_"), "full" if on_ambiguous == "error" else "left")
    # In the projection, not in a filter: the optimizer cannot move it anywhere else.
    several = F.col("_known").isNotNull() & (F.col("_n") > 1)
    new = F.when(several, F.raise_error(F.lit(AMBIGUOUS)).cast("boolean")).otherwise(
        F.col("_n").isNotNull()
    )
    merged = matched.select(
        *[F.when(new, F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) for c in columns]
    )
    if on_ambiguous != "error":
        there = known.select(*named("_key_")).distinct()
        merged = merged.unionByName(keyed.join(there, same("_key_"), "left_anti"))
    if null_keys_match:
        return merged
    return merged.unionByName(target.filter(~present)).unionByName(incoming.filter(~present))
