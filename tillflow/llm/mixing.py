"""Mixing sources to target weights by fitting word budgets.

Documents are counted by source and exact length. A source whose target is
more than all its words takes each document once and fits the rest with second
copies. The budget is spent in three steps on the table of lengths alone: the
same share of every length, then the longest lengths that still fit, then a
bounded-knapsack program over the last words, which gives back some of what the
first steps took where that comes nearer to the budget. The outcome is a number
of documents for each source and length; which ones, a seeded hash of id and
text decides.

Hot lengths: documents of one source and length are also counted by the first
bits of their hash. Whole hash buckets are taken by the running sum of these
counts; only the documents of the one bucket that a limit falls into are
ordered, so no group has to be in one task.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillflow.llm.common import WORD, stored, text_of

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_REPEATS = 2
BUCKETS = 1024
LAST_WORDS = 1 << 15


def mixture_targets(
    sources: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    max_repeats: int = MAX_REPEATS,
) -> DataFrame:
    """``target`` for each row of (``source``, ``source_size``).

    Sources in the order of their code points, null last, take the weights in
    turn and share ``share`` of all sizes; a target stops at ``max_repeats``
    times its source's size, and what is above goes to the others by weight.
    That is one water level: target = min(cap, weight * level). Sorted by
    cap / weight, the sources below the level come first, so running sums
    find it. There is a row per source, so this is small next to the texts.
    """
    places = W.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    turns = F.array(*[F.lit(float(w)) for w in weights])
    ranked = sources.withColumn("place", F.row_number().over(places) - 1).select(
        "source",
        "source_size",
        F.get(turns, (F.col("place") % len(weights)).cast("int")).alias("weight"),
        (F.col("source_size") * float(max_repeats)).alias("cap"),
        "place",
    )
    up = W.orderBy(F.col("cap") / F.col("weight"), "place")
    everything = W.partitionBy()
    before = F.coalesce(F.sum("cap").over(up.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    left = F.sum("weight").over(up.rowsBetween(0, W.unboundedFollowing))
    leveled = (
        ranked.withColumn("whole", F.sum("source_size").over(everything) * float(share))
        .withColumn("level", (F.col("whole") - before) / left)
        .withColumn("open", F.col("level") <= F.col("cap") / F.col("weight"))
    )
    # The first source whose cap is not reached tells the level of all.
    rank = F.when(F.col("open"), F.struct(F.col("cap") / F.col("weight"), "place"))
    level = F.min_by("level", rank).over(everything)
    target = F.least("cap", F.col("weight") * level)
    return leveled.select(
        "source", "source_size", F.coalesce(target, F.col("cap")).alias("target")
    )


def _knapsack(lengths: np.ndarray, free: np.ndarray, left: int) -> np.ndarray:
    """How many of each length, at most ``free``, sum to the most words up to ``left``.

    A bounded knapsack over the sums 0 to ``left``: a length available c times
    is offered in lots of 1, 2, 4 ... and the rest, from the shortest up.
    """
    reached = np.zeros(left + 1, dtype=bool)
    reached[0] = True
    by = np.full(left + 1, -1, dtype=np.int32)
    lots: list[tuple[int, int]] = []
    for i in np.argsort(lengths, kind="stable"):
        length = int(lengths[i])
        if reached[left] or length > left:
            break
        more = min(int(free[i]), left // length)
        lot = 1
        while more > 0 and not reached[left]:
            lot = min(lot, more)
            words = lot * length
            new = np.zeros_like(reached)
            new[words:] = reached[: left + 1 - words]
            new &= ~reached
            by[new] = len(lots)
            reached |= new
            lots.append((int(i), lot))
            more -= lot
            lot *= 2
    taken = np.zeros(len(lengths), dtype=np.int64)
    best = int(np.flatnonzero(reached).max())
    while best > 0:  # each sum was reached first by a later lot than its remainder
        i, lot = lots[by[best]]
        taken[i] += lot
        best -= lot * int(lengths[i])
    return taken


def _given_back(lengths: np.ndarray, taken: np.ndarray, words: int) -> np.ndarray:
    """How many of each length to give back, at most ``words`` in all: an equal
    share for each length, what one can't use going to the longer ones."""
    back = np.zeros_like(taken)
    order = [i for i in np.argsort(lengths, kind="stable") if taken[i] > 0]
    for place, i in enumerate(order):
        back[i] = min(int(taken[i]), words // (len(order) - place) // int(lengths[i]))
        words -= int(back[i] * lengths[i])
    return back


def fit_budget(
    lengths: np.ndarray, counts: np.ndarray, budget: int, last_words: int = LAST_WORDS
) -> np.ndarray:
    """How many of each length (distinct, positive) to take: their words sum to
    the budget, or to the nearest sum below it.

    The knapsack runs over at most ``last_words`` sums, so its memory doesn't
    depend on the input. Where the documents left over don't fit the words left
    over, some that were taken are given back and chosen anew, twice as many
    words each time. Up to a budget of ``last_words`` the last try gives back
    everything, so no other choice comes nearer; beyond it none does that
    differs by the documents given back in the last try.
    """
    lengths, counts = lengths.astype(np.int64), counts.astype(np.int64)
    whole = int((lengths * counts).sum())
    if budget >= whole:
        return counts.copy()
    if budget <= 0:
        return np.zeros_like(counts)
    # The same share of every length. The quotient is in whole numbers, so no
    # rounding can take more than the budget.
    taken = np.array([int(c) * budget // whole for c in counts], dtype=np.int64)
    left = budget - int((lengths * taken).sum())
    # From the longest down, but leave the knapsack something to fit; where too
    # many words are left for it then, without leaving anything.
    for spare in (last_words // 2, 0):
        for i in np.argsort(-lengths, kind="stable"):
            if not spare and left <= last_words:
                break
            more = min(int(counts[i] - taken[i]), max(0, left - spare) // int(lengths[i]))
            taken[i] += more
            left -= more * int(lengths[i])
    best, missing, words = taken, left, 0
    while True:
        tried = taken - _given_back(lengths, taken, words)
        short = budget - int((lengths * tried).sum())
        tried = tried + _knapsack(lengths, counts - tried, min(short, last_words))
        short = budget - int((lengths * tried).sum())
        if short < missing:
            best, missing = tried, short
        most = min(budget, last_words) - left
        if missing == 0 or words >= most:
            return best
        words = min(most, max(2 * words, 2 * left, 64))


def _fit(group: pd.DataFrame) -> pd.DataFrame:
    """Of one source: a row per length. Distinct lengths are few: n of them need n*n/2 words."""
    target, size = float(group["target"].iloc[0]), int(group["source_size"].iloc[0])
    rounds = int(target // size) if size else 0
    budget = int(round(target)) - rounds * size
    lengths, counts = group["size"].to_numpy(), group["n"].to_numpy()
    more = fit_budget(lengths, counts, budget)
    out = group[["source", "size"]].copy()
    out["rounds"] = rounds
    out["more"] = more
    return out


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    max_repeats: int = MAX_REPEATS,
    seed: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    row_col: str | None = None,
) -> DataFrame:
    """A row per row of ``docs``: id, ``size``, ``source``, ``source_size``, ``target``, ``taken``.

    ``size`` is the number of words, ``taken`` the words the mix takes of the
    row: ``size`` times 0 to ``max_repeats``. A column ``row_col`` is returned
    too; it decides nothing.

    * A null text has no words; rows without words are never taken.
    * A null source is a source of its own, the last one.
    * Rows are drawn by a hash of id and text, so null and repeated ids are told
      apart by their texts; of rows equal in both, any takes the part of a limit
      that falls among them.
    * An empty table gives no rows; sources without words have target 0.
    * The same rows give the same mix, however they are partitioned.
    """
    rows = docs.select(
        *([F.col(row_col).alias("row")] if row_col else []),
        F.col(id_col).alias("id"),
        F.col(source_col).cast("string").alias("source"),
        F.regexp_count(text_of(text_col), F.lit(WORD)).cast("long").alias("size"),
        F.xxhash64(id_col, text_of(text_col), F.lit(seed)).alias("draw"),
    )
    bucket = F.pmod("draw", F.lit(BUCKETS)).cast("int")
    rows = stored(rows.withColumn("bucket", bucket), "mix-rows")
    by_bucket = stored(
        rows.groupBy("source", "size", "bucket").agg(F.count("*").alias("n")), "mix-counts"
    )
    by_length = by_bucket.groupBy("source", "size").agg(F.sum("n").alias("n"))
    sizes = by_length.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    targets = stored(mixture_targets(sizes, weights, share, max_repeats), "mix-targets")

    def same_source(left, right):
        return left["source"].eqNullSafe(right["source"])

    some = by_length.filter("size > 0")
    planned = some.join(targets, same_source(some, targets)).select(
        some["source"], "size", "n", "source_size", "target"
    )
    plan = stored(
        planned.groupBy("source").applyInPandas(
            _fit, "source string, size bigint, rounds bigint, more bigint"
        ),
        "mix-plan",
    )
    # Buckets below the limit are taken whole; the limit falls into one bucket.
    earlier = F.coalesce(
        F.sum("n").over(
            W.partitionBy("source", "size")
            .orderBy("bucket")
            .rowsBetween(W.unboundedPreceding, -1)
        ),
        F.lit(0),
    )
    running = by_bucket.filter("size > 0").withColumn("earlier", earlier)
    limits = stored(
        running.join(plan, same_source(running, plan) & (running["size"] == plan["size"])).select(
            running["source"].alias("l_source"),
            running["size"].alias("l_size"),
            F.col("bucket").alias("l_bucket"),
            "rounds",
            F.least(F.greatest(F.col("more") - F.col("earlier"), F.lit(0)), F.col("n")).alias(
                "of_bucket"
            ),
            "n",
        ),
        "mix-limits",
    )
    placed = rows.join(
        limits,
        F.col("source").eqNullSafe(F.col("l_source"))
        & (F.col("size") == F.col("l_size"))
        & (F.col("bucket") == F.col("l_bucket")),
        "left",
    ).drop("l_source", "l_size", "l_bucket")
    split = (F.col("of_bucket") > 0) & (F.col("of_bucket") < F.col("n"))
    whole = placed.filter(~F.coalesce(split, F.lit(False))).withColumn(
        "extra", F.when(F.col("of_bucket") > 0, 1).otherwise(0)
    )
    order = W.partitionBy("source", "size", "bucket").orderBy("draw", "id")
    ordered = (
        placed.filter(split)
        .withColumn("extra", F.when(F.row_number().over(order) <= F.col("of_bucket"), 1).otherwise(0))
    )
    decided = whole.unionByName(ordered)
    return decided.join(targets, same_source(decided, targets)).select(
        *([F.col("row").alias(row_col)] if row_col else []),
        F.col("id").alias(id_col),
        "size",
        decided["source"].alias(source_col),
        "source_size",
        "target",
        (F.col("size") * (F.coalesce("rounds", F.lit(0)) + F.col("extra"))).alias("taken"),
    )
