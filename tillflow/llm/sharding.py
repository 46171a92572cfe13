"""Sharding by sampled splitters: shards of nearly equal bytes.

The key of a row is a hash of its text, so that equal texts are neighbours.
Keys are sampled in proportion to the rows' sizes; quantiles of the sample cut
the keys into many more ranges than there are shards. The exact bytes of each
range are then counted, and ranges that came out too full are subdivided: by
key, or by row where there is only one key. Ranges and their parts are laid
into the shards, the heaviest first, each into the lightest shard so far; the
parts of a text that is lighter than a shard stay together. A part holds a
small, even share of the rows, so the places inside a shard are numbered part
by part.

Everything is built of DataFrame functions; the texts are read and never moved.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillflow.llm.common import stored, text_of

ROW_BYTES = 16
RANGES_PER_SHARD = 128
SAMPLES_PER_RANGE = 8
FULL = 2.0


def _splitters(rows: DataFrame, total: int, ranges: int, per_range: int) -> list[int]:
    """Size-weighted sample quantiles of the keys.

    The sample has ``ranges * per_range`` keys on average whatever the input,
    and ``percentile_approx`` returns ``ranges - 1`` of them: both are bounded
    by parameters. A key that is a quantile twice is too heavy for one range
    and gets a range of its own.
    """
    wanted = ranges * per_range
    draw = F.pmod(F.xxhash64("row", "id", "key", F.lit(7)), F.lit(1 << 30)) / float(1 << 30)
    sample = rows.filter(draw * total < F.col("size") * wanted)
    steps = [i / ranges for i in range(1, ranges)]
    found = sample.agg(F.percentile_approx("key", steps, 10 * ranges).alias("q")).first()["q"]
    found = found or []
    twice = {a for a, b in zip(found, found[1:]) if a == b}
    after = {k + 1 for k in twice}
    return sorted({*found, *after})


def _laid(units: list[tuple[int, int, int]], shards: int) -> list[int]:
    """The shard of each (unit, part, bytes): whole units, heaviest first, into the lightest."""
    weights: dict[int, int] = {}
    for unit, _, weight in units:
        weights[unit] = weights.get(unit, 0) + weight
    loads = [(0, shard) for shard in range(shards)]
    place = {}
    for unit in sorted(weights, key=lambda u: (-weights[u], u)):
        load, shard = heapq.heappop(loads)
        place[unit] = shard
        heapq.heappush(loads, (load + weights[unit], shard))
    return [place[unit] for unit, _, _ in units]


def shard_by_bytes(
    docs: DataFrame,
    shards: int = 40,
    id_col: str = "doc_id",
    text_col: str = "text",
    ranges_per_shard: int = RANGES_PER_SHARD,
) -> DataFrame:
    """A row per row of ``docs``: id, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot``.

    ``size`` is the text's UTF-8 bytes plus 16. Shards are numbered from 0 and
    take nearly equal sums of ``size``; equal texts share a shard unless they
    are heavier than one. ``slot`` counts from 0 without gaps.

    * A null text has no bytes and goes with the empty ones.
    * Null and repeated ids are ordinary values; a heavy text is cut by row,
      whatever the ids.
    * A row larger than a shard takes one of its own.
    * An empty table gives no rows. Other columns are not looked at.
    """
    text = text_of(text_col)
    rows = stored(
        docs.select(
            F.col(id_col).alias("id"),
            (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("crc"),
            # 52 bits: quantiles are computed in doubles, and a cut has to be a key itself.
            F.shiftrightunsigned(F.xxhash64(text), 12).alias("key"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "shard-rows",
    )
    total = rows.agg(F.sum("size")).first()[0] or 0
    ranges = shards * ranges_per_shard
    cuts = _splitters(rows, total, ranges, SAMPLES_PER_RANGE)
    bounds = F.array(*map(F.lit, cuts)) if cuts else F.array().cast("array<bigint>")
    # Binary search: the number of cuts at or below the key.
    steps = [1 << i for i in reversed(range(max(1, len(cuts)).bit_length()))]
    at = F.aggregate(
        F.array(*map(F.lit, steps)),
        F.lit(0),
        lambda low, step: low
        + F.when(F.try_element_at(bounds, low + step) <= F.col("key"), step).otherwise(0),
    )
    ranged = rows.withColumn("range", at)
    sizes = ranged.groupBy("range").agg(
        F.sum("size").alias("bytes"),
        F.count("*").alias("n"),
        (F.min("key") == F.max("key")).alias("single"),
    )
    mean = max(1.0, total / ranges)
    # An overfull range is cut into parts of about the mean: between its keys, or inside its one.
    parts = sizes.select(
        "range",
        "single",
        (F.col("single") & (F.col("bytes") <= total / shards)).alias("whole"),
        F.when(
            F.col("bytes") > FULL * mean, F.least(F.ceil(F.col("bytes") / mean), F.col("n"))
        )
        .otherwise(1)
        .cast("int")
        .alias("parts"),
    )
    cut = F.when(F.col("single"), F.xxhash64("row", "id", F.lit(11))).otherwise(
        F.xxhash64("key", F.lit(11))
    )
    # A row per range, at most twice as many as asked for: small enough to broadcast at any
    # size of the input, so that a text with a third of all rows is not gathered.
    placed = stored(
        ranged.join(F.broadcast(parts), "range").withColumn(
            "part", F.when(F.col("parts") == 1, 0).otherwise(F.pmod(cut, F.col("parts"))).cast("int")
        ),
        "shard-placed",
    )
    fine = placed.groupBy("range", "part").agg(
        F.sum("size").alias("bytes"), F.count("*").alias("n"), F.first("whole").alias("whole")
    )
    # One row per part of a range. The parts of a range are its bytes by the mean, so all
    # together are at most twice the ranges and one for each: bounded by the parameters.
    order = W.orderBy("range", "part")
    numbered = stored(fine.withColumn("number", F.row_number().over(order)), "shard-parts")
    # A unit is a part, or all parts of a text that fits one shard: named by its first part.
    of_text = F.min("number").over(W.partitionBy("range"))
    unit = F.when(F.col("whole"), of_text).otherwise(F.col("number"))
    units = numbered.select(unit.alias("unit"), "number", "bytes").orderBy("number").collect()
    shard_of = _laid([tuple(r) for r in units], shards)
    chosen = F.array(*map(F.lit, shard_of)) if shard_of else F.array().cast("array<int>")
    laid = numbered.withColumn("shard", F.try_element_at(chosen, F.col("number")))
    in_shard = W.partitionBy("shard").orderBy("range", "part")
    laid = laid.select(
        "range",
        "part",
        "shard",
        F.coalesce(
            F.sum("n").over(in_shard.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)
        ).alias("first_slot"),
    )
    inside = W.partitionBy("range", "part").orderBy("key", "id", "size", "crc", "row")
    places = placed.withColumn("place", F.row_number().over(inside) - 1)
    return places.join(F.broadcast(laid), ["range", "part"]).select(
        F.col("id").alias(id_col),
        "size",
        F.col("crc").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("first_slot") + F.col("place")).cast("long").alias("slot"),
    )
