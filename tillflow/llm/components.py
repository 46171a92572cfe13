"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, for edges (``a``, ``b``).

    Each round hangs the neighbours of a node onto the smallest among them;
    the number of rounds is about the logarithm of the longest chain. A node
    with many neighbours is reduced to their minimum before the shuffle. Edges
    from a node to itself are ignored, so such nodes may be absent.
    """
    hi, lo = F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")
    now = stored(edges.filter("a <> b").select(hi, lo).distinct(), "stars")
    state = None
    while True:
        seen = now.agg(F.count("*"), F.bit_xor(F.xxhash64("hi", "lo"))).first()
        if tuple(seen) == state:
            break
        state = tuple(seen)
        both = now.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
            now.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        )
        # Stored, so that the join can split a node with many neighbours.
        least = stored(
            both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")),
            "stars-least",
        )
        large = stored(
            both.join(least, "u")
            .filter("v > u")
            .select(F.col("v").alias("hi"), F.col("m").alias("lo"))
            .distinct(),
            "stars-large",
        )
        least = stored(large.groupBy("hi").agg(F.min("lo").alias("m")), "stars-least")
        met = large.join(least, "hi")
        small = met.select(F.col("lo").alias("hi"), F.col("m").alias("lo")).filter(
            "hi <> lo"
        ).unionByName(met.select("hi", F.col("m").alias("lo")))
        now = stored(small.distinct(), "stars")
    roots = now.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionByName(roots)
