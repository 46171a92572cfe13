"""A manifest of a dataset as Merkle trees, with a proof for each row.

Every node carries the interval of leaf ranks that it covers: a leaf [r, r+1),
a node the union of its children. With that label, ancestors need no pointers:
they are the nodes whose interval contains the leaf's. Levels are joined in
bands; inside a band, a node and all its descendants fall into one bucket of
ranks, so a containment join only meets a bucket of bounded size, and the
nodes above a band are attached once to each of its top nodes. The siblings
of a node are what its parent's interval has beyond its own.

No task holds more than a bucket, and rows with proofs are never shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillflow.llm.common import stored

ARITY = 2
#: Levels of a band: a bucket has at most ``ARITY ** BAND`` items and about twice as many nodes.
BAND = 6
_SIBLINGS = "array<struct<level:int,before:string,after:string>>"


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of the parts, concatenated."""
    return F.sha2(F.concat(*parts), 256)


def field_text(column: Column) -> Column:
    """``-`` for null, else the UTF-8 length, a colon and the value as text."""
    text = column.cast("string")
    sized = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    return F.coalesce(sized, F.lit("-"))


def ranked(rows: DataFrame, tree: str, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``rank`` from 0 inside each tree by ``order``, and ``n``, the tree's rows.

    Ranges of (tree, order) are sorted apart from each other; what lies before
    a range is a sum over ranges. ``order`` should tell all rows apart, so that
    a hot value can be cut anywhere.
    """
    keys = [tree, *order]
    ranges = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = stored(ranges.withColumn("_at", F.monotonically_increasing_id()), "merkle-ranges")
    placed = placed.withColumn("_range", F.shiftright("_at", 33))
    # A row per range and tree: as many as ranges and trees together.
    counted = placed.groupBy(tree, "_range").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    before = W.partitionBy(tree).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    counted = counted.select(
        tree,
        "_range",
        "_first",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_n").over(W.partitionBy(tree)).alias("n"),
    )
    met = placed.join(counted, [tree, "_range"])
    rank = F.col("_at") - F.col("_first") + F.col("_before")
    return met.select(*rows.columns, "n", rank.alias("rank"))


def _power(arity: int, level: Column | int) -> Column:
    return F.pow(F.lit(arity), F.lit(level) if isinstance(level, int) else level).cast("long")


def _band(items: DataFrame, base: int, arity: int, band: int) -> DataFrame:
    """The nodes of the levels ``base`` to ``base + band`` over its items.

    ``items``: tree, ``n`` (leaves of the tree), ``lo``, ``hash``, all of level
    ``base``. A node: tree, ``n``, ``bucket``, ``level``, ``lo``, ``hi``,
    ``hash`` and its siblings' hashes, ``before`` and ``after`` it; these are
    null for a root and for the top of the band, which the next one takes up.
    """
    width, fan = arity**base, arity**band
    inside = F.expr(f"lo div {width * fan}").alias("bucket")
    buckets = (
        items.select("tree", "n", inside, "lo", "hash")
        .groupBy("tree", "bucket")
        .agg(
            F.first("n").alias("n"),
            F.sort_array(F.collect_list(F.struct("lo", "hash"))).alias("items"),
        )
    )
    whole = F.col("n") <= width * fan

    def parents(hashes: Column) -> Column:
        runs = F.sequence(F.lit(0), F.ceil(F.size(hashes) / arity).cast("int") - 1)
        return F.transform(
            runs, lambda i: F.sha2(F.array_join(F.slice(hashes, i * arity + 1, arity), ""), 256)
        )

    def rise(levels: Column, _: Column) -> Column:
        last = F.element_at(levels, -1)
        done = whole & (F.size(last) == 1)
        return F.when(done, levels).otherwise(F.concat(levels, F.array(parents(last))))

    levels = F.aggregate(
        F.sequence(F.lit(1), F.lit(band)),
        F.array(F.transform("items", lambda x: x["hash"])),
        rise,
    )
    risen = buckets.select("tree", "n", "bucket", F.posexplode(levels).alias("up", "hashes"))
    nodes = risen.select(
        "tree", "n", "bucket", "up", F.posexplode("hashes").alias("place", "hash")
    )
    reach = _power(arity, F.col("up")) * width
    nodes = nodes.withColumn("lo", F.col("bucket") * (width * fan) + F.col("place") * reach)
    nodes = nodes.withColumn("hi", F.least(F.col("lo") + reach, F.col("n")))
    # The parent's interval: the next longer one of this grid.
    longer = reach * arity
    nodes = nodes.withColumn("parent_lo", F.col("lo") - F.col("lo") % longer)
    family = nodes.groupBy("tree", "bucket", "up", "parent_lo").agg(
        F.first("n").alias("n"),
        F.sort_array(F.collect_list(F.struct("lo", "hi", "hash"))).alias("children"),
    )
    each = family.select(
        "tree", "n", "bucket", "up", "children", F.explode("children").alias("own")
    )

    def others(side) -> Column:
        beside = F.filter("children", side)
        text = F.array_join(F.transform(beside, lambda x: x["hash"]), "")
        root = (F.col("own.lo") == 0) & (F.col("own.hi") == F.col("n"))
        return F.when(~root & (F.col("up") < band), text)

    # The parent's interval without the node's own: what ends before it and what begins after.
    return each.select(
        "tree",
        "n",
        "bucket",
        (F.col("up") + base).alias("level"),
        "own.lo",
        "own.hi",
        "own.hash",
        others(lambda x: x["hi"] <= F.col("own.lo")).alias("before"),
        others(lambda x: x["lo"] >= F.col("own.hi")).alias("after"),
    )


def grow(leaves: DataFrame, arity: int = ARITY, band: int = BAND) -> list[DataFrame]:
    """The nodes of all trees, a table for each band of levels, leaves first.

    ``leaves``: ``tree``, ``n``, ``rank``, ``hash``. The rows of all tables
    together are about twice the leaves (and the tops of bands, twice).
    """
    most = leaves.agg(F.max("n")).first()[0] or 0
    items = leaves.select("tree", "n", F.col("rank").alias("lo"), "hash")
    bands = []
    while True:
        base = band * len(bands)
        bands.append(stored(_band(items, base, arity, band), "merkle-nodes"))
        if most <= arity ** (base + band):
            return bands
        top = F.col("level") == base + band
        items = bands[-1].filter(top & (F.col("n") > arity ** (base + band))).select(
            "tree", "n", "lo", "hash"
        )


def tree_roots(bands: Sequence[DataFrame]) -> DataFrame:
    """``tree``, ``n`` and ``hash`` of the node that covers the whole tree."""
    covering = (F.col("lo") == 0) & (F.col("hi") == F.col("n"))
    roots = None
    for nodes in bands:
        found = nodes.filter(covering).select("tree", "n", "hash")
        roots = found if roots is None else roots.unionByName(found)
    return roots


def with_siblings(
    leaves: DataFrame,
    bands: Sequence[DataFrame],
    above: DataFrame | None = None,
    arity: int = ARITY,
    band: int = BAND,
) -> DataFrame:
    """``leaves`` with ``siblings``: level, hashes before and after, from the leaf upwards.

    ``above`` (``tree``, ``subroot``, ``more``) is put behind the siblings of
    all leaves of a tree; ``subroot`` goes along. From the top band down, the items of a band meet its nodes by
    bucket and containment, and what was found for their bucket's top.
    """
    empty = F.array().cast(_SIBLINGS)
    found = None
    for number in reversed(range(len(bands))):
        base = band * number
        cell, width = arity ** (base + band), arity**base
        nodes = bands[number]
        if number == 0:
            items = leaves.withColumn("lo", F.col("rank"))
        else:
            items = nodes.filter(F.col("level") == base).select("tree", "n", "lo")
        own = [c for c in items.columns if c not in ("tree", "lo")]
        items = items.select(
            "tree",
            F.expr(f"lo div {cell}").alias("bucket"),
            "lo",
            F.least(F.col("lo") + width, F.col("n")).alias("hi"),
            F.struct(*own).alias("own"),
        )
        carried = nodes.filter("before is not null").select(
            "tree",
            "bucket",
            F.struct("level", "before", "after").alias("node"),
            F.col("lo").alias("node_lo"),
            F.col("hi").alias("node_hi"),
        )
        contained = (F.col("node_lo") <= F.col("lo")) & (F.col("hi") <= F.col("node_hi"))
        same = ["tree", "bucket"]
        met = items.alias("i").join(
            carried.alias("c"),
            (F.col("i.tree") == F.col("c.tree")) & (F.col("i.bucket") == F.col("c.bucket")) & contained,
            "left",
        )
        part = met.groupBy("i.tree", "i.bucket", "lo").agg(
            F.first("own").alias("own"),
            F.sort_array(F.collect_list("node")).cast(_SIBLINGS).alias("part"),
        )
        # What lies above the bucket: for trees that end in this band, ``above`` of the tree.
        tops = (
            bands[number]
            .filter((F.col("lo") == 0) & (F.col("hi") == F.col("n")))
            .select("tree", F.lit(0).cast("long").alias("bucket"))
        )
        if above is None:
            higher = tops.select(
                *same, F.lit(None).cast("string").alias("subroot"), empty.alias("more")
            )
        else:
            more = F.col("more").cast(_SIBLINGS).alias("more")
            higher = tops.join(above, "tree").select(*same, "subroot", more)
        if found is not None:
            higher = higher.unionByName(
                found.select(
                    "tree",
                    F.expr(f"lo div {cell}").alias("bucket"),
                    "subroot",
                    F.col("siblings").alias("more"),
                )
            )
        full = part.join(higher, same).select(
            "tree", "lo", "own.*", "subroot", F.concat("part", "more").alias("siblings")
        )
        if number == 0:
            return full.drop("lo")
        found = stored(full.select("tree", "lo", "subroot", "siblings"), "merkle-paths")
    raise ValueError("no bands")


def folded(leaf: Column, siblings: Column) -> Column:
    """The hash at the end of the path that begins with ``leaf``."""
    return F.aggregate(
        siblings, leaf, lambda own, level: digest(level["before"], own, level["after"])
    )


def proof_text(siblings: Column) -> Column:
    """The siblings' hashes level by level, left to right."""
    return F.array_join(
        F.transform(siblings, lambda level: F.concat(level["before"], level["after"])), ""
    )


def merkle_manifest(
    docs: DataFrame,
    fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    tree_col: str = "lang",
    order_col: str = "doc_id",
    changed: dict[str, Column] | None = None,
    arity: int = ARITY,
    band: int = BAND,
) -> DataFrame:
    """A row per row: ``order_col``, ``tree``, ``rank``, ``leaf``, ``changed_leaf``, ``subroot``,
    ``root``, ``siblings``.

    A leaf is the digest of ``fields``. Rows of one ``tree_col`` are a tree, in
    the order of ``order_col`` (nulls first; equal ones by leaf); its root is
    the ``subroot``. The subroots, in the order of ``tree_col`` (null first,
    bytewise), are the leaves of one more tree with the ``root``. ``siblings``
    goes from the leaf through the subroot to the root. ``changed`` has other
    expressions for some fields: ``changed_leaf`` is the leaf they give.

    * A null field is ``-`` in the leaf, an empty one ``0:``; texts are digested
      whole.
    * Null ids are the first leaves. Rows repeated in full are leaves of their
      own, beside each other.
    * An empty table gives no rows. Columns beyond these are not looked at.
    """

    def leaf_of(other: dict[str, Column]) -> Column:
        return digest(*[field_text(other.get(c, F.col(c))) for c in fields])

    kind = F.col(tree_col).cast("string")
    rows = docs.select(
        F.coalesce(F.concat(F.lit("="), kind), F.lit("")).alias("tree"),
        F.col(order_col).alias("id"),
        leaf_of({}).alias("leaf"),
        (leaf_of(changed) if changed else F.lit(None).cast("string")).alias("changed_leaf"),
        F.monotonically_increasing_id().alias("row"),
    )
    leaves = stored(
        ranked(stored(rows, "merkle-leaves"), "tree", ["id", "leaf", "row"]).drop("row"),
        "merkle-ranked",
    )
    bands = grow(leaves.select("tree", "n", "rank", F.col("leaf").alias("hash")), arity, band)
    subroots = tree_roots(bands).select(
        F.lit("").alias("tree"), F.col("tree").alias("subtree"), F.col("hash").alias("leaf")
    )
    upper = stored(ranked(stored(subroots, "merkle-subroots"), "tree", ["subtree"]), "merkle-trees")
    upper_bands = grow(upper.select("tree", "n", "rank", F.col("leaf").alias("hash")), arity, band)
    top = tree_roots(upper_bands).first()
    above = with_siblings(upper, upper_bands, None, arity, band).select(
        F.col("subtree").alias("tree"),
        F.col("leaf").alias("subroot"),
        F.col("siblings").alias("more"),
    )
    paths = with_siblings(leaves, bands, stored(above, "merkle-above"), arity, band)
    return paths.select(
        F.col("id").alias(order_col),
        "tree",
        "rank",
        "leaf",
        "changed_leaf",
        "subroot",
        F.lit(top["hash"] if top else None).cast("string").alias("root"),
        "siblings",
    )
