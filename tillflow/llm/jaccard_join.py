"""Similarity join of word 5-gram sets by chosen paths.

A text is its set of 5-word shingles, two texts are linked where the Jaccard
similarity of their sets is 0.8 or more. Sets are embedded as 64 minhash
values, of which two sets share as large a part as they are similar. A run
splits all sets on a sampled value: sets with the same value share a bucket.
Buckets of several sets are split again in the same way, by one or two sampled
values so that a similar pair stays together on one path on average, until
they are small. Small buckets are compared pair by pair on their values. Runs
with other samples are repeated as often as the target recall needs.

What a bucket finds is only a candidate: candidates are joined to clusters,
and within a cluster the exact similarity of all pairs decides. Large clusters
are cut into blocks, and a task compares two blocks, so a cluster of any size
is spread over many tasks; pairs are counted there and never become rows. Most
shingles of a cluster are in one text or in the very same texts as others, and
cost no column of their own.

Equal texts are one node of all this and are counted before any shuffle.
"""

from __future__ import annotations

import hashlib
import math
import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.llm.common import stored, text_of
from tillflow.llm.components import components

SHINGLE = 5
SIMILARITY = 0.8
TARGET_RECALL = 0.99
VALUES = 64
LEAF = 32
DEPTH = 8
SECOND = 4  # one node in so many is split by a second value
STUCK = 0.75  # a bucket with this part of the one above is not split again
BLOCK_ROWS = 1024
BLOCK_SHINGLES = 2_000_000
CHUNK_BYTES = 1 << 17
CHUNK_WORDS = 1 << 13
PLACES = 64  # longer words have a hash of another kind
COLUMNS = 1 << 12
SPARSE = 256  # columns of so few pairs are added up pair by pair

_draw = random.Random(0)
_MULTIPLIERS = np.array([_draw.getrandbits(32) | 1 for _ in range(VALUES)], np.uint32)
_INVERSES = np.array([pow(int(m), -1, 1 << 32) for m in _MULTIPLIERS], np.uint32)
# A random number for each byte at each place of a word.
_BYTES = np.array([_draw.getrandbits(64) for _ in range(PLACES * 256)], np.uint64)
_NONE = np.zeros(0, np.uint8)


def words_of(text: str) -> list[bytes]:
    """Words between blanks, A-Z lower-cased."""
    return text.encode().lower().split()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    return (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def _word_hashes(low: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words ``low[begin:end]``, sums of a number for each byte and place."""
    hashes = np.empty(len(begin), np.uint64)
    sizes = end - begin
    for lo in range(0, len(begin), CHUNK_WORDS):
        size = np.minimum(sizes[lo : lo + CHUNK_WORDS], PLACES)
        first = np.cumsum(size) - size
        place = np.arange(first[-1] + size[-1])
        place -= np.repeat(first, size)
        at = np.repeat(begin[lo : lo + CHUNK_WORDS], size)
        at += place
        place *= 256
        place += low[at]
        hashes[lo : lo + CHUNK_WORDS] = np.add.reduceat(_BYTES.take(place), first)
    for i in np.flatnonzero(sizes > PLACES).tolist():
        hashes[i] = xxhash.xxh3_64_intdigest(low[begin[i] : end[i]].tobytes())
    return hashes


def _windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """The hash of each ``size`` words that follow one another."""
    mixed = np.full(len(hashes) - size + 1, size, np.uint64)
    for k in range(size):
        mixed = _mix(mixed + hashes[k : len(hashes) - size + 1 + k])
    return mixed


def _signs(texts: pa.Array) -> Iterator[tuple[bytes, np.ndarray]]:
    """For each text the digest of its words and its shingles, as sorted 64-bit hashes.

    A text of fewer words than ``SHINGLE`` is one shingle, one without words has none.
    """
    held = texts.cast(pa.large_binary())
    ends = np.frombuffer(held.buffers()[1], np.int64)[held.offset : held.offset + len(held) + 1]
    data = held.buffers()[2]
    lo = 0
    while lo < len(held):
        hi = int(np.searchsorted(ends, ends[lo] + CHUNK_BYTES, "right")) - 1
        hi = min(max(hi, lo + 1), len(held))
        start, stop = int(ends[lo]), int(ends[hi])
        low = np.frombuffer(data[start:stop].to_pybytes().lower(), np.uint8) if stop > start else _NONE
        # Words begin and end at blanks and at the ends of texts.
        word = (low != 32) & ((low < 9) | (low > 13))
        edge = np.zeros(len(low) + 1, bool)
        edge[ends[lo : hi + 1] - start] = True
        begin = np.flatnonzero(word & (edge[:-1] | ~np.concatenate(([False], word[:-1]))))
        end = np.flatnonzero(word & (edge[1:] | ~np.concatenate((word[1:], [False])))) + 1
        hashes = _word_hashes(low, begin, end)
        windows = _windows(hashes, SHINGLE) if len(hashes) >= SHINGLE else hashes[:0]
        # The words with one blank behind each that another follows.
        plain = np.where(word, low, np.uint8(32))
        kept = word.copy()
        kept[end[end < len(low)]] = True
        first = np.searchsorted(begin, ends[lo : hi + 1] - start).tolist()
        for a, b in zip(first, first[1:]):
            if a == b:
                yield _digest(b""), hashes[:0]
                continue
            words = plain[begin[a] : end[b - 1]][kept[begin[a] : end[b - 1]]]
            found = windows[a : b - SHINGLE + 1] if b - a >= SHINGLE else _windows(hashes[a:b], b - a)
            found = np.sort(found)
            other = found[1:] != found[:-1]
            if not other.all():
                found = np.concatenate((found[:1], found[1:][other]))
            yield _digest(words.tobytes()), found
        lo = hi


def minhashes(found: np.ndarray) -> np.ndarray:
    """For each multiplier the shingle whose upper half has the smallest product; its lower half.

    ``found`` is sorted. The lower half says nothing about the size of the set,
    so that sets without a common shingle hardly ever agree in a value.
    """
    upper = (found >> np.uint64(32)).astype(np.uint32)
    least = np.full(VALUES, np.iinfo(np.uint32).max, np.uint32)
    for lo in range(0, len(upper), 1024):
        least = np.minimum(least, (_MULTIPLIERS[:, None] * upper[lo : lo + 1024]).min(axis=1))
    if not len(found):
        return np.zeros(VALUES, np.int32)
    return found[np.searchsorted(upper, least * _INVERSES)].astype(np.uint32).view(np.int32)


def _digest(words: bytes) -> bytes:
    return hashlib.blake2b(words, digest_size=16).digest()


def _survival(similarity: float, depth: int) -> float:
    """Probability that a pair shares a bucket down to the depth in one run."""
    second = 1.0 / SECOND
    dies = 0.0
    for _ in range(depth):
        apart = 1.0 - similarity * (1.0 - dies)
        dies = (1.0 - second) * apart + second * apart * apart
    return 1.0 - dies


def runs_for(similarity: float, recall: float, depth: int = DEPTH) -> int:
    """Runs after which a pair of just this similarity was together with this probability."""
    alone = 1.0 - _survival(similarity, depth)
    return max(1, math.ceil(math.log(1.0 - recall) / math.log(alone))) if alone > 0 else 1


def _signed(docs: DataFrame, id_col: str, text_col: str, row_col: str | None) -> DataFrame:
    """Per row: id, row, digest of the words, number of shingles, minhash values."""
    kind = docs.schema[id_col].dataType.simpleString()
    row_kind = docs.schema[row_col].dataType.simpleString() if row_col else "bigint"
    row = F.col(row_col) if row_col else F.monotonically_increasing_id()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            copies, sizes, values = [], [], []
            for copy, found in _signs(batch["text"]):
                copies.append(copy)
                sizes.append(len(found))
                values.append(minhashes(found))
            flat = np.concatenate(values) if values else np.zeros(0, np.int32)
            ends = np.arange(0, VALUES * len(values) + 1, VALUES, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["id"],
                    batch["row"],
                    pa.array(copies, pa.binary()),
                    pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                ],
                names=["id", "row", "copy", "shingles", "values"],
            )

    rows = docs.select(
        F.col(id_col).alias("id"), row.alias("row"), text_of(text_col).alias("text")
    )
    return rows.mapInArrow(
        run, f"id {kind}, row {row_kind}, copy binary, shingles bigint, values array<int>"
    )


def _children(path: Column, first: Column, second: Column, has_second: Column) -> Column:
    """Buckets one level below ``path``: by the values at one or two places."""

    def child(place: Column) -> Column:
        return F.xxhash64(path, place, F.get("values", place))

    return F.explode(
        F.when(has_second & (first != second), F.array(child(first), child(second))).otherwise(
            F.array(child(first))
        )
    )


def _leaf_edges(rows: DataFrame, similarity: float) -> DataFrame:
    """Spanning edges of the pairs in each small bucket that look similar by their values.

    ``rows`` are (``bucket``, ``node``, ``sketch``), sorted by bucket within
    partitions. Four standard deviations of the estimate are granted.
    """
    sure = similarity - 4.0 * math.sqrt(similarity * (1.0 - similarity) / VALUES)
    least = math.ceil(sure * VALUES)

    def link(bucket: np.ndarray, node: np.ndarray, sketch: np.ndarray) -> list[tuple[int, int]]:
        up = np.arange(len(node))

        def root(i: int) -> int:
            while up[i] != i:
                up[i] = up[up[i]]
                i = up[i]
            return i

        for apart in range(1, len(node)):
            same = np.flatnonzero(bucket[:-apart] == bucket[apart:])
            if not len(same):
                break
            alike = (sketch[same] == sketch[same + apart]).sum(axis=1) >= least
            for i in same[alike].tolist():
                a, b = root(i), root(i + apart)
                if a != b:
                    up[max(a, b)] = min(a, b)
        tops = [root(i) for i in range(len(node))]
        return [(int(node[i]), int(node[t])) for i, t in enumerate(tops) if i != t]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: tuple[np.ndarray, ...] | None = None

        def made(edges: list[tuple[int, int]]) -> pa.RecordBatch:
            a, b = zip(*edges) if edges else ((), ())
            return pa.RecordBatch.from_pydict(
                {"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())}
            )

        for batch in batches:
            if not len(batch):
                continue
            now = (
                batch["bucket"].to_numpy(),
                batch["node"].to_numpy(),
                np.frombuffer(b"".join(batch["sketch"].to_pylist()), np.uint8).reshape(-1, VALUES),
            )
            if rest is not None:
                now = tuple(np.concatenate(pair) for pair in zip(rest, now))
            # The last bucket may go on in the next batch.
            whole = int(np.argmax(now[0] == now[0][-1]))
            rest = tuple(part[whole:] for part in now)
            yield made(link(*(part[:whole] for part in now)))
        if rest is not None:
            yield made(link(*rest))

    return rows.mapInArrow(run, "a bigint, b bigint")


def candidate_edges(
    nodes: DataFrame, similarity: float, recall: float, leaf: int = LEAF, depth: int = DEPTH
) -> DataFrame:
    """Edges (``a``, ``b``) that connect every similar pair with the wanted probability.

    ``nodes`` are (``node``, ``values``). A large bucket that a split leaves
    nearly whole holds near copies, which no further split would tell apart,
    and one at the greatest depth agrees in as many values: their members are
    joined to one of them unseen, and the exact check decides.
    """
    draw = random.Random(0)
    roots = []
    for run in range(runs_for(similarity, recall, depth)):
        places = draw.sample(range(VALUES), 2 if draw.random() * SECOND < 1 else 1)
        roots += [F.xxhash64(F.lit(run), F.lit(p), F.get("values", F.lit(p))) for p in places]
    paths = nodes.select("node", F.explode(F.array(*roots)).alias("bucket")).withColumn(
        "above", F.lit(None).cast("bigint")
    )
    sketch = F.unhex(
        F.array_join(
            F.transform("values", lambda v: F.lpad(F.hex(v.bitwiseAND(255)), 2, "0")), ""
        )
    )
    sketches = nodes.select("node", sketch.alias("sketch"))
    small: list[DataFrame] = []
    edges: list[DataFrame] = []
    for level in range(1, depth + 1):
        sizes = stored(
            paths.groupBy("bucket")
            .agg(F.count("*").alias("n"), F.max("above").alias("above"), F.min("node").alias("b"))
            .filter("n > 1"),
            "path-sizes",
        )
        stuck = (F.col("n") >= STUCK * F.col("above")) | F.lit(level == depth)
        kind = F.when(F.col("n") <= leaf, "small").when(stuck, "whole").otherwise("large")
        members = stored(
            paths.drop("above").join(sizes, "bucket").withColumn("kind", kind), "path-members"
        )
        small.append(members.filter("kind = 'small'").select("bucket", "node"))
        edges.append(members.filter("kind = 'whole'").select(F.col("node").alias("a"), "b"))
        large = members.filter("kind = 'large'").select("bucket", "node", F.col("n").alias("above"))
        if large.isEmpty():
            break
        at = [F.pmod(F.xxhash64("bucket", F.lit(k)), F.lit(VALUES)).cast("int") for k in (1, 2)]
        twice = F.pmod(F.xxhash64("bucket", F.lit(3)), F.lit(SECOND)) == 0
        paths = (
            large.join(nodes.select("node", "values"), "node")
            .select("node", _children(F.col("bucket"), at[0], at[1], twice).alias("bucket"), "above")
        )
    leaves = small[0]
    for more in small[1:]:
        leaves = leaves.unionByName(more)
    ready = leaves.join(sketches, "node").repartition("bucket").sortWithinPartitions("bucket")
    found = _leaf_edges(ready, similarity)
    for more in edges:
        found = found.unionByName(more)
    return found


def _sets(docs: DataFrame, text_col: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for copy, found in _signs(batch["text"]):
                out.append({"copy": copy, "hashes": found.tobytes()})
                if len(out) == 512:
                    yield pa.RecordBatch.from_pylist(out, schema=schema)
                    out = []
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    schema = pa.schema([("copy", pa.binary()), ("hashes", pa.binary())])
    return docs.select(text_of(text_col).alias("text")).mapInArrow(
        run, "copy binary, hashes binary"
    )


def _overlaps(sets: list[np.ndarray], others: list[np.ndarray] | None = None) -> np.ndarray:
    """Sizes of the intersections of all pairs of sets, or of the sets with the others.

    A shingle of one set is in no intersection. Shingles that are in the very
    same sets are one column with a weight. Columns of few sets are added up
    pair by pair, the others are a product of matrices.
    """
    every = sets + (others or [])
    n, m = len(sets), len(every) - len(sets) if others else len(sets)
    sizes = np.fromiter(map(len, every), np.int64, len(every))
    if len(every) <= 8:
        pairs = [(i, j) for i in range(n) for j in range(m) if others or i < j]
        few = np.zeros((n, m), np.int64) if others else np.diag(sizes)
        for i, j in pairs:
            few[i, j] = len(np.intersect1d(sets[i], (others or sets)[j], assume_unique=True))
        return few if others else np.maximum(few, few.T)
    out = np.zeros((n, m))
    flat = np.concatenate(every)
    order = np.argsort(flat)
    flat, row = flat[order], np.repeat(np.arange(len(every)), sizes)[order]
    edge = np.flatnonzero(np.concatenate(([True], flat[1:] != flat[:-1])))
    count = np.diff(np.append(edge, len(flat)))
    marks = _mix(_mix(np.arange(1, len(every) + 1, dtype=np.uint64)))[row]
    _, first, weight = np.unique(
        np.add.reduceat(marks, edge), return_index=True, return_counts=True
    )
    edge, count = edge[first], count[first]
    shared = np.flatnonzero(count > 1)
    shared = shared[np.argsort(count[shared])]
    edge, count, weight = edge[shared], count[shared], weight[shared]
    few = int(np.searchsorted(count, math.isqrt(n * m // SPARSE), "right"))
    lo = 0
    while lo < few:  # columns of the same number of sets at a time
        size = int(count[lo])
        hi = min(int(np.searchsorted(count[:few], size, "right")), lo + max(1, COLUMNS * 64 // size**2))
        held = row[edge[lo:hi, None] + np.arange(size)]
        left, right = held[:, :, None], held[:, None, :] - (n if others else 0)
        at = left * m + right
        real = (left < n) & (right >= 0)
        np.add.at(out.reshape(-1), at[real], np.broadcast_to(weight[lo:hi, None, None], at.shape)[real])
        lo = hi
    kind = np.float32 if len(flat) < 1 << 24 else np.float64
    for lo in range(few, len(edge), COLUMNS):
        hi = min(lo + COLUMNS, len(edge))
        column = np.repeat(np.arange(hi - lo), count[lo:hi])
        within = np.arange(len(column)) - np.repeat(np.cumsum(count[lo:hi]) - count[lo:hi], count[lo:hi])
        held = row[edge[lo:hi][column] + within]
        block = np.zeros((len(every), hi - lo), kind)
        block[held, column] = 1
        out += (block[:n] * weight[lo:hi].astype(kind)) @ (block[n:] if others else block).T
    if not others:
        np.fill_diagonal(out, sizes)
    return out.astype(np.int64)


def _groups(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number for each row and each column, the same for those that links connect; -1 without links."""
    turned = np.ascontiguousarray(linked.T)
    rows, columns = np.full(len(linked), -1), np.full(len(turned), -1)
    for i in np.flatnonzero(linked.any(axis=1)).tolist():
        if rows[i] >= 0:
            continue
        rows[i], found = i, np.array([i])
        while len(found):
            found = np.flatnonzero(linked[found].any(axis=0) & (columns < 0))
            columns[found] = i
            if len(found):
                found = np.flatnonzero(turned[found].any(axis=0) & (rows < 0))
                rows[found] = i
    return rows, columns


def _compare(
    nodes: list[int], blocks: list[int], sets: list[np.ndarray], across: bool, similarity: float
) -> list[tuple[int, int, int]]:
    """(node, root, links) of the nodes with links in this group; ``across``: between two blocks."""
    side = np.array(blocks) == blocks[0]
    one = np.flatnonzero(side)
    two = np.flatnonzero(~side) if across else one
    if not len(two):
        return []
    common = _overlaps([sets[i] for i in one], [sets[i] for i in two] if across else None)
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    union = sizes[one, None] + sizes[None, two] - common
    linked = common / np.maximum(union, 1) >= similarity
    if not across:
        np.fill_diagonal(linked, False)
    links = linked.sum(axis=1).tolist()
    if across:
        roots, others = _groups(linked)
        found = zip(two.tolist(), others.tolist(), linked.sum(axis=0).tolist())
    else:
        np.fill_diagonal(linked, True)  # the row and the column of a node belong together
        (roots, _), found = _groups(linked), ()
    return [
        (nodes[i], nodes[one[root]], n)
        for i, root, n in [*zip(one.tolist(), roots.tolist(), links), *found]
        if n
    ]


def _verified(grouped: DataFrame, similarity: float) -> DataFrame:
    """``grouped`` is sorted by (cluster, lo, hi); a task holds one group at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, nodes, blocks, sets = None, [], [], []

        def settle() -> pa.RecordBatch:
            found = _compare(nodes, blocks, sets, group[1] != group[2], similarity)
            columns = list(zip(*found)) if found else [(), (), ()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], names=["node", "root", "links"]
            )

        for batch in batches:
            keys = zip(*(batch[c].to_pylist() for c in ("cluster", "lo", "hi", "block", "node")))
            for (cluster, lo, hi, block, node), hashes in zip(keys, batch["hashes"]):
                if (cluster, lo, hi) != group:
                    if len(nodes) > 1:
                        yield settle()
                    group, nodes, blocks, sets = (cluster, lo, hi), [], [], []
                nodes.append(node)
                blocks.append(block)
                sets.append(np.frombuffer(hashes.as_py(), np.uint64))
        if len(nodes) > 1:
            yield settle()

    return grouped.mapInArrow(run, "node bigint, root bigint, links bigint")


def jaccard_join(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    similarity: float = SIMILARITY,
    recall: float = TARGET_RECALL,
    row_col: str | None = None,
) -> DataFrame:
    """A row per row of ``docs``: id, ``copy_of``, ``n_copies``, ``n_links``, ``class_id``, ``kept``.

    ``copy_of`` is the largest id with the same words and ``n_copies`` their
    number, ``n_links`` the number of different texts that are linked to this
    one, ``class_id`` the largest id among all texts connected by links, and
    ``kept`` marks one row of each class, that with the largest id. A column
    ``row_col`` that tells all rows apart is returned too.

    * Texts are compared by words, A-Z lower-cased; blanks don't matter. Fewer
      words than five make one shingle.
    * Rows whose text is null, empty or blank have no set: each is a class of
      its own, with itself as ``copy_of``, no links, and is kept.
    * Rows that repeat an id and its text are copies; one of them is kept.
      Rows with one id and different texts are apart.
    * A null id is smaller than any other.
    * An empty table gives no rows. Other columns are not looked at.
    """
    rows = stored(_signed(docs, id_col, text_col, row_col), "join-rows")
    first = F.struct("id", "row")
    nodes = stored(
        rows.filter("shingles > 0")
        .groupBy("copy")
        .agg(
            F.first("values").alias("values"),
            F.first("shingles").alias("shingles"),
            F.count("*").alias("n_copies"),
            F.max(first).alias("best"),
        )
        .withColumn("node", F.monotonically_increasing_id()),
        "join-nodes",
    )
    clusters = stored(components(candidate_edges(nodes, similarity, recall)), "join-clusters")
    members = clusters.join(nodes, "node").select(
        "node", F.col("root").alias("cluster"), "copy", "shingles", F.col("best.id").alias("id")
    )
    members = stored(members, "join-members")
    shares = (
        members.groupBy("cluster")
        .agg(F.count("*").alias("n"), F.sum("shingles").alias("all"))
        .select(
            "cluster",
            F.greatest(
                F.ceil(F.col("n") / BLOCK_ROWS), F.ceil(F.col("all") / BLOCK_SHINGLES)
            ).cast("int").alias("blocks"),
        )
    )
    block = F.pmod(F.xxhash64("node", F.lit(5)), F.col("blocks")).cast("int")
    placed = stored(
        members.join(shares, "cluster").withColumn("block", block).select(
            "node", "cluster", "copy", "block", "blocks"
        ),
        "join-placed",
    )
    # The texts move once, by a sorted shuffle at every size; copies meet by their words.
    wanted = members.select(F.col("id").alias("_id")).distinct().hint("merge")
    texts = docs.select(F.col(id_col).alias("_own"), F.col(text_col).alias("text"))
    chosen = texts.join(wanted, F.col("_own").eqNullSafe(F.col("_id"))).select("text")
    sets = _sets(chosen, "text").dropDuplicates(["copy"])
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    grouped = (
        placed.join(sets, "copy")
        .withColumn("other", other)
        .select(
            "cluster",
            F.least("block", "other").alias("lo"),
            F.greatest("block", "other").alias("hi"),
            "block",
            "node",
            "hashes",
        )
        .repartition("cluster", "lo", "hi")
        .sortWithinPartitions("cluster", "lo", "hi")
    )
    linked = stored(_verified(grouped, similarity), "join-links")
    links = linked.groupBy("node").agg(F.sum("links").alias("n_links"))
    roots = stored(
        components(linked.select(F.col("node").alias("a"), F.col("root").alias("b"))),
        "join-roots",
    )
    classes = (
        roots.join(nodes.select("node", "best"), "node")
        .groupBy("root")
        .agg(F.max("best").alias("class_best"))
    )
    in_class = roots.join(classes, "root").select("node", "class_best")
    answers = (
        nodes.select("node", "copy", "n_copies", "best")
        .join(links, "node", "left")
        .join(in_class, "node", "left")
        .select(
            "copy",
            F.col("best.id").alias("copy_of"),
            "n_copies",
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("class_best", "best").alias("class_best"),
        )
    )
    answers = stored(answers, "join-answers")
    named = [F.col("row").alias(row_col)] if row_col else []
    with_set = rows.filter("shingles > 0").select("id", "row", "copy").join(answers, "copy")
    return with_set.select(
        *named,
        F.col("id").alias(id_col),
        "copy_of",
        "n_copies",
        "n_links",
        F.col("class_best.id").alias("class_id"),
        (F.col("row") == F.col("class_best.row")).alias("kept"),
    ).unionByName(
        rows.filter("shingles = 0").select(
            *named,
            F.col("id").alias(id_col),
            F.col("id").alias("copy_of"),
            F.lit(1).cast("long").alias("n_copies"),
            F.lit(0).cast("long").alias("n_links"),
            F.col("id").alias("class_id"),
            F.lit(True).alias("kept"),
        )
    )
