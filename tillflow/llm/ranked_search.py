"""Ranked lexical search: exact inner products by sparse ball trees.

A document is a sparse vector of integer term weights, a query one of integer
factors, and the score is their inner product. Each task builds ball trees
over the documents it reads, one for some thousand of them: a node is a
centroid and the radius of the ball that holds its documents, over all terms
and term by term. With q.x <= q.c + |q| |x - c|, the ball bounds the score of
every document in it; nodes
are visited best first, and a subtree is left out if its bound, rounded up,
is below the last score that a query still keeps. Scores are summed in
integers at the leaves, so floats decide what is skipped, never a rank.

Only terms of the queries matter to an inner product, so documents are
projected onto these. Queries go to the tasks in blocks of a bounded number
of terms; documents are never gathered.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillflow.llm.common import ascii_lower, stored, text_of

#: Letters and digits of ASCII and everything beyond it.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
TOP = 10
#: Different terms of the queries of a block; a single query may have more.
BLOCK_TERMS = 1 << 15
#: Bytes of a tree's documents as a table of integers, and its documents at most.
TREE_BYTES, TREE_DOCS = 16 << 20, 2048
LEAF_DOCS = 8
_PARTS_BYTES = 8 << 20

# Term weights are whole thousandths, BM25 with b = 3/4 and k1 = 0.8 in integers.
SCALE, SATURATION = 1_000_000_000, 8


class Query(NamedTuple):
    """``number`` names it; ``places`` are terms of the block, ``factors`` their weights."""

    number: int
    places: np.ndarray
    factors: np.ndarray


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _blocks(items: DataFrame, text_col: str) -> Iterator[list[tuple[int, Counter]]]:
    """The queries' terms, some queries at a time: (number, terms with their counts)."""
    terms = F.regexp_extract_all(ascii_lower(text_of(text_col)), F.lit(f"({TERM})"), F.lit(1))
    held, known = [], set()
    for row in items.select("number", terms.alias("terms")).toLocalIterator():
        found = Counter(row["terms"])
        if held and len(known | found.keys()) > BLOCK_TERMS:
            yield held
            held, known = [], set()
        held.append((row["number"], found))
        known |= found.keys()
    if held:
        yield held


def _counted(docs: DataFrame, id_col: str, text_col: str, wanted: set[str]) -> DataFrame:
    """``id``, ``n`` (all terms) and the wanted terms of each text with their counts."""
    vocabulary = docs.sparkSession.sparkContext.broadcast({t: i for i, t in enumerate(sorted(wanted))})
    kind = docs.schema[id_col].dataType.simpleString()
    term = re.compile(TERM)

    def run(batches):
        place = vocabulary.value
        for batch in batches:
            ids, texts = batch.column("id"), batch.column("text")
            begin = 0
            while begin < len(texts):
                # Texts may be long: what is returned at once is bounded by bytes.
                n, places, counts, size, end = [], [], [], 0, begin
                while end < len(texts) and size < _PARTS_BYTES:
                    found = term.findall(texts[end].as_py())
                    n.append(len(found))
                    known = {place[t]: c for t, c in Counter(found).items() if t in place}
                    at = sorted(known)
                    places.append(at)
                    counts.append([known[p] for p in at])
                    size += 64 + 16 * len(at)
                    end += 1
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(begin, end - begin),
                        pa.array(n, pa.int64()),
                        pa.array(places, pa.list_(pa.int32())),
                        pa.array(counts, pa.list_(pa.int64())),
                    ],
                    ["id", "n", "places", "counts"],
                )
                begin = end

    texts = docs.select(F.col(id_col).alias("id"), ascii_lower(text_of(text_col)).alias("text"))
    return texts.mapInArrow(run, f"id {kind}, n bigint, places array<int>, counts array<bigint>")


def _distances(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    away = points - centre
    return np.sqrt(np.einsum("ij,ij->i", away, away))


class _Tree:
    """A ball tree over the rows of ``table`` (documents by terms, integers)."""

    def __init__(self, table: np.ndarray, stretch: np.ndarray):
        #: Any factor per term keeps q.x if q is divided by it; this one makes balls tighter.
        self.stretch = stretch
        points = table * stretch
        self.children: list[list[int]] = []
        #: A leaf's documents lie beside each other in ``table`` and ``order``.
        self.spans: list[tuple[int, int] | None] = []
        centres, radii, most, laid = [], [], [], []
        begin = 0
        waiting = [(np.arange(len(table)), None)]
        while waiting:
            rows, parent = waiting.pop()
            node = len(centres)
            if parent is not None:
                self.children[parent].append(node)
            inside = points[rows]
            centre = inside.mean(axis=0)
            distance = _distances(inside, centre)
            centres.append(centre)
            radii.append(distance.max())
            most.append(table[rows].max(axis=0))
            self.children.append([])
            if len(rows) > LEAF_DOCS:
                # Two documents far apart; each takes the half that lies on its side.
                left = inside[distance.argmax()]
                right = inside[_distances(inside, left).argmax()]
                order = np.argsort(inside @ (right - left), kind="stable")
                middle = len(rows) // 2
                waiting += [(rows[order[middle:]], node), (rows[order[:middle]], node)]
                self.spans.append(None)
            else:
                laid.append(rows)
                self.spans.append((begin, begin + len(rows)))
                begin += len(rows)
        self.order = np.concatenate(laid)
        self.table = table[self.order]
        self.centres, self.radii, self.most = np.array(centres), np.array(radii), np.array(most)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """For each query and node, a number that no score in the ball exceeds.

        The smaller of two: q.c + |q| r, where only terms that the node has
        count in |q|, since all its documents are 0 elsewhere; and q.c with a
        radius for each term by itself, which is q by the greatest value of
        each term. Every operation on doubles errs by at most one part in
        2**53, and sums of n terms by n of these, all terms being positive.
        Some multiple of that, of the sum of all magnitudes, covers centre,
        radius, norm and products.
        """
        shrunk = queries / self.stretch
        present = (self.most > 0).astype(np.float64)
        lengths = np.sqrt((shrunk * shrunk) @ present.T)
        ball = shrunk @ self.centres.T + lengths * self.radii
        reach = np.sqrt(np.einsum("ij,ij->i", self.centres, self.centres)) + self.radii
        box = queries @ self.most.T.astype(np.float64)
        slack = 16.0 * (queries.shape[1] + 16) * 2.0**-52
        return np.minimum(ball + slack * lengths * reach, box * (1.0 + slack)) + 1.0


def _search(tree: _Tree, ids: list, query: Query, bound: np.ndarray, best: list, top: int) -> None:
    """Adds the tree's documents to ``best``: a heap of (score, whether it has an id, -id)."""
    ahead = [(-bound[0], 0)]
    while ahead:
        most, node = heapq.heappop(ahead)
        # A document with the same score as the last one kept may have a smaller id.
        least = best[0][0] if len(best) == top else 1
        if -most < least:
            break
        if tree.spans[node] is None:
            for child in tree.children[node]:
                if bound[child] >= least:
                    heapq.heappush(ahead, (-bound[child], child))
            continue
        begin, end = tree.spans[node]
        scores = tree.table[begin:end, query.places].astype(np.int64) @ query.factors
        for at in np.flatnonzero(scores >= least):
            key = ids[tree.order[begin + at]]
            # Of equal scores the smallest id stays; a null one goes after all others.
            entry = (int(scores[at]), key is not None, -key if key is not None else 0)
            if len(best) < top:
                heapq.heappush(best, entry)
            elif entry > best[0]:
                heapq.heapreplace(best, entry)


def _searched(
    counted: DataFrame, queries: Sequence[Query], weights: np.ndarray, n_docs: int, n_terms: int, top: int
) -> DataFrame:
    """``number``, ``id``, ``score``: the best of each task for every query."""
    width = len(weights)
    shared = counted.sparkSession.sparkContext.broadcast((list(queries), weights))
    chunk = max(LEAF_DOCS, min(TREE_DOCS, TREE_BYTES // (4 * max(1, width))))

    def found(batches):
        asked, weight = shared.value
        # Balanced between documents and queries: both carry the root of the term's weight.
        stretch = np.sqrt(np.maximum(weight, 1)).astype(np.float64)
        best: list[list] = [[] for _ in asked]
        per_time = max(1, TREE_BYTES // (8 * max(1, width)))

        def look(ids, n, places, counts):
            lengths = 25 + (75 * n * n_docs) // max(1, n_terms)
            owner = np.repeat(np.arange(len(ids)), [len(p) for p in places])
            at, tf = np.concatenate(places), np.concatenate(counts)
            # Only the terms that these documents have take room.
            used = np.unique(at)
            table = np.zeros((len(ids), len(used)), np.int32)
            table[owner, np.searchsorted(used, at)] = (SCALE * tf) // (
                1000 * tf + SATURATION * lengths[owner]
            )
            tree = _Tree(table, stretch[used])
            for begin in range(0, len(asked), per_time):
                some = asked[begin : begin + per_time]
                met, dense = [], np.zeros((len(some), len(used)))
                for row, query in enumerate(some):
                    where = np.searchsorted(used, query.places)
                    here = where < len(used)
                    here[here] = used[where[here]] == query.places[here]
                    local = Query(query.number, where[here], query.factors[here])
                    met.append(local)
                    dense[row, local.places] = local.factors
                bounds = tree.bounds(dense)
                for row, local in enumerate(met):
                    if len(local.places):
                        _search(tree, ids, local, bounds[row], best[begin + row], top)

        held = [], [], [], []
        for batch in batches:
            for column, values in zip(
                held,
                (
                    batch.column("id").to_pylist(),
                    batch.column("n").to_pylist(),
                    batch.column("places"),
                    batch.column("counts"),
                ),
            ):
                if isinstance(values, list):
                    column.extend(values)
                else:
                    column.extend(v.values.to_numpy() for v in values)
            while len(held[0]) >= chunk:
                part = [column[:chunk] for column in held]
                held = tuple(column[chunk:] for column in held)
                look(part[0], np.array(part[1]), part[2], part[3])
        if held[0]:
            look(held[0], np.array(held[1]), held[2], held[3])
        for query, entries in zip(asked, best):
            for score, known, low in entries:
                yield query.number, -low if known else None, score

    def run(batches):
        columns = [list(c) for c in zip(*found(batches))] or [[], [], []]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in columns], ["number", "id", "score"]
        )

    rows = counted.filter(F.size("places") > 0)
    return rows.mapInArrow(run, "number bigint, id bigint, score bigint")


def ranked_search(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    top: int = TOP,
) -> DataFrame:
    """The ``top`` documents of each item with a score above 0: item, ``rank``, id, ``score``.

    Terms are runs of ASCII letters and digits and of characters beyond ASCII,
    A-Z lower-cased. N documents have a term, L is all their terms. A term of
    df documents weighs w = floor(1000 ln((2N+2)/(2df+1))); tf of it in a
    document of n terms give w * (10**9 tf div (1000 tf + 8 m)) for
    each time that the item has it, with m = 25 + 75 n N div L. Equal scores
    go by ascending id.

    * A null or empty text, document or item, has no terms: no rows for it.
    * Each row is a document, each item row an item: repeated ids are ranked
      beside each other, null ids after others of the same score.
    * Texts are read whole. Equal texts are one point of the space, so their
      balls have no radius.
    * Empty tables give no rows. Other columns are not looked at. Ids are
      whole numbers.
    """
    # Numbers, since item ids may repeat or be null; written, so that they stay.
    items = stored(
        items.select(
            F.col(item_col).alias("item"),
            F.col(item_text_col).alias("text"),
            F.monotonically_increasing_id().alias("number"),
        ),
        "search-items",
    )
    found = None
    for block in _blocks(items, "text"):
        wanted = set().union(*(terms.keys() for _, terms in block))
        names = sorted(wanted)
        counted = stored(_counted(docs, id_col, text_col, wanted), "search-terms")
        n_docs, n_terms = counted.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
        frequency = counted.select(F.explode("places").alias("place")).groupBy("place").count()
        # As many rows as the block has terms.
        df = dict(map(tuple, frequency.collect()))
        weights = np.array([term_weight(n_docs, df.get(p, 0)) for p in range(len(names))], np.int64)
        place = {t: p for p, t in enumerate(names)}
        queries = []
        for number, terms in block:
            at = sorted(place[t] for t in terms)
            times = np.array([terms[names[p]] for p in at], np.int64)
            places = np.array(at, np.int64)
            queries.append(Query(number, places, times * weights[places]))
        some = _searched(counted, queries, weights, n_docs, n_terms or 0, top)
        found = some if found is None else found.unionByName(some)
    if found is None:
        found = docs.sparkSession.createDataFrame([], "number bigint, id bigint, score bigint")
    order = W.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    ranks = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    named = ranks.join(items.select("number", "item"), "number")
    return named.select(
        F.col("item").alias(item_col), F.col("rank").cast("int"), F.col("id").alias(id_col), "score"
    )
