"""Ranked search against scoring every document by itself."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np

from tests.llm.cases import edge_docs, edge_rows, empty_docs, lower
from tillflow.llm import ranked_search as search

TERM = re.compile(search.TERM)


def terms(text):
    return TERM.findall(lower(text or ""))


def by_force(docs, items, top=10):
    """(item, rank, id, score) of documents (id, text) for items (id, text)."""
    counted = [(key, Counter(terms(text))) for key, text in docs]
    n_docs = sum(1 for _, c in counted if c)
    total = sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = Counter()
    for item, text in items:
        wanted, scores = Counter(terms(text)), []
        for key, found in counted:
            if not found:
                continue
            m = 100 - 75 + 75 * sum(found.values()) * n_docs // total
            score = 0
            for t, times in wanted.items():
                if t in found:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += times * w * (10**9 * found[t] // (1000 * found[t] + 8 * m))
            if score > 0:
                scores.append((-score, key is None, key or 0))
        for rank, (score, absent, key) in enumerate(sorted(scores)[:top], 1):
            out[(item, rank, None if absent else key, -score)] += 1
    return out


def found(docs, items, **more):
    ranked = search.ranked_search(docs, items, **more)
    return Counter(tuple(r) for r in ranked.select("item_id", "rank", "doc_id", "score").collect())


ITEMS = [
    (1, "same TEXT over here"),
    (1, "the very line, the documents; the line"),
    (None, "É ünï odd blanks"),
    (3, None),
    (4, "... --- !"),
    (5, "nowhere tobefound"),
    (6, "piece7 piece8 word3 word3 x"),
]


def test_edges(spark):
    items = spark.createDataFrame([(*i, "e") for i in ITEMS], "item_id bigint, text string, number string")
    docs = [(r[0], r[1]) for r in edge_rows()]
    assert found(edge_docs(spark), items) == by_force(docs, ITEMS)
    assert found(empty_docs(spark), items) == Counter()
    assert found(edge_docs(spark), items.limit(0)) == Counter()


def corpus(seed, n):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    text = lambda k: " ".join(rng.choices(words, [1 / (i + 1) for i in range(300)], k=k))
    docs = [(i, text(rng.randint(1, 60))) for i in range(n)]
    # A third of all documents are copies of one.
    docs += [(n + i, "w1 w2 w3 w280 w281 w282") for i in range(n // 3)]
    rng.shuffle(docs)
    return docs, [(i, text(12)) for i in range(15)] + [(99, "w280 w281 w282")]


def test_ties_and_many_trees(spark, monkeypatch):
    docs, rows = corpus(1, 600)
    monkeypatch.setattr(search, "TREE_DOCS", 64)
    table = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    items = spark.createDataFrame(rows, "item_id bigint, text string")
    assert found(table, items) == by_force(docs, rows)
    assert found(table, items, top=3) == by_force(docs, rows, 3)


def test_items_in_blocks(spark, monkeypatch):
    docs, rows = corpus(2, 120)
    monkeypatch.setattr(search, "BLOCK_TERMS", 20)
    table = spark.createDataFrame(docs, "doc_id bigint, text string")
    items = spark.createDataFrame(rows[-4:], "item_id bigint, text string")
    assert found(table, items) == by_force(docs, rows[-4:])


def test_bounds_hold_and_skip_most_leaves():
    rng = np.random.default_rng(5)
    table = np.zeros((2000, 400), np.int32)
    for row in table:
        row[rng.zipf(1.3, 30) % 400] = rng.integers(1, 10**6, 30)
    weights = rng.integers(1, 10**4, 400)
    tree = search._Tree(table, np.sqrt(weights))
    queries = np.zeros((20, 400))
    for row in queries:
        at = rng.integers(0, 400, 8)
        row[at] = weights[at]
    bounds = tree.bounds(queries)
    scores = queries @ tree.table.T
    leaves = [n for n, span in enumerate(tree.spans) if span]
    assert sorted(tree.order) == list(range(2000))
    for node in leaves:
        begin, end = tree.spans[node]
        assert (bounds[:, node] >= scores[:, begin:end].max(axis=1)).all()
    for node, below in enumerate(tree.children):
        for child in below:
            begin, end = tree.spans[child] or (0, 0)
            assert end == begin or (bounds[:, node] >= scores[:, begin:end].max(axis=1)).all()
    tenth = np.sort(scores, axis=1)[:, -10]
    assert (bounds[:, leaves] >= tenth[:, None]).mean() < 0.5
