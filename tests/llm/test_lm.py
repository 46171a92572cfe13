"""Language-model scores against a recursive backoff model and held-out texts."""

from __future__ import annotations

import math
from collections import Counter
from functools import lru_cache

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from tests.llm.cases import edge_docs, edge_rows, empty_docs
from tillflow.llm import lm_score
from tillflow.llm.common import id_residue
from tillflow.llm.lm_score import END, PRIOR, START, Automaton, Block, lm_scores, tokens_of


def by_force(rows, order=3, prior=PRIOR):
    """Scores by the textbook recursion, over dictionaries."""
    train = [[START, *tokens_of(text or "")] for _, text, trained in rows if trained]
    n = sum(len(t) - 1 for t in train)
    count = Counter(w for t in train for w in t[1:])
    denominator = n + 0.1 * (len(count) + 1)
    grams = Counter(
        tuple(t[i : i + k]) for t in train for k in range(1, order + 1) for i in range(len(t) - k + 1)
    )

    @lru_cache(None)
    def chance(history, word):
        if not history:
            return (count[word] + 0.1) / denominator
        lower = chance(history[1:], word)
        return (grams[history + (word,)] + prior * lower) / (grams[history] + prior)

    out = []
    for key, text, trained in rows:
        tokens = [START, *tokens_of(text or "")]
        base = sum(math.log10((count[w] + 0.1) / denominator) for w in tokens[1:])
        score = sum(
            math.log10(chance(tuple(tokens[max(0, i - order + 1) : i]), tokens[i]))
            for i in range(1, len(tokens))
        )
        out.append((key, trained, len(tokens) - 1, sum(count[w] > 0 for w in tokens[1:]), n, base, score))
    return out


def compare(found, expected):
    got = [tuple(r) for r in found.collect()]
    order = lambda r: (r[0] is None, r[0] or 0, r[1], r[2], round(r[5], 6))
    got, expected = sorted(got, key=order), sorted(expected, key=order)
    assert [g[:5] for g in got] == [e[:5] for e in expected]
    for g, e in zip(got, expected):
        assert g[5:] == pytest.approx(e[5:], rel=1e-9, abs=1e-9), g[0]


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_small_texts(spark, order):
    texts = ["a b c a b d", "a b c", "The a b c a b e", "", None, "the the A b", "b c a b c a b c"] * 3
    rows = [(i, text, i % 5 != 0) for i, text in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, t boolean")
    compare(lm_scores(docs, F.col("t"), order=order, prior=0.5), by_force(rows, order, 0.5))


def test_blocks(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "BLOCK_TOKENS", 40)
    rows = [(i, f"w{i % 7} x y z w{i % 3} end of {i}", i % 10 != 0) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, t boolean")
    compare(lm_scores(docs, F.col("t")), by_force(rows))


@given(st.lists(st.tuples(st.text("ab cA\n", max_size=30), st.booleans()), min_size=1, max_size=8))
@settings(max_examples=200, deadline=None)
def test_automaton(texts):
    """One block without Spark: its own counts are those of the corpus."""
    rows = [(i, text, trained) for i, (text, trained) in enumerate(texts)]
    number, words, sizes = {START: 0}, [], []
    for _, text, _ in rows:
        ids = [0, *(number.setdefault(w, len(number)) for w in tokens_of(text))]
        words += ids
        sizes.append(len(ids))
    hashes = np.array([lm_score._word_hash(w) for w in number], "<u8").tobytes()
    packed = lm_score._pack(np.array(words, np.uint64))
    marks = [r[2] for r in rows]
    block = Block(
        {"ids": marks, "train": marks, "sizes": sizes, "words": packed, "hashes": hashes}, 3
    )
    n = [level.uses for level in block.levels]
    expected = by_force(rows)
    denominator = expected[0][4] + 0.1 * ((n[0][1:] > 0).sum() + 1)
    automaton = Automaton(block.levels, n, denominator, PRIOR)
    for at, size, row in zip(block.starts, sizes, expected):
        found = automaton.read(block.words[at + 1 : at + size].tolist())
        assert found == pytest.approx(row[6], rel=1e-9)
    # After every history that doesn't end a text, all known words and an unknown one sum to one.
    known = [i for i in range(1, len(number)) if n[0][i] > 0]
    last = np.concatenate([[0], block.levels[0].word, block.levels[1].word])
    for state in np.flatnonzero(last != number[END]):
        unknown = 0.1 / denominator
        at = state
        while at:
            unknown *= 10 ** automaton.miss[at]
            at = automaton.back[at]
        start, automaton.start = automaton.start, state
        total = sum(10 ** automaton.read([w]) for w in known) + unknown
        automaton.start = start
        assert total == pytest.approx(1, rel=1e-9)


@pytest.mark.parametrize("numbers", [[], [0], [255, 256, 0], [2**63, 2**64 - 1, 1]])
@pytest.mark.parametrize("noise", [0, 5])
def test_packing(numbers, noise):
    numbers = np.array(numbers, np.uint64)
    assert lm_score._unpack(lm_score._pack(numbers, noise)).tolist() == numbers.tolist()


def test_edges(spark):
    docs = edge_docs(spark)
    train = F.coalesce(id_residue("doc_id", 10) != 0, F.lit(True))
    marked = {r["doc_id"]: r["t"] for r in docs.select("doc_id", train.alias("t")).collect()}
    rows = [(r[0], r[1], marked[r[0]]) for r in edge_rows()]
    compare(lm_scores(docs, train), by_force(rows))
    assert lm_scores(empty_docs(spark), train).count() == 0
    nobody = lm_scores(docs, F.lit(None).cast("boolean")).collect()
    assert {r["n_known"] for r in nobody} == {0} and {r["train_tokens"] for r in nobody} == {0}


def test_rare_ngrams_have_histories_at_every_size(spark):
    """Two occurrences are enough, however many other tokens there are."""
    rows = [(i, "x " * 10_000, True) for i in range(30)]
    rows += [(100, "p q r s", True), (101, "p q r t", True), (102, "p q r", False)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, t boolean").repartition(3)
    found = lm_scores(docs, F.col("t"))
    compare(found, by_force(rows))
    last = found.filter("doc_id = 102").first()
    assert last["score"] > last["base_score"] + 5


def test_held_out_texts_are_better_than_unigrams(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    found = lm_scores(docs, id_residue("doc_id", 10) != 0).filter("not trained")
    sums = found.agg(F.sum("base_score"), F.sum("score")).first()
    assert sums[1] > sums[0]
