"""Mixing: targets against resharing by hand, budgets against what lengths allow, whole mixes."""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from tests.llm.cases import WORD, edge_docs, edge_rows, empty_docs, rows_of
from tillflow.llm.mixing import fit_budget, mix, mixture_targets


def targets_by_force(sizes: dict, weights=(5, 2, 1), share=1.5, cap=2):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, target, open_ = share * sum(sizes.values()), {}, set(names)
    while open_:
        whole = sum(weight[s] for s in open_)
        left = total - sum(target.values())
        above = [s for s in open_ if left * weight[s] / whole > cap * sizes[s]]
        if not above:
            target.update({s: left * weight[s] / whole for s in open_})
            break
        for s in above:
            target[s] = float(cap * sizes[s])
            open_.remove(s)
    return target


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 100, "b": 100, "c": 100},
        {"a": 1, "b": 1000, "c": 10, None: 500, "": 7, "é": 0},
        {"a": 0},
        {f"s{i}": (i * 37) % 101 for i in range(25)},
    ],
)
def test_targets(spark, sizes):
    table = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    found = {r["source"]: r["target"] for r in mixture_targets(table).collect()}
    assert found == pytest.approx(targets_by_force(sizes))


@settings(max_examples=200, deadline=None)
@given(
    st.dictionaries(st.integers(1, 30), st.integers(1, 4), max_size=6), st.integers(0, 200)
)
def test_budget_bounds(counts, budget):
    lengths = np.array(sorted(counts), np.int64)
    numbers = np.array([counts[n] for n in sorted(counts)], np.int64)
    taken = fit_budget(lengths, numbers, budget)
    assert (taken >= 0).all() and (taken <= numbers).all()
    words = int((lengths * taken).sum())
    assert words <= max(budget, 0)
    # What is left is less than the shortest document that could still be taken.
    free = lengths[taken < numbers]
    assert not len(free) or budget - words < free.min()


def nearest_by_force(counts: dict, budget: int) -> int:
    """The largest sum up to the budget, of all choices there are."""
    sums = {0}
    for length, n in counts.items():
        sums = {s + k * length for s in sums for k in range(n + 1)}
    return max(s for s in sums if s <= max(budget, 0))


@settings(max_examples=300, deadline=None)
@given(
    st.dictionaries(st.integers(1, 60), st.integers(1, 6), max_size=6), st.integers(0, 600)
)
def test_budget_against_all_choices(counts, budget):
    lengths = np.array(sorted(counts), np.int64)
    numbers = np.array([counts[n] for n in sorted(counts)], np.int64)
    taken = fit_budget(lengths, numbers, budget)
    assert (taken >= 0).all() and (taken <= numbers).all()
    assert int((lengths * taken).sum()) == nearest_by_force(counts, budget)


@pytest.mark.parametrize(
    "counts, budget",
    [({3: 2, 4: 2}, 8), ({2: 3, 5: 3}, 10), ({7: 4, 11: 4}, 44), ({40_000: 9, 3: 1}, 50_000)],
)
def test_budget_gives_back(counts, budget):
    lengths, numbers = np.array(list(counts)), np.array(list(counts.values()))
    words = int((lengths * fit_budget(lengths, numbers, budget)).sum())
    assert words == nearest_by_force(counts, budget)


@settings(max_examples=100, deadline=None)
@given(
    st.dictionaries(st.integers(1, 40), st.integers(1, 30), min_size=1, max_size=6),
    st.integers(0, 3000),
)
def test_budget_beyond_the_knapsack(counts, budget):
    """With a knapsack far smaller than the budget: within bounds, never worse than greedy."""
    lengths = np.array(sorted(counts), np.int64)
    numbers = np.array([counts[n] for n in sorted(counts)], np.int64)
    taken = fit_budget(lengths, numbers, budget, last_words=100)
    assert (taken >= 0).all() and (taken <= numbers).all()
    words = int((lengths * taken).sum())
    assert words <= max(budget, 0)
    free = lengths[taken < numbers]
    assert not len(free) or budget - words < free.min()


def test_budget_is_hit_when_lengths_allow():
    lengths, counts = np.arange(3, 2000), np.full(1997, 50)
    for budget in (1, 2, 3, 77, 123_456, 9_999_999):
        taken = fit_budget(lengths, counts, budget)
        words = int((lengths * taken).sum())
        assert words == budget if budget > 2 else words == 0


COLUMNS = ("doc_id", "size", "source", "source_size", "target", "taken")


def test_edges(spark):
    docs = edge_docs(spark)
    found = mix(docs)
    got = found.collect()
    assert Counter((r["doc_id"], r["size"]) for r in got) == Counter(
        (r[0], len(WORD.findall(r[1] or ""))) for r in edge_rows()
    )
    sizes = defaultdict(int)
    for row in edge_rows():
        sizes[row[3]] += len(WORD.findall(row[1] or ""))
    target = targets_by_force(sizes)
    taken = defaultdict(int)
    for r in got:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(target[r["source"]])
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        taken[r["source"]] += r["taken"]
    longest = {s: max(len(WORD.findall(r[1] or "")) for r in edge_rows() if r[3] == s) for s in sizes}
    for s in sizes:
        assert abs(taken[s] - target[s]) <= longest[s]
    again = mix(docs.repartition(7))
    assert rows_of(again, *COLUMNS) == rows_of(found, *COLUMNS)
    assert mix(empty_docs(spark)).count() == 0


def test_targets_are_met_by_the_word(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    taken = mix(docs).groupBy("source").agg({"taken": "sum", "target": "max"}).collect()
    assert all(abs(r["sum(taken)"] - r["max(target)"]) < 50 for r in taken)


def test_rows_without_ids_are_taken_alike_in_any_order(spark):
    texts = [f"text {i} of some words here" for i in range(40)]

    def taken(order):
        rows = [(None, t, "a") for t in order]
        df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
        df = df.withColumn("name", F.col("text"))
        found = mix(df, share=0.5, row_col="name").filter("taken > 0").collect()
        return sorted(r["name"] for r in found)

    once = taken(texts)
    assert once == taken(texts[::-1]) == taken(sorted(texts, key=hash)) and 0 < len(once) < 40
