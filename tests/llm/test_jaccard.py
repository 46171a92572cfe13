"""The similarity join against all pairs."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.cases import edge_docs, edge_rows, empty_docs
from tillflow.llm import jaccard_join as jj
from tillflow.llm.components import components
from tillflow.llm.jaccard_join import jaccard_join, runs_for, words_of


def by_force(rows, similarity=0.8):
    sets, best = {}, {}
    for place, (key, text) in enumerate(rows):
        words = tuple(words_of(text or ""))
        if words:
            n = min(5, len(words))
            sets[words] = {words[i : i + n] for i in range(len(words) - n + 1)}
            mark = (key is not None, key or 0)
            best[words] = max(best.get(words, mark), mark)
    names = list(sets)
    up = list(range(len(names)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    links = Counter()
    for i, a in enumerate(names):
        for j in range(i):
            common = len(sets[a] & sets[names[j]])
            if common / (len(sets[a]) + len(sets[names[j]]) - common) >= similarity:
                links[i] += 1
                links[j] += 1
                up[root(i)] = root(j)
    top = defaultdict(lambda: (False, 0))
    for i, a in enumerate(names):
        top[root(i)] = max(top[root(i)], best[a])
    place = {a: i for i, a in enumerate(names)}
    copies = Counter(tuple(words_of(text or "")) for _, text in rows)
    out, left = Counter(), Counter()
    for key, text in rows:
        words = tuple(words_of(text or ""))
        if not words:
            out[(key, key, 1, 0, key, True)] += 1
            continue
        i = place[words]
        own, cls = best[words], top[root(i)]
        kept = (key is not None, key or 0) == cls and own == cls and not left[root(i)]
        left[root(i)] += kept
        pick = lambda mark: mark[1] if mark[0] else None
        out[(key, pick(own), copies[words], links[i], pick(cls), kept)] += 1
    return out


COLUMNS = ("doc_id", "copy_of", "n_copies", "n_links", "class_id", "kept")


def found_rows(docs):
    return Counter(map(tuple, jaccard_join(docs).select(*COLUMNS).collect()))


def near_copies(groups: int, size: int, words: int, seed: int = 3):
    """Groups of texts that differ in a few places, and passages that groups share."""
    draw = random.Random(seed)
    shared = [f"s{i}" for i in range(30)]
    rows, key = [], 0
    for g in range(groups):
        base = [f"g{g}w{i}" for i in range(words)]
        for _ in range(size):
            text = list(base)
            for _ in range(draw.randrange(4)):
                text[draw.randrange(words)] = f"x{draw.randrange(10**6)}"
            rows.append((key, " ".join(text + shared)))
            key += 1
    return rows


def test_edges(spark):
    rows = [(r[0], r[1]) for r in edge_rows()]
    assert found_rows(edge_docs(spark)) == by_force(rows)
    assert jaccard_join(empty_docs(spark)).count() == 0


@pytest.mark.parametrize("shape", [(25, 4, 60), (1, 90, 120)])
def test_groups(spark, monkeypatch, shape):
    monkeypatch.setattr(jj, "BLOCK_ROWS", 32)  # the large group is compared by blocks
    rows = near_copies(*shape)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert found_rows(docs) == by_force(rows)


def test_given_documents(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet").select("doc_id", "text")
    assert found_rows(docs) == by_force([tuple(r) for r in docs.collect()])


def test_overlaps():
    draw = np.random.default_rng(0)
    sets = [np.unique(draw.integers(0, 60_000, 3000)).astype(np.uint64) for _ in range(12)]
    assert (jj._overlaps(sets) == [[len(set(a) & set(b)) for b in sets] for a in sets]).all()


def test_overlaps_with_others_and_columns_that_are_not_made(monkeypatch):
    draw = np.random.default_rng(1)
    own = [draw.integers(0, 2**63, 2000).astype(np.uint64) for _ in range(60)]
    most, few = np.arange(300, dtype=np.uint64), np.arange(300, 330, dtype=np.uint64)
    sets = [np.unique(np.concatenate((x, most[i % 2 :], few[i // 2 : i // 2 + 2]))) for i, x in enumerate(own)]
    wanted = np.array([[len(set(a) & set(b)) for b in sets] for a in sets])
    made, zeros = [], np.zeros
    monkeypatch.setattr(np, "zeros", lambda shape, *kind: made.append(shape) or zeros(shape, *kind))
    assert (jj._overlaps(sets) == wanted).all()
    assert (jj._overlaps(sets[:20], sets[20:]) == wanted[:20, 20:]).all()
    assert sum(shape[1] for shape in made if shape[1] != 60 and len(shape) == 2) < 200, made


@pytest.mark.parametrize("across", [False, True])
def test_compared_blocks(across):
    draw = np.random.default_rng(2)
    base = [draw.integers(0, 2**63, 120).astype(np.uint64) for _ in range(9)]
    sets = [np.sort(base[i % 9][draw.random(120) > 0.08]) for i in range(70)]
    blocks = [int(across and draw.random() < 0.4) for _ in sets]
    alike = np.array([[len(set(a) & set(b)) / len(set(a) | set(b)) >= 0.8 for b in sets] for a in sets])
    alike &= np.not_equal.outer(blocks, blocks) if across else ~np.eye(70, dtype=bool)
    found = jj._compare(list(range(70)), blocks, sets, across, 0.8)
    wanted = {i: n for i, n in enumerate(alike.sum(axis=1).tolist()) if n}
    assert {n: links for n, _, links in found} == wanted
    reach = (alike | np.eye(70, dtype=bool)).astype(int)
    for _ in range(7):
        reach = (reach @ reach > 0).astype(int)
    root = {n: r for n, r, _ in found}
    assert all((root[a] == root[b]) == bool(reach[a, b]) for a in root for b in root)


def test_signs_are_those_of_the_words(monkeypatch):
    draw = random.Random(7)
    some = ["a", "B", "b", "É", "\x1c", "\x85", "x" * 64, "x" * 65, "x" * 66, "y" * 500, "word", "ſ"]
    blanks = [" ", "\n", "\t\r", "\x0b \x0c", "   "]
    texts = ["", " \n", "one", "\tone ", " A b c d", "a b c d e"] + [
        "".join(draw.choice(some) + draw.choice(blanks) for _ in range(draw.randrange(40))) for _ in range(150)
    ]
    whole = list(jj._signs(pa.array(texts)))
    monkeypatch.setattr(jj, "CHUNK_BYTES", 300)
    monkeypatch.setattr(jj, "CHUNK_WORDS", 3)
    hashes, copies = {}, {}
    for text, (copy, found), (_, cut) in zip(texts, whole, jj._signs(pa.array(["off", *texts])[1:])):
        words = tuple(words_of(text))
        n = min(5, len(words))
        sets = {words[i : i + n] for i in range(len(words) - n + 1)} if n else set()
        assert copies.setdefault(words, copy) == copy
        assert found.tolist() == cut.tolist() == sorted(set(found.tolist())) and len(found) == len(sets)
        hashes.setdefault(frozenset(sets), found.tolist())
        assert hashes[frozenset(sets)] == found.tolist()
    assert len(set(copies.values())) == len(copies)
    every = set().union(*hashes)
    assert len(set().union(*hashes.values())) == len(every)


def test_values_of_sets_without_a_common_shingle_differ():
    draw = np.random.default_rng(3)
    sets = [np.unique(draw.integers(0, 2**64, 4000, dtype=np.uint64)) for _ in range(1500)]
    values = np.array([jj.minhashes(found) for found in sets])
    equal = sum(len(v) - len(np.unique(v)) for v in values.T)
    assert equal < 5, equal


def test_values_agree_as_sets_are_similar():
    draw = np.random.default_rng(4)
    for size in (20, 300, 3000):
        apart = []
        for _ in range(100):
            every = draw.integers(0, 2**64, size, dtype=np.uint64)
            same = size * 8 // 10
            one, two = every[: same + size // 10], np.delete(every, slice(same, same + size // 10))
            equal = jj.minhashes(np.sort(one)) == jj.minhashes(np.sort(two))
            apart.append(equal.mean() - 0.8)
        assert abs(np.mean(apart)) < 0.025 and np.std(apart) < 0.08


def test_runs():
    assert 1 <= runs_for(0.8, 0.9) < runs_for(0.8, 0.999)


def test_components(spark):
    draw = random.Random(5)
    edges = [(i, i + 1) for i in range(60)] + [
        (draw.randrange(100, 300), draw.randrange(100, 300)) for _ in range(150)
    ]
    found = dict(components(spark.createDataFrame(edges, "a bigint, b bigint")).collect())
    up = {n: n for e in edges for n in e}

    def root(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        up[b] = a
    alone = {n for a, b in edges if a == b for n in (a,)} - {n for a, b in edges if a != b for n in (a, b)}
    assert found == {n: root(n) for n in up if n not in alone}
