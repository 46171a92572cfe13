"""Merkle manifests against trees built by recursion."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter, defaultdict

import pytest

from pyspark.sql import functions as F

from tests.llm.cases import edge_docs, edge_rows, empty_docs
from tillflow.llm.merkle import folded, merkle_manifest, proof_text


def sha(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row) -> str:
    out = []
    for value in row:
        text = None if value is None else str(value)
        out.append("-" if text is None else f"{len(text.encode())}:{text}")
    return sha(*out)


def tree(hashes, arity):
    """The root and the siblings of each leaf as (before, after), from below."""
    paths, groups = [[] for _ in hashes], [[i] for i in range(len(hashes))]
    while len(hashes) > 1:
        above, joined = [], []
        for at in range(0, len(hashes), arity):
            run = hashes[at : at + arity]
            for i, members in enumerate(groups[at : at + arity]):
                for m in members:
                    paths[m].append(("".join(run[:i]), "".join(run[i + 1 :])))
            above.append(sha(*run))
            joined.append(sum(groups[at : at + arity], []))
        hashes, groups = above, joined
    return hashes[0], paths


def by_force(rows, arity=2):
    """(id, leaf, subroot, root, proof, folded) for rows (doc_id, text, lang, source, n_chars)."""
    langs = defaultdict(list)
    for doc, text, lang, source, n in rows:
        touched = doc is not None and zlib.crc32(str(doc).encode()) % 7 == 0 and n is not None
        own = leaf((doc, source, lang, n, text))
        more = leaf((doc, source, lang, n + 1, text)) if touched else own
        langs[lang].append((doc is not None, doc or 0, own, more, doc))
    order = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    below = []
    for lang in order:
        langs[lang].sort(key=lambda x: x[:3])
        below.append(tree([x[2] for x in langs[lang]], arity))
    root, upper = tree([r for r, _ in below], arity)
    out = Counter()
    for lang, (subroot, paths), top in zip(order, below, upper):
        for (_, _, own, more, doc), path in zip(langs[lang], paths):
            full = path + top
            end = more
            for before, after in full:
                end = sha(before, end, after)
            out[(doc, own, subroot, root, sha(*[b + a for b, a in full]), end)] += 1
    return out


def found(docs, **shape):
    touched = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    more = F.col("n_chars") + F.when(touched, 1).otherwise(0)
    rows = merkle_manifest(docs, changed={"n_chars": more}, **shape).select(
        "doc_id", "leaf", "subroot", "root",
        F.sha2(proof_text(F.col("siblings")), 256),
        folded(F.col("changed_leaf"), F.col("siblings")),
    )
    return Counter(tuple(r) for r in rows.collect())


def test_edges(spark):
    assert found(edge_docs(spark)) == by_force([r[:5] for r in edge_rows()])
    assert found(empty_docs(spark)) == Counter()


@pytest.mark.parametrize("arity, band", [(2, 2), (3, 1), (4, 2)])
def test_many_bands(spark, arity, band):
    # Trees of 1 to 150 leaves, most of them no power of the arity, over several bands.
    sizes = {None: 5, "": 1, "a": 150, "b": arity**2, "c": arity**2 + 1, "ä": 2, "z": 33}
    rows, doc = [], 0
    for lang, n in sizes.items():
        for _ in range(n):
            doc += 1
            rows.append((doc * 7919 % 1009, f"text {doc}", lang, "s", doc))
    # A third of a tree is one row.
    rows += [(5000, "again", "a", "s", 1)] * 50
    docs = spark.createDataFrame(
        rows, "doc_id bigint, text string, lang string, source string, n_chars bigint"
    ).repartition(5)
    assert found(docs, arity=arity, band=band) == by_force(rows, arity)


def test_a_changed_row_is_found(spark):
    rows = [(i, f"t{i}", "en", "s", i) for i in range(40)]
    docs = spark.createDataFrame(
        rows, "doc_id bigint, text string, lang string, source string, n_chars bigint"
    )
    other = F.when(F.col("doc_id") == 7, F.lit("changed")).otherwise(F.col("text"))
    proven = merkle_manifest(docs, changed={"text": other})
    held = proven.filter(folded(F.col("changed_leaf"), F.col("siblings")) != F.col("root"))
    assert [r["doc_id"] for r in held.collect()] == [7]
