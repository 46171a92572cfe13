"""Language identification: forward sums against all segmentations, held-out accuracy."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from pyspark.sql import functions as F

from tests.llm.cases import edge_docs, edge_rows, empty_docs
from tillflow.llm import language_id as li
from tillflow.llm.common import id_residue

PIECES = {piece: i for i, piece in enumerate([b" ", b"a", b"b", b" a", b"ab", b"ba", b" ab", b"bab"])}
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def segmentations(raw: bytes):
    if not raw:
        yield []
    for n in range(1, len(raw) + 1):
        if raw[:n] in PIECES:
            for rest in segmentations(raw[n:]):
                yield [raw[:n], *rest]


def toy_model():
    chance = np.random.default_rng(1).dirichlet(np.ones(len(PIECES)), 2).T
    sizes = np.array([len(p) for p in PIECES])[:, None]
    table = np.vstack([chance * li.PER_BYTE**sizes, np.zeros(2)])
    return li.Model(["x", "y"], np.zeros(2), PIECES, table), chance


@pytest.mark.parametrize("word", ["a", "ab", "abba", "babab", "aabbab"])
def test_forward_sums_all_segmentations(word):
    model, chance = toy_model()
    expected = sum(
        np.prod([chance[PIECES[p]] for p in cut], axis=0)
        for cut in segmentations(b" " + word.encode())
    )
    assert np.allclose(np.exp(li.word_scores([word], model)[0]), expected)


def test_expected_uses():
    used = np.zeros(len(PIECES) + 1)
    li._expected(Counter({"abab": 3}), PIECES, used)
    cuts = list(segmentations(b" abab"))
    weights = [len(PIECES) ** -len(cut) for cut in cuts]
    for piece, i in PIECES.items():
        share = sum(w * cut.count(piece) for w, cut in zip(weights, cuts)) / sum(weights)
        assert math.isclose(used[i], 3 * share, abs_tol=1e-9)


def test_edges(spark):
    docs = edge_docs(spark)
    model = li.learn(docs, RANKS)
    assert model.languages == ["de", "en", "fr"]
    found = li.identify(docs, model).collect()
    by_id = {r["doc_id"]: r for r in found}
    assert len(found) == len(edge_rows())
    for key in (3, 4, 5):
        assert (by_id[key]["lang_pred"], by_id[key]["score"]) == ("und", 0.0)
    assert by_id[6]["lang_pred"] == "en"
    assert all(0.0 <= r["score"] <= 1.0 for r in found)
    assert li.identify(empty_docs(spark), model).count() == 0
    nothing = li.learn(empty_docs(spark), RANKS)
    assert {r["lang_pred"] for r in li.identify(docs, nothing).collect()} == {"und"}


def test_held_out_accuracy(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    held_out = id_residue("doc_id", 4) == 2
    model = li.learn(docs.filter(~held_out), RANKS)
    found = li.identify(docs.filter(held_out), model).join(docs.select("doc_id", "lang"), "doc_id")
    right = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right >= 0.95
