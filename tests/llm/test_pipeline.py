"""The corpus pipeline, stage by stage, against the operators' brute force."""

from __future__ import annotations

from collections import Counter

import pytest

import corpus_pipeline
from tests.llm.cases import WORD, edge_docs, empty_docs
from tests.llm.test_dedup import lines_by_force
from tests.llm.test_jaccard import by_force as joined_by_force
from tests.llm.test_quality import rules_by_force
from tests.llm.test_tokens import ENCODING
from tillflow.llm.quality import MIN_GROUP

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def texts(df):
    return Counter((r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect())


def run_stages(spark, docs, check):
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = corpus_pipeline.stored(stage(spark, docs, ""), f"test-{name}")
        if name != "byte_level_bpe":
            assert docs.columns == before.columns
        if check:
            CHECKS[name](before, docs)
    return docs


def check_quality(before, after):
    rows = [tuple(r) for r in before.select("doc_id", "text", "lang", "source").collect()]
    judged = rules_by_force(rows, MIN_GROUP)
    kept = Counter({k[0]: n for k, n in judged.items() if k[-1]})
    assert Counter(r["doc_id"] for r in after.select("doc_id").collect()) == kept


def check_lines(before, after):
    expected = lines_by_force(list(texts(before).elements()))
    assert texts(after) == Counter((k[0], k[3]) for k in expected.elements())
    assert all(r["n_chars"] == len(r["text"]) for r in after.select("text", "n_chars").collect())


def check_near(before, after):
    rows = list(texts(before).elements())
    kept = Counter(k[0] for k in joined_by_force(rows).elements() if k[-1])
    assert Counter(r["doc_id"] for r in after.select("doc_id").collect()) == kept


def check_mix(before, after):
    was, now = texts(before), texts(after)
    assert set(now) <= set(was) and all(n <= 2 * was[k] for k, n in now.items())
    size = lambda c: sum(len(WORD.findall(t or "")) * n for (_, t), n in c.items())
    assert abs(size(now) - 1.5 * size(was)) < 0.01 * size(was)


def check_tokens(before, after):
    expected = Counter((k, len(ENCODING.encode_ordinary(t))) for k, t in texts(before).elements())
    assert Counter(map(tuple, after.select("doc_id", "n_tokens").collect())) == expected


CHECKS = dict(
    zip(
        [name for name, _ in corpus_pipeline.STAGES],
        [check_quality, check_lines, check_near, check_mix, check_tokens],
    )
)


def test_stages(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    assert docs.columns == COLUMNS
    last = run_stages(spark, docs, check=True)
    assert last.count() == corpus_pipeline.run(spark, small_dir).count()


@pytest.mark.parametrize("make", [edge_docs, empty_docs])
def test_edges(spark, make):
    run_stages(spark, make(spark), check=False)
