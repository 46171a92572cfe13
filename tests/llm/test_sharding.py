"""Sharding: every row once, gapless slots, even bytes, equal texts together."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

from tests.llm.cases import edge_docs, edge_rows, empty_docs
from tillflow.llm.sharding import shard_by_bytes


def check(rows, expected):
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == Counter(
        (key, len((text or "").encode()) + 16, zlib.crc32((text or "").encode()))
        for key, text in expected
    )
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    for found in slots.values():
        assert sorted(found) == list(range(len(found)))
    return slots


def test_edges(spark):
    rows = shard_by_bytes(edge_docs(spark)).collect()
    slots = check(rows, [(r[0], r[1]) for r in edge_rows()])
    assert set(slots) <= set(range(40))
    assert shard_by_bytes(empty_docs(spark)).count() == 0


def test_even_bytes_with_a_hot_text(spark):
    docs = [(i, "the same text again " * 5 if i % 3 == 0 else f"text {i} " * (1 + i % 7)) for i in range(6000)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    rows = shard_by_bytes(df, shards=8).collect()
    check(rows, docs)
    sizes = Counter()
    for r in rows:
        sizes[r["shard"]] += r["size"]
    mean = sum(sizes.values()) / 8
    assert len(sizes) == 8 and all(abs(s - mean) < 0.1 * mean for s in sizes.values())


def loads(rows):
    sizes = Counter()
    for r in rows:
        sizes[r["shard"]] += r["size"]
    return sizes


def test_equal_rows_without_ids_are_dealt_evenly(spark):
    docs = [(None, "no id, and the same text for a third of all rows")] * 3000
    docs += [(i, f"text {i} " * (1 + i % 5)) for i in range(6000)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(7)
    rows = shard_by_bytes(df).collect()
    check(rows, docs)
    sizes = loads(rows)
    mean = sum(sizes.values()) / 40
    assert len(sizes) == 40 and all(abs(s - mean) < 0.05 * mean for s in sizes.values())


def test_groups_lighter_than_a_shard_are_whole(spark):
    docs = [(i, f"text {i} " * (1 + i % 5)) for i in range(4000)]
    # Groups of a tenth to nine tenths of a shard, and one of two and a half.
    share = sum(len(t) + 16 for _, t in docs) // 6
    for g, part in enumerate([0.1, 0.3, 0.5, 0.7, 0.9, 2.5]):
        text = f"group {g} " * 4
        docs += [(10_000 + i, text) for i in range(int(part * share / (len(text) + 16)))]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)
    rows = shard_by_bytes(df, shards=11).collect()
    check(rows, docs)
    sizes, shards, weights = loads(rows), defaultdict(set), Counter()
    for r in rows:
        shards[r["text_crc32"]].add(r["shard"])
        weights[r["text_crc32"]] += r["size"]
    mean = sum(sizes.values()) / 11
    assert all(abs(s - mean) < 0.05 * mean for s in sizes.values())
    assert all(len(s) == 1 for crc, s in shards.items() if weights[crc] <= mean)
    assert max(map(len, shards.values())) > 1


def test_equal_texts_share_a_shard(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    rows = shard_by_bytes(docs.unionByName(docs), shards=4).collect()
    shards = defaultdict(set)
    for r in rows:
        shards[r["text_crc32"]].add(r["shard"])
    assert all(len(s) == 1 for s in shards.values())


def test_runs_no_python(spark, capsys):
    shard_by_bytes(edge_docs(spark)).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan
