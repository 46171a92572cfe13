"""Quality rules: counts, sketches and fences against brute force."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.cases import WORD, edge_docs, edge_rows, empty_docs, rows_of
from tillflow.llm.quality import RATES, quality_rules, repeated_words, text_counts


def counts_by_force(text):
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = {w for w, n in Counter(windows).items() if n > 1}
    inside = {i + k for i, w in enumerate(windows) if w in often for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(inside),
        len(lines),
    )


@settings(max_examples=200, deadline=None)
@given(st.text("ab #|\n\té", max_size=80))
def test_counts(text):
    assert text_counts(text) == counts_by_force(text)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b"]), max_size=40))
def test_repeated_words(words):
    assert repeated_words(words) == counts_by_force(b" ".join(words).decode())[4]


def bucket(value: int) -> int:
    shift = max(value.bit_length() - 11, 0)
    return value >> shift << shift


def rules_by_force(rows, min_group):
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
    rows = [(key, lang, source, dict(zip(names, counts_by_force(text or "")))) for key, text, lang, source in rows]

    def rate(name, c):
        top, bottom, _, _ = RATES[name]
        return 1000 * c[top] // c[bottom]

    groups = defaultdict(lambda: defaultdict(list))
    for _, lang, source, c in rows:
        if c["n_words"]:
            for name in RATES:
                for group in ((0, lang, source), (1, lang, None), (2, None, None)):
                    groups[group][name].append(bucket(rate(name, c)))
    out = Counter()
    for key, lang, source, c in rows:
        base = c["n_words"] < 10 or 100 * c["n_repeat_words"] > 20 * c["n_words"]
        rejected = []
        if c["n_words"]:
            for group in ((0, lang, source), (1, lang, None), (2, None, None)):
                if len(groups[group]["symbols"]) >= min_group or group[0] == 2:
                    break
            for name, (_, _, least, both) in RATES.items():
                values = sorted(groups[group][name])
                n = len(values)
                q1, q3 = values[-(-n // 4) - 1], values[-(-3 * n // 4) - 1]
                reach = 3 * max(q3 - q1, least)
                r = rate(name, c)
                if r > q3 + reach or (both and r < q1 - reach):
                    rejected.append(name)
        out[(key, *c.values(), base, tuple(rejected), not base and not rejected)] += 1
    return out


COLUMNS = (
    "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
    "base_failed", "rejected_by", "kept",
)


def found_rows(docs, **more):
    got = quality_rules(docs, **more).select(*COLUMNS).collect()
    return Counter(tuple(tuple(v) if isinstance(v, list) else v for v in r) for r in got)


@pytest.mark.parametrize("min_group", [1, 3, 200])
def test_edges(spark, min_group):
    rows = [(r[0], r[1], r[2], r[3]) for r in edge_rows()]
    assert found_rows(edge_docs(spark), min_group=min_group) == rules_by_force(rows, min_group)
    assert quality_rules(empty_docs(spark)).count() == 0


def test_given_documents(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source").collect()]
    assert found_rows(docs, min_group=20) == rules_by_force(rows, 20)
    labels = spark.read.parquet(f"{small_dir}/labels.parquet")
    met = quality_rules(docs).join(labels, "doc_id").filter("not base_failed")
    kept = Counter((r["quality"], r["kept"]) for r in met.select("quality", "kept").collect())
    assert kept[(1, True)] >= 0.98 * (kept[(1, True)] + kept[(1, False)])
    assert kept[(0, False)] > kept[(0, True)]
