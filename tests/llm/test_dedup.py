"""Exact and line deduplication against brute force."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from tests.llm.cases import edge_docs, edge_rows, empty_docs, lower, rows_of
from tillflow.llm.exact_dedup import exact_dedup
from tillflow.llm.line_dedup import line_dedup


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def exact_by_force(rows):
    groups = defaultdict(list)
    for key, text in rows:
        groups[lower(text or "")].append(key)
    out = Counter()
    for text, keys in groups.items():
        known = [k for k in keys if k is not None]
        keep = max(known) if known else None
        left = 1
        for key in keys:
            kept = key == keep and left > 0
            left -= kept
            out[(key, keep, len(keys), kept, sha(text))] += 1
    return out


EXACT = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def test_exact_edges(spark):
    expected = exact_by_force([(r[0], r[1]) for r in edge_rows()])
    assert rows_of(exact_dedup(edge_docs(spark)), *EXACT) == expected
    assert exact_dedup(empty_docs(spark)).count() == 0


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(
            st.one_of(st.none(), st.integers(0, 9)),
            st.one_of(st.none(), st.text("aAbé\n", max_size=12)),
        ),
        max_size=25,
    )
)
def test_exact_short_digits(spark, rows):
    # Digits of one byte, then two, four ...: many levels.
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = exact_dedup(docs, first_digit=1, widening=2)
    assert rows_of(found, *EXACT) == exact_by_force(rows)


def lines_by_force(rows, min_chars=40, min_docs=5):
    blanks = " \t\n\x0b\x0c\r"
    holders = defaultdict(list)
    for key, text in rows:
        for line in {lower(x.strip(blanks)) for x in (text or "").split("\n")}:
            if len(line) >= min_chars:
                holders[line].append(key)
    last = {
        k: max((i for i in ids if i is not None), default=None)
        for k, ids in holders.items()
        if len(ids) >= min_docs
    }
    out = Counter()
    for key, text in rows:
        lines = (text or "").split("\n")
        stay = []
        for line in lines:
            norm = lower(line.strip(blanks))
            if norm not in last or key is None or key == last[norm]:
                stay.append(line)
        out[(key, len(lines), len(lines) - len(stay), "\n".join(stay))] += 1
    return out


def test_line_edges(spark):
    found = line_dedup(edge_docs(spark))
    expected = lines_by_force([(r[0], r[1]) for r in edge_rows()])
    assert rows_of(found, "doc_id", "n_lines", "n_dropped", "text") == expected
    assert sum(n for (_, _, dropped, _), n in expected.items() if dropped) == 7
    assert line_dedup(empty_docs(spark)).count() == 0


@pytest.mark.parametrize("min_docs", [2, 3])
def test_line_small_limits(spark, min_docs):
    rows = [(i, "\n".join(f" Line {j}\t" for j in range(i % 4, 4))) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = line_dedup(docs, min_chars=3, min_docs=min_docs)
    expected = lines_by_force(rows, 3, min_docs)
    assert rows_of(found, "doc_id", "n_lines", "n_dropped", "text") == expected


def test_line_dedup_runs_no_python(spark, capsys):
    line_dedup(edge_docs(spark)).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_line_counts_documents_not_rows(spark):
    line = "a line of more than forty characters, shared by some documents"
    rows = [(1, line), (2, line), (3, line), (3, line), (3, line)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert line_dedup(docs).agg(F.sum("n_dropped")).first()[0] == 0
    more = docs.union(spark.createDataFrame([(None, line), (None, line)], docs.schema))
    assert line_dedup(more).agg(F.sum("n_dropped")).first()[0] == 2


def test_many_lost_lines(spark):
    """All lines of long documents are lost but those between, before and behind them."""
    shared = [f"line {i} of a passage that many documents share word by word" for i in range(20_000)]
    rows = []
    for doc in range(6):
        own = [f"{doc}", *(x for line in shared for x in (line, "-"))]
        rows.append((doc, "\n".join([*own, shared[0].upper() + " "])))
    rows.append((3, "\n".join(shared[:2])))  # a second text of an id
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {(r[0], r[2]): (r[1], r[3]) for r in line_dedup(docs).collect()}
    assert len(found) == 7
    assert found[3, 2] == ("", 2)
    assert found[5, 40_002] == (rows[5][1], 0)
    for doc in range(5):
        assert found[doc, 40_002] == ("\n".join([str(doc), *["-"] * 20_000]), 20_001)
