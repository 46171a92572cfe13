"""Byte-level BPE: exact round trips, and parts that add up to the whole."""

from __future__ import annotations

import numpy as np
import public_tokenizers
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.cases import edge_docs, edge_rows, empty_docs
from tillflow.llm import bpe

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
ENCODING = tiktoken.Encoding(
    "test",
    pat_str=public_tokenizers.PATTERN,
    mergeable_ranks=bpe.read_ranks(RANKS),
    special_tokens={},
)


def test_round_trip_of_edges(spark):
    docs = edge_docs(spark)
    encoded = bpe.encode(docs, RANKS, public_tokenizers.PATTERN)
    found = bpe.decode(encoded, RANKS, public_tokenizers.PATTERN).collect()
    at_once = bpe.round_trip(docs, RANKS, public_tokenizers.PATTERN).collect()
    assert sorted(map(str, at_once)) == sorted(map(str, found))
    expected = sorted(
        (text or "").encode() for _, text, *_ in edge_rows()
    )
    assert sorted(bytes(r["decoded"]) for r in found) == expected
    plain = {t: len(ENCODING.encode_ordinary(t or "")) for _, t, *_ in edge_rows()}
    assert sorted(r["n_tokens"] for r in found) == sorted(plain[t] for _, t, *_ in edge_rows())
    for r in found:
        assert np.frombuffer(r["ids"], "<u4").size == r["n_tokens"]
    assert bpe.encode(empty_docs(spark), RANKS, public_tokenizers.PATTERN).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.text(st.sampled_from(" \t\n\x85 ab'sé1!日\x1c"), max_size=60))
def test_cuts_change_nothing(text):
    assert "".join(bpe._parts(text, 3)) == text
    ids = []
    for part in bpe._parts(text, 3):
        ids += ENCODING.encode_ordinary(part)
    assert ids == ENCODING.encode_ordinary(text)


def test_long_white_space():
    for text in (" " * 700, "a" + " " * 700 + "b", "\n" * 600 + "\tx", " " * 600 + "\x85" * 5):
        assert bpe.encode_text(ENCODING, text) == ENCODING.encode_ordinary(text)
    text = "a" + " " * 1_000_000 + "b"  # too much for the pattern alone
    assert ENCODING.decode_bytes(bpe.encode_text(ENCODING, text)) == text.encode()
