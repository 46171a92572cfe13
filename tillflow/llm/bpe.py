"""Byte-level BPE: texts to token ids and back to bytes.

The ranks come from a local file that the driver reads once; executors get
them as a broadcast of fixed size (the vocabulary), so they need no file. A
task encodes record batches one after the other; long texts are encoded in
parts, so that neither a batch nor a text of any length fills a worker.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.llm.common import text_of

PART_CHARS = 1 << 16
LONG_BLANK = 512
FLUSH_BYTES = 8 << 20

# What the pattern's \s means: the Unicode property White_Space.
_SPACE = "\t-\r \x85\xa0  -     　"
_LONG_SPACES = re.compile(f"[{_SPACE}]{{{LONG_BLANK},}}")
_WORD_ENDS = re.compile(f"[^{_SPACE}](?=[{_SPACE}])")


def read_ranks(path: str) -> dict[bytes, int]:
    """The rank file: a base64 token and its rank in each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


_built: dict[tuple, object] = {}


def _encoding(ranks: Broadcast, pattern: str):
    """The encoding of this worker; building it anew for each task would be slow."""
    import tiktoken

    key = (ranks._jid if hasattr(ranks, "_jid") else id(ranks), len(ranks.value), pattern)
    if key not in _built:
        _built.clear()
        _built[key] = tiktoken.Encoding(
            "ranks", pat_str=pattern, mergeable_ranks=ranks.value, special_tokens={}
        )
    return _built[key]


def _parts(text: str, size: int = PART_CHARS) -> Iterator[str]:
    """``text`` cut where a match of the pattern must end.

    No match goes on from a character that is no white space to one that is,
    and none looks behind, so each such place may be cut. Without any, the
    text stays whole.
    """
    start = 0
    while len(text) - start > size:
        end = _WORD_ENDS.search(text, start + size)
        if end is None:
            break
        yield text[start : end.end()]
        start = end.end()
    yield text[start:] if start else text


def encode_text(encoding, text: str) -> list[int]:
    """Ids of the text, as if the pattern had been applied to all of it at once.

    The pattern backs up in long white space; such a run is one match up to
    its last character (all of it at the end of the text) and is encoded as
    that one piece.
    """
    ids: list[int] = []
    start = 0
    for run in _LONG_SPACES.finditer(text):
        stop = run.end() if run.end() == len(text) else run.end() - 1
        for part in _parts(text[start : run.start()]):
            ids += encoding.encode_ordinary(part)
        ids += encoding._encode_single_piece(run.group()[: stop - run.start()])
        start = stop
    for part in _parts(text[start:] if start else text):
        ids += encoding.encode_ordinary(part)
    return ids


def _batches(rows: Iterator[dict], schema: pa.Schema, weigh: str) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    weight = 0
    for row in rows:
        held.append(row)
        weight += len(row[weigh]) + 64
        if weight > FLUSH_BYTES:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held, weight = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def encode(
    docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """A row per row of ``docs``: id, ``n_tokens``, ``ids`` (unsigned 32-bit, little endian).

    Special tokens are not used: their strings in a text are ordinary text.

    * A null text counts as empty; an empty text has no tokens.
    * Null and repeated ids are passed on; each row is encoded by itself.
    * An empty table gives no rows. Other columns are not looked at.
    """
    spark = docs.sparkSession
    ranks = spark.sparkContext.broadcast(read_ranks(rank_file))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        encoding = _encoding(ranks, pattern)

        def rows(batch):
            for key, text in zip(batch["id"].to_pylist(), batch["text"]):
                ids = encode_text(encoding, text.as_py())
                yield {
                    "id": key,
                    "n_tokens": len(ids),
                    "ids": np.asarray(ids, dtype="<u4").tobytes(),
                }

        for batch in batches:
            schema = pa.schema(
                [batch.schema.field("id"), ("n_tokens", pa.int64()), ("ids", pa.binary())]
            )
            yield from _batches(rows(batch), schema, "ids")

    texts = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    return texts.mapInArrow(run, f"id {kind}, n_tokens bigint, ids binary").withColumnRenamed(
        "id", id_col
    )


def decode(encoded: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``encode`` with ``decoded``: the raw bytes of the ids.

    Bytes, since ids may end inside a character; null ids give null.
    """
    spark = encoded.sparkSession
    ranks = spark.sparkContext.broadcast(read_ranks(rank_file))
    kind = encoded.schema[id_col].dataType.simpleString()

    def run(batches):
        encoding = _encoding(ranks, pattern)

        def rows(batch):
            for key, n, ids in zip(
                batch["id"].to_pylist(), batch["n_tokens"].to_pylist(), batch["ids"]
            ):
                packed = ids.as_py()
                raw = (
                    None
                    if packed is None
                    else encoding.decode_bytes(np.frombuffer(packed, dtype="<u4").tolist())
                )
                yield {"id": key, "n_tokens": n, "ids": packed or b"", "decoded": raw}

        for batch in batches:
            fields = [batch.schema.field(c) for c in ("id", "n_tokens", "ids")]
            schema = pa.schema([*fields, ("decoded", pa.binary())])
            yield from _batches(rows(batch), schema, "ids")

    packed = encoded.select(F.col(id_col).alias("id"), "n_tokens", "ids")
    return packed.mapInArrow(
        run, f"id {kind}, n_tokens bigint, ids binary, decoded binary"
    ).withColumnRenamed("id", id_col)


def round_trip(
    docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``decode(encode(docs))`` by one Python worker for each task instead of two."""
    spark = docs.sparkSession
    ranks = spark.sparkContext.broadcast(read_ranks(rank_file))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        encoding = _encoding(ranks, pattern)

        def rows(batch):
            for key, text in zip(batch["id"].to_pylist(), batch["text"]):
                ids = encode_text(encoding, text.as_py())
                yield {
                    "id": key,
                    "n_tokens": len(ids),
                    "ids": np.asarray(ids, dtype="<u4").tobytes(),
                    "decoded": encoding.decode_bytes(ids),
                }

        for batch in batches:
            fields = [("n_tokens", pa.int64()), ("ids", pa.binary()), ("decoded", pa.binary())]
            schema = pa.schema([batch.schema.field("id"), *fields])
            yield from _batches(rows(batch), schema, "ids")

    texts = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    return texts.mapInArrow(
        run, f"id {kind}, n_tokens bigint, ids binary, decoded binary"
    ).withColumnRenamed("id", id_col)
