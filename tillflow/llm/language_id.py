"""Language identification by unigram pieces, summed over all segmentations.

The vocabulary is fixed and public: the byte pieces of a rank file. For each
language the pieces have probabilities; the probability of a word is the sum
over all ways to cut it into pieces, found by the forward algorithm, and that
of a text is the product over its words. Probabilities are learned by one step
of expectation-maximisation from equal pieces: every training word adds the
expected number of times that each piece is used in its segmentations.

Words repeat, so a worker keeps the scores of the words that it has met, in a
table of limited size, and the forward pass runs over many new words at once.
The model has a row per piece and a column per language: its size is that of
the vocabulary times the number of languages, whatever the corpus.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.llm.bpe import read_ranks

NOT_A_LANGUAGE = "und"
BACKGROUND = 1000.0
BLOCK_CHARS = 24
CHUNK_CHARS = 1 << 20
KNOWN_WORDS = 400_000
# Probabilities are kept multiplied by this for each byte, against underflow.
PER_BYTE = 30.0

_LETTERS = re.compile(r"[^\W\d_]+")
_NO_LETTER = re.compile(r"[\W\d_]")


class Model(NamedTuple):
    """``logs`` is the prior of each language; ``table`` piece x language, scaled by length."""

    languages: list[str]
    prior: np.ndarray
    pieces: dict[bytes, int]
    table: np.ndarray


def words_of(text: str) -> Iterator[list[str]]:
    """The lower-cased letter runs of the text, a list for each part of it."""
    start = 0
    while start < len(text):
        end = start + CHUNK_CHARS
        if end < len(text):
            gap = _NO_LETTER.search(text, end)
            end = gap.start() if gap else len(text)
        yield _LETTERS.findall(text[start:end].lower())
        start = end


def _blocks(word: str) -> list[bytes]:
    """The word as bytes behind a space; longer words in blocks that no piece crosses."""
    letters = "".join(filter(str.isalpha, word))
    cut = [letters[i : i + BLOCK_CHARS] for i in range(0, len(letters), BLOCK_CHARS)]
    return [(b"" if i else b" ") + part.encode() for i, part in enumerate(cut)]


def _by_length(blocks: list[bytes]) -> Iterator[tuple[int, list[int]]]:
    found: dict[int, list[int]] = {}
    for i, block in enumerate(blocks):
        found.setdefault(len(block), []).append(i)
    yield from found.items()


def _pieces_at(group: list[bytes], end: int, longest: int, pieces: dict[bytes, int]) -> np.ndarray:
    """Ids of the pieces that end at a position, by their length; the last id is "no piece"."""
    none = len(pieces)
    return np.array(
        [
            [pieces.get(block[end - n : end], none) for block in group]
            for n in range(1, min(end, longest) + 1)
        ],
        dtype=np.int32,
    )


def _forward(length: int, at: list[np.ndarray], table: np.ndarray) -> np.ndarray:
    """alpha[i, word, language]: the first i bytes, summed over their segmentations."""
    alpha = np.zeros((length + 1, at[0].shape[1], table.shape[1]))
    alpha[0] = 1.0
    for i in range(1, length + 1):
        for n in range(1, len(at[i - 1]) + 1):
            alpha[i] += alpha[i - n] * table[at[i - 1][n - 1]]
    return alpha


def word_scores(words: list[str], model: Model) -> np.ndarray:
    """Log probability of each word in each language."""
    scores = np.zeros((len(words), len(model.languages)))
    longest = max(map(len, model.pieces))
    blocks: list[bytes] = []
    owner: list[int] = []
    for i, word in enumerate(words):
        for block in _blocks(word):
            blocks.append(block)
            owner.append(i)
    owners = np.array(owner, dtype=np.int64)
    for length, chosen in _by_length(blocks):
        for lo in range(0, len(chosen), 4096):
            some = chosen[lo : lo + 4096]
            group = [blocks[i] for i in some]
            at = [_pieces_at(group, i, longest, model.pieces) for i in range(1, length + 1)]
            total = _forward(length, at, model.table)[length]
            logs = np.log(np.maximum(total, 1e-300)) - length * np.log(PER_BYTE)
            np.add.at(scores, owners[some], logs)
    return scores


def _expected(words: Counter, pieces: dict[bytes, int], used: np.ndarray) -> None:
    """Adds to ``used`` how often each piece is used in the words, all pieces being equal."""
    longest = max(map(len, pieces))
    sizes = np.zeros(len(pieces) + 1)
    for piece, i in pieces.items():
        sizes[i] = len(piece)
    table = np.power(PER_BYTE, sizes)[:, None] / len(pieces)
    table[-1] = 0.0
    blocks: Counter = Counter()
    for word, n in words.items():
        for block in _blocks(word):
            blocks[block] += n
    names = list(blocks)
    counts = np.array([blocks[name] for name in names], dtype=float)
    for length, chosen in _by_length(names):
        for lo in range(0, len(chosen), 4096):
            some = chosen[lo : lo + 4096]
            group = [names[i] for i in some]
            at = [_pieces_at(group, i, longest, pieces) for i in range(1, length + 1)]
            alpha = _forward(length, at, table)[:, :, 0]
            beta = np.zeros_like(alpha)
            beta[length] = 1.0
            for i in range(length, 0, -1):
                for n in range(1, len(at[i - 1]) + 1):
                    beta[i - n] += beta[i] * table[at[i - 1][n - 1], 0]
            weight = counts[some] / np.maximum(alpha[length], 1e-300)
            for i in range(1, length + 1):
                for n in range(1, len(at[i - 1]) + 1):
                    ids = at[i - 1][n - 1]
                    share = weight * alpha[i - n] * table[ids, 0] * beta[i]
                    used += np.bincount(ids, share, len(used))


def _indexed(rank_file: str) -> dict[bytes, int]:
    """Pieces by consecutive numbers, whatever gaps the ranks have."""
    ranks = read_ranks(rank_file)
    return {piece: i for i, piece in enumerate(sorted(ranks, key=ranks.get))}


def learn(
    labelled: DataFrame, rank_file: str, text_col: str = "text", lang_col: str = "lang"
) -> Model:
    """The model of all rows with a text and a language.

    A task sends a row per language and piece at most, so what reaches the
    driver has the size of the model.

    * Rows without text or language teach nothing; no such rows give a model
      without languages.
    * A piece that a language never uses gets its probability from all
      languages together.
    """
    spark = labelled.sparkSession
    pieces = _indexed(rank_file)
    shared = spark.sparkContext.broadcast(pieces)

    def count(batches):
        known = shared.value
        used: dict[str, np.ndarray] = {}
        docs: Counter = Counter()
        seen: dict[str, Counter] = {}

        def settle():
            for lang, words in seen.items():
                _expected(words, known, used.setdefault(lang, np.zeros(len(known) + 1)))
            seen.clear()

        for batch in batches:
            for text, lang in zip(batch["text"], batch["lang"].to_pylist()):
                docs[lang] += 1
                words = seen.setdefault(lang, Counter())
                for part in words_of(text.as_py()):
                    words.update(part)
                if sum(map(len, seen.values())) > KNOWN_WORDS:
                    settle()
        settle()
        for lang, n in docs.items():
            hits = np.flatnonzero(used[lang][:-1])
            yield pa.RecordBatch.from_pydict(
                {
                    "lang": pa.array([lang] * (len(hits) + 1), pa.string()),
                    "piece": pa.array([-1, *hits.tolist()], pa.int32()),
                    "used": pa.array([float(n), *used[lang][hits].tolist()], pa.float64()),
                }
            )

    rows = labelled.select(
        F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")
    ).dropna()
    sums = (
        rows.mapInArrow(count, "lang string, piece int, used double")
        .groupBy("lang", "piece")
        .agg(F.sum("used").alias("used"))
        .toPandas()
    )
    languages = sorted(sums["lang"].unique())
    uses = np.zeros((len(pieces), len(languages)))
    prior = np.zeros(len(languages))
    for i, lang in enumerate(languages):
        own = sums[sums["lang"] == lang]
        prior[i] = own.loc[own["piece"] == -1, "used"].sum()
        own = own[own["piece"] >= 0]
        uses[own["piece"].to_numpy(), i] = own["used"].to_numpy()
    prior = np.log(prior / max(1.0, prior.sum()))
    background = (uses.sum(axis=1) + 1.0) / (uses.sum() + len(pieces))
    chances = (uses + BACKGROUND * background[:, None]) / (uses.sum(axis=0) + BACKGROUND)
    sizes = np.array([len(p) for p in pieces])
    table = np.vstack([chances * np.power(PER_BYTE, sizes)[:, None], np.zeros(len(languages))])
    return Model(languages, prior, pieces, table)


class _Known(dict):
    """Word to row of ``scores``; new words are noted and scored together."""

    def __init__(self, model: Model):
        super().__init__()
        self.model = model
        self.fresh: list[str] = []
        self.scores = np.zeros((0, len(model.languages)))

    def __missing__(self, word: str) -> int:
        self[word] = place = len(self)
        self.fresh.append(word)
        return place

    def settle(self) -> None:
        if not self.fresh:
            return
        if len(self.scores) < len(self):
            room = np.zeros((max(1024, 2 * len(self)), self.scores.shape[1]))
            done = len(self) - len(self.fresh)
            room[:done] = self.scores[:done]
            self.scores = room
        done = len(self) - len(self.fresh)
        self.scores[done : len(self)] = word_scores(self.fresh, self.model)
        self.fresh = []


_known: dict = {}


def _worker_table(model: Broadcast, key: str) -> _Known:
    if key not in _known or len(_known[key]) > KNOWN_WORDS:
        _known.clear()
        _known[key] = _Known(model.value)
    return _known[key]


def identify(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """A row per row of ``docs``: id, ``lang_pred``, ``score``.

    ``score`` is the probability of the language given the text, 0 to 1. Of
    equally likely languages the first by name wins.

    * ``und`` with score 0 if the text is null or has no letter, or if the
      model has no language.
    * Null and repeated ids are passed on; each row is judged by its text.
    * An empty table gives no rows. Other columns are not looked at.
    """
    import uuid

    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    own = uuid.uuid4().hex
    kind = docs.schema[id_col].dataType.simpleString()

    def judge(total: np.ndarray, model: Model) -> tuple[str, float]:
        total = total + model.prior
        best = int(total.argmax())
        return model.languages[best], float(1.0 / np.exp(total - total[best]).sum())

    def run(batches):
        languages = shared.value.languages
        for batch in batches:
            out = []
            texts = batch["text"]
            for lo in range(0, len(texts), 256):
                known = _worker_table(shared, own)
                placed = []
                for text in texts[lo : lo + 256]:
                    text = text.as_py() or ""
                    places = [
                        np.fromiter(map(known.__getitem__, part), np.int64, len(part))
                        for part in (words_of(text) if languages else ())
                    ]
                    placed.append((places, any(map(str.isalpha, text)) if places else False))
                known.settle()
                for places, lettered in placed:
                    if lettered:
                        total = sum(known.scores[p].sum(axis=0) for p in places)
                        out.append(judge(total, known.model))
                    else:
                        out.append((NOT_A_LANGUAGE, 0.0))
            yield pa.RecordBatch.from_arrays(
                [
                    batch["id"],
                    pa.array([lang for lang, _ in out], pa.string()),
                    pa.array([score for _, score in out], pa.float64()),
                ],
                names=["id", "lang_pred", "score"],
            )

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {kind}, lang_pred string, score double").withColumnRenamed(
        "id", id_col
    )
