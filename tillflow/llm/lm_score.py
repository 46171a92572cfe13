"""Language-model scores by a weighted backoff automaton.

Word n-grams up to order three are smoothed towards the next lower order, down
to the add-0.1 unigrams: ``(count + PRIOR * lower) / (history's count + PRIOR)``.
All n-grams of the training texts take part, singletons too, and the words
after any history sum to one. They make an automaton: a state is a history, an
arc reads a word at the cost of its log-probability and leads to the longest
history that ends with it, and a failure arc reads nothing, costs the
history's weight for all other words and leads to the next shorter history. A
text is read once from left to right, carrying the state.

The model grows with the corpus, so it is never gathered or broadcast. Texts
are put into blocks of words as numbers. A block sends its different n-grams
as sorted hashes, cut into parts, one packed row for each part; a part's task
adds up the blocks' counts and returns them in the same order. With them a block
builds the states and arcs that its texts can meet. An n-gram is in a block
once, so a frequent one costs a part at most one entry per block.

Equal hashes count as equal n-grams. They have twice as many bits as the number
of tokens, up to 64, so that less than one pair is expected to share a hash;
beyond four billion tokens about one n-gram in a billion does for each ten
billion different ones.
"""

from __future__ import annotations

import zlib
from array import array
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from itertools import count
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.llm.common import stored, text_of

ORDER = 3
ADDED = 0.1
# The weight of the next lower order, in occurrences of the history.
PRIOR = 8.0
# A block ends with the text that reaches this many tokens, so it is bounded by the longest text.
BLOCK_TOKENS = 1 << 19
# Parts have the n-grams of about this many blocks.
PART_BLOCKS = 2

# Not words, since they are blanks: the end and the start of a text.
END = b"\n"
START = b"\t"


def tokens_of(text: str) -> list[bytes]:
    """Words of the text with A-Z lower-cased, and the end. Bytes split at the six blanks."""
    return [*text.encode().lower().split(), END]


def _pack(numbers: np.ndarray, noise: int = 0) -> bytes:
    """Numbers by byte planes as far as they are needed, deflated but for the lowest ``noise``."""
    top = int(numbers.max()) if len(numbers) else 0
    width = max(1, noise, (top.bit_length() + 7) // 8)
    planes = numbers.astype("<u8").view(np.uint8).reshape(-1, 8).T[:width]
    raw = np.ascontiguousarray(planes[:noise]).tobytes()
    rest = zlib.compress(np.ascontiguousarray(planes[noise:]).tobytes(), 1)
    return len(numbers).to_bytes(4, "little") + bytes([width, noise]) + raw + rest


def _unpack(packed: bytes) -> np.ndarray:
    n, width, noise = int.from_bytes(packed[:4], "little"), packed[4], packed[5]
    raw = packed[6 : 6 + n * noise] + zlib.decompress(packed[6 + n * noise :])
    numbers = np.zeros((n, 8), np.uint8)
    numbers[:, :width] = np.frombuffer(raw, np.uint8).reshape(width, n).T
    return numbers.view("<u8").ravel()


def _word_hash(word: bytes) -> int:
    """The lowest bit tells words, which have it, from all else."""
    known = xxhash.xxh3_64_intdigest(word)
    return known & ~1 if word == START else known | 1


def _numbers() -> defaultdict[bytes, int]:
    """Numbers of words in the order of their first use, from 0 for the start."""
    number: defaultdict[bytes, int] = defaultdict(count().__next__)
    number[START]
    return number


def _joined(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Hashes of n-grams made of an n-gram and a word, both given by theirs."""
    x = first * np.uint64(0x9E3779B97F4A7C15) + second
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))) & ~np.uint64(1)


def _blocked(rows: DataFrame, kind: str) -> DataFrame:
    """A row per block: ids, marks and sizes of its texts, their words as numbers, the hashes
    of the words.

    Each text follows a start, word 0, and its size counts the start. A block is
    a stretch of one task's rows, named by the task and a counter.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 24
        kind_of_id = None
        ids, train, sizes, words = [], [], [], []
        number = _numbers()

        def row() -> pa.RecordBatch:
            hashes = np.fromiter(map(_word_hash, number), np.uint64, len(number))
            learnt = sum(size - 1 for size, marked in zip(sizes, train) if marked)
            columns = [
                pa.array([block], pa.int64()),
                pa.array([held], pa.int64()),
                pa.array([learnt], pa.int64()),
                pa.array([ids], pa.list_(kind_of_id)),
                pa.array([train], pa.list_(pa.bool_())),
                pa.array([sizes], pa.list_(pa.int64())),
                pa.array([_pack(np.concatenate(words))], pa.binary()),
                pa.array([hashes.astype("<u8").tobytes()], pa.binary()),
            ]
            names = ["block", "tokens", "learnt", "ids", "train", "sizes", "words", "hashes"]
            return pa.RecordBatch.from_arrays(columns, names=names)

        held = 0
        for batch in batches:
            kind_of_id = batch.schema.field("id").type
            columns = (batch[c] for c in ("id", "text", "train"))
            for key, text, marked in zip(*columns):
                tokens = tokens_of(text.as_py())
                numbers = np.zeros(len(tokens) + 1, np.int64)
                numbers[1:] = list(map(number.__getitem__, tokens))
                ids.append(key.as_py())
                train.append(marked.as_py())
                sizes.append(len(numbers))
                words.append(numbers)
                held += len(numbers)
                if held >= BLOCK_TOKENS:
                    yield row()
                    ids, train, sizes, words, held = [], [], [], [], 0
                    number = _numbers()
                    block += 1
        if ids:
            yield row()

    return rows.mapInArrow(
        run,
        f"block bigint, tokens bigint, learnt bigint, ids array<{kind}>, train array<boolean>,"
        " sizes array<bigint>, words binary, hashes binary",
    )


class Level(NamedTuple):
    """The different n-grams of one order in a block.

    ``history`` and ``lower`` are places in the level below, of the n-gram
    without its last and without its first word.
    """

    hashes: np.ndarray
    uses: np.ndarray
    history: np.ndarray
    word: np.ndarray
    lower: np.ndarray


class Block:
    """The texts of a block and their n-grams. ``row`` has the columns of ``_blocked``."""

    def __init__(self, row: dict, order: int) -> None:
        self.ids, self.train, self.sizes = row["ids"], row["train"], row["sizes"]
        self.words = _unpack(row["words"]).astype(np.int64)
        self.starts = np.cumsum([0, *self.sizes[:-1]])
        hashes = np.frombuffer(row["hashes"], "<u8")
        size = len(hashes)
        train = np.repeat(np.array(self.train, bool), self.sizes)
        uses = np.bincount(self.words[train], minlength=size)
        none = np.zeros(size, np.int64)
        self.levels = [Level(hashes, uses, none, np.arange(size), none)]
        place = self.words
        for _ in range(1, order):
            at = 1 + np.flatnonzero((place[:-1] >= 0) & (self.words[1:] > 0))
            codes, number = np.unique(
                place[at - 1] * size + self.words[at], return_inverse=True
            )
            history, word = codes // size, codes % size
            lower = np.zeros(len(codes), np.int64)
            lower[number] = place[at]
            uses = np.bincount(number[train[at]], minlength=len(codes))
            joined = _joined(self.levels[-1].hashes[history], hashes[word])
            self.levels.append(Level(joined, uses, history, word, lower))
            place = np.full(len(self.words), -1)
            place[at] = number

    def sorted_grams(self, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """All hashes in ``bits`` bits, sorted, and the order that sorts the n-grams."""
        hashes = np.concatenate([level.hashes for level in self.levels])
        one = np.uint64(1)
        short = ((hashes >> np.uint64(64 - bits)) & ~one) | (hashes & one)
        by_hash = np.argsort(short, kind="stable")
        return short[by_hash], by_hash


def _sent(blocks: DataFrame, order: int, bits: int, part_bits: int) -> DataFrame:
    """The n-grams of each block by parts of the hashes: sorted, as differences, and their uses."""
    shift = bits - part_bits
    # The bytes of a difference that hold nothing to be deflated.
    noise = max(0, bits - BLOCK_TOKENS.bit_length()) // 8

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                held = Block(row, order)
                hashes, by_hash = held.sorted_grams(bits)
                uses = np.concatenate([level.uses for level in held.levels])[by_hash]
                parts = (hashes >> np.uint64(shift)).astype(np.int64)
                edges = np.flatnonzero(np.diff(parts, prepend=-1, append=-1))
                out = []
                for lo, hi in zip(edges, edges[1:]):
                    base = np.array([int(parts[lo]) << shift], np.uint64)
                    steps = np.diff(hashes[lo:hi], prepend=base)
                    out.append((int(parts[lo]), _pack(steps, noise), _pack(uses[lo:hi])))
                part, packed, used = zip(*out)
                yield pa.RecordBatch.from_pydict(
                    {
                        "block": pa.array([row["block"]] * len(out), pa.int64()),
                        "part": pa.array(part, pa.int64()),
                        "grams": pa.array(packed, pa.binary()),
                        "uses": pa.array(used, pa.binary()),
                    }
                )

    return blocks.mapInArrow(run, "block bigint, part bigint, grams binary, uses binary")


def _counted(sent: DataFrame, bits: int, part_bits: int) -> DataFrame:
    """For each block and part the counts in all training texts, in the order of the n-grams.

    ``n_words``, in one row of a part, is its number of different training words.
    """
    shift = bits - part_bits

    def add_up(rows: pa.Table) -> pa.Table:
        base = np.uint64(rows["part"][0].as_py() << shift)
        hashes = [np.cumsum(_unpack(p), dtype=np.uint64) + base for p in rows["grams"].to_pylist()]
        uses = [_unpack(p) for p in rows["uses"].to_pylist()]
        different, number = np.unique(np.concatenate(hashes), return_inverse=True)
        # Sums of whole numbers are exact in doubles up to 2**53.
        total = np.bincount(number, np.concatenate(uses), len(different)).astype(np.uint64)
        ends = np.cumsum([len(h) for h in hashes])[:-1]
        counts = [_pack(c) for c in np.split(total[number], ends)]
        n_words = int(((different & np.uint64(1) == 1) & (total > 0)).sum())
        return pa.table(
            {
                "block": rows["block"],
                "part": rows["part"],
                "counts": pa.array(counts, pa.binary()),
                "n_words": pa.array([n_words] + [0] * (len(counts) - 1), pa.int64()),
            }
        )

    dealt = sent.repartition(1 << part_bits, "part")
    return dealt.groupBy("part").applyInArrow(
        add_up, "block bigint, part bigint, counts binary, n_words bigint"
    )


class Automaton:
    """States, arcs and failure arcs for all that the texts of a block can meet.

    State 0 is the empty history and has an arc for each word of the block; the
    histories of one word follow, then those of two, and so on. The arcs of a
    state lie together, from ``first`` of the state to that of the next, ordered
    by word. ``miss`` is the weight of a state's failure arc, which leads to
    ``back``.
    """

    def __init__(self, levels: list[Level], counts: list[np.ndarray], denominator: float,
                 prior: float) -> None:
        size = len(levels[0].word)
        # Of the histories by their length. Without longer ones, there is the empty one only.
        states = np.cumsum([0, 1, *(len(level.word) for level in levels[:-1])])
        chance = (counts[0] + ADDED) / denominator
        words, weights, targets, degrees = [], [], [], []
        miss, back = [np.zeros(1)], [np.zeros(1, np.int64)]
        for k, (level, n) in enumerate(zip(levels, counts)):
            if k > 0:
                of_history = counts[k - 1][level.history]
                chance = (n + prior * chance[level.lower]) / (of_history + prior)
            arcs = np.flatnonzero(n > 0) if k > 0 else np.arange(size)
            degrees.append(
                np.bincount(level.history[arcs], minlength=states[k + 1] - states[k])
            )
            words.append(level.word[arcs])
            weights.append(np.log10(chance[arcs]))
            if k + 1 < len(levels):
                # After words that the model doesn't know, the history is empty.
                targets.append(np.where(n[arcs] > 0, states[k + 1] + arcs, 0))
                miss.append(np.log10(prior / (n + prior)))
                back.append(states[k] + level.lower)
            else:
                targets.append(states[k] + level.lower[arcs])
        self.alone = weights[0]
        self.alone[0] = 0.0  # the start is no word to read
        self.words = array("q", np.concatenate(words).astype(np.int64).tobytes())
        self.weights = array("d", np.concatenate(weights).tobytes())
        self.targets = array("q", np.concatenate(targets).astype(np.int64).tobytes())
        first = np.cumsum(np.concatenate([[0], *degrees]))
        self.first = array("q", first.astype(np.int64).tobytes())
        self.miss = array("d", np.concatenate(miss).tobytes())
        self.back = array("q", np.concatenate(back).astype(np.int64).tobytes())
        self.start = 1 if len(levels) > 1 else 0

    def read(self, words: list[int]) -> float:
        """The log10 probability of a text: one pass, by arcs and, where there is none, failures."""
        first, word_of, find = self.first, self.words, bisect_left
        weights, targets, miss, back = self.weights, self.targets, self.miss, self.back
        state, total = self.start, 0.0
        for word in words:
            while state:
                end = first[state + 1]
                arc = find(word_of, word, first[state], end)
                if arc < end and word_of[arc] == word:
                    break
                total += miss[state]
                state = back[state]
            else:
                arc = word  # state 0 has the arcs of all words, in order
            total += weights[arc]
            state = targets[arc]
        return total


def _scored(blocks: DataFrame, counted: DataFrame, kind: str, order: int, bits: int,
            denominator: float, prior: float, n_blocks: int) -> DataFrame:
    """Each block meets its counts and reads its texts."""

    def score(block: pa.Table, counts: pa.Table) -> pa.Table:
        row = block.to_pylist()[0]
        held = Block(row, order)
        _, by_hash = held.sorted_grams(bits)
        parts = sorted(zip(counts["part"].to_pylist(), counts["counts"].to_pylist()))
        n = np.zeros(len(by_hash), np.int64)
        n[by_hash] = np.concatenate([_unpack(packed) for _, packed in parts])
        n = np.split(n, np.cumsum([len(level.word) for level in held.levels])[:-1])
        automaton = Automaton(held.levels, n, denominator, prior)
        known = (held.words > 0) & (n[0][held.words] > 0)
        known = np.add.reduceat(known.astype(np.int64), held.starts)
        alone = np.add.reduceat(automaton.alone[held.words], held.starts)
        texts = zip(held.starts.tolist(), held.sizes)
        totals = [automaton.read(held.words[at + 1 : at + size].tolist()) for at, size in texts]
        return pa.table(
            {
                "id": pa.array(held.ids, block.schema.field("ids").type.value_type),
                "trained": pa.array(held.train, pa.bool_()),
                "n_tokens": pa.array([size - 1 for size in held.sizes], pa.int64()),
                "n_known": pa.array(known, pa.int64()),
                "base_score": pa.array(alone, pa.float64()),
                "score": pa.array(totals, pa.float64()),
            }
        )

    tasks = max(1, n_blocks)
    dealt = blocks.repartition(tasks, "block").groupBy("block")
    met = counted.select("block", "part", "counts").repartition(tasks, "block").groupBy("block")
    return dealt.cogroup(met).applyInArrow(
        score,
        f"id {kind}, trained boolean, n_tokens bigint, n_known bigint, base_score double,"
        " score double",
    )


def lm_scores(
    docs: DataFrame,
    train: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    order: int = ORDER,
    prior: float = PRIOR,
) -> DataFrame:
    """A row per row of ``docs``: id, ``trained``, ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score`` and ``score``, log10 probabilities by unigrams and by the automaton.

    The model learns from the rows where ``train`` holds, all their n-grams up to
    ``order``. Tokens are the words, A-Z lower-cased, and one end per text.

    * A null text counts as empty: its only token is the end.
    * A null ``train`` counts as false.
    * Repeated rows are counted and scored like others; null ids are passed on.
    * No training rows: every token is unknown. An empty table gives no rows.
      Other columns are not looked at, unless ``train`` does.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(
        F.col(id_col).alias("id"),
        text_of(text_col).alias("text"),
        F.coalesce(train, F.lit(False)).alias("train"),
    )
    blocks = stored(_blocked(rows, kind), "lm-blocks")
    zero = F.lit(0)
    sums = [F.coalesce(F.sum(name), zero) for name in ("tokens", "learnt")]
    n_blocks, n_tokens, n_train = blocks.agg(F.count("*"), *sums).first()
    bits = min(64, max(32, 8 * -(-2 * n_tokens.bit_length() // 8)))
    part_bits = max(3, (n_blocks // PART_BLOCKS).bit_length())
    counted = stored(_counted(_sent(blocks, order, bits, part_bits), bits, part_bits), "lm-counts")
    n_words = counted.agg(F.coalesce(F.sum("n_words"), zero)).first()[0]
    denominator = n_train + ADDED * (n_words + 1)
    return _scored(blocks, counted, kind, order, bits, denominator, prior, n_blocks).select(
        F.col("id").alias(id_col),
        "trained",
        "n_tokens",
        "n_known",
        F.lit(n_train).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )
