"""Quality rules with thresholds from mergeable quantile sketches.

Four rates of a document are judged: symbols per word, characters per word,
repeated lines per line and words in repeated passages per word, in
thousandths. Each language and source has a sketch of each rate: the number of
documents per bucket, with exact buckets up to 2047 thousandths and eleven
significant bits beyond, so quantiles are off by less than a thousandth part.
Sketches merge by adding up: those of a language's sources make the language's
and all make the corpus's, which judge groups that are small themselves. A
document is rejected where a rate lies outside the quartiles by three times
their distance, as extreme outliers are usually defined. A smallest distance
keeps groups without any spread from rejecting every document that differs.

Counts are integers and the thresholds too: the result doesn't depend on how
the rows are partitioned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillflow.llm.common import BLANKS, stored, text_of

SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
MIN_GROUP = 200
FENCE = 3
UNIT = 1000
BITS = 11

# Rate: numerator, denominator, smallest distance of the quartiles (thousandths),
# and whether low values are bad as well.
RATES = {
    "symbols": ("n_symbols", "n_words", 50, False),
    "word_length": ("word_chars", "n_words", 1000, True),
    "repeated_lines": ("n_dup_lines", "n_lines", 150, False),
    "repeated_words": ("n_repeat_words", "n_words", 60, False),
}

_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows of ``window`` words that are in the text twice or more.

    Windows get numbers by joining two numbered halves, so equal numbers mean
    equal windows; no hash decides. ``window`` is 5: pairs, fours, fives.
    """
    assert window == 5
    n = len(words)
    if n <= window:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    _, pairs = np.unique(ids[:-1] * len(number) + ids[1:], return_inverse=True)
    k = int(pairs.max()) + 1
    if k == n - 1:
        return 0
    _, fours = np.unique(pairs[:-2] * k + pairs[2:], return_inverse=True)
    if int(fours.max()) == n - 4:
        return 0
    _, fives, counts = np.unique(
        fours[:-1] * len(number) + ids[4:], return_inverse=True, return_counts=True
    )
    starts = np.flatnonzero(counts[fives] > 1)
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + window, -1)
    return int((np.cumsum(change) > 0).sum())


def text_counts(text: str) -> tuple[int, ...]:
    """The counts of a text, in the order of ``_COUNTS``."""
    raw = text.encode()
    words = raw.split()  # of bytes: exactly the six blanks
    seen: set[bytes] = set()
    n_lines = n_dup = 0
    for line in raw.split(b"\n"):
        if line.strip():
            n_lines += 1
            n_dup += line in seen
            seen.add(line)
    return (
        len(words),
        len(text) - sum(map(text.count, BLANKS)),
        sum(map(text.count, SYMBOLS)),
        n_dup,
        repeated_words(words),
        n_lines,
    )


def quality_counts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
) -> DataFrame:
    """Id, language, source and the counts of each row; a null text has no words."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counted = [text_counts(text.as_py()) for text in batch["text"]]
            columns = zip(*counted) if counted else [()] * len(_COUNTS)
            yield pa.RecordBatch.from_arrays(
                [batch["id"], batch["lang"], batch["source"]]
                + [pa.array(c, pa.int64()) for c in columns],
                names=["id", "lang", "source", *_COUNTS],
            )

    rows = docs.select(
        F.col(id_col).alias("id"),
        F.col(lang_col).cast("string").alias("lang"),
        F.col(source_col).cast("string").alias("source"),
        text_of(text_col).alias("text"),
    )
    counts = ", ".join(f"{c} bigint" for c in _COUNTS)
    return rows.mapInArrow(run, f"id {kind}, lang string, source string, {counts}")


def _rate(name: str) -> Column:
    top, bottom, _, _ = RATES[name]
    return F.when(F.col(bottom) > 0, F.expr(f"({UNIT} * {top}) div {bottom}"))


def sketches(counts: DataFrame) -> DataFrame:
    """Documents per language, source, rate and bucket."""
    rates = F.explode(
        F.array(*[F.struct(F.lit(n).alias("rate_name"), _rate(n).alias("rate")) for n in RATES])
    )
    shift = f"greatest(length(bin(rate)) - {BITS}, 0)"
    return (
        counts.filter("n_words > 0")
        .select("lang", "source", rates.alias("r"))
        .select("lang", "source", "r.*")
        .filter("rate is not null")
        .select(
            "lang",
            "source",
            "rate_name",
            F.expr(f"shiftleft(shiftright(rate, {shift}), {shift})").alias("bucket"),
        )
        .groupBy("lang", "source", "rate_name", "bucket")
        .agg(F.count("*").alias("n"))
    )


def merged(sketch: DataFrame) -> DataFrame:
    """The sketches of groups (level 0), of languages (1) and of the corpus (2)."""
    null = F.lit(None).cast("string")
    levels = [("lang", "source"), ("lang", null), (null, null)]
    parts = [
        sketch.select(
            F.lit(level).alias("level"),
            (F.col(lang) if isinstance(lang, str) else lang).alias("lang"),
            (F.col(source) if isinstance(source, str) else source).alias("source"),
            "rate_name",
            "bucket",
            "n",
        )
        for level, (lang, source) in enumerate(levels)
    ]
    whole = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return whole.groupBy("level", "lang", "source", "rate_name", "bucket").agg(
        F.sum("n").alias("n")
    )


def fences(sketch: DataFrame, fence: int = FENCE) -> DataFrame:
    """Per level and group: number of documents, and ``low_`` and ``high_`` of each rate."""
    of_rate = W.partitionBy("level", "lang", "source", "rate_name")
    running = sketch.withColumn(
        "up_to", F.sum("n").over(of_rate.orderBy("bucket"))
    ).withColumn("all", F.sum("n").over(of_rate))
    quartiles = running.groupBy("level", "lang", "source", "rate_name").agg(
        F.max("all").alias("all"),
        F.min(F.when(4 * F.col("up_to") >= F.col("all"), F.col("bucket"))).alias("q1"),
        F.min(F.when(4 * F.col("up_to") >= 3 * F.col("all"), F.col("bucket"))).alias("q3"),
    )
    slack = F.lit(0)
    for name, (_, _, least, _) in RATES.items():
        slack = F.when(F.col("rate_name") == name, least).otherwise(slack)
    reach = fence * F.greatest(F.col("q3") - F.col("q1"), slack)
    bounds = quartiles.withColumn("low", F.col("q1") - reach).withColumn(
        "high", F.col("q3") + reach
    )
    limits = [
        F.max(F.when(F.col("rate_name") == name, F.col(side))).alias(f"{side}_{name}")
        for name in RATES
        for side in ("low", "high")
    ]
    return bounds.groupBy("level", "lang", "source").agg(F.max("all").alias("docs"), *limits)


def quality_rules(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    min_group: int = MIN_GROUP,
    fence: int = FENCE,
) -> DataFrame:
    """A row per row of ``docs``: id, the counts, ``base_failed``, ``rejected_by``, ``kept``.

    ``base_failed``: under ten words, or more than 20 % of the words in
    repeated windows. ``rejected_by`` lists the rates outside their fences. A
    group under ``min_group`` documents is judged by its language, a language
    under it by the corpus.

    * A null or empty text has no words: it fails the base and has no rates.
    * A null language or source is a group of its own.
    * Null ids and repeated rows are judged like others, each row counts.
    * An empty table gives no rows. Other columns are not looked at.
    """
    counts = stored(
        quality_counts(docs, id_col, text_col, lang_col, source_col), "quality-counts"
    )
    bounds = stored(fences(merged(sketches(counts)), fence), "quality-fences")
    null = F.lit(None).cast("string")
    ways = F.explode(
        F.array(
            F.struct(F.lit(0).alias("level"), F.col("lang").alias("l"), F.col("source").alias("s")),
            F.struct(F.lit(1).alias("level"), F.col("lang").alias("l"), null.alias("s")),
            F.struct(F.lit(2).alias("level"), null.alias("l"), null.alias("s")),
        )
    )
    groups = bounds.filter("level = 0").select("lang", "source").select(
        F.col("lang").alias("g_lang"), F.col("source").alias("g_source"), ways.alias("w")
    )
    limits = [f"{side}_{name}" for name in RATES for side in ("low", "high")]
    usable = (F.col("docs") >= min_group) | (F.col("level") == 2)
    # Stored, so that the join below can split a language and source with a third of all rows.
    chosen = stored(
        groups.join(
            bounds,
            (F.col("w.level") == F.col("level"))
            & F.col("w.l").eqNullSafe(F.col("lang"))
            & F.col("w.s").eqNullSafe(F.col("source")),
        )
        .filter(usable)
        .groupBy("g_lang", "g_source")
        .agg(F.min_by(F.struct(*limits), "level").alias("fence")),
        "quality-chosen",
    )
    judged = counts.join(
        chosen,
        F.col("lang").eqNullSafe(F.col("g_lang")) & F.col("source").eqNullSafe(F.col("g_source")),
        "left",
    )
    outside = []
    for name, (_, _, _, both) in RATES.items():
        beyond = _rate(name) > F.col(f"fence.high_{name}")
        if both:
            beyond = beyond | (_rate(name) < F.col(f"fence.low_{name}"))
        outside.append(F.when(beyond, F.lit(name)))
    base = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    return judged.select(
        F.col("id").alias(id_col),
        *_COUNTS,
        base.alias("base_failed"),
        F.filter(F.array(*outside), lambda name: name.isNotNull()).alias("rejected_by"),
    ).withColumn("kept", ~F.col("base_failed") & (F.size("rejected_by") == 0))
