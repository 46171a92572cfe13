"""Rows that operators must not stumble over, and helpers for brute force."""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import DataFrame, SparkSession

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint,"
    " id string, row string, size string, kept string, part string, n string, shard int,"
    " taken int, bucket string, copy string, node int, _id string, _lost string, word string,"
    " block string, draw string, best string"
)
EXTRA = ("x",) * 6 + (1, 1) + ("x",) * 2 + (1,) + ("x",) * 6
WORD = re.compile("[^\x20\x09-\x0d]+")
LONG = " ".join(f"word{i % 977} piece{i}" for i in range(60_000))
LINE = "This very line stands in a good many of the documents here"


def edge_rows() -> list[tuple]:
    return [
        (1, "Same text over here.\nWith two lines.", "en", "a", 10),
        (2, "SAME TEXT over here.\nWith two lines.", "en", "a", 10),
        (2, "SAME TEXT over here.\nWith two lines.", "en", "a", 10),
        (3, None, "en", "a", None),
        (4, "", "de", None, 0),
        (4, "", "de", None, 0),
        (5, "\n \n\t", None, "b", 4),
        (None, "Same text over here.\nWith two lines.", None, None, 10),
        (None, "a row without an id", "fr", "b", 1),
        (6, LONG, "en", "b", len(LONG)),
        (7, "É é Ünï ſ \x1c\x85\xa0 odd\rblanks\x0bhere", "de", "c", 1),
        (8, "ab" * 50_000, None, "c", 1),
        (9, " " * 3000 + "x", "en", "c", 1),
        (-10, "one", "en", "", 3),
        *[(20 + i, f"{LINE}\nown line {i}\n  {LINE.upper()} \t", "en", "hot", 1) for i in range(8)],
    ]


def edge_docs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([row + EXTRA for row in edge_rows()], SCHEMA)


def empty_docs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def lower(text: str) -> str:
    return text.translate({c: c + 32 for c in range(65, 91)})


def rows_of(df: DataFrame, *columns: str) -> Counter:
    return Counter(tuple(r) for r in df.select(*columns).collect())
