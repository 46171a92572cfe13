"""A corpus pipeline: quality rules, line deduplication, near duplicates, mixing, tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tillflow.llm.common import documents, stored
from tillflow.llm.jaccard_join import jaccard_join
from tillflow.llm.line_dedup import line_dedup
from tillflow.llm.mixing import mix
from tillflow.llm.quality import quality_rules
from tillflow.llm.queries import bpe_round_trip


def with_rows(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a last column that tells equal rows apart, and its name.

    It is the file and the place in it; rows that were not read from files are
    written first.
    """
    name = "row"
    while name in docs.columns:
        name += "_"
    place = F.struct(F.xxhash64("_metadata.file_path"), F.col("_metadata.row_index")).alias(name)
    try:
        return docs.select("*", place), name
    except AnalysisException:
        return stored(docs, "pipeline-rows").select("*", place), name


def _only(rows: DataFrame, row: str, decided: DataFrame) -> DataFrame:
    """The rows that ``decided`` names; texts move once, by a sorted shuffle at every size."""
    return rows.join(decided.select(row).hint("merge"), row, "left_semi").drop(row)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    rows, row = with_rows(docs)
    return _only(rows, row, quality_rules(rows, id_col=row).filter("kept"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that stay in another one; ``n_chars`` follows the text."""
    kept = line_dedup(docs).select(*docs.columns)
    return kept.withColumn("n_chars", F.length("text").cast("long"))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: that with the largest id."""
    rows, row = with_rows(docs)
    return _only(rows, row, jaccard_join(rows, row_col=row).filter("kept"))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: never, once or twice."""
    rows, row = with_rows(docs)
    taken = mix(rows, row_col=row).filter("taken > 0")
    times = (F.col("taken") / F.col("size")).cast("int")
    copies = taken.select(row, F.explode(F.array_repeat(F.lit(0), times))).select(row)
    return rows.join(copies.hint("merge"), row).drop(row)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded bytes."""
    return bpe_round_trip(docs)


STAGES = [
    ("quality_rules", quality_stage),
    ("line_dedup", line_stage),
    ("ngram_jaccard_join", near_stage),
    ("mixing", mix_stage),
    ("byte_level_bpe", token_stage),
]

# Mixing is a dynamic program and tokens are ranks in a file: neither is SQL.
# tests/llm/test_pipeline.py holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
