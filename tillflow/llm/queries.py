"""One query per operator over the whole of its table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.llm import bpe
from tillflow.llm.common import WORD, documents, id_residue
from tillflow.llm.exact_dedup import exact_dedup
from tillflow.llm.jaccard_join import jaccard_join
from tillflow.llm.language_id import identify, learn
from tillflow.llm.license_scan import CUES, license_scan
from tillflow.llm.line_dedup import line_dedup
from tillflow.llm.lm_score import lm_scores
from tillflow.llm.merkle import folded, merkle_manifest, proof_text
from tillflow.llm.mixing import mix
from tillflow.llm.quality import quality_rules
from tillflow.llm.ranked_search import ranked_search
from tillflow.llm.sharding import shard_by_bytes
from tillflow.llm.url_filter import ALLOW, BLOCK, Rule, judge_urls

RANKS = "byte_bpe_50k.tiktoken"
LANGUAGE_PIECES = "byte_bpe_multi_50k.tiktoken"
URL_RULES = (
    Rule(BLOCK, "net", "/"),
    Rule(ALLOW, "example.net", "/en/"),
    Rule(BLOCK, "example.com", "/de/"),
    Rule(ALLOW, "org", "/fr/"),
)


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup(documents(spark, sf_dir))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = F.coalesce(id_residue("doc_id", 4) == 2, F.lit(False))
    model = learn(docs.filter(~held_out), public_tokenizers.path(LANGUAGE_PIECES))
    found = identify(docs, model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def with_path(docs: DataFrame) -> DataFrame:
    """A path for each document, since the table has none: its source is the top
    directory, sections of 4096 and of 64 ids lie below. Texts that begin with a
    licence notice, or have one in half of their lines, whatever their length,
    are the licence files of their directories.
    """
    lines = F.filter(F.split("text", "\n", -1), lambda line: line.rlike(WORD))
    first = F.lower(F.get(lines, F.lit(0))).rlike(CUES)
    with_cue = F.filter(lines, lambda line: F.lower(line).rlike(CUES))
    notice = first | ((F.size(lines) > 0) & (2 * F.size(with_cue) >= F.size(lines)))
    name = F.when(notice, F.lit("LICENSE")).otherwise(F.format_string("%d.txt", "doc_id"))
    return docs.withColumn(
        "path",
        F.concat_ws("/", "source", F.expr("doc_id div 4096"), F.expr("doc_id div 64"), name),
    )


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(with_path(documents(spark, sf_dir)))


def bpe_round_trip(docs: DataFrame) -> DataFrame:
    path = public_tokenizers.path(RANKS)
    return bpe.round_trip(docs, path, public_tokenizers.PATTERN).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_round_trip(documents(spark, sf_dir))


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    train = F.coalesce(id_residue("doc_id", 10) != 0, F.lit(True))
    scored = lm_scores(documents(spark, sf_dir), train)
    return scored.select(
        "doc_id",
        (~F.col("trained")).alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
    )


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(documents(spark, sf_dir))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules(documents(spark, sf_dir))
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(documents(spark, sf_dir))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_by_bytes(documents(spark, sf_dir)).withColumn(
        "grown_shard", F.lit(None).cast("int")
    )


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return ranked_search(documents(spark, sf_dir), items)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proofs of all rows, held against a copy in which some rows have one more ``n_chars``."""
    touched = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    n_chars = F.col("n_chars").cast("decimal(20,0)")
    more = n_chars + F.when(touched, F.lit(1)).otherwise(F.lit(0))
    proven = merkle_manifest(documents(spark, sf_dir), changed={"n_chars": more})
    found = folded(F.col("changed_leaf"), F.col("siblings"))
    rows = proven.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(proof_text(F.col("siblings")), 256).alias("proof_sha256"),
        found.alias("folded_root"),
    )
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return judge_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


QUERIES = {
    f.__name__: f
    for f in (
        op1_exact_dedup,
        op2_line_dedup,
        op3_language_id,
        op4_license_scan,
        op5_byte_bpe,
        op6_lm_score,
        op7_jaccard_join,
        op8_quality_rules,
        op9_mixing,
        op10_sharding,
        op11_ranked_search,
        op12_merkle_manifest,
        op13_url_filter,
    )
}
