"""Line deduplication: lines that many documents share stay in one of them.

Everything is built of DataFrame functions. A document's long lines become
128-bit keys, each once per row. Rows of a key are counted first, summed before
the shuffle; keys with enough of them are then counted by distinct document.
Lines of lost keys are met by document and key, as positions; a text is moved
once, to meet its positions, and put together from the stretches between them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.llm.common import BLANKS, ascii_lower, stored, text_of

MIN_CHARS = 40
MIN_DOCS = 5


def _normal(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def _key(line: Column) -> Column:
    """The key of a line: 16 bytes; two different lines share one practically never."""
    return F.unhex(F.md5(_normal(line)))


def _is_long(line: Column, min_chars: int) -> Column:
    # The raw length first: it spares most lines the normalisation.
    return (F.length(line) >= min_chars) & (F.length(_normal(line)) >= min_chars)


def _between(lines: str, edges: str) -> Column:
    """The lines between the positions in the sorted array ``edges``, in time linear in both."""
    return F.flatten(
        F.transform(
            F.sequence(F.lit(0), F.size(edges) - 2),
            lambda i: F.slice(
                F.col(lines), F.get(edges, i) + 2, F.get(edges, i + 1) - F.get(edges, i) - 1
            ),
        )
    )


def line_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
) -> DataFrame:
    """``docs`` with the remaining ``text_col``, and ``n_lines`` and ``n_dropped`` added.

    A line's key is the line without blanks at its ends, A-Z lower-cased. Keys
    of ``min_chars`` code points or more that are in ``min_docs`` documents or
    more stay only in the document with the largest id. ``n_lines`` and
    ``n_dropped`` replace columns of these names.

    * A null or empty text is one empty line and comes back as empty text.
    * A line repeated inside a document counts once; all its copies go or stay.
    * Rows that repeat an id are one document. Those of the largest id all keep the line.
    * Rows without id count as documents and keep all their lines.
    * An empty table gives no rows.
    """
    # The row as one struct: whatever its columns are called, nothing clashes.
    names = [name for name in docs.columns if name not in ("n_lines", "n_dropped")]
    rows = docs.select(F.struct(*names).alias("doc"))
    own = F.col("doc").getField(id_col)
    text = F.split(text_of(F.col("doc").getField(text_col)), "\n", -1)
    # By position; lines that are too short have none.
    keys = F.transform(text, lambda line: F.when(_is_long(line, min_chars), _key(line)))
    # Rows of one id may have different texts.
    content = F.xxhash64(F.col("doc").getField(text_col)).alias("content")
    keyed = rows.select(own.alias("id"), content, keys.alias("keys"))
    keyed = stored(keyed.filter(F.exists("keys", lambda key: key.isNotNull())), "line-keys")
    different = F.array_compact(F.array_distinct("keys"))
    holders = keyed.select("id", F.explode(different).alias("key"))
    # A key has no more documents than rows: only keys of enough rows are counted by document.
    often = stored(
        holders.groupBy("key")
        .agg(F.count("*").alias("n"), F.max("id").alias("last"))
        .filter(F.col("n") >= min_docs)
        .select("key", "last"),
        "line-often",
    )
    held = stored(holders.join(often, "key"), "line-held")
    of_rows = F.when(F.col("id").isNull(), F.col("rows")).otherwise(1)
    frequent = stored(
        held.groupBy("key", "id")
        .agg(F.count("*").alias("rows"))
        .groupBy("key")
        .agg(F.sum(of_rows).alias("n"))
        .filter(F.col("n") >= min_docs)
        .select("key"),
        "line-frequent",
    )
    lost = stored(
        held.join(frequent, "key").filter(F.col("id") != F.col("last")).select("id", "key").distinct(),
        "line-lost",
    )
    places = keyed.join(lost.select("id").distinct(), "id", "left_semi").select(
        "id", "content", F.size("keys").alias("n"), F.posexplode("keys").alias("place", "key")
    )
    before, end = F.array(F.lit(-1)), F.array(F.max("n"))
    dropped = (
        places.filter("key is not null")
        .join(lost, ["id", "key"])
        .groupBy("id", "content")
        .agg(F.concat(before, F.sort_array(F.collect_set("place")), end).alias("edges"))
    )
    met = (
        rows.select("doc", own.alias("own"), content.alias("own_content"), text.alias("lines"))
        .join(
            dropped,
            (F.col("own") == F.col("id")) & F.col("own_content").eqNullSafe(F.col("content")),
            "left",
        )
        .withColumn("stays", F.coalesce(_between("lines", "edges"), F.col("lines")))
    )
    return met.select(
        *[
            (
                F.array_join("stays", "\n") if name == text_col else F.col("doc").getField(name)
            ).alias(name)
            for name in names
        ],
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size("stays")).cast("long").alias("n_dropped"),
    )
