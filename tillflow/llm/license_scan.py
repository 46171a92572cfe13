"""Licence scans: cosine similarity to templates, then inheritance by directory.

A passage is a line that has one of the cues of a licence notice, or a window:
lines in a row, or a whole text, that may reach the threshold. Passages and
templates are TF-IDF vectors; document frequencies are counted over the lines
with a cue of all documents. A passage takes the licence of its nearest
template if the cosine reaches a threshold. Equal passages are scored once,
so a notice that stands in a third of all documents is one row here.

Licences of one family differ in a word or a number. A template that names a
version speaks for its licence only where the passage names it too, and for
the family (the name without version: ``GPL``) elsewhere. Of templates within
``MARGIN`` of the best, those of one family give the licence if they agree on
one and the family if not; those of different families give nothing. A
document whose best passage names a family takes the licence that its best
passage of that family names, if there is one.

Windows need no cue. A text is looked at for them if it shares so much of a
template's weight that a cosine over the threshold is possible at all, and a
window is scored if its cosine would reach the threshold were its other terms
as light as terms can be. These two bounds lose nothing. Two more rules say what
counts as a passage at all: a window is at most twice as long as the longest
template, and it must share more than half of its template's different terms,
since where all lines with a cue have "licensed", a stray "by" may be most of
the weight of a short template.

A document without a licence of its own takes that of the nearest directory
above it that has a licence file. Directories, not documents, are joined with
the ancestors of their paths; each directory then meets its documents.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.llm.common import stored, text_of

THRESHOLD = 0.6
MARGIN = 0.005
CUES = "licen[sc]e|copyright|spdx|redistribut|warrant|public domain|all rights reserved"
LICENSE_FILE = r"(?i)^(licen[sc]e|copying|copyright|notice)(\..*)?$"
TERM = "[a-z0-9]+(?:[.-][a-z0-9]+)*"
VERSION = r"^[0-9]+([.][0-9]+)*$"
OF_FAMILY = "-[0-9].*$"  # what a licence's name has more than its family's

# Notices in the words that their licences recommend, and the
# short references to them that are in use.
TEMPLATES = (
    (
        "AGPL-3.0",
        "This work is licensed under the GNU Affero General Public License, version 3.",
    ),
    (
        "AGPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the"
        " terms of the GNU Affero General Public License as published by the Free Software"
        " Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    ("Apache-1.1", "Licensed under the Apache License, Version 1.1."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this'
        " file except in compliance with the License.",
    ),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are"
        " permitted provided that the following conditions are met",
    ),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are"
        " permitted provided that the following conditions are met",
    ),
    (
        "BSD-3-Clause",
        "Neither the name of the copyright holder nor the names of its contributors may be used"
        " to endorse or promote products derived from this software without specific prior"
        " written permission.",
    ),
    ("CC-BY-3.0", "Licensed under CC BY 3.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Released into the public domain under CC0 1.0."),
    (
        "GPL-2.0",
        "This work is licensed under the GNU General Public License, version 2.",
    ),
    (
        "GPL-2.0",
        "This program is free software; you can redistribute it and/or modify it under the"
        " terms of the GNU General Public License as published by the Free Software"
        " Foundation; either version 2 of the License, or (at your option) any later version.",
    ),
    (
        "GPL-3.0",
        "This work is licensed under the GNU General Public License, version 3.",
    ),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the"
        " terms of the GNU General Public License as published by the Free Software"
        " Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    ("ISC", "Released under the ISC License."),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with"
        " or without fee is hereby granted, provided that the above copyright notice and this"
        " permission notice appear in all copies.",
    ),
    (
        "LGPL-2.1",
        "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    ),
    (
        "LGPL-2.1",
        "This library is free software; you can redistribute it and/or modify it under the"
        " terms of the GNU Lesser General Public License as published by the Free Software"
        " Foundation; either version 2.1 of the License, or (at your option) any later version.",
    ),
    (
        "LGPL-3.0",
        "This work is licensed under the GNU Lesser General Public License, version 3.",
    ),
    (
        "LGPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the"
        " terms of the GNU Lesser General Public License as published by the Free Software"
        " Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    ("MIT", "Released under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this"
        " software and associated documentation files",
    ),
    (
        "MPL-1.1",
        "The contents of this file are subject to the Mozilla Public License Version 1.1",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
)


def _terms(text_col: str):
    return F.regexp_extract_all(F.lower(F.col(text_col)), F.lit(f"({TERM})"), 1)


def passages(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(``id``, ``passage``, ``text``, ``cue``): the different lines with a cue in each document.

    ``passage`` is a digest of the line, so that long lines are not repeated
    with each of their terms.
    """
    has_cue = F.lower(text_of(text_col)).rlike(CUES)
    lines = F.filter(
        F.split(text_of(text_col), "\n", -1), lambda line: F.lower(line).rlike(CUES)
    )
    found = docs.filter(has_cue).select(
        F.col(id_col).alias("id"), F.explode(F.array_distinct(lines)).alias("text")
    )
    passage = F.unhex(F.md5("text")).alias("passage")
    return found.select("id", passage, "text", F.lit(True).alias("cue"))


def _given(spark: SparkSession, templates) -> DataFrame:
    given = spark.createDataFrame(
        [(i, name, text) for i, (name, text) in enumerate(templates)],
        "template int, license string, text string",
    )
    return (
        given.select("template", "license", F.explode(_terms("text")).alias("term"))
        .groupBy("template", "license", "term")
        .agg(F.count("*").alias("tf"))
    )


def weigh(found: DataFrame, templates=TEMPLATES) -> tuple[DataFrame, float]:
    """(``term``, ``idf``) for the terms of ``found`` and the templates; the idf of all others."""
    units = found.groupBy("passage").agg(F.count("*").alias("n"), F.first("text").alias("text"))
    terms = units.select("n", F.explode(F.array_distinct(_terms("text"))).alias("term"))
    in_templates = (
        _given(found.sparkSession, templates).groupBy("term").agg(F.count("*").alias("n"))
    )
    total = found.count() + len(templates)
    frequency = terms.select("term", "n").unionByName(in_templates)
    idf = F.log((1.0 + total) / (1.0 + F.col("df"))) + 1.0
    weights = frequency.groupBy("term").agg(F.sum("n").alias("df")).select("term", idf.alias("idf"))
    return stored(weights, "license-weights"), math.log(1.0 + total) + 1.0


def windows(
    docs: DataFrame,
    id_col: str,
    text_col: str,
    idf: dict[str, float],
    templates=TEMPLATES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """(``id``, ``passage``, ``text``, ``cue``): windows that may reach the threshold.

    ``idf`` has the terms of the templates. A window has at most twice as many
    terms as the longest template, since a notice and the rests of its first
    and last line fit in; besides, each whole text is one.
    """
    vectors = [
        {term: tf * idf[term] for term, tf in Counter(re.findall(TERM, text.lower())).items()}
        for _, text in templates
    ]
    squares = [sum(w * w for w in vector.values()) for vector in vectors]
    longest = 2 * max((len(re.findall(TERM, text.lower())) for _, text in templates), default=0)
    least = threshold - 1e-6
    kind = docs.schema[id_col].dataType.simpleString()

    def possible(terms) -> list[int]:
        """Templates of whose weight enough is in ``terms``: no cosine exceeds that share."""
        return [
            i
            for i, (vector, square) in enumerate(zip(vectors, squares))
            if 2 * len(vector.keys() & terms) > len(vector)
            and sum(w * w for t, w in vector.items() if t in terms) >= least * least * square
        ]

    def reaches(counts: Counter, among: list[int]) -> bool:
        # No idf is below one.
        norm = sum((tf * idf.get(term, 1.0)) ** 2 for term, tf in counts.items())
        return any(
            2 * len(vectors[i].keys() & counts.keys()) > len(vectors[i])
            and sum(w * counts[t] * idf[t] for t, w in vectors[i].items() if t in counts)
            >= least * math.sqrt(norm * squares[i])
            for i in among
        )

    def found_in(text: str) -> Iterator[str]:
        among = possible(set(re.findall(TERM, text.lower())))
        if not among:
            return
        lines = [(line, re.findall(TERM, line.lower())) for line in text.split("\n")]
        lines = [(line, terms) for line, terms in lines if terms]
        of_templates = set().union(*(vectors[i] for i in among))
        whole: Counter = Counter()
        for i, (_, terms) in enumerate(lines):
            whole.update(terms)
            if of_templates.isdisjoint(terms):
                continue
            counts: Counter = Counter()
            n = 0
            for j in range(i, len(lines)):
                n += len(lines[j][1])
                if n > longest:
                    break
                counts.update(lines[j][1])
                if not of_templates.isdisjoint(lines[j][1]) and reaches(counts, among):
                    yield "\n".join(line for line, _ in lines[i : j + 1])
        if reaches(whole, among):
            yield text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                (key, window)
                for key, text in zip(batch["id"].to_pylist(), batch["text"].to_pylist())
                for window in dict.fromkeys(found_in(text))
            ]
            keys, texts = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_pydict(
                {
                    "id": pa.array(keys, batch.schema.field("id").type),
                    "text": pa.array(texts, pa.string()),
                }
            )

    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    seen = rows.mapInArrow(run, f"id {kind}, text string")
    passage = F.unhex(F.md5("text")).alias("passage")
    return seen.select("id", passage, "text", F.lit(False).alias("cue"))


def match(
    found: DataFrame,
    weights: DataFrame,
    other: float,
    templates=TEMPLATES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """(``passage``, ``license``, ``score``) for the different passages of ``found``.

    ``license`` is a licence or a family. Terms that are not in ``weights`` weigh ``other``. Where ``cue`` is false, more than half of
    the template's terms must be shared. The templates are a
    parameter of fixed size and are the only broadcast.
    """
    units = found.groupBy("passage").agg(F.first("text").alias("text"), F.max("cue").alias("cue"))
    terms = stored(
        units.select("passage", "cue", F.explode(_terms("text")).alias("term"))
        .groupBy("passage", "cue", "term")
        .agg(F.count("*").alias("tf")),
        "license-terms",
    )
    wanted = _given(found.sparkSession, templates)
    is_version = F.col("term").rlike(VERSION)
    of_template = wanted.join(weights, "term").select(
        "template", "license", "term", (F.col("tf") * F.col("idf")).alias("w_template")
    )
    template_norm = of_template.groupBy("template").agg(
        F.sqrt(F.sum(F.col("w_template") * F.col("w_template"))).alias("norm_template"),
        F.count("*").alias("n_template"),
        F.count_if(is_version).alias("n_versions"),
    )
    idf = F.coalesce("idf", F.lit(other))
    of_passage = terms.join(weights, "term", "left").select(
        "passage", "cue", "term", (F.col("tf") * idf).alias("w")
    )
    norm = of_passage.groupBy("passage").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    dot = (
        of_passage.join(F.broadcast(of_template), "term")
        .groupBy("passage", "cue", "template", "license")
        .agg(
            F.sum(F.col("w") * F.col("w_template")).alias("dot"),
            F.count("*").alias("shared"),
            F.count_if(is_version).alias("shared_versions"),
        )
    )
    scored = (
        dot.join(norm, "passage")
        .join(F.broadcast(template_norm), "template")
        .filter("cue or 2 * shared > n_template")
        .withColumn(
            "score", F.round(F.col("dot") / (F.col("norm") * F.col("norm_template")), 9)
        )
    )
    family = _family(F.col("license"))
    name = F.when(F.col("shared_versions") == F.col("n_versions"), F.col("license")).otherwise(family)
    # As many entries as there are templates.
    claims = scored.groupBy("passage").agg(
        F.collect_list(F.struct("score", name.alias("name"), family.alias("family"))).alias("claims"),
        F.max("score").alias("score"),
    )
    near = F.filter("claims", lambda c: F.col("score") - c["score"] <= MARGIN)
    families = F.array_distinct(F.transform("near", lambda c: c["family"]))
    exact = F.filter("near", lambda c: c["name"] != c["family"])
    exact = F.array_distinct(F.transform(exact, lambda c: c["name"]))
    return (
        claims.filter(F.col("score") >= threshold)
        .withColumn("near", near)
        .withColumn("families", families)
        .withColumn("exact", exact)
        .filter(F.size("families") == 1)
        .select(
            "passage",
            F.when(F.size("exact") == 1, F.get("exact", F.lit(0)))
            .otherwise(F.get("families", F.lit(0)))
            .alias("license"),
            "score",
        )
    )


def _family(license: Column) -> Column:
    return F.regexp_replace(license, OF_FAMILY, "")


def ancestors(directory):
    """The directory and all above it, the root ('') last, with their depths."""
    parts = F.split(directory, "/")
    return F.transform(
        F.sequence(F.size(parts), F.lit(0), F.lit(-1)),
        lambda n: F.struct(
            n.alias("depth"), F.array_join(F.slice(parts, F.lit(1), n), "/").alias("above")
        ),
    )


def license_scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    path_col: str = "path",
    templates=TEMPLATES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """A row per row of ``docs``: id, ``license``, ``score``, ``own``, ``from_directory``.

    ``own`` tells whether the licence stands in the document; otherwise
    ``from_directory`` is the directory whose licence file it was taken from,
    and ``score`` that file's. The best passage of a document decides, of equal
    scores the licence that is last by name; so it is with several licence
    files in a directory. ``license`` is a family where no passage tells its
    licences apart.

    * A null or empty text has no passage and can only inherit.
    * A null path has no directory: the document keeps to its own passages.
    * No licence anywhere: ``license``, ``score`` and ``from_directory`` are
      null and ``own`` is false.
    * Rows that repeat an id share the passages of that id, a null id has none
      of its own. An empty table gives no rows. Other columns are not looked at.
    """
    found = stored(passages(docs, id_col, text_col), "license-passages")
    weights, other = weigh(found, templates)
    # As many rows as the templates have terms.
    own_terms = _given(docs.sparkSession, templates).select("term").distinct()
    idf = {r["term"]: r["idf"] for r in weights.join(F.broadcast(own_terms), "term").collect()}
    wide = windows(docs, id_col, text_col, idf, templates, threshold)
    found = stored(found.unionByName(wide), "license-units")
    # A notice may stand in a third of all documents: a stored side lets the join split it.
    nearest_template = stored(match(found, weights, other, templates, threshold), "license-matched")
    matched = found.select("id", "passage").join(nearest_template, "passage")
    family = _family(F.col("license")).alias("family")
    exact = F.when(F.col("license") != F.col("family"), F.struct("score", "license"))
    by_family = (
        matched.filter("id is not null")
        .select("id", "license", "score", family)
        .groupBy("id", "family")
        .agg(F.max("score").alias("score"), F.max(exact).alias("exact"))
        .select("id", "score", F.coalesce("exact.license", "family").alias("license"))
    )
    own = stored(
        by_family.groupBy("id").agg(F.max(F.struct("score", "license")).alias("best")),
        "license-own",
    )
    path = F.col(path_col).cast("string")
    placed = docs.select(
        F.col(id_col).alias("id"),
        F.regexp_replace(path, "/?[^/]*$", "").alias("directory"),
        F.regexp_extract(path, "[^/]*$", 0).alias("name"),
    )
    marked = stored(placed.join(own, "id", "left"), "license-marked")
    files = (
        marked.filter(F.col("name").rlike(LICENSE_FILE) & F.col("best").isNotNull())
        .groupBy("directory")
        .agg(F.max("best").alias("given"))
        .withColumnRenamed("directory", "above")
    )
    directories = marked.filter("directory is not null").select("directory").distinct()
    nearest = (
        directories.select("directory", F.explode(ancestors(F.col("directory"))).alias("up"))
        .select("directory", "up.depth", "up.above")
        .join(files, "above")
        .groupBy("directory")
        .agg(F.max(F.struct("depth", "above", "given")).alias("near"))
    )
    nearest = stored(nearest, "license-nearest")
    has_own = F.col("best").isNotNull()
    return marked.join(nearest, "directory", "left").select(
        F.col("id").alias(id_col),
        F.coalesce("best.license", "near.given.license").alias("license"),
        F.coalesce("best.score", "near.given.score").alias("score"),
        has_own.alias("own"),
        F.when(~has_own, F.col("near.above")).alias("from_directory"),
    )
