"""Licence scans against a plain TF-IDF and a walk up the directories."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from tests.llm.cases import edge_docs, empty_docs
from tillflow.llm.license_scan import (
    CUES,
    MARGIN,
    OF_FAMILY,
    TEMPLATES,
    TERM,
    THRESHOLD,
    VERSION,
    license_scan,
)

TEXTS = [
    (1, "code\nReleased under the MIT License.", "p/a/x.py"),
    (2, "Licensed under the Apache License, Version 2.0.", "p/LICENSE"),
    (3, "nothing here", "p/a/b/y.py"),
    (4, "nothing here", "q/z.py"),
    (5, None, "p/a/b/c/w.py"),
    (6, "This work is licensed under the GNU General Public License, version 3.", "p/a/b/COPYING"),
    (7, "licensed as you like it", "q/r/x"),
    (8, "no path\nReleased under the MIT License", None),
    (9, "", None),
    (10, "Copyright of nobody\nLicensed under CC BY-NC 4.0.", "r/LICENSE.md"),
    (10, "Copyright of nobody\nLicensed under CC BY-NC 4.0.", "r/LICENSE.md"),
    (None, "Released under the MIT License.", "r/s/n"),
    (11, "x", "top"),
]


def by_force(rows):
    terms = lambda text: re.findall(TERM, text.lower())
    passages = defaultdict(set)
    for key, text, _ in rows:
        for line in (text or "").split("\n"):
            if re.search(CUES, line.lower()):
                passages[line].add(key)
    # A row's passage counts once for each row.
    n = Counter()
    for _, text, _ in rows:
        n.update({x for x in (text or "").split("\n") if x in passages})
    df = Counter()
    for line, times in n.items():
        for term in set(terms(line)):
            df[term] += times
    for _, text in TEMPLATES:
        df.update(set(terms(text)))
    total = sum(n.values()) + len(TEMPLATES)

    def vector(text):
        return {t: k * (math.log((1 + total) / (1 + df[t])) + 1) for t, k in Counter(terms(text)).items()}

    def cosine(a, b):
        norm = math.sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values()))
        return sum(x * b.get(t, 0.0) for t, x in a.items()) / norm if norm else 0.0

    def family(name):
        return re.sub(OF_FAMILY, "", name)

    def named(passage, cue):
        """(score, licence or family) of a passage, or nothing."""
        near = []
        for name, text in TEMPLATES:
            mine, given = set(terms(passage)), set(terms(text))
            if not mine & given or not cue and 2 * len(mine & given) <= len(given):
                continue
            versions = {t for t in given if re.match(VERSION, t)}
            name = name if versions <= mine else family(name)
            near.append((round(cosine(vector(passage), vector(text)), 9), name))
        top = max(near, default=(0.0, ""))[0]
        names = {name for score, name in near if top - score <= MARGIN}
        exact = {name for name in names if name != family(name)}
        if top < THRESHOLD or len({family(name) for name in names}) != 1:
            return None
        return top, exact.pop() if len(exact) == 1 else family(names.pop())

    longest = 2 * max(len(terms(text)) for _, text in TEMPLATES)
    claims = defaultdict(set)
    for line, keys in passages.items():
        for key in keys:
            claims[key].add(named(line, True))
    for key, text, _ in rows:  # every window of lines, and the whole text
        lines = [x for x in (text or "").split("\n") if terms(x)]
        for i in range(len(lines)):
            for j in range(i + 1, len(lines) + 1):
                window = "\n".join(lines[i:j])
                if len(terms(window)) <= longest:
                    claims[key].add(named(window, False))
        claims[key].add(named(text or "", False))
    own = {}
    for key in claims.keys() - {None}:
        of_family = defaultdict(list)
        for score, name in claims[key] - {None}:
            of_family[family(name)].append((score, name))
        best = []
        for kin, found in of_family.items():
            exact = max((c for c in found if c[1] != kin), default=(0.0, kin))
            best.append((max(found)[0], exact[1]))
        if best:
            own[key] = max(best)
    files = {}
    for key, _, path in rows:
        if path and key in own and re.match(r"(licen[sc]e|copying|copyright|notice)(\..*)?$", path.split("/")[-1].lower()):
            d = "/".join(path.split("/")[:-1])
            files[d] = max(files.get(d, (0.0, "")), own[key])
    out = Counter()
    for key, _, path in rows:
        if key in own:
            out[(key, own[key][1], True, None)] += 1
            continue
        found = (None, None)
        if path is not None:
            parts = path.split("/")[:-1]
            for k in range(len(parts), -1, -1):
                d = "/".join(parts[:k])
                if d in files:
                    found = (files[d][1], d)
                    break
        out[(key, found[0], False, found[1])] += 1
    return out


def test_scan(spark):
    docs = spark.createDataFrame(TEXTS, "doc_id bigint, text string, path string")
    found = license_scan(docs).select("doc_id", "license", "own", "from_directory").collect()
    assert Counter(map(tuple, found)) == by_force(TEXTS)


HEADERS = {
    "MIT": """# Permission is hereby granted, free of charge, to any person obtaining a copy
# of this software and associated documentation files (the "Software"), to deal
# in the Software without restriction, including without limitation the rights
# to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
# copies of the Software.""",
    "MPL-2.0": """/* This Source Code Form is subject to the terms of the Mozilla Public
 * License, v. 2.0. If a copy of the MPL was not distributed with this
 * file, You can obtain one at https://mozilla.org/MPL/2.0/. */""",
    "GPL-3.0": """// This program is free software: you can redistribute it and/or modify
// it under the terms of the GNU General Public License as published by
// the Free Software Foundation, either version 3 of the License, or
// (at your option) any later version.""",
    "BSD": """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions
are met:""",
    "GPL-2.0": """ * This program is free software; you can redistribute it and/or
 * modify it under the terms of the GNU General Public License
 * as published by the Free Software Foundation; either version 2
 * of the License, or (at your option) any later version.""",
    "LGPL-2.1": """ * This library is free software; you can redistribute it and/or
 * modify it under the terms of the GNU Lesser General Public
 * License as published by the Free Software Foundation; either
 * version 2.1 of the License, or (at your option) any later version.""",
    "LGPL-3.0": """# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU Lesser General Public License as
# published by the Free Software Foundation, either version 3 of the
# License, or (at your option) any later version.""",
    "AGPL-3.0": """# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU Affero General Public License as
# published by the Free Software Foundation, either version 3 of the
# License, or (at your option) any later version.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.""",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions
are met:
* Redistributions in binary form must reproduce the notice.
* Neither the name of the copyright holder nor the names of its
  contributors may be used to endorse or promote products derived from
  this software without specific prior written permission.""",
}

LINES = [
    ("CC-BY-3.0", "Licensed under CC BY 3.0."),
    (None, "Licensed under CC BY 2.5."),  # another version: below the threshold
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("Apache-1.1", "Licensed under the Apache License, Version 1.1."),
    ("Apache", "Licensed under the Apache License."),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("ISC", "Released under the ISC License."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL", "This work is licensed under the GNU General Public License, version 4."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    (None, "Released under the licence of nobody at all"),
]


def test_versions_and_families(spark):
    rows = [(i, f"one\n{text}", None) for i, (_, text) in enumerate(LINES)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, path string")
    found = {r["doc_id"]: r["license"] for r in license_scan(docs).collect()}
    assert found == {i: name for i, (name, _) in enumerate(LINES)}


def test_windows_against_every_window(spark):
    around = "def first(): pass\n\n{}\n\nimport os\nfor x in the: of(to)"
    rows = [(i, around.format(text), f"{i % 3}/{i}") for i, text in enumerate(HEADERS.values())]
    rows += [(50 + i, text, f"{i % 3}/LICENSE") for i, text in enumerate(HEADERS.values())]
    rows += [(90, "no notice", "1/a/b"), (91, HEADERS["MIT"][:150], "x/y"), *TEXTS]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, path string")
    found = license_scan(docs).select("doc_id", "license", "own", "from_directory").collect()
    assert Counter(map(tuple, found)) == by_force(rows)


def test_wrapped_headers_and_lines_without_a_cue(spark):
    one_line = (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this"
        " software and associated documentation files"
    )
    around = "def first(): pass\n\n{}\n\nimport os\nfor x in the: of(to)"
    rows = [(i, around.format(text)) for i, text in enumerate([*HEADERS.values(), one_line])]
    rows.append((99, "Permission to sit here\nis of the kind that any person\nmay use"))
    docs = spark.createDataFrame([(*row, None) for row in rows], "doc_id int, text string, path string")
    found = {r["doc_id"]: r["license"] for r in license_scan(docs).collect()}
    assert found == dict(enumerate([*HEADERS, "MIT"])) | {99: None}


def test_edges(spark):
    docs = edge_docs(spark).withColumn("path", F.lit("a/b"))
    assert license_scan(docs).count() == docs.count()
    assert license_scan(empty_docs(spark).withColumn("path", F.lit("a"))).count() == 0
