"""License scans: TF-IDF cosine of headers and licence files to templates, then inheritance.

Tokens weigh tf * idf, idf from the templates (a token of no template has the
highest idf). The first of these that a file has names its licence:

1. licence files (``is_file``): the whole text against the full texts of ``texts/``;
2. a line with a licence word that is a short notice, or a header block (the
   tokens around a licence word, over line ends and comment signs, as many as a
   standard header has) that is a standard header, word for word;
3. an SPDX identifier;
4. such a line of a cosine of at least ``least``, then such a block of at least 0.9;
5. a line that is a licence's title and nothing else;
6. "All rights reserved" (many licences hold that line too).

A licence file names its directory; a file without a licence takes the licence
of the nearest directory above that has one.

Null texts have no header; null paths have no licence; very long texts are read whole (a text in
one line counts as a line); ties go to the template first by name; rows of one path share its headers; an empty table gives an
empty result; extra columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from functools import reduce
from importlib import resources

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Short notices of public licences.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted under the BSD license.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Proprietary": "All rights reserved.",
}
GPL = ("This {0} is free software: you can redistribute it and/or modify it under the terms of the GNU {1} Public License "
       "as published by the Free Software Foundation, either version {2} of the License, or (at your option) any later version.")
# Standard headers and short forms; the part of a key after "/" tells forms of a licence apart.
HEADERS = {
    **TEMPLATES,
    "Apache-2.0/header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "BSD-3-Clause/conditions": "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, "
        "this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
        "promote products derived from this software without specific prior written permission.",
    "CC-BY-4.0/short": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0/header": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "GPL-2.0/header": GPL.format("program", "General", 2),
    "GPL-2.0/title": "GNU General Public License Version 2",
    "GPL-3.0/header": GPL.format("program", "General", 3),
    "GPL-3.0/title": "GNU General Public License Version 3",
    "LGPL-2.1/header": GPL.format("library", "Lesser General", "2.1"),
    "LGPL-2.1/title": "GNU Lesser General Public License Version 2.1",
    "LGPL-3.0/header": GPL.format("library", "Lesser General", 3),
    "LGPL-3.0/title": "GNU Lesser General Public License Version 3",
    "AGPL-3.0/header": GPL.format("program", "Affero General", 3),
    "AGPL-3.0/title": "GNU Affero General Public License Version 3",
    "MIT/permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights "
        "to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to "
        "whom the Software is furnished to do so, subject to the following conditions:",
    "MPL-2.0/header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
}
# Titles count as a line of their own only: in a sentence they may just be talked about.
TITLES = {
    "mit license": "MIT", "the mit license": "MIT", "the mit license mit": "MIT", "mozilla public license version 2 0": "MPL-2.0",
    "apache license": "Apache-2.0", "apache license version 2 0": "Apache-2.0", "gnu general public license": "GPL",
    "gnu lesser general public license": "LGPL", "gnu affero general public license": "AGPL",
}
SPDX = r"SPDX-License-Identifier:[ \t]*([A-Za-z0-9.+-]+(?: (?:AND|OR|WITH) [A-Za-z0-9.+-]+)*)"
ANCHORS = r"licen[sc]e|^reserved$|^redistribution$"
MARKS = r"(?i)licen[sc]e|all rights reserved|redistribution"
TOKEN = r"[a-z0-9]+"


def weights(templates: dict[str, str] = TEMPLATES) -> tuple[list[tuple[str, str, float]], dict[str, float], float]:
    """(template, token, unit weight) rows, idf by token, idf of other tokens."""
    bags = {n: Counter(re.findall(TOKEN, t.lower())) for n, t in sorted(templates.items())}
    df = Counter(t for b in bags.values() for t in b)
    idf = {t: math.log((1 + len(bags)) / (1 + c)) + 1 for t, c in df.items()}
    rows = []
    for n, b in bags.items():
        norm = math.sqrt(sum((c * idf[t]) ** 2 for t, c in sorted(b.items())))
        rows += [(n, t, c * idf[t] / norm) for t, c in sorted(b.items())]
    return rows, idf, math.log(1 + len(bags)) + 1


def full_texts() -> dict[str, str]:
    return {f.name.removesuffix(".txt"): f.read_text() for f in resources.files(__package__).joinpath("texts").iterdir()
            if f.name.endswith(".txt")}


def _tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(f"({TOKEN})"), 1)


def _best(lines: DataFrame, templates: dict[str, str], least: float) -> DataFrame:
    """(path, license, score): the best cosine of the rows (path, line) of a path with a template."""
    spark = lines.sparkSession
    rows, idf, other = weights(templates)
    # bounded: the tokens of the templates
    known = F.broadcast(spark.createDataFrame(rows, "license string, token string, w double"))
    scale = F.broadcast(spark.createDataFrame(sorted(idf.items()), "token string, idf double"))
    bags = (lines.select("path", F.xxhash64("line").alias("h"), F.explode(_tokens(F.col("line"))).alias("token"))
            .groupBy("path", "h", "token").agg(F.count("*").alias("tf")).join(scale, "token", "left")
            .withColumn("v", F.col("tf") * F.coalesce("idf", F.lit(other))))
    norm = bags.groupBy("path", "h").agg(F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("norm"))
    dots = bags.join(known, "token").groupBy("path", "h", "license").agg(F.sum(F.col("v") * F.col("w")).alias("dot"))
    scored = dots.join(norm, ["path", "h"]).select("path", F.substring_index("license", "/", 1).alias("license"),
                                                   F.round(F.col("dot") / F.col("norm"), 6).alias("score"))
    return (scored.where(F.col("score") >= least).groupBy("path")
            .agg(F.min(F.struct((-F.col("score")).alias("below"), "license")).alias("best"))
            .select("path", "best.license", (-F.col("best.below")).alias("score")))


def _lines(files: DataFrame) -> DataFrame:
    return (files.select("path", F.explode(F.array_distinct(F.split("text", "\n"))).alias("line"))
            .where(F.col("line").rlike(MARKS)))


def headers(files: DataFrame, least: float = 0.75) -> DataFrame:
    """(path, license, score) of files with a line that matches; the best line counts."""
    return _best(_lines(files), TEMPLATES, least)


def blocks(files: DataFrame, least: float = 0.9) -> DataFrame:
    """(path, license, score) of files with a header block that matches, wrapped or inside other text."""
    rows = []
    for name, text in HEADERS.items():
        ts = re.findall(TOKEN, text.lower())
        rows += [(t, i, len(ts), sorted(set(ts))) for i, t in enumerate(ts) if re.search(ANCHORS, t)]
    reach = max(r[2] for r in rows)
    anchors = F.broadcast(files.sparkSession.createDataFrame(rows, "token string, o int, n int, bag array<string>"))

    def around(ts: Column) -> Column:
        marks = F.filter(F.transform(ts, lambda t, i: F.struct(t.alias("token"), i.alias("at"))),
                         lambda m: m["token"].rlike(ANCHORS))
        return F.transform(marks, lambda m: F.struct(
            m["token"].alias("token"), F.least(m["at"], F.lit(reach)).alias("mid"),
            F.slice(ts, F.greatest(m["at"] - reach, F.lit(0)) + 1, F.lit(2 * reach)).alias("near")))

    marked = files.where(F.col("text").rlike("(?i)licen[sc]e|reserved|redistribution"))
    spans = marked.select("path", F.inline(F.array_distinct(F.transform(F.array(_tokens(F.col("text"))), around)[0])))
    # a mark of the text lies on the same mark of the header; half of the header's words must be there
    windows = (spans.join(anchors, "token").where("mid >= o").select("path", "bag", F.expr("slice(near, mid - o + 1, n)").alias("w"))
               .where("2 * size(array_intersect(w, bag)) >= size(bag)").select("path", F.array_join("w", " ").alias("line")))
    return _best(windows.distinct(), HEADERS, least)


def licenses_of(files: DataFrame, least: float = 0.75) -> DataFrame:
    """(path, license, score) of files (path, text, is_file) with a licence of their own."""
    whole = _best(files.where(F.col("is_file") & F.col("text").rlike(MARKS)).select("path", F.col("text").alias("line")), full_texts(), 0.9)
    lines = _lines(files)
    title = F.create_map(*[F.lit(x) for kv in TITLES.items() for x in kv])[F.array_join(_tokens(F.col("line")), " ")]
    exact = lambda name: lines.select("path", name.alias("license"), F.lit(1.0).alias("score")).where("license <> ''")
    rank = lambda near, last: F.when(F.col("license") == "Proprietary", last).when(F.col("score") == 1, 2).otherwise(near)
    found = [(whole, F.lit(1)), (headers(files, least), rank(4, 7)), (exact(F.regexp_extract("line", SPDX, 1)), F.lit(3)),
             (blocks(files), rank(5, 8)), (exact(title), F.lit(6))]
    return (reduce(DataFrame.unionByName, [d.select("path", r.alias("r"), (-F.col("score")).alias("below"), "license") for d, r in found])
            .groupBy("path").agg(F.min(F.struct("r", "below", "license")).alias("best"))
            .select("path", "best.license", (-F.col("best.below")).alias("score")))


def _parents(path: Column) -> Column:
    """Directories of a path, the nearest first, up to the root (empty text)."""
    parts = F.split(path, "/")
    steps = F.when(path.isNotNull(), F.sequence(F.size(parts) - 1, F.lit(0), F.lit(-1)))
    return F.transform(steps, lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/"))


def license_scan(files: DataFrame, least: float = 0.75) -> DataFrame:
    """files (path, text, is_file) to (path, license, score, origin): header, directory or none."""
    own = licenses_of(files.where("path is not null"), least)
    marked = files.select("path", "is_file").join(own, "path", "left")
    named = (marked.where("is_file and license is not null").withColumn("dir", _parents(F.col("path"))[0])
             .groupBy("dir").agg(F.min("license").alias("dir_license")))
    # distinct leaf directories find their nearest ancestor; files then join their own directory only
    leaves = marked.select(_parents(F.col("path"))[0].alias("leaf")).distinct()
    up = leaves.select("leaf", F.posexplode(_parents(F.concat("leaf", F.lit("/x")))).alias("steps", "dir"))
    near = up.join(named, "dir").groupBy("leaf").agg(F.min_by("dir_license", "steps").alias("dir_license"))
    j = marked.withColumn("leaf", _parents(F.col("path"))[0]).join(near, "leaf", "left")
    return j.select("path", F.coalesce("license", "dir_license").alias("license"), "score",
                    F.when(F.col("license").isNotNull(), "header").when(F.col("dir_license").isNotNull(), "directory")
                    .otherwise("none").alias("origin"))
