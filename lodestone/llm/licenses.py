"""Licence scan of files, in DataFrame functions only.

Every statement (a line, or a sentence of one) of every whole file that has a word of
licensing is a candidate, and so is every block of lines without a blank line between, and a
licence file as a whole, with line breaks joined and comment marks gone. Statements are
compared with one-line notices, blocks and files with the standard texts and headers. Candidates and templates are sparse vectors of TF-IDF weights, with document
frequencies counted over all candidates of their kind. Equal candidates are weighed once.
A candidate takes the licence of the template with the largest cosine, if that reaches
``COSINE``, for blocks ``BLOCK_COSINE``, as any two legal texts have much in common. A file
takes the licence of its best block, or else that of its best statement. A file without one inherits
from the licence files of its nearest ancestor directory, found by joins on paths.
"""

from __future__ import annotations

from functools import lru_cache
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.llm import common
from lodestone.session import Workspace

COSINE = 0.6
BLOCK_COSINE = 0.9
ANCHOR = r"(?i)licen[cs]|copyright|spdx|public domain|permission is hereby|redistribution and use"
LICENCE_FILE = r"(?i)^(un)?(licen[cs]e|copying|copyright)([.-].*)?$"

# SPDX identifiers and the notices by which files name these licences.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("ISC", "Licensed under the ISC License."),
)


# Headers by which files point to a standard text: the licence, then paragraphs.
_FSF = (
    "This {0} is free software: you can redistribute it and/or modify it under the terms of the GNU {1} as published by the Free Software Foundation, either version {2} of the License, or (at your option) any later version.",
    "This {0} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {1} for more details.",
    "You should have received a copy of the GNU {1} along with this {0}. If not, see <https://www.gnu.org/licenses/>.",
)
HEADERS = (
    *((name, tuple(p.format(*of) for p in _FSF)) for name, of in (
        ("GPL-2.0", ("program", "General Public License", "2")),
        ("GPL-3.0", ("program", "General Public License", "3")),
        ("LGPL-2.1", ("library", "Lesser General Public License", "2.1")),
        ("LGPL-3.0", ("library", "Lesser General Public License", "3")),
        ("AGPL-3.0", ("program", "Affero General Public License", "3")),
    )),
    ("Apache-2.0", (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at',
        "http://www.apache.org/licenses/LICENSE-2.0",
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    )),
    ("MPL-2.0", ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",)),
)
# Marks at the begin and end of a comment's lines.
_MARKS = r"(?m)^[ \t]*(?:/\*+|\*+/|\*+|//+|#+|;+|--+|<!--|-->|%+|dnl\b)|(?:\*+/|-->)[ \t\r]*$"


@lru_cache(maxsize=1)
def standard_texts() -> tuple[tuple[str, str], ...]:
    """The whole standard texts, and the headers with all their paragraphs and with the first only."""
    whole = [(p.name.removesuffix(".txt"), p.read_text()) for p in sorted((Path(__file__).parent / "license_texts").glob("*.txt"))]
    return (*whole, *((name, " ".join(parts[:n])) for name, parts in HEADERS for n in sorted({1, len(parts)})))


def blocks(text: Column, whole: Column) -> Column:
    """The distinct blocks of more than one line of a text, lines joined; where ``whole``, the text itself too."""
    parts = F.filter(F.split(text, r"\n(?:[ \t\r]*\n)+"), lambda b: F.trim(b).contains("\n"))
    parts = F.concat(parts, F.when(F.coalesce(whole, F.lit(False)), F.array(text)).otherwise(F.array().cast("array<string>")))
    parts = F.filter(parts, lambda b: b.rlike(ANCHOR))
    return F.array_distinct(F.transform(parts, lambda b: F.trim(F.regexp_replace(F.regexp_replace(b, _MARKS, " "), r"\s+", " "))))


def terms(text: Column) -> Column:
    """Lower-case words and numbers; a version such as 2.0, or a part such as by-nc, is one term."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"([a-z]+(?:-[a-z]+)*|[0-9]+(?:\.[0-9]+)*)"), F.lit(1))


def statements(text: Column) -> Column:
    """The distinct candidates of a whole text."""
    parts = F.transform(F.split(text, r"\n|(?<=[.!?;])\s+"), lambda s: F.trim(F.regexp_replace(s, r"\s+", " ")))
    return F.array_distinct(F.filter(parts, lambda s: s.rlike(ANCHOR)))


def _weights(units: DataFrame, idf: DataFrame, key: str) -> DataFrame:
    """(key, term, weight): tf times idf, of length 1 per key. ``units`` has key and term, a row per occurrence."""
    tf = units.groupBy(key, "term").agg(F.count("*").alias("tf"))
    weighed = tf.join(idf, "term").select(key, "term", (F.col("tf") * F.col("idf")).alias("w"))
    length = weighed.groupBy(key).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("length"))
    return weighed.join(length, key).select(key, "term", (F.col("w") / F.col("length")).alias("w"))


def matched(ws: Workspace, found: DataFrame, text: str = "statement", templates: tuple = TEMPLATES, least: float = COSINE) -> DataFrame:
    """``statement``, ``license``, ``cosine`` of each distinct statement that a template is near enough to.

    ``found`` has statement, n, how many files have it, and ``text``, which statement may be or name.
    """
    spark = found.sparkSession
    found = ws.table("statements", found)
    words = ws.table("terms", found.select("statement", "n", F.explode(terms(F.col(text))).alias("term")))
    total = found.agg(F.sum("n")).first()[0] or 0
    seen = words.groupBy("statement", "term").agg(F.max("n").alias("n")).groupBy("term").agg(F.sum("n").alias("df"))
    given = spark.createDataFrame([(i, name, text) for i, (name, text) in enumerate(templates)], "template int, license string, text string")
    named = given.select("template", F.explode(terms(F.col("text"))).alias("term"))
    vocabulary = words.select("term").union(named.select("term")).distinct().join(seen, "term", "left")
    idf = ws.table("idf", vocabulary.select("term", (F.log(F.lit(1.0 + total) / (1 + F.coalesce("df", F.lit(0)))) + 1).alias("idf")))
    ours = _weights(words, idf, "statement")
    theirs = _weights(named, idf, "template").withColumnRenamed("w", "w_template")  # one row per word of the fixed templates
    dots = ours.join(F.broadcast(theirs), "term").groupBy("statement", "template").agg(F.sum(F.col("w") * F.col("w_template")).alias("cosine"))
    dots = dots.where(F.round("cosine", 9) >= least).join(F.broadcast(given.select("template", "license")), "template")
    # The largest cosine; of equal ones the first name.
    best = dots.groupBy("statement").agg(F.min_by(F.struct("license", "cosine"), F.struct(-F.round("cosine", 9), "license")).alias("best"))
    return best.select("statement", "best.license", "best.cosine")


def parents(path: Column) -> Column:
    """All ancestor directories of a path, the nearest first, the root ('') last."""
    parts = F.split(F.regexp_replace(path, r"^/+", ""), "/+")
    return F.transform(F.sequence(F.size(parts) - 1, F.lit(0)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))


def scanned(files: DataFrame, path: str = "path", text: str = "text") -> DataFrame:
    """``path``, ``license``, ``cosine``, ``origin`` and ``named_by`` for every distinct path of ``files``.

    origin is 'own' for a block or statement in the file, 'inherited' for that of a licence file in
    the nearest ancestor directory that has one, else 'none' with a null licence.
    named_by is the path that has it. A null text has none. Rows with the same path are one
    file: the best block, or else statement, of any of them counts. Among equal
    cosines the first licence by name wins; among licence files of one directory the
    largest cosine, then the first path. A null path has no ancestors and is one file of
    its own. No rows give none. Other columns are not read.
    """
    ws = Workspace(files.sparkSession, "licenses")
    rows = files.select(F.col(path).alias("path"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    candidates = rows.where(F.col("text").rlike(ANCHOR)).select("path", F.explode(statements(F.col("text"))).alias("statement"))
    candidates = ws.table("candidates", candidates.distinct())
    known = ws.table("matched", matched(ws, candidates.groupBy("statement").agg(F.count("*").alias("n"))))
    # Blocks are known by a digest; a text is kept once.
    name = F.element_at(F.split("path", "/"), -1)
    pieces = rows.where(F.col("text").rlike(ANCHOR)).select("path", F.explode(blocks(F.col("text"), name.rlike(LICENCE_FILE))).alias("text"))
    pieces = ws.table("blocks", pieces.select("path", F.md5("text").alias("statement"), "text"))
    held = pieces.select("path", "statement").distinct().groupBy("statement").agg(F.count("*").alias("n"))
    held = held.join(pieces.groupBy("statement").agg(F.first("text").alias("text")), "statement")
    near = ws.table("near", matched(Workspace(files.sparkSession, "license-blocks"), held, "text", standard_texts(), BLOCK_COSINE))
    hits = candidates.join(known, "statement").withColumn("kind", F.lit(1))
    hits = hits.unionByName(pieces.select("path", "statement").join(near, "statement").withColumn("kind", F.lit(0)))
    own = hits.groupBy("path").agg(F.min_by(F.struct("license", "cosine"), F.struct("kind", -F.round("cosine", 9), "license")).alias("best"))
    own = ws.table("own", own.select("path", "best.license", "best.cosine"))
    # One licence per directory that has a licence file with a known licence.
    heads = own.where(F.element_at(F.split("path", "/"), -1).rlike(LICENCE_FILE))
    heads = heads.withColumn("dir", F.element_at(parents(F.col("path")), 1))
    heads = heads.groupBy("dir").agg(F.min_by(F.struct("license", "cosine", "path"), F.struct(-F.round("cosine", 9), "path")).alias("head"))
    paths = ws.table("paths", rows.select("path").distinct())
    rest = paths.join(own, paths["path"].eqNullSafe(own["path"]), "left_anti").withColumn("dir", F.element_at(parents(F.col("path")), 1))
    # Directories are few beside files: each finds its nearest ancestor once.
    above = rest.where("dir is not null").select("dir").distinct().select(F.col("dir").alias("of"), F.posexplode(F.concat(F.array("dir"), parents(F.col("dir")))).alias("up", "dir"))
    nearest = above.join(heads, "dir").groupBy("of").agg(F.min_by("head", "up").alias("head"))
    kept = rest.join(nearest, rest["dir"] == nearest["of"], "left")
    inherited = kept.select("path", F.col("head.license"), F.col("head.cosine"), F.when(F.col("head").isNotNull(), "inherited").otherwise("none").alias("origin"), F.col("head.path").alias("named_by"))
    return own.select("path", "license", "cosine", F.lit("own").alias("origin"), F.col("path").alias("named_by")).unionByName(inherited)
