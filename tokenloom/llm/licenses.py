"""Licence scan: sparse TF-IDF cosine of lines to licence templates, then inheritance from the nearest directory.

Every line of every file is a vector over the templates' terms, with document frequencies counted over all lines of the table. A term
that no template has counts in the line's length with the weight of an unseen term. A line names the template of
its highest cosine, from ``THRESHOLD`` on; a file has the licence of its best line. A licence file is one named LICENSE,
LICENCE, COPYING or NOTICE, or one whose lines with words all name a licence; it covers its directory. Files without a
licence of their own take that of the nearest directory above them. Built-in functions only.

Defined cases: null or empty text has no licence of its own; a null path has no directory; ties go to the higher cosine, then the
earlier line, then the template's name, and among licence files of a directory to the smaller path; repeated paths are scanned one by
one; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.common import Scratch

THRESHOLD = 0.8

#: Short notices of common licences, and words left out of all vectors.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MPL-2.0", "This file is subject to the terms of the Mozilla Public License, version 2.0."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0 Universal."),
    ("All-Rights-Reserved", "Copyright. All rights reserved."),
)
STOP_WORDS = ("a", "be", "can", "found", "in", "is", "of", "that", "the", "this", "to", "under")

_NAMES = r"(?i)^(licen[cs]e|copying|notice)([._-].*)?$"


def terms(text: Column) -> Column:
    """Lower-case runs of letters and digits, without stop words."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda t: (t != "") & ~t.isin(*STOP_WORDS))


def vocabulary_of(templates: Sequence[tuple[str, str]]) -> list[str]:
    """The templates' terms; as long as the templates make it."""
    return sorted({t for _, text in templates for t in re.split(r"[\W_]+", text.lower()) if t} - set(STOP_WORDS))


def licence_lines(files: DataFrame, scratch: Scratch, templates: Sequence[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(file, line, license, similarity) for the lines of ``files`` (file, text) that name a licence."""
    spark = files.sparkSession
    vocabulary = F.array(*map(F.lit, vocabulary_of(templates)))
    lines = files.select("file", F.posexplode(F.split("text", "\n")).alias("line", "value"))
    lines = lines.select("file", "line", terms(F.col("value")).alias("terms"))
    # only a line with a template's term can have a cosine above zero; frequencies count all lines
    found = F.transform(
        F.array_intersect("terms", vocabulary),
        lambda t: F.struct(t.alias("term"), F.size(F.filter("terms", lambda x: x == t)).alias("tf")),
    )
    others = F.size(F.filter("terms", lambda x: ~F.array_contains(vocabulary, x)))
    seen = lines.where(F.arrays_overlap("terms", vocabulary)).select("file", "line", found.alias("found"), others.alias("others"))
    seen = scratch.keep(seen, "lines")

    count = files.agg(F.coalesce(F.sum(F.size(F.split(F.coalesce("text", F.lit("")), "\n"))), F.lit(0)).alias("all_lines"))
    frequency = seen.select(F.explode("found.term").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    weight = lambda df: F.log((F.col("all_lines") + 1) / (df + 1)) + 1
    frequency = frequency.join(count).select("term", weight(F.col("df")).alias("idf"), weight(F.lit(0)).alias("unseen"))  # one row joins
    frequency = scratch.keep(frequency, "frequency")

    known = spark.createDataFrame(list(templates), "license string, text string").select("license", F.explode(terms(F.col("text"))).alias("term"))
    known = known.groupBy("license", "term").agg(F.count("*").alias("tf"))
    absent = F.log(F.lit(1.0)) + 1  # a template term without a line meets nothing, its weight only adds to the template's length
    known = known.join(frequency, "term", "left").withColumn("w", F.col("tf") * F.coalesce("idf", F.col("unseen"), absent))
    length = known.groupBy("license").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("length"))
    per_term = known.join(length, "license").groupBy("term").agg(F.collect_list(F.struct("license", (F.col("w") / F.col("length")).alias("w"))).alias("templates"))
    per_term = scratch.keep(per_term.join(frequency, "term"), "terms")

    # a line's terms meet the templates through one row per term; sums by line need a hash of few values
    hits = seen.select("file", "line", "others", F.explode("found").alias("f")).select("file", "line", "others", "f.term", "f.tf")
    hits = hits.join(per_term, "term").withColumn("v", F.col("tf") * F.col("idf"))
    norm = hits.groupBy("file", "line", "others").agg(
        F.sum(F.col("v") * F.col("v")).alias("squares"), F.first("unseen").alias("unseen"),
        F.flatten(F.collect_list(F.transform("templates", lambda t: F.struct(t["license"].alias("license"), (t["w"] * F.col("v")).alias("dot"))))).alias("dots"),
    )
    scored = norm.withColumn("norm", F.sqrt(F.col("squares") + F.col("others") * F.col("unseen") * F.col("unseen")))
    scored = scored.select("file", "line", "norm", F.explode("dots").alias("d")).groupBy("file", "line", "d.license").agg(F.sum("d.dot").alias("dot"), F.first("norm").alias("norm"))
    similarity = F.round(F.col("dot") / F.col("norm"), 6)
    return scored.select("file", "line", "license", similarity.alias("similarity")).where(F.col("similarity") >= threshold)


def scan_licences(files: DataFrame, scratch: Scratch, templates: Sequence[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """``files`` (file, path, text; file is unique) with license, similarity, origin ('own', 'inherited', null) and directory."""
    lines = scratch.keep(licence_lines(files.select("file", "text"), scratch, templates, threshold), "matches")
    order = F.struct(-F.col("similarity"), F.col("line"), F.col("license"))
    best = lines.groupBy("file").agg(F.min(order).alias("top")).select("file", "top.license", (-F.col("top.col1")).alias("similarity"))
    matched = lines.groupBy("file").agg(F.count_distinct("line").alias("matched"))

    worded = F.size(F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    base = F.regexp_extract("path", r"[^/]*$", 0)
    heads = files.select("file", "path", base.rlike(_NAMES).alias("named"), worded.alias("worded"), F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("directory"))
    own = heads.join(best, "file", "left").join(matched, "file", "left")
    own = scratch.keep(own, "own")

    # one licence for each directory that has a licence file, then each directory's nearest one above or at it
    covering = own.where(F.col("license").isNotNull() & F.col("directory").isNotNull() & (F.coalesce("named", F.lit(False)) | (F.col("matched") == F.col("worded"))))
    covering = covering.groupBy("directory").agg(F.min(F.struct(-F.col("similarity"), "path", "license")).alias("m")).select(F.col("directory").alias("above"), F.col("m.license").alias("from_above"))
    parts = F.split("directory", "/")
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, 1, k), "/"))
    directories = own.select("directory").where("directory is not null").distinct().select("directory", F.explode(above).alias("above"))
    nearest = directories.join(covering, "above").groupBy("directory").agg(F.max_by(F.struct("from_above", "above"), F.char_length("above")).alias("n"))
    joined = own.join(nearest, "directory", "left")
    origin = F.when(F.col("license").isNotNull(), "own").when(F.col("n").isNotNull(), "inherited")
    return joined.select(
        "file", "path", F.coalesce("license", "n.from_above").alias("license"), "similarity", origin.alias("origin"),
        F.when(F.col("license").isNull(), F.col("n.above")).alias("inherited_from"),
    )
