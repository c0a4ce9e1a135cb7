"""License scans with DataFrame functions only.

Every line of every text is compared with license templates by sparse TF-IDF cosine; a file's
license is that of its best line. A file in which the matching lines hold at least half of the
words is a licence file of its directory. A file without a license of its own inherits from the
nearest ancestor directory that has a licence file, by joins on directory paths.

Weights: the document frequencies of the templates' terms count all files. A term outside the
templates weighs the mean of the templates' terms. Lines are first sifted without loss: by
Cauchy-Schwarz a line needs at least one ``strong`` term of a template, for the other terms alone
cannot reach the threshold. Only the templates (fixed, a few hundred terms) are broadcast.

Cases: a null or empty text has no license of its own, but may inherit. A null path stands alone.
On equal scores the license first in order of name wins; of several licence files in a directory
the best score, then the smallest path. Rows that repeat a path are all reported. No rows, no
results. Other columns are not looked at.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.6
FILE_SHARE = 0.5

#: License id and the notices that stand for it.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "you may not use this file except in compliance with the License"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright (CC0 1.0)."),
    ("GPL-2.0", "This program is free software under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
]

_APART = r"[^a-z0-9]+"


def terms(text: str) -> Counter:
    """Terms of a template: lower-case runs of letters and digits."""
    return Counter(x for x in re.split(_APART, text.lower()) if x)


def _terms(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), _APART), lambda x: x != "")


def frequencies(files: DataFrame, vocabulary: list[str]) -> tuple[int, dict[str, int]]:
    """The number of files and, of the given terms, how many files hold each."""
    listed = F.array(*[F.lit(x) for x in vocabulary])
    found = files.select(F.explode_outer(F.array_intersect(_terms(F.coalesce("text", F.lit(""))), listed)).alias("term"))
    rows = found.groupBy("term").count().collect()
    total = files.count()
    return total, {r["term"]: r["count"] for r in rows if r["term"] is not None}


class Weights:
    """Template vectors of unit length, term weights, and the terms a matching line must have."""

    def __init__(self, templates, total: int, found: dict[str, int], threshold: float):
        counted = [(name, terms(text)) for name, text in templates]
        vocabulary = sorted({t for _, c in counted for t in c})
        self.idf = {t: math.log((1 + total) / (1 + found.get(t, 0))) + 0.01 for t in vocabulary}
        self.other = sum(self.idf.values()) / len(self.idf)
        self.rows, self.strong = [], set()
        for number, (name, c) in enumerate(counted):
            raw = {t: n * self.idf[t] for t, n in c.items()}
            norm = math.sqrt(sum(v * v for v in raw.values()))
            unit = {t: v / norm for t, v in raw.items()}
            self.rows += [(number, name, t, v, self.idf[t]) for t, v in sorted(unit.items())]
            # Weakest terms first, as long as together they stay below the threshold.
            held = 0.0
            for t, v in sorted(unit.items(), key=lambda x: (x[1], x[0])):
                held += v * v
                if math.sqrt(held) >= threshold - 1e-9:
                    self.strong.add(t)


def line_scores(files: DataFrame, weights: Weights, threshold: float) -> DataFrame:
    """Of each line that matches: its file, license, score, and the words of file and line."""
    spark = files.sparkSession
    pattern = r"(?<![a-z0-9])(?:" + "|".join(sorted(weights.strong)) + r")(?![a-z0-9])"
    some = files.where(F.lower("text").rlike(pattern))
    file_words = F.size(_terms(F.col("text"))).alias("file_words")
    lines = some.select("path", "hash", file_words, F.posexplode(F.split("text", "\n")).alias("line", "words"))
    lines = lines.where(F.lower("words").rlike(pattern)).dropDuplicates(["path", "hash", "line"])
    lines = lines.select("path", "hash", "line", "file_words", _terms(F.col("words")).alias("words"))
    key = ["path", "hash", "line", "file_words", "n_words"]
    each = lines.select(*key[:4], F.size("words").alias("n_words"), F.explode("words").alias("term"))
    counted = each.groupBy(*key, "term").agg(F.count("*").cast("double").alias("tf"))
    idf = spark.createDataFrame(sorted(weights.idf.items()), "term string, idf double")
    templates = spark.createDataFrame(
        [(n, name, t, w) for n, name, t, w, _ in weights.rows], "number int, license string, term string, weight double"
    )
    # Both come from the fixed templates, so they may be broadcast. A line's terms are collected
    # within the line only.
    weighed = counted.join(F.broadcast(idf), "term", "left").select(
        *key, "term", (F.col("tf") * F.col("idf")).alias("known"),
        F.when(F.col("idf").isNull(), F.col("tf") * weights.other * weights.other).otherwise(
            F.pow(F.col("tf") * F.col("idf"), 2)
        ).alias("square"),
    )
    norms = weighed.groupBy(*key).agg(
        F.sqrt(F.sum("square")).alias("norm"),
        F.collect_list(F.when(F.col("known").isNotNull(), F.struct("term", "known"))).alias("terms"),
    )
    dots = (
        norms.select(*key, "norm", F.inline("terms"))
        .join(F.broadcast(templates), "term")
        .groupBy(*key, "norm", "number", "license")
        .agg(F.sum(F.col("known") * F.col("weight")).alias("dot"))
        .select(*key, "license", F.round(F.col("dot") / F.col("norm"), 9).alias("score"))
        .where(F.col("score") >= threshold)
    )
    return dots


def own_licenses(files: DataFrame, threshold: float = THRESHOLD, templates=None) -> DataFrame:
    """path, hash, license, score and words of each file that has a matching line."""
    templates = templates or TEMPLATES
    vocabulary = sorted({t for _, text in templates for t in terms(text)})
    weights = Weights(templates, *frequencies(files, vocabulary), threshold)
    scores = line_scores(files, weights, threshold)
    best = F.min(F.struct((-F.col("score")).alias("minus"), "license"))
    lines = scores.groupBy("path", "hash", "line", "file_words", "n_words").agg(best.alias("best"))
    return (
        lines.groupBy("path", "hash", "file_words")
        .agg(F.min("best").alias("best"), F.sum("n_words").alias("matched_words"))
        .select(
            "path", "hash", F.col("best.license").alias("license"), (-F.col("best.minus")).alias("score"),
            "matched_words", "file_words",
        )
    )


def ancestors(path: Column) -> Column:
    """Directories above a path, with their depth."""
    parts = F.split(path, "/")
    return F.transform(
        F.sequence(F.lit(1), F.size(parts) - 1),
        lambda i: F.struct(i.alias("depth"), F.array_join(F.slice(parts, 1, i), "/").alias("dir")),
    )


def scan(files: DataFrame, threshold: float = THRESHOLD, file_share: float = FILE_SHARE, templates=None) -> DataFrame:
    """``files`` has doc_id, path and text. One row per row: doc_id, path, license, score, origin
    (own, inherited or none) and inherited_from, the directory."""
    rows = files.select(F.col("doc_id").cast("long").alias("doc_id"), "path", "text", F.xxhash64("text").alias("hash"))
    own = own_licenses(rows, threshold, templates)
    parts = F.split("path", "/")
    notices = own.where((F.col("matched_words") >= file_share * F.col("file_words")) & (F.size(parts) > 1))
    folders = notices.select(
        F.array_join(F.slice(parts, 1, F.size(parts) - 1), "/").alias("dir"),
        F.struct((-F.col("score")).alias("minus"), "path", "license").alias("notice"),
    ).groupBy("dir").agg(F.min("notice").alias("notice"))

    base = rows.select("doc_id", "path", "hash")
    licensed = base.join(
        own.select(F.col("path").alias("p"), F.col("hash").alias("h"), "license", "score"),
        F.col("path").eqNullSafe(F.col("p")) & (F.col("hash") == F.col("h")),
        "left",
    ).drop("p", "h")
    open_paths = licensed.where(F.col("license").isNull() & F.col("path").isNotNull()).select("path").distinct()
    near = (
        open_paths.where(F.size(F.split("path", "/")) > 1)
        .select("path", F.inline(ancestors(F.col("path"))))
        .join(folders, "dir")
        .groupBy(F.col("path").alias("p"))
        .agg(F.max(F.struct("depth", "dir", F.col("notice.license").alias("license"), (-F.col("notice.minus")).alias("score"))).alias("near"))
    )
    out = licensed.join(near, F.col("path") == F.col("p"), "left")
    inherits = F.col("license").isNull() & F.col("near").isNotNull()
    return out.select(
        "doc_id",
        "path",
        F.coalesce("license", "near.license").alias("license"),
        F.coalesce("score", "near.score").alias("score"),
        F.when(inherits, "inherited").when(F.col("license").isNotNull(), "own").otherwise("none").alias("origin"),
        F.when(inherits, F.col("near.dir")).alias("inherited_from"),
    )


def paths(docs: DataFrame) -> DataFrame:
    """Documents as files: <source>/<thousand>/<fifty>/<doc_id>.txt."""
    name = F.concat_ws(
        "/",
        F.regexp_replace(F.coalesce("source", F.lit("unknown")), "/", "_"),
        F.floor(F.col("doc_id") / 1000).cast("string"),
        F.floor(F.col("doc_id") / 50).cast("string"),
        F.concat(F.col("doc_id").cast("string"), F.lit(".txt")),
    )
    return docs.select("doc_id", F.when(F.col("doc_id").isNotNull(), name).alias("path"), "text")
