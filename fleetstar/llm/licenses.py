"""License scan: TF-IDF cosine of headers and licence files to templates, then directory inheritance.

Every line of every text that holds a marker word is compared, as a sparse
TF-IDF vector of its words and word pairs, to the templates, and so is every
run of consecutive lines around it up to a blank line or ``longest_run`` words;
a licence file (by its name) is also compared as a whole. Document frequencies of the
templates' terms are counted over all lines with a marker; a term that no template
has counts as rare. A file whose best cosine reaches the threshold has that
licence; any other file takes that of the nearest directory above it, in the
same repository, with a licence file.

Inheritance works on directories, not files: their ancestors are joined to
the directories with licence files, the nearest one is kept per directory,
and files are joined to their directory's row. The tables joined are written
first, so adaptive execution splits hot repositories and directories.

Edge cases: null and empty texts match nothing; a null path or empty
directory is the repository's root; a null repository is one of its own; of
several licence files in a directory the best match counts, then the smallest
path and id; repeated rows are scanned alike; empty tables give empty
results; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise
from .tokens import text_blocks

THRESHOLD = 0.6
LICENSE_FILE = r"(?i)^(un)?licen[cs]e|^copying|^notice"

# Headers and notices of public licences, as text.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3"),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("CC0-1.0", "Released into the public domain under CC0 1.0 Universal"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
    ("Proprietary", "All rights reserved"),
]
MARKERS = re.compile(r"licen[cs]|copyright|rights reserved|permission|redistribut|public domain|\bcc0\b|\bcc by\b")
TOKEN = re.compile(r"[^\W_]+(?:\.\d+)*")


def terms(text: str) -> Counter:
    """Words and word pairs with their counts."""
    words = TOKEN.findall(text.lower())
    return Counter(words) + Counter(zip(words, words[1:]))


class Templates:
    """TF-IDF vectors of the templates under given document frequencies."""

    def __init__(self, frequencies: dict, lines: int):
        self.counts = [(name, terms(text)) for name, text in TEMPLATES]
        self.rare = math.log(1 + lines) + 1
        self.idf = {t: math.log((1 + lines) / (1 + frequencies.get(t, 0))) + 1 for _, c in self.counts for t in c}
        self.vectors = []
        for name, c in self.counts:
            v = {t: n * self.idf[t] for t, n in c.items()}
            self.vectors.append((name, v, math.sqrt(sum(x * x for x in v.values()))))

    def best(self, text: str) -> tuple[float, str]:
        """(cosine, licence) of the nearest template."""
        v = {t: n * self.idf.get(t, self.rare) for t, n in terms(text).items()}
        norm = math.sqrt(sum(x * x for x in v.values())) or 1.0
        return max((sum(x * v[t] for t, x in u.items() if t in v) / (norm * size), name) for name, u, size in self.vectors)


def marked_lines(text: str | None) -> list[str]:
    low = (text or "").lower()
    return [line for line in low.split("\n") if MARKERS.search(line)] if MARKERS.search(low) else []


def longest_run(threshold: float) -> int:
    """Words of a run that can still reach the threshold: where no term repeats and W words hold all L of
    a template, the squared cosine is L / W at most, as other words weigh as much as the template's or more."""
    return math.ceil(max(len(TOKEN.findall(text)) for _, text in TEMPLATES) / max(threshold, 0.1) ** 2)


def marked_runs(text: str | None, longest: int) -> list[str]:
    """Runs of two or more consecutive lines without a blank one, with a marked line and at most ``longest`` words."""
    low = (text or "").lower()
    if not MARKERS.search(low):
        return []
    lines, sizes, runs = low.split("\n"), {}, set()

    def size(i: int) -> int:
        if i not in sizes:
            sizes[i] = len(TOKEN.findall(lines[i])) if 0 <= i < len(lines) and lines[i].strip() else longest + 1
        return sizes[i]

    for i, line in enumerate(lines):
        if MARKERS.search(line):
            first, before = i, size(i)
            while before <= longest:
                last, words = i, before
                while words <= longest:
                    if first < last:
                        runs.add((first, last))
                    last += 1
                    words += size(last)
                first -= 1
                before += size(first)
    return ["\n".join(lines[a:b + 1]) for a, b in sorted(runs)]


def frequencies(files: DataFrame) -> tuple[dict, int]:
    """Lines with each template term, and lines with a marker word, over all texts."""
    vocabulary = {t for _, text in TEMPLATES for t in terms(text)}
    names = {t: " ".join(t) if isinstance(t, tuple) else t for t in vocabulary}
    schema = pa.schema([("pair", pa.bool_()), ("term", pa.string()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, lines = Counter(), 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                for line in marked_lines(text):
                    lines += 1
                    found.update(t for t in terms(line) if t in vocabulary)
        rows = [(isinstance(t, tuple), names[t], n) for t, n in found.items()] + [(False, "", lines)]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    rows = (files.select("text").mapInArrow(run, "pair boolean, term string, n long").groupBy("pair", "term")
            .agg(F.sum("n").alias("n")).collect())       # at most the templates' terms and one
    counts = {tuple(r["term"].split(" ")) if r["pair"] else r["term"]: r["n"] for r in rows}
    return counts, counts.pop("", 0)


def directory(path: Column) -> Column:
    """The directory of a path, without slashes at its ends; the root is an empty text."""
    return F.regexp_replace(F.coalesce(path, F.lit("")), r"^/+|/*[^/]*$", "")


def own_licenses(files: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, repo, directory, path, is_file, license and score by each file's own text."""
    counts, lines = frequencies(files)
    schema = pa.schema([("doc_id", pa.int64()), ("repo", pa.string()), ("path", pa.string()), ("is_file", pa.bool_()),
                        ("license", pa.string()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        templates, longest = Templates(counts, lines), longest_run(threshold)
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(5)]
            for a, b in text_blocks(columns[4]):
                rows = []
                for doc_id, repo, path, is_file, text in zip(*(c[a:b] for c in columns)):
                    heads = marked_lines(text) + marked_runs(text, longest)
                    score, name = max(map(templates.best, heads + ([text] if is_file and heads else [])), default=(0.0, None))
                    rows.append((doc_id, repo, path, is_file, name if score >= threshold else None, score))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    is_file = F.coalesce(F.regexp_extract("path", r"([^/]*)$", 1).rlike(LICENSE_FILE), F.lit(False))
    scanned = files.select("doc_id", "repo", "path", is_file.alias("is_file"), "text").mapInArrow(
        run, "doc_id long, repo string, path string, is_file boolean, license string, score double")
    return scanned.withColumn("directory", directory(F.col("path")))


def scan(files: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Licence of every row of ``files`` (doc_id, repo, path, text): doc_id, license, origin
    (``own``, ``inherited`` or ``none``), score of its own text, and the licence file inherited from."""
    own = materialise(own_licenses(files, threshold), "own-licenses")
    # The best licence file of each directory; grouped with partial aggregation.
    first = F.struct((-F.col("score")).alias("s"), F.col("path").alias("source"), F.col("doc_id").alias("d"), "license")
    holders = materialise(own.where("is_file and license is not null").groupBy("repo", "directory")
                          .agg(F.min(first).alias("f")).select(F.col("repo").alias("_r"), F.col("directory").alias("_d"),
                                                               F.col("f.license").alias("_license"), F.col("f.source").alias("_source")), "holders")
    parts = F.when(F.col("directory") == "", F.array().cast("array<string>")).otherwise(F.split("directory", "/"))
    above = F.transform(F.sequence(F.lit(0), F.size("parts")), lambda n: F.array_join(F.slice("parts", F.lit(1), n), "/"))
    folders = materialise(own.where("license is null").select("repo", "directory").distinct().withColumn("parts", parts)
                          .select("repo", "directory", F.posexplode(above).alias("depth", "above")), "folders")
    near = folders.join(holders, F.col("repo").eqNullSafe(F.col("_r")) & (F.col("above") == F.col("_d")))
    nearest = materialise(near.groupBy("repo", "directory").agg(F.max(F.struct("depth", "_license", "_source")).alias("n"))
                          .select(F.col("repo").alias("_r"), F.col("directory").alias("_d"), F.col("n._license").alias("_license"),
                                  F.col("n._source").alias("_source")), "nearest")
    joined = own.join(nearest, own["repo"].eqNullSafe(nearest["_r"]) & (own["directory"] == nearest["_d"]), "left")
    inherits = F.col("license").isNull() & F.col("_license").isNotNull()
    return joined.select(
        "doc_id", F.coalesce("license", "_license").alias("license"),
        F.when(F.col("license").isNotNull(), "own").when(inherits, "inherited").otherwise("none").alias("origin"),
        "score", F.when(inherits, F.col("_source")).alias("inherited_from"))
