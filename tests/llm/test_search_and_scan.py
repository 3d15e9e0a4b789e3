"""Top-k search and licence scan against brute force."""

import math

import numpy as np
import pytest

from fleetstar.llm import licenses, topk


def brute(rows, queries, k=10):
    whole = [(i, np.floor(1024 * np.array(v, np.float64)).astype(np.int64)) for i, v in rows
             if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for qi, q in whole:
        if qi in queries:
            scores = sorted(((-int(v @ q), i) for i, v in whole if i != qi and len(v) == len(q)))[:k]
            out += [(qi, rank, i, -s) for rank, (s, i) in enumerate(scores, 1)]
    return sorted(out)


def run(spark, rows, queries, shard_rows=50):
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "'x' AS v", "0 AS rank", "1.5 AS score")
    vectors = topk.integer_vectors(table)
    index, shards = topk.build(vectors, shard_rows)
    found = topk.search(vectors.where(vectors["vec_id"].isin(list(queries))), index, shards, block=3)
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found.collect())


def vectors(n, dims=16, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, dims))
    return [(i, [float(x) for x in (centres[i % 5] + rng.normal(size=dims) * 0.7).astype(np.float32)]) for i in range(n)]


def test_exact_among_many(spark):
    rows = vectors(400) + [(1000 + i, vectors(8)[7][1]) for i in range(60)]  # one vector very often: ties by id
    assert run(spark, rows, set(range(0, 400, 40)) | {1000, 1030}) == brute(rows, set(range(0, 400, 40)) | {1000, 1030})


def test_edge_rows(spark):
    rows = vectors(30, 4) + [(100, None), (101, [1.0, None, 0.0, 1.0]), (102, [1.0, float("nan"), 0.0, 1.0]),
                             (103, [float("inf"), 0.0, 0.0, 1.0]), (104, []), (None, [0.1, 0.2, 0.3, 0.4]),
                             (105, [0.0] * 4), (106, [-1e5, 1e5, 0.0, -0.0]), (107, [0.5, 0.25]), (108, [0.5, -0.25])]
    queries = {0, 5, 100, 101, 102, 105, 106, 107}
    assert run(spark, rows, queries, 7) == brute(rows, queries)
    assert run(spark, [], {0}) == []
    assert run(spark, rows[:1], {0}) == []


def test_repeated_query_ids_are_answered_each(spark):
    rows = vectors(60) + [(20, vectors(60)[33][1]), (20, vectors(60)[20][1])]
    got = run(spark, rows, {0, 20}, 20)
    assert got == brute(rows, {0, 20}) and len(got) == 40


@pytest.mark.parametrize("seed", range(4))
def test_only_proven_rows_are_left_out(seed):
    rng = np.random.default_rng(seed)
    rows = rng.integers(-300, 300, (900, 12)) if seed else np.repeat(rng.integers(-3, 3, (9, 12)), 100, 0)
    shard = topk.Shard.load(topk.Shard(np.arange(900), rows).dump())
    for q in range(0, 900, 90):
        kept, scores = shard.search(q, rows[q])
        exact = rows @ rows[q]
        best = sorted((-exact[i], i) for i in range(900) if i != q)[:10]
        assert {i for _, i in best} <= set(kept.tolist()) and (scores == exact[kept]).all()


FILES = [(1, "r", "LICENSE", "Released under the MIT License.\nfree"), (2, "r", "src/a.py", "x = 1"), (3, "r", "src/deep/b.py", None),
         (4, "r", "src/deep/COPYING", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
          "General Public License as published by the Free Software Foundation, either version 3 of the License"),
         (5, "r", "src/deep/er/c.py", ""), (6, "r", "src/deep/d.py", "# Licensed under the Apache License, Version 2.0\nimport os"),
         (7, "other", "src/deep/e.py", "text"), (8, None, "LICENSE", "Licensed under CC BY-NC 4.0."), (9, None, "x/y.md", "text"),
         (10, "r", None, "text"), (None, "r", "src/z", "text"), (2, "r", "src/a.py", "x = 1"), (11, "other", "LICENSE", "no known terms, all of us"),
         (12, "other", "n.txt", "the licence plate of the car was red and nobody knew whose it was"),
         (13, "r", "docs/LICENSE.txt", "All rights reserved"), (14, "r", "docs/guide/p.md", "p " * 200_000)]
WANT = {(1, "MIT", "own"), (2, "MIT", "inherited"), (3, "GPL-3.0", "inherited"), (4, "GPL-3.0", "own"), (5, "GPL-3.0", "inherited"),
        (6, "Apache-2.0", "own"), (7, None, "none"), (8, "CC-BY-NC-4.0", "own"), (9, "CC-BY-NC-4.0", "inherited"),
        (10, "MIT", "inherited"), (None, "MIT", "inherited"), (11, None, "none"), (12, None, "none"), (13, "Proprietary", "own"),
        (14, "Proprietary", "inherited")}


def test_licences_and_inheritance(spark):
    files = spark.createDataFrame(FILES, "doc_id long, repo string, path string, text string").selectExpr(
        "*", "'x' AS license", "'y' AS directory", "1 AS score")
    rows = licenses.scan(files).collect()
    assert len(rows) == len(FILES) and {(r["doc_id"], r["license"], r["origin"]) for r in rows} == WANT
    assert {r["inherited_from"] for r in rows if r["doc_id"] == 5} == {"src/deep/COPYING"}
    assert licenses.scan(files.where("false")).count() == 0


def test_headers_wrapped_over_lines(spark):
    wrapped = "import os\n\n# This work is licensed under the\n# GNU General Public License,\n# version {}\n\nx = 1\n"
    free = ("/* This program is free software: you can\n * redistribute it and/or modify it under the terms\n * of the GNU General "
            "Public License as\n * published by the Free Software Foundation,\n * either version 3 of the License */\nint x;")
    rows = [(1, "r", "a.py", wrapped.format(2)), (2, "r", "b.py", wrapped.format(3)), (3, "r", "c.c", free),
            (4, "r", "d.py", "the licence plate\nof the car\nwas red")]
    got = licenses.scan(spark.createDataFrame(rows, "doc_id long, repo string, path string, text string")).collect()
    assert {r["doc_id"]: r["license"] for r in got} == {1: "GPL-2.0", 2: "GPL-3.0", 3: "GPL-3.0", 4: None}


def test_each_template_names_its_licence():
    templates = licenses.Templates({}, 10)
    for name, text in licenses.TEMPLATES:
        score, found = templates.best(f"  // {text}.")
        assert found == name and score > 0.9
    assert templates.best("purple elephants dance")[0] == 0
