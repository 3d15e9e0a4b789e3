"""Spelling variants against pairs found by deletion and replacement, word by word."""

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from fleetstar.llm import spelling

from .conftest import DOC

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows):
    counts = Counter()
    for doc, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += len(run) >= 7
    n = {w: c for w, c in counts.items() if c >= 2}
    near, holes = defaultdict(set), defaultdict(list)
    for w in n:
        for k in range(len(w)):
            shorter = w[:k] + w[k + 1:]
            holes[k, shorter].append(w)
            if shorter in n:
                near[w].add(shorter)
                near[shorter].add(w)
    for group in holes.values():
        for w in group:
            near[w].update(x for x in group if x != w)
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        if best is not None and n[best] >= 10 * n[w]:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return sorted(((w, form.get(w), root(w), c, len(near[w]), n[form[w]] if w in form else None) for w, c in n.items()), key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=repr)


def noisy(seed, n):
    rng = random.Random(seed)
    syllables = ["an", "ré", "tion", "ou", "ÿa", "Er", "zz", "ma"]
    words = ["".join(rng.choices(syllables, k=rng.randrange(3, 7))) for _ in range(120)]
    weights = [1000 / (i + 1) ** 1.5 for i in range(len(words))]
    out = []
    for w in rng.choices(words, weights, k=n):
        if rng.random() < 0.2:
            k = rng.randrange(len(w))
            w = w[:k] + rng.choice(["", "q", w[k] + "e", w[k:k + 2][::-1]]) + w[k + 1:]
        out.append(w)
    return " ".join(out)


@pytest.mark.parametrize("block", [1_000, 3])
def test_equals_plain_python(spark, monkeypatch, block):
    monkeypatch.setattr(spelling, "BLOCK", block)
    rows = [(i, noisy(i, 700), "en", "a", 0) for i in range(25)]
    # A chain: each spelling ten times as frequent as the one before, and many words of one block.
    rows += [(100 + i, " ".join(["abcdefgh"] * 200 + ["abcdefgx"] * 18 + ["abcdefxx"]), "en", "a", 0) for i in range(3)]
    rows += [(200, " ".join(f"samestart{chr(97 + i)}{chr(97 + j)}" for i in range(9) for j in range(9) for _ in range(2)), "en", "a", 0)]
    result = got(spelling.variants(spark.createDataFrame(rows, DOC).repartition(4)))
    assert result == plain(rows)
    assert any(r[1] and r[2] != r[1] for r in result)


def test_edge_rows(spark, edge_docs, edge_rows, no_docs):
    assert got(spelling.variants(edge_docs)) == plain(edge_rows)
    assert got(spelling.variants(no_docs)) == []


def test_pairs_meet_in_one_block_only(spark):
    words = ["abcdefg", "abcdefh", "abcdefgh", "bcdefgh", "abcxdefgh", "aaaaaaa", "aaaaaaaa", "aaaaaaaaa"]
    vocabulary = spark.createDataFrame([(w, 5) for w in words], "word string, n long")
    near = {r["word"]: r["n_near"] for r in spelling.neighbours(vocabulary).collect()}
    assert near == {"abcdefg": 2, "abcdefh": 2, "abcdefgh": 4, "bcdefgh": 1, "abcxdefgh": 1, "aaaaaaa": 1, "aaaaaaaa": 2, "aaaaaaaaa": 1}
