"""Mixing and quality rules against plain Python."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from fleetstar.llm import mixing, quality

from .conftest import DOC, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plan(sizes):
    """Targets by sharing the excess until no source is above twice its size."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    wanted, fixed = 1.5 * sum(sizes.values()), {}
    while True:
        left = [s for s in names if s not in fixed]
        level = (wanted - sum(fixed.values())) / sum(weight[s] for s in left) if left else 0
        over = [s for s in left if weight[s] * level >= 2 * sizes[s]]
        if not over:
            return {s: fixed.get(s, weight[s] * level) for s in names}
        fixed.update({s: 2.0 * sizes[s] for s in over})


def test_mix_follows_the_plan(spark, edge_docs, edge_rows):
    sizes = defaultdict(int)
    for _, text, _, source, _ in edge_rows:
        sizes[source] += len(WORD.findall(text or ""))
    target = plan(sizes)
    sized = edge_docs.select("doc_id", "source", mixing.size_of(F.col("text")).alias("size"))
    want = []
    for doc_id, text, _, source, _ in edge_rows:
        size = len(WORD.findall(text or ""))
        rate = target[source] / sizes[source] if sizes[source] else 0.0
        u = int(hashlib.md5(f"mix-1:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:13], 16) / 2.0**52
        want.append((doc_id, size, sizes[source], round(target[source], 6), math.floor(rate) + (u < rate - math.floor(rate))))
    rows = [(r["doc_id"], r["size"], r["source_size"], round(r["target"], 6), r["copies"]) for r in mixing.copies(sized).collect()]
    assert sorted(rows, key=repr) == sorted(want, key=repr)
    mixed = mixing.mix(edge_docs)
    assert mixed.columns == edge_docs.columns
    assert Counter(r["doc_id"] for r in mixed.select("doc_id").collect()) == Counter(
        d for d, *_, n in want for _ in range(n))


def test_mix_of_nothing(spark, no_docs):
    assert mixing.mix(no_docs).count() == 0
    blank = spark.createDataFrame([(1, None, None, "a", None), (2, " ", None, None, 1)], DOC)
    assert mixing.mix(blank).count() == 0


@pytest.mark.parametrize("n", [1, 2, 5, 40])
def test_level_is_the_shared_out_one(spark, n):
    sizes = {f"s{i:02d}": (i * 7919) % 50 * 10 ** (i % 4) for i in range(n)}
    rows = spark.createDataFrame([(s, v) for s, v in sizes.items()], "source string, size long")
    got = {r["source"]: r["target"] for r in mixing.source_plan(rows).collect()}
    assert got == pytest.approx(plan(sizes))


def base_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for j in range(i, i + 3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered))


def test_base_counts(spark, edge_docs, edge_rows):
    more = ["a b c a b c", "a b c x a b c\na b c x a b c\n\n \n", "x x x x x", "x x x", "# $ | <a>", " lead\n lead\n",
            "a b c d e a b c z b c d", "日本 語 日本 語 日本"]
    docs = edge_docs.select("doc_id", "text", "lang").unionByName(
        spark.createDataFrame([(100 + i, t, "en") for i, t in enumerate(more)], "doc_id long, text string, lang string"))
    got = quality.features(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect()
    texts = [(r[0], r[1]) for r in edge_rows] + [(100 + i, t) for i, t in enumerate(more)]
    assert sorted((tuple(r) for r in got), key=repr) == sorted(((d, *base_counts(t)) for d, t in texts), key=repr)


def jensen_shannon(p, q):
    m = [(a + b) / 2 for a, b in zip(p, q)]
    kl = lambda x: sum(a * math.log2(a / c) for a, c in zip(x, m) if a)
    return math.sqrt(max(0.0, (kl(p) + kl(q)) / 2))


def classes(text):
    letters = sum(c.isalpha() for c in text)
    capitals = sum(c.isupper() for c in text)
    digits, spaces = sum(c.isdigit() for c in text), len(re.findall(r"[\x20\x09-\x0D]", text))
    stops, symbols = len(re.findall(r"[.,;:!?]", text)), len(re.findall(r"[#*$%&|<>]", text))
    return [letters - capitals, capitals, digits, spaces, stops, symbols, len(text) - letters - digits - spaces - stops - symbols]


def test_verdicts_match_plain_python(spark):
    good = [(i, prose(i, 60 + 5 * i) + ".", "en") for i in range(40)]
    bad = [(100, " ".join(f"##{i}$$ %%" for i in range(80)), "en"), (101, "zzzzz " * 10 + " ".join(f"qqqqq{i}" for i in range(90)), "en"),
           (102, prose(7, 20), "en"), (103, "a b c " * 60, "en"), (104, prose(5, 90) + ".", None), (105, None, "en")]
    rows = good + bad
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    words = {d: WORD.findall(t or "") for d, t, _ in rows}
    refs = []
    for chosen in ([r for r in rows if r[2] == "en"], rows):
        counts = Counter(w.lower() for d, _, _ in chosen for w in words[d] if len(w) <= quality.COMMON_CHARS)
        n = sum(len(words[d]) for d, _, _ in chosen)
        common = sorted(w for w, k in counts.items() if k >= n * quality.COMMON_SHARE)
        total = [sum(x) for x in zip(*(classes(t or "") for _, t, _ in chosen))]
        refs.append((common, [counts[w] / n for w in common] + [1 - sum(counts[w] for w in common) / n], [x / sum(total) for x in total]))
    want = {}
    for d, t, lang in rows:
        n, _, _, _, repeats = base_counts(t)
        failed = n < 50 or 100 * repeats > 50 * n
        found = []
        for common, shares, kinds in refs:
            c = Counter(w.lower() for w in words[d])
            hits = [sum(w.lower() == x for w in words[d] if len(w) <= quality.COMMON_CHARS) for x in common]
            p = [h / max(n, 1) for h in hits] + [(n - sum(hits)) / max(n, 1)]
            k = classes(t or "")
            found.append((jensen_shannon(p, shares), jensen_shannon([x / max(sum(k), 1) for x in k], kinds)))
            assert c is not None
        near = any(a <= quality.MAX_WORD_DISTANCE and b <= quality.MAX_CHARACTER_DISTANCE for a, b in found)
        want[d] = (failed, not failed and near, found[0] if lang else min(found, key=lambda x: x[0] / quality.MAX_WORD_DISTANCE + x[1] / quality.MAX_CHARACTER_DISTANCE))
    for r in quality.divergence(docs).collect():
        failed, kept, near = want[r["doc_id"]]
        assert (r["base_failed"], r["kept"]) == (failed, kept), r
        if r["doc_id"] < 100:
            assert (r["word_distance"], r["class_distance"]) == pytest.approx(near, abs=1e-9)
    assert all(want[d][1] for d, *_ in good) and not any(want[d][1] for d in (100, 101, 102, 103, 105))
    assert want[104][1]  # no language: the nearest reference counts


def test_quality_edges(edge_docs, no_docs):
    kept = quality.keep_good(edge_docs)
    assert kept.columns == edge_docs.columns
    verdicts = quality.divergence(edge_docs)
    assert verdicts.count() == edge_docs.count()
    assert kept.count() == verdicts.where("kept").count()
    assert quality.divergence(no_docs).count() == 0 and quality.keep_good(no_docs).count() == 0


def test_only_ascii_white_space_parts_words(spark):
    texts = ["foo \u0085", "foo \u2028", "a\tfoo \u2029", "foo \n", "\u0085", " \u2028 "]
    rows = [(i, t, "en", "a", len(t)) for i, t in enumerate(texts)]
    got = {r["doc_id"]: (r["n_words"], r["word_chars"]) for r in quality.features(spark.createDataFrame(rows, DOC)).collect()}
    assert got == {i: (len(w), sum(map(len, w))) for i, w in ((i, re.findall(r"[^\x20\x09-\x0D]+", t)) for i, t in enumerate(texts))}
    assert got[0] == (2, 4)
