"""Substring dedup: the index against plain search, results against windows listed one by one."""

import hashlib
import random

import numpy as np
import pytest

from fleetstar.llm import substrings

from .conftest import DOC, prose


def listed(rows, words):
    """(id, n_words, n_removed, kept) by listing every window; one document per (id, text)."""
    docs = sorted({(r[0] is None, r[0] or 0, r[1]) for r in rows}, key=lambda d: d[:2])
    first, seen = {}, {}
    for d, (_, _, text) in enumerate(docs):
        found = (text or "").encode().split()
        gone = [False] * len(found)
        for i in range(len(found) - words + 1):
            window = tuple(found[i:i + words])
            if first.setdefault(window, (d, i)) != (d, i):
                gone[i:i + words] = [True] * words
        seen[docs[d]] = (len(found), sum(gone), b" ".join(w for w, g in zip(found, gone) if not g).decode())
    return sorted(((r[0], *seen[(r[0] is None, r[0] or 0, r[1])]) for r in rows), key=repr)


def found(df):
    return sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in df.collect()), key=repr)


def copied(seed, n_docs, alphabet):
    """Texts that copy stretches of earlier ones, with edits, beside words of their own."""
    rng = random.Random(seed)
    texts = []
    for _ in range(n_docs):
        out = []
        while len(out) < rng.choice([5, 60, 150]):
            if texts and rng.random() < 0.6:
                other = rng.choice(texts)
                a = rng.randrange(len(other))
                stretch = other[a:a + rng.randrange(3, 60)]
                if stretch and rng.random() < 0.5:
                    stretch[rng.randrange(len(stretch))] = f"e{rng.randrange(alphabet)}"
                out += stretch
            else:
                out += [f"w{rng.randrange(alphabet)}" for _ in range(rng.randrange(1, 30))]
        texts.append(out)
    return [" ".join(t) for t in texts]


@pytest.mark.parametrize("seed", range(20))
def test_index_finds_what_plain_search_finds(seed):
    rng = random.Random(seed)
    parts = [[rng.randrange(1, 6) for _ in range(rng.randrange(1, 12))] + [0] for _ in range(rng.randrange(1, 9))]
    text = np.array(sum(parts, []))
    index = substrings.FMIndex(text, 12)
    for _ in range(40):
        pattern = [rng.randrange(1, int(text.max()) + 1) for _ in range(rng.randrange(1, 5))]
        lo, hi = index.rows(np.array(pattern[-1:]))
        for c in pattern[-2::-1]:
            lo, hi = index.extend(np.array([c]), lo, hi)
        want = [i for i in range(len(text)) if text[i:i + len(pattern)].tolist() == pattern]
        assert sorted(index.sa[lo[0]:hi[0]]) == want
        if want:
            assert index.earliest(lo, hi)[0] == want[0]


@pytest.mark.parametrize("seed", range(6))
def test_shard_search_marks_every_window_that_starts_earlier(seed):
    rng = random.Random(seed)
    words = 8
    bodies, seen = [], set()
    for text in copied(seed, 25, 12):
        body = " ".join(text.split()[:rng.randrange(words, words + 9)])
        if len(body.split()) >= words and body not in seen:
            seen.add(body)
            bodies.append(body.encode())
    split = [b.split() for b in bodies]
    masks = substrings.search_shard(bodies, np.array([len(s) - words + 1 for s in split]), words)
    first = {}
    for d, s in enumerate(split):
        want = 0
        for i in range(len(s) - words + 1):
            want |= (first.setdefault(tuple(s[i:i + words]), (d, i)) != (d, i)) << i
        assert int(masks[d]) == want


def test_segments_cover_every_window_once():
    texts = [t.encode() for t in copied(4, 30, 20)] + [b"", b"a b", b"z " * 50]
    owner, first, windows, m, _ = substrings.cut_segments(texts)
    starts = sorted((int(o), int(f) + i) for o, f, n in zip(owner, first, windows) for i in range(n))
    assert starts == [(d, i) for d, t in enumerate(texts) for i in range(len(t.split()) - 19)]
    assert windows.max() <= substrings.WORDS - substrings.GRAM + 1
    assert len(m) == len(owner)


@pytest.mark.parametrize("shard_words,hot", [(400_000, 20_000), (300, 20_000), (300, 2)])
def test_equals_listed_windows(spark, monkeypatch, shard_words, hot):
    monkeypatch.setattr(substrings, "SHARD_WORDS", shard_words)
    monkeypatch.setattr(substrings, "HOT", hot)
    texts = copied(7, 120, 40) + [prose(5, 300)] * 9 + ["a " * 70, "x y " * 40, prose(5, 150) + " end " + prose(5, 90)]
    texts += [prose(i, 30) + " " + prose(77, 25) + " " + prose(1000 + i, 30) for i in range(25)]  # a passage of many documents
    rng = random.Random(1)
    rng.shuffle(texts)
    rows = [(i * 7 % 1009, t, "en", "a", len(t)) for i, t in enumerate(texts)]
    df = substrings.remove_repeats(spark.createDataFrame(rows, DOC).repartition(5))
    assert found(df) == listed(rows, substrings.WORDS)


def test_edge_rows(spark, edge_docs, edge_rows, no_docs):
    assert found(substrings.remove_repeats(edge_docs.repartition(3))) == listed(edge_rows, substrings.WORDS)
    assert substrings.remove_repeats(no_docs).collect() == []


def test_one_id_with_several_texts(spark):
    rows = [(1, prose(1, 60), "en", "a", 0), (1, prose(1, 60), "en", "a", 0), (1, prose(2, 60), "en", "a", 0), (2, prose(2, 60), "en", "a", 0)]
    got = sorted((r["doc_id"], r["n_removed"], hashlib.sha256(r["kept"].encode()).hexdigest()[:4] != "")
                 for r in substrings.remove_repeats(spark.createDataFrame(rows, DOC).repartition(2)).collect())
    assert got == [(1, 0, True), (1, 0, True), (1, 0, True), (2, 60, True)]
