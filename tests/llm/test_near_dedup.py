import random
import re
from collections import defaultdict

import numpy as np
import pytest

from fleetstar.llm import near_dedup, shingles

from .conftest import DOC, prose


def shingle_set(text, words):
    found = (text or "").encode().lower().split()
    if len(found) < words:
        return frozenset([tuple(found)] if found else [])
    return frozenset(zip(*(found[i:] for i in range(words))))


def brute(rows, words, threshold):
    """(set size, least id reachable) of each row, by comparing all pairs of sets."""
    sets = [shingle_set(text, words) for _, text in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            union = len(sets[i] | sets[j])
            if union and 100 * len(sets[i] & sets[j]) >= 100 * threshold * union:
                parent[root(i)] = root(j)
    least = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)].append(doc_id)
    return [(doc_id, len(s), (min(least[root(i)], default=None) if s else doc_id)) for i, ((doc_id, _), s) in enumerate(zip(rows, sets))]


def planted(n=260):
    """Texts with exact copies, chains of edits around the threshold, and one large group."""
    rng, rows = random.Random(4), []
    for i in range(n):
        rows.append((i, prose(i + 50, rng.choice([3, 12, 60, 150]))))
    for i in range(n, n + 120):
        words = rows[rng.randrange(n)][1].split()
        for _ in range(rng.randrange(1, 9)):
            words[rng.randrange(len(words))] = f"edit{rng.randrange(1000)}"
        rows.append((i, " ".join(words)))
    centre = prose(9999, 140).split()
    for i in range(n + 120, n + 320):
        words = centre[:]
        for _ in range(rng.randrange(0, 6)):
            words[rng.randrange(len(words))] = f"near{rng.randrange(1000)}"
        rows.append((i, " ".join(words)))
    rows += [(n + 320 + i, rows[5][1]) for i in range(30)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("words, node", [(2, 100), (5, 12)])
def test_groups_match_all_pairs(spark, monkeypatch, words, node):
    monkeypatch.setattr(near_dedup, "NODE", node)
    rows = planted()
    docs = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in rows], DOC)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dedup.near_duplicates(docs, words).collect()}
    want = {d: (n, c) for d, n, c in brute(rows, words, 0.8)}
    wrong = {d for d in want if got[d] != want[d]}
    assert not wrong


def edited(rng, words, n):
    """``words`` with ``n`` of them replaced by new ones, no two side by side."""
    words, left = words[:], list(range(0, len(words), 2))
    for at in rng.sample(left, n):
        words[at] = f"new{rng.randrange(10**9)}"
    return words


def families(n, size, change, linked):
    """``n`` families of near copies that share a boilerplate, and texts linked to one member of a family."""
    rng = random.Random(8)
    base, out = [f"base{i}" for i in range(200)], []
    for _ in range(n):
        centre = edited(rng, base, 6)
        out.append([edited(rng, centre, change) for _ in range(size)])
    texts = [" ".join(w) for f in out for w in f] + [" ".join(edited(rng, rng.choice(rng.choice(out)), 10)) for _ in range(linked)]
    return list(enumerate(texts))


def assert_groups(spark, rows):
    docs = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in rows], DOC)
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(docs, 2).collect()}
    want = {d: c for d, _, c in brute(rows, 2, 0.8)}
    assert not {d for d in want if got[d] != want[d]}
    return len(set(want.values()))


def only_in_one_large_node(monkeypatch, first):
    """From document ``first`` on no text is in a leaf; all texts are in one node that no token divides."""
    real = near_dedup.leaves

    def leaves(members):
        late = members.where(members["doc_id"] >= first).select("set_id")
        node = members.selectExpr("1L AS key", "0 AS tree", "set_id", "signature", f"{members.count()}L AS n")
        return real(members)[0].join(late, "set_id", "left_anti"), node

    monkeypatch.setattr(near_dedup, "leaves", leaves)


def test_texts_linked_to_one_of_several_families(spark, monkeypatch):
    only_in_one_large_node(monkeypatch, 80)
    assert assert_groups(spark, families(n=4, size=20, change=3, linked=20)) == 4


def test_texts_linked_to_few_of_a_large_group(spark, monkeypatch):
    only_in_one_large_node(monkeypatch, 900)
    monkeypatch.setattr(near_dedup, "BLOCK", 300)
    rows = families(n=1, size=900, change=2, linked=60)
    assert assert_groups(spark, rows) == 1


def test_edge_rows(edge_docs, edge_rows, no_docs):
    got = sorted((tuple(r[:4]) for r in near_dedup.near_duplicates(edge_docs, 2).collect()), key=repr)
    want = brute([(r[0], r[1]) for r in edge_rows], 2, 0.8)
    assert got == sorted(((d, n, c, d is not None and d == c) for d, n, c in want), key=repr)
    assert near_dedup.near_duplicates(no_docs, 2).count() == 0


def test_one_of_each_group_stays(edge_docs, edge_rows):
    kept = near_dedup.keep_one(edge_docs, words=2)
    assert kept.columns == edge_docs.columns
    ids = [r["doc_id"] for r in kept.select("doc_id").collect()]
    groups = {c for d, _, c in brute([(r[0], r[1]) for r in edge_rows], 2, 0.8) if c is not None}
    assert sorted(i for i in ids if i is not None) == sorted(groups)
    assert ids.count(None) == 1  # one document without an id belongs to no named group


def test_word_hashes_follow_the_words():
    texts = ["a bc  a", "", " \t\n", "bc", "x" * 70_000 + " a", "é\x1cé a\x0bbc"]
    hashes, bounds = shingles.word_hashes([t.encode() for t in texts])
    by_word = defaultdict(set)
    for i, t in enumerate(texts):
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", t) if w]
        assert bounds[i + 1] - bounds[i] == len(words)
        for w, h in zip(words, hashes[bounds[i]:bounds[i + 1]].tolist()):
            by_word[w].add(h)
    assert all(len(h) == 1 for h in by_word.values())
    assert len({next(iter(h)) for h in by_word.values()}) == len(by_word)


def test_shingles_are_of_the_given_length():
    assert [len(s) for s in shingles.shingle_sets(["a b a b", "A B", "a", None, ""], 2)] == [2, 1, 1, 0, 0]
    one, two = shingles.shingle_sets(["a b", "A  B\n"], 2)
    assert np.array_equal(one, two)


def test_components_of_a_long_chain(spark):
    n = 200
    order = list(range(n))
    random.Random(1).shuffle(order)
    links = spark.createDataFrame([(order[i], order[i + 1]) for i in range(n - 1)] + [(1000, 1001)], "a long, b long")
    roots = {r["set_id"]: r["root"] for r in near_dedup.components(links).collect()}
    assert roots == {**{i: 0 for i in range(n)}, 1000: 1000, 1001: 1000}

