"""Toxicity and language: automata against edit distances, held-out accuracy, edge rows."""

import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fleetstar.llm import language, queries, toxicity

from .conftest import DOC

SF_MID = "/root/testdata/sf0.1"
TERMS = [("abcde", False), ("abc", False), ("bcdabcdab", False), ("dca", True), ("cabdacb", True), ("ab", False)]


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def nearest(word):
    """Least edits to any term within its allowance; a stem may be any beginning of the word."""
    found = []
    for text, stem in TERMS:
        allowed = 0 if len(text) < 5 or (stem and len(text) < 7) else 1 if len(text) <= 8 else 2
        least = min(edits(word[:n], text) for n in (range(len(word) + 1) if stem else [len(word)]))
        if least <= allowed:
            found.append(least)
    return min(found, default=None)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="abcdx", max_size=11))
def test_automata_match_edit_distances(word):
    found = toxicity.Automata(TERMS).match(word)
    assert (found and found[1]) == nearest(word)


@given(st.lists(st.text(alphabet="abcdx", max_size=9), max_size=20))
@settings(max_examples=60, deadline=None)
def test_dead_beginnings_lose_no_word(words):
    lexicon = toxicity.Lexicon(TERMS, [1.0] * len(TERMS))
    for _ in range(2):
        assert {i for i, _ in lexicon.hits(words)} == {i for i, w in enumerate(words) if nearest(w) is not None}


def test_quotations_and_misspellings_weigh_less():
    lexicon = toxicity.Lexicon([("moron", False)], [4.0], [-3.0, 3.0, 1.0, 0.0, 0.0, 0.0])
    plain, wrong = lexicon.score("you are a moron today"), lexicon.score("you are a morron today")
    quoted, told = lexicon.score('he read "you are a moron" aloud to us'), lexicon.score("she said moron to him")
    assert plain > wrong > lexicon.score("you are a baron today") and plain > quoted and plain > told
    assert lexicon.score(None) == lexicon.score("") == lexicon.score("nothing here") < 0.1


def test_toxicity_held_out(spark):
    got = queries.toxicity_scores(spark, SF_MID)
    labels = spark.read.parquet(f"{SF_MID}/labels.parquet")
    rows = got.join(labels, "doc_id").where("held_out").collect()
    toxic, clean = [r for r in rows if r["toxic"]], [r for r in rows if not r["toxic"]]
    assert sum(r["predicted"] for r in toxic) >= 0.75 * len(toxic)
    assert sum(r["predicted"] for r in clean) <= 0.02 * len(clean)
    for r in rows[:50]:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1
    assert got.count() == spark.read.parquet(f"{SF_MID}/documents.parquet").count()


def test_toxicity_edges(spark, edge_docs, no_docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    untrained = toxicity.train(edge_docs, none)
    assert [r["score"] for r in toxicity.score(edge_docs, untrained).collect()] == [0.0] * edge_docs.count()
    odd = spark.createDataFrame([(1, 1), (2, 0), (3, None), (None, 1), (4, 7)], "doc_id long, toxic int")
    lexicon = toxicity.train(edge_docs, odd)
    assert toxicity.score(edge_docs, lexicon).count() == edge_docs.count()
    assert toxicity.score(no_docs, lexicon).count() == 0
    kept = toxicity.drop_toxic(edge_docs, toxicity.Lexicon([("word", False)], [9.0], [-5.0, 5.0, 1.0, 0.0, 0.0, 0.0]))
    assert kept.columns == edge_docs.columns and kept.where("doc_id = 7").count() == 0 and kept.count() == edge_docs.count() - 1


def test_language_held_out(spark):
    got = queries.language_id(spark, SF_MID)
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    rows = got.join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in rows) >= 0.99 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows) and got.count() == docs.count()


def test_language_edges(spark, edge_docs, no_docs):
    rows = [(i, "der die das und nicht " * 3 + f"wort{i}", "de", "a", 1) for i in range(30)]
    rows += [(100 + i, "the of and with not " * 3 + f"word{i}", "en", "a", 1) for i in range(30)] + [(300, "the and", None, "a", 1)]
    model = language.train(spark.createDataFrame(rows, DOC))
    assert model.languages == ["de", "en"]
    got = {r["doc_id"]: r for r in language.predict(edge_docs.where("doc_id is not null"), model).collect()}
    assert got[4]["lang_pred"] == got[5]["lang_pred"] == got[6]["lang_pred"] == "und" and got[4]["score"] == 0
    assert got[1]["lang_pred"] == "en" and language.predict(edge_docs, model).count() == edge_docs.count()
    none = language.train(no_docs)
    assert none is None and language.predict(no_docs, none).count() == 0
    assert {r["lang_pred"] for r in language.predict(edge_docs, none).collect()} == {"und"}


def test_every_language_is_learned(spark):
    words = lambda i: [chr(0x4E00 + 40 * i + j) * 3 + chr(0x4E00 + 40 * i + j + 1) for j in range(30)]
    rows = [(100 * i + r, " ".join(words(i)[r:r + 20]), f"l{i:02d}", "a", 1) for i in range(70) for r in range(6)]
    docs = spark.createDataFrame(rows, DOC)
    model = language.train(docs)
    assert model.languages == [f"l{i:02d}" for i in range(70)]
    got = {r["doc_id"]: r["lang_pred"] for r in language.predict(docs, model).collect()}
    assert got == {r[0]: r[2] for r in rows}


def test_letters_decide_what_is_a_language():
    empty = [len(b) for b, _ in language.ngram_counts(["", None, "123 !?\n", "é", "a1b", "\ud800"])]
    assert empty[:3] == [0, 0, 0] and empty[3] and empty[4]


@pytest.mark.parametrize("name", ["op9_toxicity", "op10_language_id"])
def test_reruns_agree(spark, name):
    run = queries.QUERIES[name]
    one, two = run(spark, "/root/testdata/sf0.01"), run(spark, "/root/testdata/sf0.01")
    assert one.exceptAll(two).count() == 0
