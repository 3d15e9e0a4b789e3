"""The corpus pipeline, stage by stage, against plain Python; the registered queries on the smallest tables."""

import hashlib
import importlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from fleetstar.llm import mixing, queries

from .conftest import DOC, fold, prose
from .test_native import WORD, plan
from .test_near_dedup import brute

SMALL = "/root/testdata/sf0.001"


def corpus():
    rows = []
    for i in range(70):
        rows.append((i, prose(i, 70 + i * 3) + ".", "en", f"s{i % 5}"))
    for i in range(100, 150):  # toxic by one made-up word
        words = prose(i, 80).split()
        for k in (5, 30, 60):
            words[k + i % 7] = "vilething"
        rows.append((i, " ".join(words) + ".", "en", "s0"))
    rows += [(200 + i, " ".join(f"##{i}{k}$$ %%{k}&&" for k in range(80)), "en", "s1") for i in range(6)]      # junk
    rows += [(300 + i, prose(i, 20), "en", "s1") for i in range(4)]                                         # too short
    for i in range(30):  # near and exact copies
        words = rows[i][1].split()
        if i % 3:
            words[-2] = f"changed{i}"
        rows.append((400 + i, " ".join(words), "en", f"s{i % 4}"))
    rows += [(500, None, "en", "s0"), (501, "", None, None), (502, prose(1000, 3000) + ".", "en", None)]
    return [(*r, len(r[1] or "")) for r in rows]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus"))
    rows = corpus()
    spark.createDataFrame(rows, DOC).repartition(3).write.parquet(f"{path}/documents.parquet")
    labels = [(r[0], 1, int("vilething" in (r[1] or ""))) for r in rows]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_stages_match_plain_python(spark, folder):
    rows = corpus()
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "quality rules", "MinHash near-dedup", "mixing sources", "best-fit packing"]
    docs, found = spark.read.parquet(f"{folder}/documents.parquet"), []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, folder)
        out.write.parquet(f"{folder}/out{i}")
        docs = spark.read.parquet(f"{folder}/out{i}")
        if i < 4:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            found.append(Counter(r["doc_id"] for r in docs.select("doc_id").collect()))
    texts = {r[0]: r for r in rows}
    mild = [i for i in texts if "vilething" not in (texts[i][1] or "")]
    assert found[0] == Counter(mild)
    good = [i for i in mild if len(WORD.findall(texts[i][1] or "")) >= 50 and not 200 <= i < 210]
    assert found[1] == Counter(good)
    groups = {c for d, _, c in brute([(i, texts[i][1]) for i in good], 5, 0.8)}
    assert found[2] == Counter(groups) and len(groups) < len(good)
    sizes = defaultdict(int)
    for i in groups:
        sizes[texts[i][3]] += len(WORD.findall(texts[i][1]))
    target, taken = plan(sizes), Counter()
    for i in groups:
        rate = target[texts[i][3]] / sizes[texts[i][3]]
        u = int(hashlib.md5(f"{mixing.SEED}:{i}".encode()).hexdigest()[:13], 16) / 2.0**52
        if n := math.floor(rate) + (u < rate - math.floor(rate)):
            taken[i] = n
    assert found[3] == taken
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {i: tokenizer.encode(texts[i][1], add_special_tokens=False).ids + [2] for i in taken}
    placed, sequences = Counter(), defaultdict(list)
    for r in docs.collect():
        part = ids[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
        placed[r["doc_id"]] += r["length"]
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert placed == Counter({i: n * len(ids[i]) for i, n in taken.items()})
    for places in sequences.values():
        ends = [0, *np.cumsum([n for _, n in sorted(places)])]
        assert [o for o, _ in sorted(places)] == ends[:-1] and ends[-1] <= 1024


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_queries_cover_their_tables(spark, name):
    table = {"op4_exact_topk": "embeddings", "op8_archive_conversion": "pages"}.get(name, "documents")
    rows = queries.QUERIES[name](spark, SMALL)
    have = spark.read.parquet(f"{SMALL}/{table}.parquet").count()
    if name == "op4_exact_topk":
        assert rows.count() == 10 * spark.read.parquet(f"{SMALL}/{table}.parquet").where("vec_id % 100 = 0").count()
    elif name == "op2_best_fit_packing":
        assert rows.select("doc_id").distinct().count() == have <= rows.count()
    elif name == "op12_spelling_variants":   # a row per word
        assert rows.count() == rows.select("word").distinct().count() > 0
    else:
        assert rows.count() == have
    if "held_out" in rows.columns:
        parts, rest = (5, 0) if name.startswith("op9") else (3, 1)
        assert all(r["held_out"] == (fold(r["doc_id"], parts) == rest) for r in rows.collect())


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_queries_match_their_sql(spark, name):
    parity = importlib.import_module("tests.parity")
    r = parity.compare(spark, parity.duck(SMALL), name, queries.QUERIES[name], queries.ORACLE[name], SMALL)
    assert "error" not in r and r["exact"], r


def test_entry_works_without_the_subpackage(monkeypatch):
    import sys

    import __spark_entry__ as entry
    from fleetstar.registry import QUERIES

    assert set(QUERIES) < set(entry.queries()) and {"pipeline", *queries.QUERIES} <= set(entry.queries())
    for name in [m for m in sys.modules if m.startswith("fleetstar.llm") or m == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)

    class Gone:
        def find_spec(self, name, path=None, target=None):
            if name in ("fleetstar.llm", "corpus_pipeline"):
                raise ModuleNotFoundError(f"No module named {name!r}", name=name)

    import fleetstar
    monkeypatch.setattr(sys, "meta_path", [Gone(), *sys.meta_path])
    monkeypatch.delattr(fleetstar, "llm", raising=False)
    assert set(entry.queries()) == set(QUERIES)
