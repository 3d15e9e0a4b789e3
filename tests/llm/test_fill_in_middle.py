"""Fill-in-middle: cuts against plain token lists, exact round trips."""

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fleetstar.llm import fill_in_middle as fim

from .conftest import DOC, prose


def plain(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text, re.S)
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in range(0, 32, 8))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, text, text
    if h4 % 100 < 20:
        return doc_id, n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}", text
    return doc_id, n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}", text


def rows_of(df):
    out = df.withColumn("restored", fim.restored(F.col("output"), F.col("form")))
    return sorted((tuple(r) for r in out.collect()), key=repr)


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=300))
def test_unit_starts(text):
    starts = fim.unit_starts(text)
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text, re.S)
    assert [text[a:b] for a, b in zip(starts, [*starts[1:], len(text)])] == units


@pytest.mark.parametrize("n", [1, 2, 3, 10, 1000, 40_000])
def test_skip_list_reaches_every_rank(n):
    widths = np.random.default_rng(n).integers(1, 9, n)
    starts = np.cumsum(widths) - widths
    units = fim.SkipList(starts, int(widths.sum()))
    ranks = range(n + 1) if n <= 1000 else [0, 1, n // 3, n - 1, n]
    assert [units.chars_before(r) for r in ranks] == [int(widths[:r].sum()) for r in ranks]
    assert all(len(upper[0]) < len(lower[0]) for lower, upper in zip(units.lanes, units.lanes[1:]))


def test_equals_plain_python(spark):
    texts = [prose(i, 5 + 7 * i % 90) + "\n日本語 😀 é 1234 don't\r\n" for i in range(150)]
    texts += ["has <P> inside", "<M>", "<S", "x", "\n", "aB", "😀" * 30]
    rows = [(i, t, "en", "a", len(t)) for i, t in enumerate(texts)]
    result = rows_of(fim.transform(spark.createDataFrame(rows, DOC).repartition(3)))
    assert result == sorted((plain(r[0], r[1]) for r in rows), key=repr)
    assert {r[2] for r in result} == {"plain", "psm", "spm"}


def test_edge_rows(spark, edge_docs, edge_rows, no_docs):
    assert rows_of(fim.transform(edge_docs)) == sorted((plain(r[0], r[1]) for r in edge_rows), key=repr)
    assert rows_of(fim.transform(no_docs)) == []
