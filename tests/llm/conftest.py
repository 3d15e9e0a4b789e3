import zlib

import pytest
from pyspark.sql import Row

DOC = "doc_id long, text string, lang string, source string, n_chars long"
GIVEN = (  # ordinary words for long fixtures
    "the river runs past old stone houses where people meet and talk about the weather of the day while children play "
    "near a small bridge that was built by hand in winter and now stands as a sign of time").split()


def prose(seed: int, n: int) -> str:
    """Repeatable text of ``n`` words."""
    state, out = seed * 7919 + 1, []
    for _ in range(n):
        state = (state * 1103515245 + 12345) % 2**31
        word = GIVEN[state % len(GIVEN)] if state % 3 else f"w{state % 5000}"
        out.append(word)
    return " ".join(out)


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls in any column, empty, blank and very long texts, ties and repeated rows."""
    base = prose(1, 120)
    rows = [(1, base, "en", "a"), (2, base, "en", "a"), (2, base, "en", "a"),
            (3, base + " end", "en", "b"), (4, None, "en", "b"), (5, "", None, None), (6, " \n\t ", "en", "a"),
            (7, "word", "de", "c"), (8, "two words", None, "a"), (None, prose(2, 80), "en", None),
            (None, base.upper(), "en", "a"), (9, prose(3, 40_000), "en", "a"), (10, prose(4, 200), "en", None),
            (11, "ünï çødé – 日本語 text\r\nnext  line\x1c.\x85", "fr", "d")]
    return [(*r, len(r[1]) if r[1] is not None else None) for r in rows]


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    """The edge rows with extra columns whose names clash with those that operators add."""
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(edge_rows, DOC)
    for name in ("size", "target", "words", "key", "n", "root", "piece", "start", "set_id", "score", "kept", "_key", "_id"):
        docs = docs.withColumn(name, F.lit("x"))
    return docs


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC)


def fold(doc_id, parts):
    return zlib.crc32(str(doc_id).encode()) % parts


def as_set(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


__all__ = ["Row", "as_set", "fold", "prose"]
