"""Spelling variants: words one edit apart, grouped under the most frequent spelling.

Two words are near if their common prefix plus common suffix reaches the
longer length minus one: then they differ by exactly one inserted, deleted or
replaced code point. Words are compared densely, as rows of padded code-point
matrices (one aligned left, one right), block by block.

A block holds the words that may be near by their place in a tiling: for a
longer length ``n`` the ``n - 1`` code points that must agree are tiled in
``TILES`` stretches; if the common prefix ends in stretch i, all before it and
all behind it agree. So each word enters one block per stretch and for its own
and the next length, and a pair counts only in its first common block.
Blocks of more than ``BLOCK`` words are dealt into parts, every two parts
meeting in a task of their own: no pair is left out, no block is one task.
A block returns a count and the best neighbour of each word, never pairs.

Words are maximal runs of Latin letters, A-Z lower-cased; one of ``VARY``
runs of a document, by crc32, loses a code point first. Edge cases: a null or
empty text has no words; a null id is written as an empty string in the hashed
text; repeated rows count again; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise

MIN_CHARS = 7
MIN_COUNT = 2
RATIO = 10            # a form is this many times as frequent
VARY = 31
TILES = 4
BLOCK = 1_000
PAIRS = 100_000       # pairs compared at a time


def vary(prefix_crc: int, run: str) -> str:
    """The run, or without one code point where 31 divides the hash of ``<doc_id>:<run>``."""
    h = zlib.crc32(run.encode(), prefix_crc)
    if h % VARY:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) of the words long and frequent enough; counts meet per batch, then by word."""
    long_runs = re.compile(r"[A-Za-zÀ-ÿ]{%d,}" % MIN_CHARS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = (batch.column(i).to_pylist() for i in range(2))
            counts: Counter = Counter()
            for doc, text in zip(ids, texts):
                if text:
                    prefix = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                    lower = text.encode().lower().decode()        # bytes: A-Z only
                    for word, n in Counter(long_runs.findall(lower)).items():
                        counts[vary(prefix, word)] += n
            kept = [w for w in counts if len(w) >= MIN_CHARS]
            yield pa.RecordBatch.from_arrays([pa.array(kept, pa.string()), pa.array([counts[w] for w in kept], pa.int64())],
                                             names=["word", "n"])

    counted = docs.select("doc_id", "text").mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT)


def tile(longer: int) -> list[int]:
    """Where the stretches of the code points that must agree begin and end."""
    return [(longer - 1) * i // TILES for i in range(TILES + 1)]


def blocks(words: DataFrame) -> DataFrame:
    """(key, longer, stretch, word, n): the blocks that each word enters."""
    entries = F.explode(F.array(*[F.struct((F.length("word") + more).cast("int").alias("longer"), F.lit(i).alias("stretch"))
                                  for more in range(2) for i in range(TILES)]))
    found = words.select("word", "n", entries.alias("e")).select("word", "n", "e.*")
    must = F.col("longer") - 1
    begin = F.floor(must * F.col("stretch") / TILES).cast("int")
    behind = (must - F.floor(must * (F.col("stretch") + 1) / TILES)).cast("int")
    return found.select(F.xxhash64("longer", "stretch", F.substring(F.col("word"), F.lit(1), begin),
                                   F.substring(F.col("word"), F.length("word") - behind + 1, behind)).alias("key"),
                        "longer", "stretch", "word", "n")


class Members:
    """Words of some blocks as padded code-point matrices."""

    def __init__(self, words: list[str]):
        self.words = np.array([w.encode("latin-1") for w in words])
        self.size = np.char.str_len(self.words).astype(np.int64)
        width = self.words.dtype.itemsize
        self.left = self.words.view(np.uint8).reshape(-1, width)
        self.right = np.zeros_like(self.left)
        for n in np.unique(self.size):
            rows = np.flatnonzero(self.size == n)
            self.right[rows[:, None], np.arange(width - n, width)] = self.left[rows, :n]
        self.right = np.ascontiguousarray(self.right[:, ::-1])

    def near(self, a: np.ndarray, b: np.ndarray, longer: np.ndarray, stretch: np.ndarray) -> np.ndarray:
        """Which pairs are one edit apart and meet in their first common block."""
        most = np.maximum(self.size[a], self.size[b])
        prefix = (self.left[a] != self.left[b]).argmax(1)
        suffix = (self.right[a] != self.right[b]).argmax(1)
        near = (prefix + suffix >= most - 1) & (most == longer) & (self.words[a] != self.words[b])
        first = np.full(len(a), TILES)
        for i in reversed(range(TILES)):
            begin, end = (most - 1) * i // TILES, (most - 1) * (i + 1) // TILES
            first[(prefix >= begin) & (suffix >= most - 1 - end)] = i
        return near & (first == stretch)


def _pairs(bounds: np.ndarray, side: np.ndarray, cross: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row pairs of each block, of different sides where two parts meet, some blocks at a time."""
    ones: list[np.ndarray] = []
    twos: list[np.ndarray] = []
    total = 0
    for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if hi - lo < 2 or cross[lo] and side[lo] == side[hi - 1]:
            continue
        if cross[lo]:
            cut = lo + int(np.searchsorted(side[lo:hi], side[hi - 1]))
            a, b = np.repeat(np.arange(lo, cut), hi - cut), np.tile(np.arange(cut, hi), cut - lo)
        else:
            a, b = (x + lo for x in np.triu_indices(hi - lo, 1))
        for at in range(0, len(a), PAIRS):
            ones.append(a[at:at + PAIRS])
            twos.append(b[at:at + PAIRS])
            total += len(ones[-1])
            if total >= PAIRS:
                yield np.concatenate(ones), np.concatenate(twos)
                ones, twos, total = [], [], 0
    if ones:
        yield np.concatenate(ones), np.concatenate(twos)


def neighbours(words: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best) of the words with a near word; best: largest n, then smallest word."""
    entered = blocks(words)
    sizes = entered.groupBy(F.col("key").alias("_key")).agg(F.count(F.lit(1)).alias("size"))
    large = materialise(sizes.where(F.col("size") > BLOCK).withColumn("parts", F.ceil(F.col("size") / BLOCK).cast("int")).drop("size"), "large-blocks")
    small = materialise(sizes.where((F.col("size") > 1) & (F.col("size") <= BLOCK)).select("_key"), "small-blocks")
    rows = entered.join(small, entered["key"] == small["_key"], "left_semi").select(
        "*", F.lit(0).alias("part"), F.lit(0).alias("side"), F.lit(False).alias("cross"))
    if not large.isEmpty():
        dealt = entered.join(large, entered["key"] == large["_key"]).withColumn("side", F.pmod(F.xxhash64("word"), F.col("parts")).cast("int"))
        other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
        met = dealt.withColumn("other", other).withColumn(
            "part", F.least("side", "other") * F.col("parts") + F.greatest("side", "other")).withColumn("cross", F.col("side") != F.col("other"))
        rows = rows.unionByName(met.select("key", "longer", "stretch", "word", "n", "part", "side", "cross"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def answer(table: pa.Table, bounds: np.ndarray) -> Iterator[pa.RecordBatch]:
            members = Members(table["word"].to_pylist())
            n, longer, stretch, side, cross = (table[c].to_numpy() for c in ("n", "longer", "stretch", "side", "cross"))
            found = [np.zeros((0, 2), np.int64)]
            for a, b in _pairs(bounds, side, cross):
                near = members.near(a, b, longer[a], stretch[a])
                found += [np.stack([a[near], b[near]], 1), np.stack([b[near], a[near]], 1)]
            pairs = np.concatenate(found)
            if not len(pairs):
                return
            order = np.lexsort((members.words[pairs[:, 1]], -n[pairs[:, 1]], pairs[:, 0]))
            pairs = pairs[order]
            starts = np.flatnonzero(np.append(True, np.diff(pairs[:, 0]) != 0))
            who, best = pairs[starts, 0], pairs[starts, 1]
            word = table["word"].combine_chunks()
            yield pa.RecordBatch.from_arrays(
                [word.take(pa.array(who)), pa.array(np.diff(np.append(starts, len(pairs)))), pa.array(n[best]), word.take(pa.array(best))],
                names=["word", "n_near", "best_n", "best"])

        held: list[pa.RecordBatch] = []                   # rows of the block that the last batch ended in
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            table = pa.Table.from_batches(held)
            key, part = table["key"].to_numpy(), table["part"].to_numpy()
            cuts = np.flatnonzero((key[1:] != key[:-1]) | (part[1:] != part[:-1])) + 1
            if not len(cuts):
                continue
            last = int(cuts[-1])
            yield from answer(table.slice(0, last), np.append(0, cuts))
            held = table.slice(last).to_batches()
        if held:
            table = pa.Table.from_batches(held)
            yield from answer(table, np.array([0, table.num_rows]))

    ordered = rows.repartition("key", "part").sortWithinPartitions("key", "part", "side")
    each = ordered.select("key", "part", "side", "cross", "longer", "stretch", "word", "n").mapInArrow(
        run, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("minus"), F.col("best").alias("best")))
    return (each.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b"))
            .select("word", "n_near", (-F.col("b.minus")).alias("best_n"), F.col("b.best").alias("best")))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of every word with a form. A form is ten times as frequent as its word, so chains
    are short and their jumps double: a few rounds end."""
    steps = materialise(forms.select("word", F.col("form").alias("root")), "steps")
    while True:
        on = steps.select(F.col("word").alias("_word"), F.col("root").alias("_next"))
        joined = materialise(steps.join(on, steps["root"] == on["_word"], "left").select("word", "root", "_next"), "steps")
        if joined.where("_next is not null").isEmpty():
            return joined.select("word", "root")
        steps = joined.select("word", F.coalesce("_next", "root").alias("root"))


def variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word."""
    words = materialise(word_counts(docs), "vocabulary")
    near = neighbours(words).withColumnRenamed("word", "_word")
    chosen = F.col("best_n") >= RATIO * F.col("n")
    described = materialise(words.join(near, words["word"] == near["_word"], "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(chosen, F.col("best")).alias("form"), F.when(chosen, F.col("best_n")).alias("form_n")), "variants")
    rooted = roots(described.where("form is not null")).withColumnRenamed("word", "_word")
    return described.join(rooted, described["word"] == rooted["_word"], "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
