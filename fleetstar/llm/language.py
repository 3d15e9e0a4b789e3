"""Language identification by sparse multinomial logistic regression.

Features are TF-IDF weights of character 2- and 3-grams (lower-cased, runs of
anything but letters read as one space), hashed into ``BUCKETS`` and scaled to
length 1. Weights are learned by follow-the-regularised-leader with L1 and L2
penalties, then the logits are divided by a temperature fitted on a part of
the sample that training left out.

Document frequencies are counted over all training rows; the classifier is
fitted on a sample of each language's rows, chosen by a hash of the id: about
``SAMPLE_PER_LANGUAGE``, or fewer (``SAMPLE_LEAST`` at least) where there are so
many languages that the sample would pass ``SAMPLE_ROWS``. Every language is
learned. Every whole text is predicted, one batch at a time.

Edge cases: a null text, or one without a letter, is ``und`` with score 0;
so is every text if nothing could be learned; null languages are never
learned; a null id counts as the empty text when folds are dealt; repeated
rows get the same prediction; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise
from .tokens import text_blocks

BUCKETS = 1 << 15
SAMPLE_PER_LANGUAGE = 1000
SAMPLE_ROWS = 64_000
SAMPLE_LEAST = 20
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.5   # step, smoothing and penalties of the learner
NOT_LETTERS = re.compile(r"[\W\d_]+")


def ngram_counts(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(buckets, counts) of each text; both empty if it has no letter."""
    clean = [f" {NOT_LETTERS.sub(' ', t.lower())} " if t else "" for t in texts]
    codes = np.frombuffer("".join(clean).encode("utf-32-le", "surrogatepass"), np.uint32)
    at = np.concatenate([[0], np.cumsum([len(t) for t in clean])])
    if len(codes) >= 3:
        pair = codes[:-1] * np.uint32(0x9E3779B1) + codes[1:] * np.uint32(0x85EBCA77)
        triple = (pair[:-1] ^ (pair[:-1] >> np.uint32(13))) * np.uint32(0xC2B2AE3D) + codes[2:] * np.uint32(0x27D4EB2F)
        grams = [((g ^ (g >> np.uint32(15))) * np.uint32(0x2C1B3C6D)) >> np.uint32(17) for g in (pair, triple)]
    for t, a, b in zip(clean, at[:-1], at[1:]):
        if not t.strip():
            yield np.zeros(0, np.int64), np.zeros(0, np.int64)
            continue
        counts = np.bincount(grams[0][a:b - 1], minlength=BUCKETS) + np.bincount(grams[1][a:b - 2], minlength=BUCKETS)
        buckets = np.flatnonzero(counts)
        yield buckets, counts[buckets]


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray          # by bucket
    weights: np.ndarray      # bucket x language
    bias: np.ndarray
    temperature: float

    def vector(self, buckets: np.ndarray, counts: np.ndarray) -> np.ndarray:
        x = (1 + np.log(counts)) * self.idf[buckets]
        return x / max(np.sqrt((x * x).sum()), 1e-12)

    def logits(self, buckets: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return self.vector(buckets, counts) @ self.weights[buckets] + self.bias


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def fit(rows: list[tuple[np.ndarray, np.ndarray, str]], idf: np.ndarray) -> Model:
    """Learn from (buckets, counts, language) rows; every fifth one only sets the temperature,
    unless its language has no other."""
    languages = sorted({r[2] for r in rows})
    k = len(languages)
    number = {name: i for i, name in enumerate(languages)}
    model = Model(languages, idf, np.zeros((BUCKETS, k)), np.zeros(k), 1.0)
    z, n = np.zeros((BUCKETS + 1, k)), np.zeros((BUCKETS + 1, k))

    def leader(i: np.ndarray) -> np.ndarray:
        return np.where(np.abs(z[i]) <= L1, 0.0, -(z[i] - np.sign(z[i]) * L1) / ((BETA + np.sqrt(n[i])) / ALPHA + L2))

    held, train = rows[::5], [r for i, r in enumerate(rows) if i % 5]
    taught = {r[2] for r in train}
    train += [r for r in held if r[2] not in taught]
    train = [(np.append(b, BUCKETS), np.append(model.vector(b, c), 1.0), number[lang]) for b, c, lang in train]
    rng = np.random.default_rng(5)
    for _ in range(EPOCHS):
        for j in rng.permutation(len(train)):
            i, x, y = train[j]
            w = leader(i)
            p = softmax(x @ w)
            p[y] -= 1
            g = x[:, None] * p
            step = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / ALPHA
            z[i] += g - step * w
            n[i] += g * g
    final = leader(np.arange(BUCKETS + 1))
    model.weights, model.bias = final[:-1], final[-1]
    logits = np.array([model.logits(b, c) for b, c, _ in held])
    truth = np.array([number[lang] for *_, lang in held])
    loss = lambda t: -np.log(softmax(logits / t)[np.arange(len(truth)), truth] + 1e-12).mean()
    model.temperature = float(min(np.geomspace(0.05, 5, 60), key=loss))
    return model


def remainder(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as the empty text."""
    return (F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts).cast("int")


def train(labelled: DataFrame) -> Model | None:
    """Fit on rows (doc_id, text, lang): statistics over all of them, weights on the sample."""
    known = labelled.where(F.col("lang").isNotNull()).select("doc_id", "text", "lang")
    sizes = materialise(known.groupBy("lang").count(), "languages")
    languages = sizes.count()
    if not languages:
        return None
    wanted = max(SAMPLE_LEAST, min(SAMPLE_PER_LANGUAGE, SAMPLE_ROWS // languages))
    schema = pa.schema([("bucket", pa.int32()), ("n", pa.int64()), ("docs", pa.int64())])

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, docs = np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for a, b in text_blocks(texts):
                for buckets, _ in ngram_counts(texts[a:b]):
                    total[buckets] += 1
                    docs += 1
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(found, -1), pa.int32()), pa.array(np.append(total[found], docs)),
                                          pa.array(np.append(np.zeros(len(found), np.int64), docs))], schema=schema)

    counted = (known.select("text").mapInArrow(frequencies, "bucket int, n long, docs long")
               .groupBy("bucket").agg(F.sum("n").alias("n")).collect())  # at most BUCKETS + 1 rows
    found = {r["bucket"]: r["n"] for r in counted}
    seen = np.zeros(BUCKETS)
    docs = found.pop(-1, 0)
    for bucket, n in found.items():
        seen[bucket] = n
    idf = np.log((1 + docs) / (1 + seen)) + 1
    chance = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1_000_003)) / 1_000_003
    sample = known.join(sizes, "lang").where(chance < F.lit(float(wanted)) / F.col("count")).select("doc_id", "text", "lang")

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, langs = (batch.column(i).to_pylist() for i in range(3))
            for a, b in text_blocks(texts):
                rows = [(i, lang, x.astype("<u2").tobytes(), n.astype("<u4").tobytes())
                        for i, lang, (x, n) in zip(ids[a:b], langs[a:b], ngram_counts(texts[a:b])) if len(x)]
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.string(), pa.binary(), pa.binary()))],
                        names=["doc_id", "lang", "buckets", "counts"])

    rows = sample.mapInArrow(grams, "doc_id long, lang string, buckets binary, counts binary").collect()
    rows.sort(key=lambda r: (r["doc_id"] is None, r["doc_id"], r["lang"], r["buckets"]))  # the same model on a re-run
    examples = [(np.frombuffer(r["buckets"], "<u2").astype(np.int64), np.frombuffer(r["counts"], "<u4").astype(np.int64), r["lang"])
                for r in rows]
    return fit(examples, idf) if examples else None


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, lang_pred and its calibrated probability for every row."""
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = (batch.column(i).to_pylist() for i in range(2))
            for a, b in text_blocks(texts):
                names, scores = [], []
                for buckets, counts in ngram_counts(texts[a:b]):
                    if model is None or not len(buckets):
                        names.append("und")
                        scores.append(0.0)
                        continue
                    p = softmax(model.logits(buckets, counts) / model.temperature)
                    best = int(p.argmax())
                    names.append(model.languages[best])
                    scores.append(float(p[best]))
                yield pa.RecordBatch.from_arrays([pa.array(ids[a:b], pa.int64()), pa.array(names), pa.array(scores)], schema=schema)

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, lang_pred string, score double")
