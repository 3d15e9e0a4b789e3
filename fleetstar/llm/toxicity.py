"""Toxicity scores from a learned lexicon, matched through Levenshtein automata.

The lexicon is a trie of whole terms and of stems (terms of any ending),
learned from labelled rows: words and word beginnings much more frequent in
toxic than in other documents, and in varied company. A word is matched by running it through the
Levenshtein automata of all terms at once, that is along the trie with a
budget of edits (none below 5 letters, one up to 8, two beyond); the states
so reached are made deterministic as they are met and kept, so most words
leave the automaton after a few letters.

Each hit weighs as much as its term tells, less if it is misspelled, and less
where its window of words marks a quotation (quotation marks around it, or a
word of reporting nearby); a document's weights, their density and maximum go
through a logistic regression.

The lexicon and the regression are fitted on a sample of about
``SAMPLE_PER_LABEL`` labelled rows of each label, chosen by a hash of the id;
every whole text is scored. Labels, languages and sources are not inputs.

Edge cases: a null or empty text has no hits; without labelled rows of both
kinds nothing is learned and every score is 0; null labels and ids are not
learned; repeated rows score alike; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokens import batch_blocks, text_blocks

SAMPLE_PER_LABEL = 5000
MIN_DOCS = 8               # toxic documents that a term must occur in
MIN_SHARE = 0.003          # and their share of the toxic sample
MIN_LIFT = 4.0             # times as frequent in toxic documents
MIN_CONTEXTS = 0.3         # different words before a term, by its toxic documents
STEM = (4, 12)             # letters of a stem
WINDOW = 6                 # words on either side that tell a quotation
QUOTED = 0.3               # weight of a hit inside a quotation
MISSPELLED = 0.5           # weight of a hit with edits
MAX_WORDS = 500_000        # remembered words per worker
MAX_STATES = 200_000       # remembered states of the automata
QUOTES = re.compile("[\"“”„«»‘]")
# Words of reporting in the four languages, as text.
REPORTING = frozenset("said says say called calls quote quoted quotes wrote writes word term "
                      "sagte sagt nannte zitat zitiert schrieb wort begriff "
                      "dit disait appelé citation cité écrit mot terme "
                      "dijo dice llamó cita citado escribió palabra término".split())


def tidy(word: str) -> str:
    """A lower-cased word without outer punctuation."""
    return word.strip("\"'.,;:!?()[]{}<>«»“”„‘’*_-#&%$|/\\~`")


class Automata:
    """The Levenshtein automata of all lexicon terms along their trie, made deterministic on demand."""

    def __init__(self, terms: list[tuple[str, bool]]):
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[list[tuple[int, int, bool]]] = [[]]   # by trie node: (term, edits allowed, is a stem)
        self.budget = [0]                                      # most edits of any term below
        for number, (text, stem) in enumerate(terms):
            allowed = 0 if len(text) < 5 or (stem and len(text) < 7) else 1 if len(text) <= 8 else 2
            node = 0
            self.budget[0] = max(self.budget[0], allowed)
            for c in text:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.ends.append([])
                    self.budget.append(0)
                node = self.children[node][c]
                self.budget[node] = max(self.budget[node], allowed)
            self.ends[node].append((number, allowed, stem))
        self.numbers: dict[frozenset, int] = {}
        self.states: list[frozenset] = []
        self.accepts: list[tuple] = []
        self.steps: list[dict[str, int]] = []
        self.start = self._state({(0, 0)})

    def _state(self, pairs: set[tuple[int, int]]) -> int:
        """Number of a state: trie nodes with the edits made to reach them, skipped letters included."""
        best: dict[int, int] = {}
        work = list(pairs)
        while work:
            node, edits = work.pop()
            if edits <= self.budget[node] and edits < best.get(node, 99):
                best[node] = edits
                work += [(child, edits + 1) for child in self.children[node].values()]
        if not best:
            return -1
        state = frozenset(best.items())
        if state not in self.numbers:
            self.numbers[state] = len(self.states)
            self.states.append(state)
            self.steps.append({})
            whole = [(edits, t) for node, edits in best.items() for t, allowed, _ in self.ends[node] if edits <= allowed]
            stems = [(edits, t) for node, edits in best.items() for t, allowed, stem in self.ends[node] if stem and edits <= allowed]
            self.accepts.append((min(whole, default=None), min(stems, default=None)))
        return self.numbers[state]

    def _step(self, state: int, c: str) -> int:
        after: set[tuple[int, int]] = set()
        for node, edits in self.states[state]:
            after.add((node, edits + 1))                                  # a letter too many
            for letter, child in self.children[node].items():
                after.add((child, edits + (letter != c)))                 # the letter, or another one
        self.steps[state][c] = self._state(after)
        return self.steps[state][c]

    def leads_nowhere(self, start: str) -> bool:
        """Whether no word that begins with ``start`` matches."""
        state = self.start
        for c in start:
            step = self.steps[state].get(c)
            state = self._step(state, c) if step is None else step
            if state < 0:
                return True
            if self.accepts[state][1]:
                return False
        return False

    def match(self, word: str) -> tuple[int, int] | None:
        """(term, edits) of the nearest term, if one is near enough."""
        state, found = self.start, None
        for c in word:
            step = self.steps[state].get(c)
            state = self._step(state, c) if step is None else step
            if state < 0:
                return found and (found[1], found[0])
            stem = self.accepts[state][1]
            if stem and (found is None or stem < found):
                found = stem
        whole = self.accepts[state][0]
        if whole and (found is None or whole < found):
            found = whole
        return found and (found[1], found[0])


@dataclass
class Lexicon:
    terms: list[tuple[str, bool]]         # text, is a stem
    weights: list[float]                  # log odds of a document with the term
    coefficients: list[float] = field(default_factory=list)

    def __post_init__(self):
        self._forget()

    def _forget(self):
        self.automata = Automata(self.terms)
        self.known: dict[str, float] = {}
        self.dead: set[str] = set()      # beginnings of four letters that lead nowhere

    def __getstate__(self):
        return {"terms": self.terms, "weights": self.weights, "coefficients": self.coefficients}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._forget()

    def _weight(self, word: str) -> float:
        """Weight of a lower-cased word, 0 if it matches nothing."""
        weight = self.known.get(word)
        if weight is None:
            m = self.automata.match(tidy(word))
            weight = self.weights[m[0]] * (MISSPELLED if m[1] else 1.0) if m else 0.0
            start = word[:4]
            if not m and len(start) == 4 and start.isalpha() and self.automata.leads_nowhere(start):
                self.dead.add(start)
            else:
                self.known[word] = weight
        return weight

    def hits(self, words: list[str]) -> list[tuple[int, float]]:
        """(position, weight) of the words that match, quotation left aside."""
        if len(self.known) > MAX_WORDS or len(self.dead) > MAX_WORDS or len(self.automata.states) > MAX_STATES:
            self._forget()
        dead = self.dead
        found = {w: weight for w in set(words) if w[:4] not in dead and (weight := self._weight(w))}
        return [(i, found[w]) for i, w in enumerate(words) if w in found] if found else []

    def features(self, text: str | None) -> list[float]:
        """Constant, summed and largest weight, hits a word, quoted share, and whether any hit is there."""
        words = (text or "").lower().split()
        total = top = quoted = 0.0
        found = self.hits(words)
        for i, weight in found:
            before, after = words[max(0, i - WINDOW):i], words[i + 1:i + 1 + WINDOW]
            marks = (QUOTES.search(" ".join(before) + " " + words[i][:1]) is not None
                     and QUOTES.search(words[i][-1:] + " " + " ".join(after)) is not None)
            if marks or any(tidy(w) in REPORTING for w in words[max(0, i - 3):i]):
                quoted += 1
                weight *= QUOTED
            total += weight
            top = max(top, weight)
        n = max(len(found), 1)
        return [1.0, math.log1p(total), top, math.log1p(100 * len(found) / max(len(words), 1)), quoted / n, float(total > 0)]

    def score(self, text: str | None) -> float:
        if not self.coefficients:
            return 0.0
        x = sum(a * b for a, b in zip(self.features(text), self.coefficients))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))


def telling(counts: dict[tuple[str, bool], tuple[int, int]], n_toxic: int, n_clean: int) -> dict[tuple[str, bool], tuple[int, float]]:
    """(toxic documents, log odds) of the terms and stems that occur mostly in toxic documents."""
    least = max(MIN_DOCS, MIN_SHARE * n_toxic)
    odds = lambda a, b: math.log((a + 0.5) / (n_toxic + 1) * (n_clean + 1) / (b + 0.5))
    good = {k: (a, odds(a, b)) for k, (a, b) in counts.items() if a >= least and odds(a, b) >= math.log(MIN_LIFT)}
    return dict(sorted(good.items()))


def choose_terms(good: dict[tuple[str, bool], tuple[int, float]]) -> Lexicon:
    """The lexicon: each beginning only as long as it stays as frequent."""
    chosen = []
    for (text, stem), (a, w) in good.items():
        longer = [k for k in ((text[:n], True) for n in range(STEM[0], len(text))) if k in good]
        if any(good[k][0] > 1.3 * a and good[k][1] >= 0.8 * w for k in longer):
            continue                                     # a shorter stem says as much of more documents
        if stem and (whole := good.get((text, False))) and whole[0] >= 0.9 * a:
            continue                                     # the term itself
        chosen.append((text, stem))
    # Of stems that continue each other with the same documents the longest stays.
    beyond: dict[str, int] = {}                          # most documents of a term that goes on from a stem
    for text, stem in chosen:
        for n in range(STEM[0], min(len(text) - stem, STEM[1]) + 1):
            beyond[text[:n]] = max(beyond.get(text[:n], 0), good[text, stem][0])
    kept = sorted(k for k in chosen if not (k[1] and beyond.get(k[0], 0) >= good[k][0] / 1.1))
    return Lexicon(kept, [good[k][1] for k in kept])


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> list[float]:
    """Coefficients by Newton's method."""
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + ridge * w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w.tolist()


def train(docs: DataFrame, labels: DataFrame) -> Lexicon:
    """Learn the lexicon and the regression from rows of ``labels`` (doc_id, toxic) joined to their texts."""
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", "toxic")
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        return Lexicon([], [])
    rate = F.when(F.col("toxic") == 1, F.lit(SAMPLE_PER_LABEL / sizes[1])).otherwise(F.lit(SAMPLE_PER_LABEL / sizes[0]))
    chosen = known.where(F.pmod(F.xxhash64("doc_id", F.lit("toxic")), F.lit(1_000_003)) / 1_000_003 < rate)
    # The sample is bounded: about SAMPLE_PER_LABEL rows of each label.
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "toxic")

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic, clean = Counter(), Counter()
            n = [0, 0]
            for text, label in zip(*(batch.column(i).to_pylist() for i in range(2))):
                words = {tidy(w) for w in (text or "").lower().split()}
                found = {(w, False) for w in words if len(w) >= 3}
                found |= {(w[:k], True) for w in words for k in range(STEM[0], min(len(w) - 1, STEM[1]) + 1)}
                (toxic if label else clean).update(found)
                n[label] += 1
            rows = [(w, stem, toxic[w, stem], clean[w, stem]) for w, stem in toxic.keys() | clean.keys()] + [("", False, n[1], n[0])]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], schema=COUNTS)

    counted = (sample.mapInArrow(terms, "word string, stem boolean, toxic long, clean long").groupBy("word", "stem")
               .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")))
    least = max(MIN_DOCS, MIN_SHARE * min(SAMPLE_PER_LABEL, sizes[1]) * 0.8)
    rows = counted.where((F.col("toxic") >= least) & (F.col("toxic") > F.col("clean") * 0.5) | (F.col("word") == "")).collect()
    counts = {(r["word"], r["stem"]): (r["toxic"], r["clean"]) for r in rows}
    n_toxic, n_clean = counts.pop(("", False), (0, 0))
    if not n_toxic or not n_clean:
        return Lexicon([], [])
    good = telling(counts, n_toxic, n_clean)

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = set()
            for text in batch.column(0).to_pylist():
                before = ""
                for word in map(tidy, (text or "").lower().split()):
                    found.update((*k, before) for k in [(word, False), *((word[:n], True) for n in range(STEM[0], min(len(word) - 1, STEM[1]) + 1))]
                                 if k in good)
                    before = word
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found)], names=["word", "stem", "before"])

    # A word that follows the same words everywhere is a passage copied, not a term.
    varied = (sample.where("toxic = 1").select("text").mapInArrow(contexts, "word string, stem boolean, before string").distinct()
              .groupBy("word", "stem").count().collect())  # one row a candidate; MIN_SHARE bounds them
    good = {k: good[k] for r in varied if r["count"] >= MIN_CONTEXTS * good[k := (r["word"], r["stem"])][0]}
    lexicon = choose_terms(good)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, y = (batch.column(i).to_pylist() for i in range(2))
            yield pa.RecordBatch.from_arrays([pa.array([lexicon.features(t) for t in texts], pa.list_(pa.float64())),
                                              pa.array(y, pa.int32())], names=["x", "y"])

    rows = sorted(tuple(r) for r in sample.mapInArrow(measure, "x array<double>, y int").collect())
    x, y = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    lexicon.coefficients = logistic(x, y)
    # Labels were sampled at different rates: move the constant back.
    kept = [min(1.0, SAMPLE_PER_LABEL / sizes[k]) for k in (0, 1)]
    lexicon.coefficients[0] += math.log(kept[0] / kept[1])
    return lexicon


COUNTS = pa.schema([("word", pa.string()), ("stem", pa.bool_()), ("toxic", pa.int64()), ("clean", pa.int64())])


def score(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """Every row's doc_id, score and predicted label."""
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("predicted", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = (batch.column(i).to_pylist() for i in range(2))
            for a, b in text_blocks(texts):
                scores = [lexicon.score(t) for t in texts[a:b]]
                yield pa.RecordBatch.from_arrays([pa.array(ids[a:b], pa.int64()), pa.array(scores),
                                                  pa.array([int(s >= 0.5) for s in scores], pa.int32())], schema=schema)

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double, predicted int")


def drop_toxic(docs: DataFrame, lexicon: Lexicon, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below the threshold, with all their columns."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in batch_blocks(batch, at):
                yield block.filter(pa.array([lexicon.score(t) < threshold for t in block.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
