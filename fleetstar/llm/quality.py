"""Quality rules and distribution divergence. DataFrame functions only.

Each document's character classes and common words are compared, as
histograms, to those of its language over the whole corpus, by
Jensen-Shannon distance (base 2, 0 to 1). A language's common words are
words of at most ``COMMON_CHARS`` characters (lower-cased) that make up at least
``COMMON_SHARE`` of the words of its documents, hence at most 1 / share of
them; every other word counts as one further bin. A language has a reference
of its own if it holds at least ``LANGUAGE_SHARE`` of all words, hence at
most 1 / share of them, which bounds what the driver holds; documents of
other languages, and of none, are held to the nearest reference, the pooled
one of all documents included.

Nothing but counts per (language, common-word candidate) and per language is
shuffled; words and three-word windows are handled inside each row, by
sorting, so a document of any length costs n log n.

Three-word windows are compared by chained 64-bit hashes. Edge cases: a null
or empty text has no words and fails the base rules; a null language uses
the nearest reference; documents below the minimum length are left to the
base rules; repeated rows are judged alike; an empty table gives an empty
result; other columns are passed over.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise

MIN_WORDS = 50
COMMON_CHARS = 4
COMMON_SHARE = 0.003
LANGUAGE_SHARE = 0.02
MAX_CHARACTER_DISTANCE = 0.29
MAX_WORD_DISTANCE = 0.45
CLASSES = ("letters", "capitals", "digits", "spaces", "stops", "symbols", "other")


def words_of(text: Column) -> Column:
    """Runs of anything but ASCII white space; null and blank texts have none."""
    bare = F.regexp_replace(F.coalesce(text, F.lit("")), r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+\z", "")
    return F.when(bare != "", F.split(bare, r"[\x20\x09-\x0D]+")).otherwise(F.array().cast("array<string>"))


def _counted(text: Column, outside: str) -> Column:
    """Characters left when runs of ``outside`` are taken out."""
    return F.length(F.regexp_replace(text, outside, ""))


def _lengths_between(sorted_positions: Column) -> Column:
    """Words covered by three-word windows that start at the given ascending positions."""
    return F.aggregate(
        F.transform(sorted_positions, lambda p, i: F.least(
            F.lit(3), F.coalesce(F.try_element_at(sorted_positions, i + 2) - p, F.lit(3)))),
        F.lit(0), lambda a, x: a + x)


def features(docs: DataFrame, *keep: Column) -> DataFrame:
    """Counts of each document: the base rules' four, character classes and short words; ``keep`` rides along."""
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select("doc_id", "lang", F.xxhash64("text").alias("text_key"), text.alias("text"), *keep).withColumn("words", words_of(F.col("text")))
    hashed = base.withColumns({
        "n_words": F.size("words").cast("long"),
        "word_chars": F.length(F.array_join("words", "")).cast("long"),
        "hashes": F.transform("words", lambda w: F.xxhash64(w)),
        "short": F.transform(F.filter("words", lambda w: F.length(w) <= COMMON_CHARS), F.lower),
    })
    windows = hashed.withColumn("windows", F.when(F.col("n_words") >= 3, F.transform(
        F.slice("hashes", F.lit(1), F.size("hashes") - 2),
        lambda h, i: F.xxhash64(h, F.get(F.col("hashes"), i + 1), F.get(F.col("hashes"), i + 2)))))
    repeats = windows.withColumn("ordered", F.when(
        F.size(F.array_distinct("windows")) < F.size("windows"),
        F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    found = repeats.withColumn("starts", F.sort_array(F.transform(
        F.filter("ordered", lambda x, i: (x["h"] == F.get(F.col("ordered"), i + 1)["h"])
                 | (x["h"] == F.get(F.col("ordered"), i - 1)["h"])), lambda x: x["i"])))
    lines = found.withColumn("lines", F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    t = F.col("text")
    counted = lines.withColumns({
        "n_symbols": F.regexp_count(t, F.lit(r"[#*$%&|<>]")).cast("long"),
        "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
        "n_repeat_words": F.coalesce(_lengths_between(F.col("starts")), F.lit(0)).cast("long"),
        "n_chars": F.length(t), "letters": _counted(t, r"\P{L}+"), "capitals": _counted(t, r"\P{Lu}+"),
        "digits": _counted(t, r"\P{Nd}+"), "stops": _counted(t, r"[^.,;:!?]+"),
    })
    spaces = F.col("n_chars") - F.col("word_chars")
    classes = F.array(F.col("letters") - F.col("capitals"), F.col("capitals"), F.col("digits"), spaces, F.col("stops"),
                      F.col("n_symbols"), F.col("n_chars") - F.col("letters") - F.col("digits") - spaces
                      - F.col("stops") - F.col("n_symbols"))
    return counted.select("doc_id", "lang", "text_key", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                          F.transform(classes, lambda x: x.cast("long")).alias("classes"), "short", *counted.columns[4:4 + len(keep)])


def references(feats: DataFrame) -> list[dict]:
    """One reference per language with enough words, and the pooled one (``lang`` None) of all documents.

    ``common``: the common words; ``words``: their shares, then the rest's;
    ``classes``: shares of characters by class. At most 1 / LANGUAGE_SHARE
    languages of at most 1 / COMMON_SHARE words, whatever the corpus holds.
    """
    sums = [F.sum(F.get("classes", F.lit(i))).alias(c) for i, c in enumerate(CLASSES)]
    totals = materialise(feats.groupBy("lang").agg(F.sum("n_words").alias("n"), *sums), "languages")
    # Every candidate is counted; only counts per (language, short word) meet.
    counts = materialise(feats.select("lang", F.explode("short").alias("word")).groupBy("lang", "word").count(), "short-words")
    everything = totals.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n", *CLASSES)]).first()
    own = totals.where(F.col("lang").isNotNull() & (F.col("n") >= everything["n"] * LANGUAGE_SHARE) & (F.col("n") > 0))
    found = {r["lang"]: r for r in own.collect()} | {None: everything}
    common: dict = {lang: [] for lang in found}
    frequent = (counts.join(own.select("lang", "n"), "lang").where(F.col("count") >= F.col("n") * COMMON_SHARE)
                .select("lang", "word", "count")
                .unionByName(counts.groupBy("word").agg(F.sum("count").alias("count"))
                             .where(F.col("count") >= everything["n"] * COMMON_SHARE)
                             .select(F.lit(None).cast("string").alias("lang"), "word", "count")))
    for r in frequent.collect():
        common[r["lang"]].append((r["word"], r["count"]))
    out = []
    for lang, row in sorted(found.items(), key=lambda x: (x[0] is None, x[0] or "")):
        words, n, n_chars = sorted(common[lang]), max(row["n"], 1), max(sum(row[c] for c in CLASSES), 1)
        out.append({"lang": lang, "common": [w for w, _ in words],
                    "words": [k / n for _, k in words] + [1 - sum(k for _, k in words) / n],
                    "classes": [row[c] / n_chars for c in CLASSES]})
    return out


def _sum(counts: Column) -> Column:
    return F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x)


def distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two count histograms of the same bins."""
    part = lambda a, m: F.when(a > 0, a * F.log2(a / m)).otherwise(0.0)
    terms = F.transform(F.arrays_zip(p.alias("p"), q.alias("q")), lambda x: (
        part(x["p"], (x["p"] + x["q"]) / 2) + part(x["q"], (x["p"] + x["q"]) / 2)) / 2)
    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(terms, F.lit(0.0), lambda a, v: a + v)))


def _distances(refs: Column) -> Column:
    """(word distance, character distance) of a row's histograms to each of ``refs``."""
    hits = F.transform(refs, lambda r: F.struct(
        r["words"].alias("words"), r["classes"].alias("classes"),
        F.transform(r["common"], lambda w: F.size("short") - F.size(F.array_remove("short", w))).alias("hits")))
    share = lambda counts, n: F.transform(counts, lambda v: v / F.greatest(n, F.lit(1)))
    return F.transform(hits, lambda h: F.struct(
        distance(share(F.concat(h["hits"].cast("array<bigint>"), F.array(F.col("n_words") - _sum(h["hits"]))), F.col("n_words")),
                 h["words"]).alias("words"),
        distance(share(F.col("classes"), F.col("n_chars")), h["classes"]).alias("classes")))


def divergence(docs: DataFrame, *keep: Column) -> DataFrame:
    """Base counts, both distances and the verdicts of every document, and the columns ``keep`` of its row.

    A document is compared to its own language's reference, and to all of
    them if it has none or diverges from it (its label may be wrong); it
    passes if it is near enough to one. The distances given are the nearest.
    """
    feats = materialise(features(docs, *keep).withColumn("n_chars", _sum(F.col("classes"))), "quality-features")
    refs = F.array(*[F.struct(F.lit(r["lang"]).cast("string").alias("lang"),
                              F.array(*map(F.lit, r["common"])).cast("array<string>").alias("common"),
                              F.array(*map(F.lit, r["words"])).alias("words"),
                              F.array(*map(F.lit, r["classes"])).alias("classes")) for r in references(feats)])
    near = lambda ds: F.exists(ds, lambda d: (d["words"] <= MAX_WORD_DISTANCE) & (d["classes"] <= MAX_CHARACTER_DISTANCE))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    first = feats.withColumns({"base_failed": failed, "own": _distances(F.filter(refs, lambda r: r["lang"] == F.col("lang")))})
    second = first.withColumn("compared", F.when(F.col("base_failed") | near(F.col("own")), F.col("own")).otherwise(_distances(refs)))
    best = F.array_min(F.transform("compared", lambda d: F.struct(
        (d["words"] / MAX_WORD_DISTANCE + d["classes"] / MAX_CHARACTER_DISTANCE).alias("s"), d.alias("d"))))["d"]
    return second.select(
        "doc_id", "lang", "text_key", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        best["words"].alias("word_distance"), best["classes"].alias("class_distance"), "base_failed",
        (~F.col("base_failed") & near(F.col("compared"))).alias("kept"), *feats.columns[-1 - len(keep):-1])


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns, which travel beside the counts: no join."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole_row")
    return divergence(docs, whole).where("kept").select("whole_row.*")
