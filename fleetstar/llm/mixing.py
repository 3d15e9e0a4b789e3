"""Mixing sources to target weights by repetition rates. DataFrame functions only.

Sizes are summed per source; the wanted total is shared out by weight; a
source never gives more than ``max_repeats`` times its size, and what it
cannot give is shared among the others by weight until nothing is over. A
source's rate is its target by its size: every document is emitted
floor(rate) times, plus once more if a hash of its id falls below the
fraction. The same input gives the same mix on every run.

Only one row per source is shuffled or joined; documents are never grouped,
so a source may hold any share of them. The join's side is broadcast by
Spark's own size check only.

Edge cases: a null text has size 0; a null source is a source of its own,
ranked last; a null id hashes as an empty string; rows with the same id take
the same draw; if no source has any size, all targets are 0 and nothing is
taken; empty tables give empty mixes; columns named like the added ones are
replaced by them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetstar.plans.ordinal import with_row_number

from .common import WORD_PATTERN, materialise

WEIGHTS = (3, 1, 2)     # dealt to the sources in order of name, repeating
SHARE = 1.5             # wanted total by all sizes
MAX_REPEATS = 2.0
SEED = "mix-1"


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def source_plan(sized: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE,
                max_repeats: float = MAX_REPEATS) -> DataFrame:
    """source, source_size, target, rate from rows with ``source`` and ``size``.

    Water filling on the per-source table: each round gives every source
    below its ceiling the same amount per unit of weight and fixes those that
    it would lift above; at most one round per source, in practice a few.
    Every round reads one aggregated row.
    """
    per = sized.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    ranked = with_row_number(per.withColumn("_last", F.col("source").isNull()),
                             [("_last", True), ("source", True)], "_rank")
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.col("_rank") - 1) % len(weights) + 1).cast("int"))
    table = materialise(ranked.select("source", "source_size", weight.cast("double").alias("weight")), "sources")
    cap = F.col("source_size") * F.lit(max_repeats)
    level, fixed = 0.0, -1
    while True:
        full = cap <= F.col("weight") * F.lit(level) if fixed >= 0 else F.lit(False)
        row = table.agg(F.sum("source_size").alias("all"), F.sum(F.when(full, cap).otherwise(0.0)).alias("given"),
                        F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("left"),
                        F.sum(F.when(full, 1).otherwise(0)).alias("n")).first()
        if row["n"] == fixed or not row["left"]:
            break
        level, fixed = ((row["all"] or 0) * share - row["given"]) / row["left"], row["n"]
    target = F.least(cap, F.col("weight") * F.lit(float(level)))
    rate = F.coalesce(F.try_divide(target, F.col("source_size")), F.lit(0.0))
    return table.select("source", "source_size", target.alias("target"), rate.alias("rate"))


def draw(doc_id: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) fixed by the seed and the id: the first 52 bits of an MD5."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def times(rate: Column, doc_id: Column, seed: str = SEED) -> Column:
    """floor(rate) copies, and one more with the probability of the fraction."""
    return F.floor(rate) + (draw(doc_id, seed) < rate - F.floor(rate)).cast("long")


def copies(sized: DataFrame, seed: str = SEED, **plan) -> DataFrame:
    """Every row of ``sized`` (doc_id, source, size) with its source's size and target and its number of copies."""
    table = source_plan(sized, **plan).withColumnRenamed("source", "_source")
    return (sized.drop("source_size", "target", "rate", "copies")
            .join(table, F.col("source").eqNullSafe(F.col("_source")))
            .withColumn("copies", times(F.col("rate"), F.col("doc_id"), seed)).drop("_source", "rate"))


def mix(docs: DataFrame, seed: str = SEED, **plan) -> DataFrame:
    """The mixed corpus: each document as often as the mix takes it, with the columns of ``docs``."""
    table = source_plan(docs.select("source", size_of(F.col("text")).alias("size")), **plan).select(
        F.col("source").alias("__source"), F.col("rate").alias("__rate"))
    taken = (docs.join(table, docs["source"].eqNullSafe(table["__source"]))
             .withColumn("__times", times(F.col("__rate"), docs["doc_id"], seed).cast("int")).where("__times > 0"))
    return taken.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__times")))).select(*[docs[c] for c in docs.columns])
