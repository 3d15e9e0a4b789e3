"""Column statistics that merge: sketches per partition, united without a rescan.

Distinct counts are HyperLogLog sketches, quantiles KLL sketches. A partition's
sketches are some kilobytes per column, are replaced when the partition is
loaded again, and unite to those of any set of partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetstar.functions.exprs import count_true
from fleetstar.sources.files import overwrite_partitions

HLL_BITS = 14                          # 2 ** 14 registers
HLL_ERROR = 3 * 1.04 / 2 ** (HLL_BITS / 2)   # three standard errors
KLL_K = 800
KLL_RANK_ERROR = 0.01                  # of all values; KLL with k = 800 stays below it with 99 % confidence


def store_column_sketches(df: DataFrame, part: Column, path: str) -> None:
    """One row per (part, column): values, NULLs and the distinct-count sketch; parts in ``df`` are replaced."""
    aggs = []
    for i, c in enumerate(df.columns):
        col = F.col(f"`{c}`")
        aggs += [F.count(col).alias(f"n{i}"), count_true(col.isNull()).alias(f"z{i}"),
                 F.hll_sketch_agg(col.cast("string"), HLL_BITS).alias(f"s{i}")]
    per = df.groupBy(part.alias("part")).agg(*aggs)
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("n"), F.col(f"z{i}").alias("nulls"), F.col(f"s{i}").alias("sketch"))
                     for i, c in enumerate(df.columns)])
    overwrite_partitions(per.select("part", F.explode(rows).alias("r")).select("part", "r.*"), path, "part")


def merged_profile(spark: SparkSession, path: str) -> DataFrame:
    """column_name, non_null_count, null_count and the estimated distinct count over all stored parts."""
    rows = spark.read.schema("column_name string, n bigint, nulls bigint, sketch binary, part string").parquet(path)
    return rows.groupBy("column_name").agg(
        F.sum("n").alias("non_null_count"), F.sum("nulls").alias("null_count"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_estimate"))


def store_quantile_sketches(df: DataFrame, columns, part: Column, path: str) -> None:
    """One row per (part, column) with the KLL sketch of its values; parts in ``df`` are replaced."""
    per = df.groupBy(part.alias("part")).agg(*[F.kll_sketch_agg_double(F.col(c).cast("double"), F.lit(KLL_K)).alias(f"s{i}")
                                               for i, c in enumerate(columns)])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"s{i}").alias("sketch")) for i, c in enumerate(columns)])
    overwrite_partitions(per.select("part", F.explode(rows).alias("r")).select("part", "r.*"), path, "part")


def merged_quantiles(spark: SparkSession, path: str, probs=(0.25, 0.75)) -> DataFrame:
    """column_name, prob and the estimated quantile over all stored parts."""
    rows = spark.read.schema("column_name string, sketch binary, part string").parquet(path)
    united = rows.groupBy("column_name").agg(F.kll_merge_agg_double("sketch", F.lit(KLL_K)).alias("s"))
    found = F.array(*[F.struct(F.lit(p).cast("double").alias("prob"), F.kll_sketch_get_quantile_double("s", F.lit(p)).alias("estimate")) for p in probs])
    return united.select("column_name", F.explode(found).alias("q")).select("column_name", "q.*")


def rank_errors(df: DataFrame, quantiles: DataFrame, columns) -> DataFrame:
    """(column_name, prob, rank_error): how far each estimate's true rank lies from its probability.

    One aggregate pass over the values, with the handful of estimates as a side of at most ``columns x probs`` rows.
    """
    wanted = {(r["column_name"], r["prob"]): r["estimate"] for r in quantiles.collect()}  # columns x probs
    aggs, keys = [], sorted(wanted)
    for i, (c, _) in enumerate(keys):
        v = F.col(c).cast("double")
        aggs += [count_true(v < F.lit(wanted[keys[i]])).alias(f"l{i}"), count_true(v <= F.lit(wanted[keys[i]])).alias(f"u{i}"), F.count(v).alias(f"n{i}")]
    error = lambda i, p: F.greatest(F.lit(p) - F.try_divide(f"u{i}", f"n{i}"), F.try_divide(f"l{i}", f"n{i}") - F.lit(p), F.lit(0.0))
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(p).alias("prob"), error(i, p).alias("rank_error")) for i, (c, p) in enumerate(keys)])
    return df.agg(*aggs).select(F.explode(rows).alias("r")).select("r.*")
