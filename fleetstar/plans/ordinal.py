"""Global RANK / DENSE_RANK / NTILE / ROW_NUMBER that scale past one task.

A window without PARTITION BY runs in a single task. That is fine for a few
thousand aggregated rows, so small inputs (row count proven by a
count of the checkpointed input) use the built-in window. Larger inputs are
ordered by a distributed range-partitioned sort; each row's position is its
partition's offset (from per-partition counts: one row per partition, a
structurally bounded table) plus its position inside the partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetstar.session import checkpoint_base

_DEFAULT_LOCAL_MAX_ROWS = 200_000
_LOCAL_BITS = 33  # monotonically_increasing_id: partition index << 33 | row index


def _sort_cols(spec) -> list[Column]:
    return [F.col(c).asc() if asc else F.col(c).desc() for c, asc in spec]


def local_limit(df: DataFrame) -> int:
    conf = df.sparkSession.conf.get("fleetstar.window.localMaxRows", None)
    return int(conf) if conf else _DEFAULT_LOCAL_MAX_ROWS


def with_row_number(df: DataFrame, spec, out: str = "_rn", total: str | None = None) -> DataFrame:
    """Distributed ROW_NUMBER over a total order ``spec`` [(column, ascending)].

    The sorted frame is checkpointed to the shared checkpoint folder so the
    per-partition counts and the numbering read the very same partitions.
    """
    checkpoint_base(df.sparkSession)
    ordered = (df.orderBy(*_sort_cols(spec))
               .withColumn("_mid", F.monotonically_increasing_id())
               .checkpoint(eager=True))
    ordered = (ordered
               .withColumn("_pid", F.shiftright("_mid", _LOCAL_BITS))
               .withColumn("_loc", F.col("_mid").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))))
    counts = ordered.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition of the sorted frame: bounded by the partition count.
    offsets = counts.select(
        "_pid",
        F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"),
        F.sum("_n").over(Window.partitionBy(F.lit(0))).alias("_total"),
    )
    res = (ordered.join(F.broadcast(offsets), "_pid")
           .withColumn(out, F.col("_off") + F.col("_loc") + 1))
    if total:
        res = res.withColumnRenamed("_total", total)
    return res.drop("_mid", "_pid", "_loc", "_off", "_total")


def _ntile(rn: Column, total: Column, n: int) -> Column:
    """NTILE(n) from a 1-based row number and the row total.

    The first ``total % n`` buckets hold one extra row, as in SQL.
    """
    q = F.floor(total / F.lit(n)).cast("long")
    r = (total - q * n).cast("long")
    big = r * (q + 1)
    first = F.floor((rn - 1) / (q + 1)).cast("long") + 1
    rest = r + F.floor(F.try_divide(rn - big - 1, q)).cast("long") + 1
    return F.when(rn <= big, first).otherwise(rest).cast("int")


def _join_back(df: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    # Derived from the data being ranked: left to adaptive execution, which
    # broadcasts it at runtime only when the materialised side is small.
    renamed = table.select(*[F.col(k).alias(f"_k_{k}") for k in keys],
                           *[c for c in table.columns if c not in keys])
    cond = [df[k].eqNullSafe(renamed[f"_k_{k}"]) for k in keys]
    return df.join(renamed, cond, "inner").drop(*[f"_k_{k}" for k in keys])


def global_rank(df: DataFrame, kind: str, order, out: str, tiebreak=(), buckets: int = 4,
                local_max_rows: int | None = None, partition_by=()) -> DataFrame:
    """Add ``out`` = RANK / DENSE_RANK / NTILE(buckets) / ROW_NUMBER.

    ``order`` and ``tiebreak`` are lists of (column, ascending). Ties in
    ``order`` share a RANK / DENSE_RANK; ``tiebreak`` makes NTILE and
    ROW_NUMBER deterministic. ``partition_by`` (RANK only) ranks within
    groups without sending a large group to one task.
    """
    order = list(order)
    tiebreak = list(tiebreak)
    groups = list(partition_by)
    if groups and kind != "rank":
        raise ValueError("partition_by is supported for RANK only")
    limit = local_max_rows or local_limit(df)
    # The input (usually an aggregate of the fact) is computed once into the
    # shared checkpoint folder; the size check and the ranking both read that.
    checkpoint_base(df.sparkSession)
    df = df.checkpoint(eager=True)
    if df.count() <= limit:
        if groups:
            return df.withColumn(out, F.rank().over(Window.partitionBy(*groups).orderBy(*_sort_cols(order))))
        w_order = Window.orderBy(*_sort_cols(order))
        w_total = Window.orderBy(*_sort_cols(order + tiebreak))
        fn = {
            "rank": lambda: F.rank().over(w_order),
            "dense_rank": lambda: F.dense_rank().over(w_order),
            "ntile": lambda: F.ntile(buckets).over(w_total),
            "row_number": lambda: F.row_number().over(w_total),
        }[kind]
        return df.withColumn(out, fn())

    names = [c for c, _ in order]
    if groups:
        # Positions in (group, order) order; a row's rank inside its group is the
        # first position of its tie group minus the group's first position, plus one.
        numbered = with_row_number(df, [(g, True) for g in groups] + order + tiebreak, "_rn")
        firsts = numbered.groupBy(*groups, *names).agg(F.min("_rn").alias("_tie_first"))
        starts = numbered.groupBy(*groups).agg(F.min("_rn").alias("_group_first"))
        ranked = _join_back(_join_back(numbered, firsts, groups + names), starts, groups)
        return (ranked.withColumn(out, (F.col("_tie_first") - F.col("_group_first") + 1).cast("int"))
                .drop("_rn", "_tie_first", "_group_first"))
    if kind == "row_number":
        return with_row_number(df, order + tiebreak, out)
    if kind == "ntile":
        numbered = with_row_number(df, order + tiebreak, "_rn", total="_tot")
        return numbered.withColumn(out, _ntile(F.col("_rn"), F.col("_tot"), buckets)).drop("_rn", "_tot")
    if kind == "rank":
        numbered = with_row_number(df, order + tiebreak, "_rn")
        firsts = numbered.groupBy(*names).agg(F.min("_rn").cast("int").alias(out))
        return _join_back(numbered.drop("_rn"), firsts, names)
    if kind == "dense_rank":
        values = df.select(*names).distinct()
        numbered = with_row_number(values, order, "_dr")
        return _join_back(df, numbered.withColumn(out, F.col("_dr").cast("int")).drop("_dr"), names)
    raise ValueError(f"unknown rank kind {kind!r}")
