"""Per-entity neighbours in time order (LEAD / LAG IGNORE NULLS), skew-safe.

``Window.partitionBy(entity)`` sends every reading of an entity to one task:
one shuffle, and right for ordinary entities. A single hot device holding a
third of all rows would then be sorted by one task, so rows are counted per
entity first (partially aggregated), and only the timelines of entities above
``hot_rows`` are cut into time buckets:

1. the window runs per (entity, bucket), so a hot entity spreads over many
   tasks;
2. a per-(entity, bucket) summary (first row, or last non-NULL value) is
   aggregated map-side (one partial row per bucket and task) from a second,
   column-pruned read, so only summaries are shuffled for it;
3. a window over the small summary table carries values across bucket
   boundaries, and is joined back on (entity, bucket). The summary grows with
   the data, so no broadcast is forced: adaptive execution switches to a
   broadcast at runtime only when the materialised summary is small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetstar.session import checkpoint_base

DEFAULT_BUCKET_SECONDS = 3600


TARGET_ROWS_PER_BUCKET = 1_000_000
HOT_ROWS = 1_000_000  # fleetstar.sequence.hotRows


def split_hot(df: DataFrame, entity: str, hot_rows: int | None = None) -> tuple[DataFrame, DataFrame | None]:
    """(rows of ordinary entities, rows of entities with more than ``hot_rows`` rows or None)."""
    limit = hot_rows if hot_rows is not None else int(
        df.sparkSession.conf.get("fleetstar.sequence.hotRows", None) or HOT_ROWS)
    checkpoint_base(df.sparkSession)
    hot = (df.groupBy(entity).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > limit)
           .select(F.col(entity).alias("_hot")).checkpoint(eager=True))
    if hot.isEmpty():
        return df, None
    on = df[entity].eqNullSafe(hot["_hot"])
    return df.join(hot, on, "left_anti"), df.join(hot, on, "left_semi")


def auto_bucket_seconds(df: DataFrame, entity: str, ts: str, target_rows: int = TARGET_ROWS_PER_BUCKET) -> int:
    """Bucket width giving the busiest entity about ``target_rows`` rows per bucket.

    One partially aggregated pass (rows and time range per entity, then a
    global max); only one summary row reaches the driver. Assumes the busiest
    entity's readings are spread over the whole time range.
    """
    per = df.groupBy(entity).agg(F.count(F.lit(1)).alias("n"),
                                 F.min(ts).alias("lo"), F.max(ts).alias("hi"))
    row = per.agg(F.max("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi")).first()
    if row is None or not row["n"]:
        return DEFAULT_BUCKET_SECONDS
    span = max(1, int((row["hi"] - row["lo"]).total_seconds()) + 1)
    return max(1, min(span, span * target_rows // row["n"]))


def _with_bucket(df: DataFrame, ts: str, bucket_seconds) -> DataFrame:
    if bucket_seconds == "auto":
        raise ValueError("resolve 'auto' with auto_bucket_seconds first")
    micros = int(bucket_seconds) * 1_000_000
    return df.withColumn(
        "_bucket", F.expr(f"unix_micros(cast(`{ts}` as timestamp)) div {micros}"))


def next_in_sequence(df: DataFrame, entity: str, ts: str, tiebreak: str, values: list[str],
                     prefix: str = "next_", bucket_seconds: int | str = "auto",
                     hot_rows: int | None = None) -> DataFrame:
    """Add ``prefix + v`` = LEAD(v) OVER (PARTITION BY entity ORDER BY ts, tiebreak).

    ``bucket_seconds`` is the bucket width of hot entities, or ``"auto"`` to size it from their data.
    """
    df, busy = split_hot(df, entity, hot_rows)
    w = Window.partitionBy(entity).orderBy(ts, tiebreak)
    out = df.withColumns({prefix + v: F.lead(v).over(w) for v in values})
    if busy is None:
        return out
    return out.unionByName(_next_in_buckets(busy, entity, ts, tiebreak, values, prefix, bucket_seconds))


def _next_in_buckets(df: DataFrame, entity: str, ts: str, tiebreak: str, values: list[str], prefix: str,
                     bucket_seconds) -> DataFrame:
    if bucket_seconds == "auto":
        bucket_seconds = auto_bucket_seconds(df, entity, ts)
    d = _with_bucket(df, ts, bucket_seconds)
    w = Window.partitionBy(entity, "_bucket").orderBy(ts, tiebreak)
    d = d.withColumn("_nxt", F.lead(F.struct(*values)).over(w))
    heads = (d.groupBy(entity, "_bucket")
             .agg(F.min(F.struct(ts, tiebreak, *values)).alias("_head")))
    nxt_heads = heads.select(
        entity, "_bucket",
        F.lead(F.struct(*[F.col(f"_head.{v}").alias(v) for v in values]))
        .over(Window.partitionBy(entity).orderBy("_bucket")).alias("_nxt_head"))
    # Data-sized summary: adaptive execution broadcasts it only if it turns out small.
    d = d.join(nxt_heads, [entity, "_bucket"], "left")
    nxt = F.coalesce(F.col("_nxt"), F.col("_nxt_head"))
    for v in values:
        d = d.withColumn(prefix + v, nxt.getField(v))
    return d.drop("_nxt", "_nxt_head", "_bucket")


def previous_non_null(df: DataFrame, entity: str, ts: str, tiebreak: str, value: str, out: str,
                      bucket_seconds: int | str = "auto", hot_rows: int | None = None) -> DataFrame:
    """Add ``out`` = last non-NULL ``value`` strictly before each row of the entity."""
    df, busy = split_hot(df, entity, hot_rows)
    w = Window.partitionBy(entity).orderBy(ts, tiebreak).rowsBetween(Window.unboundedPreceding, -1)
    found = df.withColumn(out, F.last(value, ignorenulls=True).over(w))
    if busy is None:
        return found
    return found.unionByName(_previous_in_buckets(busy, entity, ts, tiebreak, value, out, bucket_seconds))


def _previous_in_buckets(df: DataFrame, entity: str, ts: str, tiebreak: str, value: str, out: str,
                         bucket_seconds) -> DataFrame:
    if bucket_seconds == "auto":
        bucket_seconds = auto_bucket_seconds(df, entity, ts)
    d = _with_bucket(df, ts, bucket_seconds)
    w = (Window.partitionBy(entity, "_bucket").orderBy(ts, tiebreak)
         .rowsBetween(Window.unboundedPreceding, -1))
    d = d.withColumn("_in", F.last(value, ignorenulls=True).over(w))
    tails = (d.groupBy(entity, "_bucket")
             .agg(F.max(F.when(F.col(value).isNotNull(), F.struct(ts, tiebreak, value)))
                  .getField(value).alias("_tail")))
    carry = tails.select(
        entity, "_bucket",
        F.last("_tail", ignorenulls=True).over(
            Window.partitionBy(entity).orderBy("_bucket")
            .rowsBetween(Window.unboundedPreceding, -1)).alias("_carry"))
    d = d.join(carry, [entity, "_bucket"], "left")
    return (d.withColumn(out, F.coalesce(F.col("_in"), F.col("_carry")))
            .drop("_in", "_carry", "_bucket"))
