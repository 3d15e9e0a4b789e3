"""Dimension maintenance and ingest: calendar, insert-if-absent, keys, appends."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetstar import schemas as S
from fleetstar.functions.exprs import calendar_columns
from fleetstar.operators.common import fact_date
from fleetstar.operators.key_index import KeyIndex
from fleetstar.plans.ordinal import global_rank
from fleetstar.session import checkpoint_base
from fleetstar.sources.files import overwrite_partitions


def _calendar(days: DataFrame) -> DataFrame:
    return days.select(*[c.alias(k) for k, c in calendar_columns(F.col("d")).items()])


def date_dimension(spark: SparkSession, start="2024-01-01", end="2026-12-31") -> DataFrame:
    """Calendar rows for every day in [start, end] (distributed by ``spark.range``)."""
    s = dt.date.fromisoformat(str(start))
    e = dt.date.fromisoformat(str(end))
    days = spark.range((e - s).days + 1).select(
        F.date_add(F.lit(s), F.col("id").cast("int")).alias("d"))
    return _calendar(days)


def date_dimension_covering(fact: DataFrame) -> DataFrame:
    """Calendar spanning the first to the last reading date of ``fact``.

    Only the two bounds (one aggregated row) reach the driver; the days are
    generated by the distributed ``spark.range`` path.
    """
    d = fact_date(fact)
    lo, hi = fact.agg(F.min(d), F.max(d)).first()
    if lo is None:
        return _calendar(fact.sparkSession.range(0).select(F.lit(None).cast("date").alias("d")))
    return date_dimension(fact.sparkSession, lo, hi)


def dedupe_by_key(incoming: DataFrame, key: list[str]) -> DataFrame:
    """One row per business key (deterministic: the smallest remaining row).

    A grouped ``min(struct)`` is partially aggregated per task, so a key
    repeated millions of times never gathers its copies in one place.
    """
    others = [c for c in incoming.columns if c not in key]
    if not others:
        return incoming.select(*key).distinct()
    picked = incoming.groupBy(*key).agg(F.min(F.struct(*others)).alias("_row"))
    return picked.select(*key, *[F.col(f"_row.{c}").alias(c) for c in others]).select(*incoming.columns)


def new_rows(target: DataFrame, incoming: DataFrame, key) -> DataFrame:
    """Incoming rows whose business key the target does not have (existing rows win)."""
    key = [key] if isinstance(key, str) else list(key)
    fresh = dedupe_by_key(incoming, key)
    return fresh.join(target.select(*key).distinct(), on=key, how="left_anti")


def insert_if_absent(target: DataFrame, incoming: DataFrame, key) -> DataFrame:
    """The target after an insert that ignores already-known business keys."""
    return target.unionByName(new_rows(target, incoming, key).select(*target.columns))


def assign_surrogate_keys(new: DataFrame, existing_max, out: str, order: list[tuple[str, bool]]) -> DataFrame:
    """Dense keys ``existing_max + 1 ..`` for new dimension rows, in ``order``."""
    base = existing_max if isinstance(existing_max, Column) else F.lit(existing_max)
    numbered = global_rank(new, "row_number", order, "_rn")
    return numbered.withColumn(out, (F.coalesce(base, F.lit(0)) + F.col("_rn")).cast("long")).drop("_rn")


def assign_fact_keys(new: DataFrame, offset: int, out: str = "telemetry_key") -> DataFrame:
    """Unique (not dense) keys for fact rows without any shuffle."""
    return new.withColumn(out, F.monotonically_increasing_id() + F.lit(offset))


REQUIRED_FACT = [f.name for f in S.FACT.fields if not f.nullable and f.name != "ingestion_timestamp"]


def validate_facts(fact: DataFrame, device: DataFrame | None = None, index: KeyIndex | None = None, load: str | None = None) -> DataFrame:
    """Every row with its ``reject_reason`` (NULL: valid).

    Checked: all required columns exist (else ValueError) and are not NULL,
    the quality-flag domain, the device when ``device`` is given, one row per
    key (the least by its other columns stays), and keys that another load
    than ``load`` has brought into ``index``.
    """
    from fleetstar import constants as C

    missing = [c for c in REQUIRED_FACT if c not in fact.columns]
    if missing:
        raise ValueError(f"required columns are absent: {', '.join(missing)}")
    reason = F.lit(None).cast("string")
    reason = F.when(~F.col("data_quality_flag").isin(C.QUALITY_FLAGS), "unknown quality flag").otherwise(reason)
    for c in REQUIRED_FACT:
        reason = F.when(F.col(c).isNull(), f"{c} is null").otherwise(reason)
    rows = fact.withColumn("reject_reason", reason)
    if device is not None:
        keys = device.select(F.col("device_key").alias("_dk")).distinct()
        rows = rows.join(keys, rows["device_key"] == keys["_dk"], "left").withColumn(
            "reject_reason", F.coalesce("reject_reason", F.when(F.col("_dk").isNull(), "unknown device"))).drop("_dk")
    # Rows without a key are rejected already; they are spread over all tasks.
    spread = F.when(F.col("telemetry_key").isNull(), F.xxhash64(*fact.columns))
    order = [F.col("reject_reason").isNotNull(), F.xxhash64(*fact.columns)]
    rows = rows.withColumn("_n", F.row_number().over(Window.partitionBy("telemetry_key", spread).orderBy(*order)))
    twice = F.col("telemetry_key").isNotNull() & (F.col("_n") > 1)
    rows = rows.withColumn("reject_reason", F.coalesce("reject_reason", F.when(twice, "duplicate key"))).drop("_n")
    if index is not None:
        rows = index.mark_known(rows, load).withColumn(
            "reject_reason", F.coalesce("reject_reason", F.when(F.col("known"), "key already loaded"))).drop("known")
    return rows


def append_facts(fact_new: DataFrame, path: str, rejects_path: str, load_id: str, device: DataFrame | None = None) -> None:
    """Checked append of one load: valid rows by (load, month), the rest with their reason to ``rejects_path``.

    The rows are judged once, into the shared checkpoint folder; all writes
    replace only the partitions of this ``load_id``, so a load that failed
    between them, or is run again, adds nothing twice. Keys are looked up in
    the bucketed index beside the fact, so a load's cost follows the load. Its
    own keys are entered first: a load that died is to be run again.
    """
    spark = fact_new.sparkSession
    checkpoint_base(spark)
    index = KeyIndex(spark, f"{path.rstrip('/')}-keys")
    judged = validate_facts(fact_new, device, index, load_id).withColumn("load", F.lit(load_id)).checkpoint(eager=True)
    index.add(judged.where("reject_reason is null"), load_id)
    valid = (judged.where("reject_reason is null").drop("reject_reason").withColumn("ingestion_timestamp", F.localtimestamp())
             .withColumn("reading_month", F.date_format(fact_date(fact_new), "yyyy-MM")))
    overwrite_partitions(valid.hint("rebalance", "reading_month"), path, "load", "reading_month")
    overwrite_partitions(judged.where("reject_reason is not null"), rejects_path, "load")


def write_star(star, path: str, max_records_per_file: int = 5_000_000) -> None:
    """Materialise a star: fact partitioned by reading month, dimensions as files.

    Rows are rebalanced by month (a large month over several tasks), so files
    are few and of even size, and sorted inside each task by (month, device,
    time): row-group statistics then skip data for device and time filters.
    """
    fact = star.fact.withColumn("reading_month", F.date_format(fact_date(star.fact), "yyyy-MM"))
    (fact.hint("rebalance", "reading_month").sortWithinPartitions("reading_month", "device_key", "event_timestamp")
     .write.mode("overwrite").option("maxRecordsPerFile", max_records_per_file)
     .partitionBy("reading_month").parquet(f"{path}/fact"))
    for name in ("store", "device", "alert"):
        getattr(star, name).write.mode("overwrite").parquet(f"{path}/{name}")
    written = star.fact.sparkSession.read.parquet(f"{path}/fact")
    calendar = star.date if star.date is not None else date_dimension_covering(written)
    (calendar.withColumn("reading_month", F.date_format("full_date", "yyyy-MM")).coalesce(1)
     .write.mode("overwrite").parquet(f"{path}/date"))


def read_star(spark: SparkSession, path: str):
    """A written star. Its calendar carries ``reading_month``, so that filters on it prune the fact's months."""
    from fleetstar.sources.profiles import Star

    return Star(**{name: spark.read.parquet(f"{path}/{name}") for name in ("fact", "store", "device", "alert", "date")})
