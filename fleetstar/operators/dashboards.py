"""Flat extract and the dashboard data sets computed from it.

The extract is one wide row per reading (fact columns + store, device,
calendar and alert attributes). Calendar attributes are computed from the
reading's date instead of joining the calendar table; alert attributes come
from a left join (readings without an alert keep NULLs).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetstar import schemas as S
from fleetstar.functions.exprs import calendar_columns, mean_from_cents, sum_cents
from fleetstar.operators.common import fact_date
from fleetstar.plans.joins import join_dim
from fleetstar.session import checkpoint_base


def telemetry_export(fact: DataFrame, store: DataFrame, device: DataFrame, alert: DataFrame) -> DataFrame:
    cal = calendar_columns(fact_date(fact))
    x = fact.select(*S.FACT_COLUMNS, cal["full_date"].alias("full_date"), cal["month_name"].alias("month_name"),
                    cal["quarter"].alias("quarter"), cal["year"].alias("year"))
    x = join_dim(x, store.select("store_key", "store_name", "city", "country", "region"), "store_key")
    x = join_dim(x, device.select("device_key", "device_id", "model_version", "firmware_version"), "device_key")
    x = join_dim(x, alert.select("alert_type_key", "alert_code", "severity"), "alert_type_key", how="left")
    return x.select(*S.FLAT_COLUMNS)


_STORE = ["store_key", "store_name", "city", "country", "region"]


def _sums() -> list:
    t = F.col("temperature_celsius")
    return [F.count("telemetry_key").alias("readings"), F.sum(F.col("is_thermal_spike").cast("int")).alias("spikes"),
            sum_cents(t).alias("cents"), F.count(t).alias("temps")]


def store_totals(fact: DataFrame, store: DataFrame) -> DataFrame:
    """Sums per store with the store's attributes: all that the store dashboards need.

    The fact is aggregated by its store key before the join, so neither
    devices nor alerts are read and no reading is shuffled.
    """
    return join_dim(fact.groupBy("store_key").agg(*_sums()), store.select(*_STORE), "store_key")


def _totals(frame: DataFrame) -> DataFrame:
    """``store_totals`` as they are, or of a flat extract."""
    return frame if "cents" in frame.columns else frame.groupBy(*_STORE).agg(*_sums())


def _rate():
    return (F.sum("spikes") / F.sum("readings")) * F.lit(100.0)


def _mean():
    return F.round(mean_from_cents(F.sum("cents"), F.sum("temps")), 6)


def spike_rate_map(frame: DataFrame) -> DataFrame:
    """Unrounded spike rate by country, city and region; ATTR(store_name)."""
    attr = F.when(F.min("store_name") == F.max("store_name"), F.min("store_name")).otherwise(F.lit("*"))
    return (_totals(frame).groupBy("country", "city", "region")
            .agg(F.sum("readings").alias("readings"), _rate().alias("spike_rate_pct"), attr.alias("store_name")))


def with_date(fact: DataFrame) -> DataFrame:
    return fact.withColumn("full_date", fact_date(fact))


def monthly_operational_health(flat: DataFrame, by_year: bool = False) -> DataFrame:
    """Mean temperature and session length by month number (years merged unless ``by_year``)."""
    keys = [F.month("full_date").alias("month_number")]
    if by_year:
        keys = [F.year("full_date").alias("year")] + keys
    return (flat.groupBy(*keys)
            .agg(F.count("telemetry_key").alias("readings"),
                 F.round(mean_from_cents(sum_cents(F.col("temperature_celsius")), F.count("temperature_celsius")), 6)
                 .alias("avg_temp"),
                 F.try_divide(F.sum("session_duration_secs").cast("double"),
                              F.count("session_duration_secs").cast("double")).alias("avg_session_secs")))


def store_vs_global(frame: DataFrame, key: str = "store_name") -> DataFrame:
    """Each store's mean temperature against the record-weighted fleet mean; the difference is rounded once."""
    checkpoint_base(frame.sparkSession)
    totals = _totals(frame).checkpoint(eager=True)  # one row per store: read for the fleet and for the stores
    fleet = totals.agg(F.sum("cents").alias("c"), F.sum("temps").alias("n"), _mean().alias("mean")).first()
    per = totals.groupBy(key).agg(F.sum("readings").alias("readings"), _mean().alias("avg_temp"), _rate().alias("spike_rate_pct"),
                                  F.sum("cents").alias("_c"), F.sum("temps").alias("_n"))
    overall = F.lit(fleet["c"] / fleet["n"] if fleet["n"] else None).cast("double")
    return (per.withColumn("global_avg_temp", F.lit(fleet["mean"]))
            .withColumn("store_vs_global_diff", F.round((F.try_divide("_c", "_n") - overall) / 100, 6).cast("decimal(20,6)")).drop("_c", "_n")
            .orderBy(F.desc("store_vs_global_diff"), key))


def country_city_drill(frame: DataFrame) -> DataFrame:
    """Spike rate and mean temperature at fleet, country and city level (ROLLUP)."""
    return (_totals(frame).rollup("country", "city")
            .agg(F.grouping_id().alias("level"), F.sum("readings").alias("readings"),
                 F.sum("spikes").cast("long").alias("spikes"), _rate().alias("spike_rate_pct"), _mean().alias("avg_temp")))
