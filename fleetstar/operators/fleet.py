"""Fleet-health analytics: spike rates, rankings, trends, early warnings.

Every aggregation is partial (map-side: a hot key only ever contributes one
partial row per task). Store- and device-grain queries aggregate by the
foreign key and join dimension attributes to the much smaller result;
queries grouping by coarser attributes (region, store name) join a proven
small dimension map-side first (``plans.joins.aggregate_by_attributes``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetstar import constants as C
from fleetstar.functions.exprs import count_true, exact_pct, mean_from_cents, sum_cents
from fleetstar.operators.common import fact_date, label
from fleetstar.plans.joins import aggregate_by_attributes, join_dim
from fleetstar.plans.ordinal import global_rank
from fleetstar.plans.sequence import next_in_sequence


def _store_rates(fact: DataFrame, store: DataFrame) -> DataFrame:
    per_store = (fact.groupBy("store_key")
                 .agg(F.count(F.lit(1)).alias("total_readings"),
                      count_true(F.col("is_thermal_spike")).alias("spike_count"),
                      sum_cents(F.col("temperature_celsius")).alias("_temp_sum"),
                      F.count(F.col("temperature_celsius")).alias("_temp_n"),
                      F.max(F.col("temperature_celsius")).alias("max_temp_recorded"))
                 .withColumn("spike_rate_pct", exact_pct(F.col("spike_count"), F.col("total_readings"))))
    dims = store.select("store_key", "store_id", "store_name", "city", "country", "region")
    return join_dim(per_store, dims, "store_key")


def high_risk_stores(fact: DataFrame, store: DataFrame, min_rate: float = C.HIGH_RISK_MIN_RATE) -> DataFrame:
    """Stores whose (rounded) spike rate exceeds ``min_rate`` percent."""
    rates = _store_rates(fact, store).filter(F.col("spike_rate_pct") > F.lit(min_rate))
    return rates.select(
        "store_id", "store_name", "city", "country", "region", "total_readings", "spike_count",
        "spike_rate_pct",
        F.round(mean_from_cents(F.col("_temp_sum"), F.col("_temp_n")), 6).alias("avg_temp"),
        "max_temp_recorded")


def device_health(fact: DataFrame, device: DataFrame, store: DataFrame) -> DataFrame:
    """Per device and store: sessions, mean temperature/session/power, anomaly and dirty counts."""
    per = (fact.groupBy("device_key", "store_key")
           .agg(F.count(F.lit(1)).alias("n"),
                sum_cents(F.col("temperature_celsius")).alias("t_sum"),
                F.count(F.col("temperature_celsius")).alias("t_n"),
                F.sum("session_duration_secs").alias("s_sum"),
                F.count("session_duration_secs").alias("s_n"),
                sum_cents(F.col("power_draw_watts")).alias("p_sum"), F.count("power_draw_watts").alias("p_n"),
                count_true(F.col("is_anomaly")).alias("a"),
                count_true(F.col("data_quality_flag") != "CLEAN").alias("d")))
    per = join_dim(per, device.select("device_key", "device_id", "model_version", "firmware_version"),
                   "device_key")
    per = join_dim(per, store.select("store_key", "store_name", "region"), "store_key")
    keys = ["device_key", "device_id", "model_version", "firmware_version", "store_name", "region"]
    agg = per.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in
                                   ["n", "t_sum", "t_n", "s_sum", "s_n", "p_sum", "p_n", "a", "d"]])
    return agg.select(
        "device_id", "model_version", "firmware_version", "store_name", "region",
        F.col("n").alias("total_sessions"),
        F.round(mean_from_cents(F.col("t_sum"), F.col("t_n")), 6).alias("avg_temp"),
        F.try_divide(F.col("s_sum").cast("double"), F.col("s_n").cast("double")).alias("avg_session_secs"),
        F.round(mean_from_cents(F.col("p_sum"), F.col("p_n")), 6).alias("avg_power_watts"),
        F.col("a").alias("anomaly_count"),
        F.col("d").alias("dirty_record_count"))


def store_spike_ranking(fact: DataFrame, store: DataFrame, k: int | None = 10) -> DataFrame:
    """Global and regional RANK of store spike rates, best ``k`` by global rank.

    Every store ranked above one of the first k (strictly higher rate, in any
    region or in the same region) is itself among the first k in
    (rate desc, store_key) order, so both ranks are exact when computed on
    the k rows alone: a distributed top-k replaces two windows over all stores.
    """
    rates = _store_rates(fact, store)
    if k is not None:
        rates = rates.orderBy(F.desc("spike_rate_pct"), F.asc("store_key")).limit(k)
        regional = F.rank().over(Window.partitionBy("region").orderBy(F.desc("spike_rate_pct")))
        ranked = (rates.withColumn("regional_rank", regional)
                  .withColumn("global_rank", F.rank().over(Window.orderBy(F.desc("spike_rate_pct")))))
    else:
        # Every store: both ranks via the checked ranking helper, so neither the
        # whole table nor one large region is ranked inside a single task.
        ranked = global_rank(rates, "rank", [("spike_rate_pct", False)], "regional_rank",
                             tiebreak=[("store_key", True)], partition_by=["region"])
        ranked = global_rank(ranked, "rank", [("spike_rate_pct", False)], "global_rank",
                             tiebreak=[("store_key", True)])
    return (ranked.orderBy("global_rank", "store_key")
            .select("global_rank", "regional_rank", "store_name", "city", "country", "region",
                    "total_readings", "spike_count", "spike_rate_pct"))


def mom_temp_trend(fact: DataFrame, store: DataFrame, warm: float = C.TREND_WARM,
                   cool: float = C.TREND_COOL, key: str = "store_name") -> DataFrame:
    """Monthly mean temperature per store with month-over-month change.

    LAG runs over the previous *available* month of the same ``key``
    (``store_name`` as in the source model, or ``store_key``).
    """
    d = fact_date(fact)
    temp = F.col("temperature_celsius")
    readings = (fact.filter(temp.isNotNull())
                .withColumn("year", F.year(d)).withColumn("month_number", F.month(d)))
    attrs = ["store_name", "region"] + (["store_key_attr"] if key == "store_key" else [])
    dim = store.withColumn("store_key_attr", F.col("store_key"))
    monthly = aggregate_by_attributes(readings, dim, "store_key", attrs,
                                      {"s": (sum_cents(temp), F.sum), "n": (F.count(temp), F.sum)},
                                      extra_keys=["year", "month_number"])
    if key == "store_key":
        monthly = monthly.withColumnRenamed("store_key_attr", "store_key")
    monthly = (monthly.withColumn("avg_temp", F.round(mean_from_cents(F.col("s"), F.col("n")), 2))
               .withColumn("month_name", F.date_format(F.make_date("year", "month_number", F.lit(1)), "MMMM")))
    if key == "store_name":
        # Range-partition the monthly rows by store name: that clusters each
        # store for the window *and* already orders the output, so the final
        # sort needs no exchange (and no sampling pass that re-runs the window).
        monthly = monthly.repartitionByRange("store_name")
    w = Window.partitionBy(key).orderBy("year", "month_number", "region")
    trend = (monthly.withColumn("prev_month_temp", F.lag("avg_temp").over(w))
             .withColumn("mom_temp_change", F.round(F.col("avg_temp") - F.col("prev_month_temp"), 2))
             .filter(F.col("mom_temp_change").isNotNull()))
    status = label([(F.col("mom_temp_change") > warm, C.TREND_LABELS[0]),
                    (F.col("mom_temp_change") < cool, C.TREND_LABELS[1])], C.TREND_LABELS[2])
    return (trend.withColumn("trend_status", status)
            .orderBy("store_name", "year", "month_number", "region")
            .select("store_name", "region", F.col("year").cast("int").alias("year"), "month_name",
                    "avg_temp", "prev_month_temp", "mom_temp_change", "trend_status"))


def next_session_early_warning(fact: DataFrame, device: DataFrame, store: DataFrame,
                               jump: float = C.EARLY_WARNING_JUMP, k: int | None = 50,
                               bucket_seconds: int | str = "auto") -> DataFrame:
    """Next reading of each device (LEAD) and an early-warning label.

    The top-k runs before the dimension joins, so only k rows are joined in
    full; readings of unknown devices or stores are left out before it by
    semi-joins on the keys.
    """
    base = fact.filter(F.col("temperature_celsius").isNotNull()).select(
        "telemetry_key", "device_key", "store_key", "event_timestamp", "temperature_celsius",
        "is_thermal_spike")
    seq = next_in_sequence(base, "device_key", "event_timestamp", "telemetry_key",
                           ["temperature_celsius", "is_thermal_spike"], prefix="next_",
                           bucket_seconds=bucket_seconds)
    seq = (seq.filter(F.col("next_temperature_celsius").isNotNull())
           .withColumn("_jump", F.col("next_temperature_celsius") - F.col("temperature_celsius")))
    if k is not None:
        seq = join_dim(seq, device.select("device_key"), "device_key", how="left_semi")
        seq = join_dim(seq, store.select("store_key"), "store_key", how="left_semi")
        seq = seq.orderBy(F.desc_nulls_last("_jump"), F.asc("telemetry_key")).limit(k)
    seq = join_dim(seq, device.select("device_key", "device_id"), "device_key")
    seq = join_dim(seq, store.select("store_key", "store_name"), "store_key")
    warning = label([(F.col("_jump") > jump, C.EARLY_WARNING_LABELS[0]),
                     (F.col("next_is_thermal_spike") == F.lit(True), C.EARLY_WARNING_LABELS[1])],
                    C.EARLY_WARNING_LABELS[2])
    out = seq.select(
        "device_id", "store_name", "event_timestamp",
        F.col("temperature_celsius").alias("current_temp"),
        F.col("next_temperature_celsius").alias("next_session_temp"),
        F.round(F.col("_jump"), 2).alias("temp_jump"),
        F.col("next_is_thermal_spike").alias("next_is_spike"),
        warning.alias("early_warning"),
        "telemetry_key")
    if k is None:
        # Every reading with a successor: no report order to honour, so no global sort.
        return out.drop("telemetry_key")
    return out.orderBy(F.desc_nulls_last("temp_jump"), F.asc("telemetry_key")).drop("telemetry_key")


def _daily_region_spikes(fact: DataFrame, store: DataFrame) -> DataFrame:
    days = fact.withColumn("full_date", fact_date(fact))
    return aggregate_by_attributes(days, store, "store_key", ["region"],
                                   {"daily_spikes": (count_true(F.col("is_thermal_spike")), F.sum)},
                                   extra_keys=["full_date"])


def cumulative_spikes(fact: DataFrame, store: DataFrame, rows: int = 7) -> DataFrame:
    """Daily spikes per region, running total and a ``rows``-row moving mean.

    The window partitions by region, but its input is one row per region and
    day, so a partition holds at most the calendar's length.
    """
    # Range partitions by region cluster each series for the window and already
    # order the output by region, so the final sort adds no exchange.
    daily = _daily_region_spikes(fact, store).repartitionByRange("region")
    w = Window.partitionBy("region").orderBy("full_date")
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    mov = w.rowsBetween(-(rows - 1), Window.currentRow)
    mean = F.try_divide(F.sum("daily_spikes").over(mov).cast("decimal(20,0)"),
                        F.count("daily_spikes").over(mov).cast("decimal(20,0)"))
    return (daily.select("region", "full_date", "daily_spikes",
                         F.sum("daily_spikes").over(run).alias("cumulative_spikes"),
                         F.round(mean, 2).alias("rolling_7day_avg"))
            .orderBy("region", "full_date"))


def calendar_rolling_avg(fact: DataFrame, store: DataFrame, days: int = 7) -> DataFrame:
    """True ``days``-day mean of daily spikes, a row for every day between a region's first and last.

    Gaps are filled without a join: each day with readings is followed by the
    days up to the region's next one, which have 0 spikes. The mean always
    divides by ``days``.
    """
    w = Window.partitionBy("region").orderBy("full_date")
    daily = _daily_region_spikes(fact, store).repartitionByRange("region")
    until = F.coalesce(F.date_sub(F.lead("full_date").over(w), 1), F.col("full_date"))
    spine = (daily.withColumn("_until", until)
             .select("region", F.col("full_date").alias("_seen"), F.explode(F.sequence("full_date", "_until")).alias("full_date"), "daily_spikes")
             .withColumn("daily_spikes", F.when(F.col("full_date") == F.col("_seen"), F.col("daily_spikes")).otherwise(F.lit(0).cast("long"))))
    mean = F.sum("daily_spikes").over(w.rowsBetween(-(days - 1), 0)).cast("decimal(20,0)") / F.lit(days).cast("decimal(20,0)")
    return (spine.select("region", "full_date", "daily_spikes", F.round(mean, 2).alias(f"calendar_{days}day_avg"))
            .orderBy("region", "full_date"))


def device_risk_quartiles(fact: DataFrame, device: DataFrame, store: DataFrame,
                          buckets: int = 4) -> DataFrame:
    """Per-device spike rate over non-NULL readings, NTILE by rate (ties by device)."""
    temp = F.col("temperature_celsius")
    per = (fact.filter(temp.isNotNull())
           .groupBy("device_key", "store_key")
           .agg(F.count(F.lit(1)).alias("n"), sum_cents(temp).alias("t"), F.count(temp).alias("tn"),
                count_true(F.col("is_thermal_spike")).alias("sp")))
    per = join_dim(per, device.select("device_key", "device_id", "model_version", "firmware_version"),
                   "device_key")
    per = join_dim(per, store.select("store_key", "store_name", "region"), "store_key")
    keys = ["device_key", "device_id", "model_version", "firmware_version", "store_name", "region"]
    agg = (per.groupBy(*keys).agg(F.sum("n").alias("total_sessions"), F.sum("t").alias("t"),
                                  F.sum("tn").alias("tn"), F.sum("sp").alias("total_spikes"))
           .withColumn("avg_temp", F.round(mean_from_cents(F.col("t"), F.col("tn")), 2))
           .withColumn("spike_rate_pct", exact_pct(F.col("total_spikes"), F.col("total_sessions"))))
    ranked = global_rank(agg, "ntile", [("spike_rate_pct", False)], "risk_quartile",
                         tiebreak=[("device_id", True), ("device_key", True)], buckets=buckets)
    prio = F.create_map(*[x for kv in C.MAINTENANCE_LABELS.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    return (ranked.withColumn("maintenance_priority", prio[F.col("risk_quartile")])
            .orderBy("risk_quartile", F.desc("spike_rate_pct"), "device_id", "device_key")
            .select("device_id", "store_name", "region", "model_version", "firmware_version",
                    "total_sessions", "avg_temp", "total_spikes", "spike_rate_pct", "risk_quartile",
                    "maintenance_priority"))


def firmware_compliance(fact: DataFrame, device: DataFrame, fail: float = C.FIRMWARE_FAIL,
                        warn: float = C.FIRMWARE_WARN) -> DataFrame:
    """Per firmware version: devices, readings, spike rate, DENSE_RANK and status."""
    temp = F.col("temperature_celsius")
    per = (fact.filter(temp.isNotNull())
           .groupBy("device_key")
           .agg(F.count(F.lit(1)).alias("n"), sum_cents(temp).alias("t"), F.count(temp).alias("tn"),
                count_true(F.col("is_thermal_spike")).alias("sp"), sum_cents(F.col("power_draw_watts")).alias("p"),
                F.count("power_draw_watts").alias("pn")))
    per = join_dim(per, device.select("device_key", "device_id", "firmware_version"), "device_key")
    agg = (per.groupBy("firmware_version")
           .agg(F.countDistinct("device_id").alias("device_count"),
                F.sum("n").alias("total_readings"),
                F.round(mean_from_cents(F.sum("t"), F.sum("tn")), 2).alias("avg_temp"),
                F.sum("sp").alias("total_spikes"),
                F.round(mean_from_cents(F.sum("p"), F.sum("pn")), 2).alias("avg_power_watts"))
           .withColumn("spike_rate_pct", exact_pct(F.col("total_spikes"), F.col("total_readings"))))
    ranked = global_rank(agg, "dense_rank", [("spike_rate_pct", False)], "compliance_rank")
    status = label([(F.col("spike_rate_pct") > fail, C.FIRMWARE_LABELS[0]),
                    (F.col("spike_rate_pct") > warn, C.FIRMWARE_LABELS[1])], C.FIRMWARE_LABELS[2])
    return (ranked.withColumn("compliance_status", status)
            .orderBy("compliance_rank", "firmware_version")
            .select("compliance_rank", "firmware_version", "device_count", "total_readings", "avg_temp",
                    "total_spikes", "spike_rate_pct", "avg_power_watts", "compliance_status"))


def fiscal_period_health(fact: DataFrame, date: DataFrame, where=None) -> DataFrame:
    """Readings, spikes and mean temperature by fiscal period and weekend, through the calendar dimension.

    The join carries ``reading_month`` where both sides have it, so a filter on
    calendar attributes (``where``) prunes the fact's month partitions.
    """
    temp = F.col("temperature_celsius")
    keys = [c for c in ("reading_month", "date_key") if c in fact.columns and c in date.columns]
    per = fact.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), count_true(F.col("is_thermal_spike")).alias("sp"),
                                  sum_cents(temp).alias("t"), F.count(temp).alias("tn"))
    days = date if where is None else date.where(where)
    joined = join_dim(per, days.select(*keys, "fiscal_period", "is_weekend"), keys)
    return (joined.groupBy("fiscal_period", "is_weekend")
            .agg(F.sum("n").alias("total_readings"), F.sum("sp").alias("spike_count"),
                 F.round(mean_from_cents(F.sum("t"), F.sum("tn")), 2).alias("avg_temp"))
            .withColumn("spike_rate_pct", exact_pct(F.col("spike_count"), F.col("total_readings"))))
