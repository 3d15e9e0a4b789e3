"""Statistical anomaly detector: z-score, inter-quartile fences, quality flag.

The detector analyses readings with a temperature. Global statistics (mean,
sample standard deviation) are one aggregate, attached to every row as a
scalar subquery; exact quartiles are picked from the distinct values' sorted
counts, spread over all tasks, and enter as literals. So no join is needed
and no task gathers the values.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetstar import constants as C
from fleetstar.functions.exprs import count_true, exact_pct
from fleetstar.plans.joins import join_dim
from fleetstar.session import checkpoint_base

TEMP = "temperature_celsius"
IQR_COLUMNS = ("power_draw_watts", "session_duration_secs")
METHODS = ("ZSCORE", "IQR_POWER", "IQR_SESSION", "QUALITY")


QUARTILES = (0.25, 0.75)


def exact_quantiles(rows: DataFrame, cols, probs=QUARTILES) -> list[list[float | None]]:
    """Interpolated quantiles of each column (NULLs left out), as SQL's PERCENTILE_CONT.

    Equal values are counted (with partial aggregation) and sorted by range
    partitions; partition totals, one row each, give every value's rank, and
    only the values around the wanted ranks come back.
    """
    values = rows.select(F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(c).cast("double").alias("v"))
                                             for i, c in enumerate(cols)])).alias("x")).select("x.*")
    checkpoint_base(rows.sparkSession)
    counts = (values.where(F.col("v").isNotNull()).groupBy("i", "v").agg(F.count(F.lit(1)).alias("n"))
              .orderBy("i", "v").withColumn("p", F.spark_partition_id()).checkpoint(eager=True))
    totals = counts.groupBy("i", "p").agg(F.sum("n").alias("n"))  # one row per column and partition at most
    before = F.coalesce(F.sum("n").over(Window.partitionBy("i").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = totals.select("i", "p", before.alias("off"), F.sum("n").over(Window.partitionBy("i")).alias("all"))
    ranked = (counts.join(F.broadcast(offsets), ["i", "p"])
              .withColumn("last", F.col("off") + F.sum("n").over(Window.partitionBy("i", "p").orderBy("v"))))
    out: list[list[float | None]] = [[None] * len(probs) for _ in cols]
    wanted = [F.lit(q) * (F.col("all") - 1) for q in probs]
    covers = [(F.col("last") - F.col("n") <= f(w)) & (f(w) < F.col("last")) for w in wanted for f in (F.floor, F.ceil)]
    hit = covers[0]
    for c in covers[1:]:
        hit = hit | c
    found = ranked.where(hit).select("i", "v", "all", (F.col("last") - F.col("n")).alias("first"), "last").collect()
    for i in range(len(cols)):
        mine = [r for r in found if r["i"] == i]
        for j, q in enumerate(probs if mine else ()):
            place = q * (mine[0]["all"] - 1)
            low, high = (next(r["v"] for r in mine if r["first"] <= k < r["last"]) for k in (math.floor(place), math.ceil(place)))
            out[i][j] = low + (place - math.floor(place)) * (high - low)
    return out


def _quartiles(rows: DataFrame, cols, exact: bool) -> list[list[float | None]]:
    """[Q1, Q3] of each column: exact, or within 1/10000 of the rank in one pass."""
    if not cols:
        return []
    if exact:
        return exact_quantiles(rows, cols)
    probs = F.array(*map(F.lit, QUARTILES))
    row = rows.agg(*[F.percentile_approx(F.col(c).cast("double"), probs, 10000).alias(f"q{i}")
                     for i, c in enumerate(cols)]).first()
    return [list(row[f"q{i}"] or [None, None]) for i in range(len(cols))]


def _quartile_columns(rows: DataFrame, cols, exact: bool) -> list[Column]:
    return [F.array(*[F.lit(v).cast("double") for v in pair]).alias(f"q{i}")
            for i, pair in enumerate(_quartiles(rows, cols, exact))]


def analysed(fact: DataFrame, temp: str = TEMP) -> DataFrame:
    return fact.filter(F.col(temp).isNotNull())


def _moments(temp: str) -> list[Column]:
    t = F.col(temp).cast("double")
    return [F.avg(t).alias("mu"), F.stddev_samp(t).alias("sd")]


def detector_stats(rows: DataFrame, temp: str = TEMP, iqr_cols=IQR_COLUMNS, exact: bool = True) -> Column:
    """struct(mu, sd, q0, q1, ...) over ``rows``; ``qi`` = [Q1, Q3] of iqr_cols[i]."""
    moments = rows.select(F.struct(*_moments(temp))).scalar()
    return F.struct(moments["mu"].alias("mu"), moments["sd"].alias("sd"), *_quartile_columns(rows, iqr_cols, exact))


def zscore_flag(value: Column, mu: Column, sd: Column, k: float) -> Column:
    return F.coalesce(F.abs(F.try_divide(value - mu, sd)) > F.lit(k), F.lit(False))


def iqr_flag(value: Column, quart: Column, m: float) -> Column:
    q1, q3 = quart.getItem(0), quart.getItem(1)
    iqr = q3 - q1
    return F.coalesce((value < q1 - F.lit(m) * iqr) | (value > q3 + F.lit(m) * iqr), F.lit(False))


def composite_anomaly(fact: DataFrame, k: float = C.ZSCORE_K, m: float = C.IQR_MULTIPLIER,
                      temp: str = TEMP, iqr_cols=IQR_COLUMNS, exact: bool = True) -> DataFrame:
    """Analysed readings with one boolean per method, their OR and the methods that fired."""
    rows = analysed(fact, temp)
    st = detector_stats(rows, temp, iqr_cols, exact)
    d = rows.withColumn("_st", st)
    z = zscore_flag(F.col(temp).cast("double"), F.col("_st.mu"), F.col("_st.sd"), k)
    flags = {
        "z_flag": z,
        "iqr_power_flag": iqr_flag(F.col(iqr_cols[0]).cast("double"), F.col("_st.q0"), m),
        "iqr_session_flag": iqr_flag(F.col(iqr_cols[1]).cast("double"), F.col("_st.q1"), m),
        "quality_flag": F.coalesce(F.col("data_quality_flag") != "CLEAN", F.lit(False)),
    }
    for name, expr in flags.items():
        d = d.withColumn(name, expr)
    names = list(flags)
    d = d.withColumn("is_anomaly_detected", F.col(names[0]) | F.col(names[1]) | F.col(names[2]) | F.col(names[3]))
    d = d.withColumn("anomaly_methods", F.concat_ws(",", *[F.when(F.col(n), F.lit(mth))
                                                          for n, mth in zip(names, METHODS)]))
    return d.drop("_st")


def frozen_stats(fact: DataFrame, temp: str = TEMP, iqr_cols=IQR_COLUMNS, exact: bool = True) -> dict:
    """Detector statistics computed once for reuse elsewhere.

    A stream must not recompute global statistics per micro-batch; it applies
    the statistics of the last batch run with ``flag_with_stats``.
    """
    rows = analysed(fact, temp)
    quartiles = {f"q{i}": pair for i, pair in enumerate(_quartiles(rows, iqr_cols, exact))}
    return rows.agg(*_moments(temp)).first().asDict() | quartiles


def flag_with_stats(df: DataFrame, stats: dict, k: float = C.ZSCORE_K, m: float = C.IQR_MULTIPLIER,
                    temp: str = TEMP, iqr_cols=IQR_COLUMNS) -> DataFrame:
    """Composite verdict from fixed statistics (literals): works on batch and streaming frames."""
    lit = F.lit
    quart = [F.array(lit(float(stats[f"q{i}"][0])), lit(float(stats[f"q{i}"][1]))) for i in range(len(iqr_cols))]
    z = zscore_flag(F.col(temp).cast("double"), lit(float(stats["mu"])), lit(float(stats["sd"])), k)
    verdict = z
    for i, c in enumerate(iqr_cols):
        verdict = verdict | iqr_flag(F.col(c).cast("double"), quart[i], m)
    verdict = verdict | F.coalesce(F.col("data_quality_flag") != "CLEAN", F.lit(False))
    return df.withColumn("is_anomaly_detected", F.when(F.col(temp).isNotNull(), verdict))


def zscore_flags(fact: DataFrame, k: float = C.ZSCORE_K, temp: str = TEMP) -> DataFrame:
    rows = analysed(fact, temp)
    d = rows.withColumn("_st", detector_stats(rows, temp, iqr_cols=()))
    return d.select("telemetry_key", F.col(temp).alias("temperature_celsius"),
                    zscore_flag(F.col(temp).cast("double"), F.col("_st.mu"), F.col("_st.sd"), k).alias("z_flag"))


def iqr_flags(fact: DataFrame, cols=IQR_COLUMNS, m: float = C.IQR_MULTIPLIER, exact: bool = True,
              temp: str = TEMP) -> DataFrame:
    rows = analysed(fact, temp)
    d = rows.withColumn("_st", F.struct(*_quartile_columns(rows, cols, exact)))
    return d.select("telemetry_key", *[iqr_flag(F.col(c).cast("double"), F.col(f"_st.q{i}"), m)
                                       .alias(f"iqr_{c}_flag") for i, c in enumerate(cols)])


def refresh_anomaly_flags(fact: DataFrame, **kw) -> DataFrame:
    """Replace ``is_anomaly`` by the detector's verdict; rows not analysed keep theirs.

    Computed in place (statistics as a scalar subquery), so the fact is not
    joined to itself.
    """
    temp = kw.get("temp", TEMP)
    st = detector_stats(analysed(fact, temp), temp, kw.get("iqr_cols", IQR_COLUMNS), kw.get("exact", True))
    k, m = kw.get("k", C.ZSCORE_K), kw.get("m", C.IQR_MULTIPLIER)
    iqr_cols = kw.get("iqr_cols", IQR_COLUMNS)
    d = fact.withColumn("_st", st)
    verdict = (zscore_flag(F.col(temp).cast("double"), F.col("_st.mu"), F.col("_st.sd"), k)
               | iqr_flag(F.col(iqr_cols[0]).cast("double"), F.col("_st.q0"), m)
               | iqr_flag(F.col(iqr_cols[1]).cast("double"), F.col("_st.q1"), m)
               | F.coalesce(F.col("data_quality_flag") != "CLEAN", F.lit(False)))
    return (d.withColumn("is_anomaly", F.when(F.col(temp).isNotNull(), verdict).otherwise(F.col("is_anomaly")))
            .drop("_st"))


def apply_anomaly_flags(fact: DataFrame, flags: DataFrame, key: str = "telemetry_key",
                        flag: str = "is_anomaly_detected") -> DataFrame:
    """Apply externally computed flags by key; rows without a flag keep theirs.

    Both sides are keyed by the fact's primary key, so this is a shuffle
    join; adaptive execution turns it into a broadcast at runtime only if
    the flags turn out small (no extra pass to measure them up front).
    ``refresh_anomaly_flags`` avoids the join altogether.
    """
    f = flags.select(F.col(key).alias("_fk"), F.col(flag).alias("_flag"))
    out = fact.join(f, fact[key] == f["_fk"], "left")
    return out.withColumn("is_anomaly", F.coalesce(F.col("_flag"), F.col("is_anomaly"))).drop("_fk", "_flag")


def anomaly_report(fact: DataFrame, device: DataFrame, store: DataFrame, **kw) -> DataFrame:
    """Flagged readings with device and store attributes (the report's rows)."""
    flagged = composite_anomaly(fact, **kw).filter(F.col("is_anomaly_detected"))
    flagged = join_dim(flagged, device.select("device_key", "device_id"), "device_key")
    flagged = join_dim(flagged, store.select("store_key", "store_name", "region"), "store_key")
    return flagged.select("telemetry_key", "event_timestamp", "device_id", "store_name", "region",
                          "temperature_celsius", "power_draw_watts", "session_duration_secs",
                          "data_quality_flag", "anomaly_methods")


_COUNTS = ["records_analyzed", "anomalies", "zscore_flags", "iqr_power_flags", "iqr_session_flags",
           "quality_flags"]


def flag_counts(fact: DataFrame, **kw) -> DataFrame:
    """Detector verdicts counted per (device, store): the one pass every report reuses."""
    flags = composite_anomaly(fact, **kw)
    return (flags.groupBy("device_key", "store_key")
            .agg(F.count(F.lit(1)).alias("records_analyzed"),
                 count_true(F.col("is_anomaly_detected")).alias("anomalies"),
                 count_true(F.col("z_flag")).alias("zscore_flags"),
                 count_true(F.col("iqr_power_flag")).alias("iqr_power_flags"),
                 count_true(F.col("iqr_session_flag")).alias("iqr_session_flags"),
                 count_true(F.col("quality_flag")).alias("quality_flags")))


def _rates(counts: DataFrame, by: list[str]) -> DataFrame:
    return (counts.groupBy(*by).agg(F.sum("records_analyzed").alias("records_analyzed"),
                                    F.sum("anomalies").alias("anomalies"))
            .withColumn("anomaly_rate_pct", exact_pct(F.col("anomalies"), F.col("records_analyzed"))))


def _region_rates(counts: DataFrame, store: DataFrame) -> DataFrame:
    return _rates(join_dim(counts, store.select("store_key", "region"), "store_key"), ["region"])


def _device_rates(counts: DataFrame, device: DataFrame, store: DataFrame) -> DataFrame:
    per = join_dim(counts, device.select("device_key", "device_id"), "device_key")
    per = join_dim(per, store.select("store_key", "store_name"), "store_key")
    return _rates(per, ["device_key", "device_id", "store_name"]).drop("device_key")


def anomaly_rate_by_region(fact: DataFrame, store: DataFrame, **kw) -> DataFrame:
    return _region_rates(flag_counts(fact, **kw), store)


def anomaly_rate_by_device(fact: DataFrame, device: DataFrame, store: DataFrame, **kw) -> DataFrame:
    return _device_rates(flag_counts(fact, **kw), device, store)


def _worst(rates: DataFrame, name_cols: list[str]) -> Column:
    """Scalar: struct of the highest-rate row (ties: smallest names)."""
    order = F.struct((-F.col("anomaly_rate_pct")).alias("r"), *[F.col(c) for c in name_cols])
    pick = F.struct(*[F.col(c) for c in name_cols], F.col("anomaly_rate_pct"))
    return rates.select(F.min_by(pick, order)).scalar()


def anomaly_summary(fact: DataFrame, device: DataFrame, store: DataFrame, **kw) -> DataFrame:
    """One row: totals, per-method counts and the worst region and device.

    The detector runs once: its per-(device, store) counts (one row per
    device, small) are checkpointed to the shared checkpoint folder, and the
    totals and both rankings are aggregates of that table.
    """
    checkpoint_base(fact.sparkSession)
    counts = flag_counts(fact, **kw).checkpoint(eager=True)
    totals = counts.agg(*[F.sum(c).alias(c) for c in _COUNTS]).withColumnRenamed("anomalies", "anomalies_detected")
    region = _worst(_region_rates(counts, store), ["region"])
    dev = _worst(_device_rates(counts, device, store), ["device_id", "store_name"])
    return (totals
            .withColumn("anomaly_pct", exact_pct(F.col("anomalies_detected"), F.col("records_analyzed"), 1))
            .withColumn("_r", region).withColumn("_d", dev)
            .select("records_analyzed", "anomalies_detected", "anomaly_pct", "zscore_flags", "iqr_power_flags",
                    "iqr_session_flags", "quality_flags",
                    F.col("_r.region").alias("worst_region"),
                    F.col("_r.anomaly_rate_pct").alias("worst_region_pct"),
                    F.col("_d.device_id").alias("worst_device"),
                    F.col("_d.store_name").alias("worst_device_store"),
                    F.col("_d.anomaly_rate_pct").alias("worst_device_pct")))
