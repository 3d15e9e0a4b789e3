"""Registered queries: each builds its result from the driver's tables.

``QUERIES[name](spark, sf_dir)`` returns a DataFrame whose columns match
``fleetstar.oracle.ORACLE[name]``. Results are presented with portable types
(decimals as double, integral numbers as bigint).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetstar.operators import fleet
from fleetstar.session import app_id, scratch_path
from fleetstar.sources.profiles import event_star, orderline_star


def present(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType) or isinstance(f.dataType, T.FloatType):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("long")
        cols.append(c.alias(f.name))
    return df.select(*cols)


_stars: dict = {}


def _star(kind, spark: SparkSession, sf_dir: str, written: bool = True):
    """Session-scoped catalog: one star per profile and folder, written once to the shared folder and read from there."""
    key = (kind.__name__, id(spark), app_id(spark), sf_dir, written)
    hit = _stars.get(key)
    if hit is None or hit[0] is not spark:
        star = kind(spark, sf_dir)
        if written:
            path = scratch_path(spark, kind.__name__)
            M.write_star(star, path)
            star = M.read_star(spark, path)
        hit = (spark, star)
        _stars[key] = hit
    return hit[1]


def _p1(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return present(fn(_star(event_star, spark, sf_dir)))
    return run


def _p2(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        # An order line carries its store and part: nothing is gained by writing it again.
        return present(fn(_star(orderline_star, spark, sf_dir, written=False)))
    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "high_risk_stores": _p2(lambda s: fleet.high_risk_stores(s.fact, s.store)),
    "device_health": _p1(lambda s: fleet.device_health(s.fact, s.device, s.store)),
    "store_spike_ranking": _p2(lambda s: fleet.store_spike_ranking(s.fact, s.store)),
    "store_spike_ranking_all": _p2(lambda s: fleet.store_spike_ranking(s.fact, s.store, k=None)),
    "mom_temp_trend": _p2(lambda s: fleet.mom_temp_trend(s.fact, s.store)),
    "next_session_early_warning": _p1(lambda s: fleet.next_session_early_warning(s.fact, s.device, s.store)),
    "next_session_all": _p1(lambda s: fleet.next_session_early_warning(s.fact, s.device, s.store, k=None)),
    "cumulative_spikes": _p2(lambda s: fleet.cumulative_spikes(s.fact, s.store)),
    "cumulative_spikes_events": _p1(lambda s: fleet.cumulative_spikes(s.fact, s.store)),
    "calendar_rolling_avg": _p2(lambda s: fleet.calendar_rolling_avg(s.fact, s.store)),
    "device_risk_quartiles": _p1(lambda s: fleet.device_risk_quartiles(s.fact, s.device, s.store)),
    "firmware_compliance": _p2(lambda s: fleet.firmware_compliance(s.fact, s.device)),
}


# ---------------------------------------------------------------------------
# Alerts, anomalies, dashboards, quality, dimensions (events profile unless noted)
# ---------------------------------------------------------------------------

import datetime as dt  # noqa: E402

from fleetstar.operators import alerts as A  # noqa: E402
from fleetstar.operators import anomaly as N  # noqa: E402
from fleetstar.operators import carried as K  # noqa: E402
from fleetstar.operators import dashboards as D  # noqa: E402
from fleetstar.operators import dims as M  # noqa: E402
from fleetstar.operators import governance as G  # noqa: E402
from fleetstar.operators import polling as L  # noqa: E402
from fleetstar.operators import quality as Q  # noqa: E402
from fleetstar.operators import sketches as H  # noqa: E402
from fleetstar.operators import versions as V  # noqa: E402
from fleetstar import schemas as S  # noqa: E402
from fleetstar.oracle import CARD_FACT_COLUMNS, OUTBOX_RUN_TS, RETAIN_AS_OF  # noqa: E402
from fleetstar.sources import files  # noqa: E402
from fleetstar.sources.profiles import read_table, routing_table  # noqa: E402


def _routed(spark, s):
    routing, default = routing_table(spark)
    return A.route_alerts(A.critical_alerts(s.fact, s.device, s.store, s.alert, k=None), routing, default)


def _since(s):
    as_of = s.fact.select(F.max("event_timestamp")).scalar()
    return A.critical_alerts_since(s.fact, s.device, s.store, s.alert, as_of=as_of, minutes=7 * 24 * 60)


def _cards(spark, s):
    cards = A.alert_cards(_routed(spark, s))
    at = lambda path: F.get_json_object("card_json", f"$.attachments[0].{path}")
    facts = [at(f"content.body[1].facts[{i}].value").alias(c) for i, c in enumerate(CARD_FACT_COLUMNS)]
    return cards.select("telemetry_key",
                        F.get_json_object("card_json", "$.type").alias("message_type"),
                        at("contentType").alias("content_type"),
                        F.get_json_object("card_json", "$.attachments[0].content['$schema']").alias("card_schema"),
                        at("content.type").alias("card_type"), at("content.version").alias("card_version"),
                        at("content.body[0].text").alias("headline"), at("content.body[0].weight").alias("headline_weight"),
                        at("content.body[0].size").alias("headline_size"), at("content.body[0].color").alias("headline_color"),
                        F.json_array_length(at("content.body[1].facts")).cast("long").alias("fact_count"),
                        *facts,
                        at("content.body[2].text").alias("shutoff_text"), at("content.body[2].wrap").alias("shutoff_wrap"),
                        at("content.actions[0].type").alias("action_type"),
                        "manager_email")


def _p1s(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return present(fn(spark, _star(event_star, spark, sf_dir)))
    return run


def _device_sets(spark, sf_dir, s):
    """(registry so far, incoming devices): the devices that reported, then every customer's."""
    cols = ["device_key", "device_id", "store_key", "model_version", "firmware_version", "gdpr_masked"]
    seen = read_table(spark, sf_dir, "events").select(F.col("user_id").alias("device_key"))
    return s.device.join(seen, "device_key", "left_semi").select(*cols), s.device.select(*cols)


def _insert_if_absent(spark, sf_dir):
    s = _star(event_star, spark, sf_dir)
    target, incoming = _device_sets(spark, sf_dir, s)
    return present(M.insert_if_absent(target, incoming, "device_id"))


def _assign_keys(spark, sf_dir):
    s = _star(event_star, spark, sf_dir)
    target, incoming = _device_sets(spark, sf_dir, s)
    fresh = M.new_rows(target, incoming, "device_id")
    top = target.select(F.max("device_key")).scalar()
    keyed = M.assign_surrogate_keys(fresh, top, "new_device_key", [("device_id", True), ("device_key", True)])
    return present(keyed.select("device_id", "new_device_key"))


def _csv_round_trip(spark, df: DataFrame, schema=None) -> DataFrame:
    """Write as CSV to the shared folder and read it back with its explicit schema."""
    path = scratch_path(spark, "csv")
    files.write_csv(df, path)
    return files.read_csv(spark, path, schema or df.schema)


def _good_devices(spark, sf_dir, s):
    """Devices of accounts in good standing."""
    good = (read_table(spark, sf_dir, "customer").filter(F.col("c_acctbal") >= 0)
            .select(F.col("c_custkey").alias("device_key")))
    return s.device.join(good, "device_key", "left_semi").select(*s.device.columns)


def _append_facts(spark, sf_dir):
    """Load all readings twice under one name and once more under another; what arrived, read back."""
    s = _star(event_star, spark, sf_dir)
    path, rejects = scratch_path(spark, "facts"), scratch_path(spark, "fact-rejects")
    device = _good_devices(spark, sf_dir, s)
    for load in ("load-1", "load-1", "load-2"):
        M.append_facts(s.fact, path, rejects, load, device)
    return present(spark.read.parquet(path).select("load", F.lit("valid").alias("outcome"))
                   .unionByName(spark.read.parquet(rejects).select("load", F.col("reject_reason").alias("outcome")))
                   .groupBy("load", "outcome").agg(F.count(F.lit(1)).alias("readings")))


def _dealt(df: DataFrame, n: int, *key: str) -> list[DataFrame]:
    """All rows in ``n`` loads, as a hash of their key deals them."""
    return [df.where(F.pmod(F.xxhash64(*key), F.lit(n)) == i) for i in range(n)]


def _poll_alerts(spark, sf_dir):
    """Five polls over the readings' arrival; after the third's rows were written its commit fails, and it is made again."""
    s = _star(event_star, spark, sf_dir)
    lo, hi = s.fact.agg(F.min("ingestion_timestamp"), F.max("ingestion_timestamp")).first()
    consumer = L.AlertPoll(spark, scratch_path(spark, "polls"), "desk", overlap_minutes=24 * 60)
    for step in range(1, 6):
        upto = hi + dt.timedelta(seconds=1) if step == 5 else lo + (hi - lo) * step / 5
        if step == 3:
            consumer.collect(s.fact, s.device, s.store, s.alert, upto - (hi - lo) / 10)
        consumer.poll(s.fact, s.device, s.store, s.alert, upto)
    return present(consumer.delivered().select(*A.SINCE_COLUMNS))


def _flags_versioned(spark, sf_dir):
    """The detector's flags applied to a fact of daily parts as a new version."""
    s = _star(event_star, spark, sf_dir)
    fact = V.VersionedFact(spark, scratch_path(spark, "versions"), parts="yyyy-MM-dd")
    fact.write(s.fact)
    fact.update_flags(N.composite_anomaly(s.fact))
    return present(fact.read().select("telemetry_key", "is_anomaly"))


def _delta_loads(spark, sf_dir):
    """Readings in four loads without regard to time, so most come late; one load is made twice."""
    s = _star(event_star, spark, sf_dir)
    deltas = K.CarriedDeltas(spark, scratch_path(spark, "deltas"))
    for i, load in enumerate(_dealt(s.fact, 4, "telemetry_key")):
        deltas.add(load, i)
        if i == 2:
            deltas.add(load, i)
    return present(deltas.read())


_extracts: dict = {}


def _extract(spark, sf_dir, kind):
    """The dashboards' sums, taken in by three loads of which one is made twice."""
    s = _star(kind, spark, sf_dir, written=kind is event_star)
    key = (kind.__name__, id(spark), app_id(spark), sf_dir)
    if key not in _extracts:
        state = K.ExtractState(spark, scratch_path(spark, "extract"))
        loads = _dealt(s.fact, 3, "telemetry_key")
        for name, i in (("a", 0), ("b", 1), ("b", 1), ("c", 2)):
            state.add(loads[i], name)
        _extracts[key] = state
    return _extracts[key], s


def _from_extract(fn, kind=event_star):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return present(fn(*_extract(spark, sf_dir, kind)))
    return run


def _column_sketches(spark, s):
    """Exact counts, and whether the estimate united from daily sketches lies within the stated error."""
    path = scratch_path(spark, "column-sketches")
    rows = s.fact.select(*S.FACT_COLUMNS)
    H.store_column_sketches(rows, F.to_date("event_timestamp").cast("string"), path)
    found = H.merged_profile(spark, path).select("column_name", "distinct_estimate")
    exact = Q.column_profile(rows, exact=True).drop("data_type").join(found, "column_name")
    off = F.abs(F.col("distinct_estimate") - F.col("distinct_count"))
    return exact.withColumn("within_error", off <= H.HLL_ERROR * F.col("distinct_count")).drop("distinct_estimate")


def _quantile_sketches(spark, s):
    """Whether quartiles united from daily sketches have a true rank within the stated error."""
    path, columns = scratch_path(spark, "quantile-sketches"), [N.TEMP, *N.IQR_COLUMNS]
    H.store_quantile_sketches(s.fact, columns, F.to_date("event_timestamp").cast("string"), path)
    errors = H.rank_errors(s.fact, H.merged_quantiles(spark, path, (0.25, 0.5, 0.75)), columns)
    return errors.select("column_name", "prob", (F.col("rank_error") <= H.KLL_RANK_ERROR).alias("within_error"))


def _csv_quarantine(spark, s):
    """The extract as lines, of which some are cut, lengthened or hold a word for a number; rows and rejects counted."""
    flat = D.telemetry_export(s.fact, s.store, s.device, s.alert)
    damage = F.pmod("telemetry_key", F.lit(40))
    texts = [F.when(damage == 7, "warm").otherwise(F.col(c).cast("string")).alias(c) if c == "temperature_celsius" else F.col(c) for c in flat.columns]
    line = F.to_csv(F.struct(*texts), {"timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"})
    line = F.when(damage == 3, F.regexp_replace(line, ",[^,]*,[^,]*$", "")).when(damage == 11, F.concat(line, F.lit(",more,still more"))).otherwise(line)
    path = scratch_path(spark, "lines")
    flat.select(line.alias("value")).write.text(path)
    rows, rejects = files.read_csv_quarantined(spark, path, header=False)
    return (rows.select(F.lit("valid").alias("outcome")).unionByName(rejects.select(F.col("reason").alias("outcome")))
            .groupBy("outcome").agg(F.count(F.lit(1)).alias("lines")))


def _fiscal_periods(spark, sf_dir):
    s = _star(orderline_star, spark, sf_dir)
    return present(fleet.fiscal_period_health(s.fact, s.date))


def _constraints_broken(spark, sf_dir):
    """The rules over tables that break them: devices missing or doubled, a calendar that ends early."""
    s = _star(event_star, spark, sf_dir)
    rich = (read_table(spark, sf_dir, "customer").filter(F.col("c_acctbal") >= 9000)
            .select(F.col("c_custkey").alias("device_key")))
    device = _good_devices(spark, sf_dir, s).unionByName(s.device.join(rich, "device_key", "left_semi").select(*s.device.columns))
    return present(Q.check_constraints({"fact": s.fact, "store": s.store, "device": device, "alert": s.alert,
                                        "date": M.date_dimension(spark, "2024-01-01", "2024-01-15")}))


QUERIES.update({
    "critical_alerts": _p1(lambda s: A.critical_alerts(s.fact, s.device, s.store, s.alert)),
    "critical_alerts_all": _p1(lambda s: A.critical_alerts(s.fact, s.device, s.store, s.alert, k=None)),
    "critical_alerts_nulls_first": _p1(lambda s: A.critical_alerts(s.fact, s.device, s.store, s.alert,
                                                                   nulls="first")),
    "critical_alerts_since": _p1(_since),
    "routed_alerts": _p1s(lambda spark, s: _routed(spark, s).select(*A.ALERT_COLUMNS, "manager_name",
                                                                    "manager_email", "manager_handle")),
    "alert_cards": _p1s(_cards),
    "email_rows": _p1s(lambda spark, s: A.email_rows(_routed(spark, s))),
    "notification_outbox": _p1s(lambda spark, s: A.notification_outbox(_routed(spark, s), OUTBOX_RUN_TS)),
    "retain_alert_log": _p1(lambda s: A.retain(A.critical_alerts(s.fact, s.device, s.store, s.alert, k=None),
                                                "event_timestamp", months=1, as_of=RETAIN_AS_OF)),
    "alert_actions": _p1(lambda s: A.alert_actions(s.fact, s.alert)),
    "zscore_flags": _p1(lambda s: N.zscore_flags(s.fact)),
    "iqr_flags": _p1(lambda s: N.iqr_flags(s.fact)),
    "composite_anomaly": _p1(lambda s: N.composite_anomaly(s.fact).select(
        "telemetry_key", "z_flag", "iqr_power_flag", "iqr_session_flag", "quality_flag", "is_anomaly_detected",
        "anomaly_methods")),
    "refresh_anomaly_flags": _p1(lambda s: N.refresh_anomaly_flags(s.fact).select("telemetry_key", "is_anomaly")),
    "apply_anomaly_flags": _p1(lambda s: N.apply_anomaly_flags(s.fact, N.composite_anomaly(s.fact)).select(
        "telemetry_key", "is_anomaly")),
    "anomaly_report": _p1(lambda s: N.anomaly_report(s.fact, s.device, s.store)),
    "anomaly_rate_by_region": _p1(lambda s: N.anomaly_rate_by_region(s.fact, s.store)),
    "anomaly_rate_by_device": _p1(lambda s: N.anomaly_rate_by_device(s.fact, s.device, s.store)),
    "anomaly_summary": _p1(lambda s: N.anomaly_summary(s.fact, s.device, s.store)),
    "telemetry_export": _p1(lambda s: D.telemetry_export(s.fact, s.store, s.device, s.alert)),
    "telemetry_export_csv": _p1s(lambda spark, s: _csv_round_trip(
        spark, D.telemetry_export(s.fact, s.store, s.device, s.alert), files.FLAT_CSV_SCHEMA)),
    "anomaly_report_csv": _p1s(lambda spark, s: _csv_round_trip(spark, N.anomaly_report(s.fact, s.device, s.store))),
    "spike_rate_map": _p1(lambda s: D.spike_rate_map(D.store_totals(s.fact, s.store))),
    "monthly_operational_health": _p2(lambda s: D.monthly_operational_health(D.with_date(s.fact))),
    "monthly_operational_health_by_year": _p2(lambda s: D.monthly_operational_health(D.with_date(s.fact), by_year=True)),
    "store_vs_global": _p1(lambda s: D.store_vs_global(D.store_totals(s.fact, s.store))),
    "country_city_drill": _p1(lambda s: D.country_city_drill(D.store_totals(s.fact, s.store))),
    "load_summary": _p1(lambda s: G.load_summary(s.fact)),
    "classify_alerts": _p1(lambda s: Q.classify_alert(Q.spike_flag(s.fact), crit=150).select(
        "telemetry_key", "spike_recomputed", "alert_type_key_derived")),
    "quality_flag_audit": _p1(lambda s: Q.quality_flag_audit(s.fact)),
    "temp_delta": _p1(lambda s: Q.temp_delta(s.fact).select("telemetry_key", "temp_delta_derived")),
    "conform_fact": _p1(lambda s: Q.conform_schema(s.fact, S.FACT)),
    "column_profile": _p1(lambda s: Q.column_profile(s.fact.select(*S.FACT_COLUMNS), exact=True)
                          .drop("data_type")),
    "quality_breakdown": _p1(lambda s: Q.quality_breakdown(s.fact, s.store, by="store")),
    "quality_breakdown_device": _p1(lambda s: Q.quality_breakdown(s.fact, s.store, s.device, by="device")),
    "quality_breakdown_firmware": _p1(lambda s: Q.quality_breakdown(s.fact, s.store, s.device, by="firmware")),
    "quality_breakdown_month": _p2(lambda s: Q.quality_breakdown(s.fact, s.store, by="month")),
    "gdpr_report": _p1(lambda s: G.gdpr_report(s.fact, s.device, s.store)),
    "gdpr_report_by_region": _p1(lambda s: G.gdpr_report(s.fact, s.device, s.store, by="region")),
    "check_constraints": _p1(lambda s: Q.check_constraints(
        {"fact": s.fact, "store": s.store, "device": s.device, "alert": s.alert,
         "date": s.date})),
    "check_constraints_broken": _constraints_broken,
    "append_facts": _append_facts,
    "poll_alerts": _poll_alerts,
    "anomaly_flags_versioned": _flags_versioned,
    "temp_delta_loads": _delta_loads,
    "column_sketches": _p1s(_column_sketches),
    "quantile_sketches": _p1s(_quantile_sketches),
    "csv_quarantine": _p1s(_csv_quarantine),
    "fiscal_period_health": _fiscal_periods,
    "spike_rate_map_loads": _from_extract(lambda x, s: D.spike_rate_map(x.store_totals(s.store))),
    "store_vs_global_loads": _from_extract(lambda x, s: D.store_vs_global(x.store_totals(s.store))),
    "country_city_drill_loads": _from_extract(lambda x, s: D.country_city_drill(x.store_totals(s.store))),
    "monthly_operational_health_loads": _from_extract(lambda x, s: x.monthly_health(), orderline_star),
    "date_dimension": _p2(lambda s: M.date_dimension_covering(s.fact)),
    "insert_if_absent": _insert_if_absent,
    "assign_surrogate_keys": _assign_keys,
})


# ---------------------------------------------------------------------------
# Streaming: drain the file source once (availableNow) and read the sink back
# ---------------------------------------------------------------------------

from fleetstar import streaming as ST  # noqa: E402


def _stream_outbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    outbox, ckpt = scratch_path(spark, "outbox"), scratch_path(spark, "outbox-ckpt")
    ST.run_alert_outbox(spark, sf_dir, sf_dir, outbox, ckpt, glob="events.parquet")
    return present(spark.read.parquet(outbox).select(
        "telemetry_key", "store", "device", "temperature", "region", "manager", "status"))


def _stream_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, ckpt = scratch_path(spark, "alert-counts"), scratch_path(spark, "alert-counts-ckpt")
    ST.run_alert_window_counts(spark, sf_dir, sf_dir, out, ckpt, glob="events.parquet")
    ST.reconcile_window_counts(spark, out)
    return present(ST.window_counts(spark, out))


def _stream_counts_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last third of the readings arrives first, so the others' alerts are late for their windows; corrected afterwards."""
    out, ckpt, landing = (scratch_path(spark, n) for n in ("late-counts", "late-counts-ckpt", "landing"))
    events = read_table(spark, sf_dir, "events")
    lo, hi = events.agg(F.min("ts"), F.max("ts")).first()
    one, two = ((F.lit(lo + (hi - lo) * k / 3).cast("timestamp_ntz")) for k in (1, 2))
    for part in (F.col("ts") >= two, F.col("ts") < one, (F.col("ts") >= one) & (F.col("ts") < two)):
        events.where(part).write.mode("append").parquet(landing)
        ST.run_alert_window_counts(spark, landing, sf_dir, out, ckpt)
    ST.reconcile_window_counts(spark, out)
    return present(ST.window_counts(spark, out))


QUERIES.update({
    "stream_alert_outbox": _stream_outbox,
    "stream_alert_window_counts": _stream_counts,
    "stream_window_counts_late": _stream_counts_late,
})
