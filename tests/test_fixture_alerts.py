"""Alerts, anomaly detector, dashboards and quality rules on the micro-fixture."""

import json
from decimal import Decimal as Dec

from pyspark.sql import functions as F

from fleetstar.operators import alerts as A
from fleetstar.operators import anomaly as N
from fleetstar.operators import dashboards as D
from fleetstar.operators import governance as G
from fleetstar.operators import quality as Q


def test_critical_alerts_null_order(micro):
    last = [r.telemetry_key for r in A.critical_alerts(micro.fact, micro.device, micro.store, micro.alert).collect()]
    first = [r.telemetry_key for r in
             A.critical_alerts(micro.fact, micro.device, micro.store, micro.alert, nulls="first").collect()]
    assert last == [11, 6, 5] and first == [5, 11, 6]


def test_codes_none_means_all_notifying(micro):
    got = A.critical_alerts(micro.fact, micro.device, micro.store, micro.alert, codes=None, k=None)
    assert sorted(r.telemetry_key for r in got.collect()) == [5, 6, 11]


def test_route_cards_email_outbox(micro, micro_routing):
    routing, default = micro_routing
    alerts = A.critical_alerts(micro.fact, micro.device, micro.store, micro.alert, k=None)
    routed = A.route_alerts(alerts, routing, default)
    managers = {r.telemetry_key: r.manager_name for r in routed.collect()}
    assert managers == {11: "Ops Desk", 5: "Bo Example", 6: "Bo Example"}
    cards = {r.telemetry_key: json.loads(r.card_json) for r in A.alert_cards(routed).collect()}
    attachment = cards[11]["attachments"][0]
    assert cards[11]["type"] == "message" and attachment["contentType"] == "application/vnd.microsoft.card.adaptive"
    content = {k: c["attachments"][0]["content"] for k, c in cards.items()}
    assert content[11]["$schema"].endswith("/adaptive-card.json") and content[11]["type"] == "AdaptiveCard"
    assert content[11]["body"][0] == {"type": "TextBlock", "text": "CRITICAL THERMAL ALERT", "weight": "Bolder",
                                      "size": "Large", "color": "Attention"}
    assert content[11]["body"][2]["wrap"] is True and content[11]["actions"][0]["type"] == "Action.OpenUrl"
    facts = {f["title"]: f["value"] for f in content[11]["body"][1]["facts"]}
    assert list(facts)[0] == "Store" and len(facts) == 11
    assert facts["Overage"] == "+20.00°C above safety limit"
    assert facts["Assigned To"] == "Ops Desk (@ops)"
    null_facts = {f["title"]: f["value"] for f in content[5]["body"][1]["facts"]}
    assert null_facts["Overage"].startswith("+N/A")
    mails = {r.telemetry_key: r for r in A.email_rows(routed).collect()}
    assert mails[6].subject == "[CRITICAL] Thermal Alert — Beta — D2"
    assert mails[6].recipient == "bo@example.com" and "Overage: +15.01" in mails[6].body
    out = A.notification_outbox(routed, "2025-04-01 00:00:00").collect()
    assert {r.status for r in out} == {"PENDING"} and len(out) == 3


def test_since_and_actions_and_retain(micro):
    since = A.critical_alerts_since(micro.fact, micro.device, micro.store, micro.alert,
                                    as_of="2025-03-01 08:10:00", minutes=15)
    assert [r.telemetry_key for r in since.collect()] == [11]
    acts = {r.telemetry_key: r for r in A.alert_actions(micro.fact, micro.alert).collect()}
    assert str(acts[6].sla_due_ts) == "2025-01-11 08:05:00" and acts[6].auto_shutoff
    assert str(acts[3].sla_due_ts) == "2025-01-12 10:15:00" and not acts[3].notifies_regional
    kept = A.retain(micro.fact, "event_timestamp", months=1, as_of="2025-03-15 00:00:00")
    assert sorted(r.telemetry_key for r in kept.collect()) == [8, 11, 12]


def test_anomaly_detector(micro):
    flags = {r.telemetry_key: r for r in N.composite_anomaly(micro.fact).collect()}
    assert len(flags) == 11 and not any(r.z_flag for r in flags.values())
    assert {k for k, r in flags.items() if r.iqr_power_flag} == {12}
    assert {k for k, r in flags.items() if r.iqr_session_flag} == {12}
    assert {k for k, r in flags.items() if r.is_anomaly_detected} == {8, 12}
    assert flags[12].anomaly_methods == "IQR_POWER,IQR_SESSION,QUALITY"
    z2 = {r.telemetry_key for r in N.composite_anomaly(micro.fact, k=2).collect() if r.z_flag}
    assert z2 == {12}
    approx = {r.telemetry_key for r in N.composite_anomaly(micro.fact, exact=False).collect() if r.is_anomaly_detected}
    assert 12 in approx
    for r in flags.values():
        assert r.is_anomaly_detected == (r.z_flag or r.iqr_power_flag or r.iqr_session_flag or r.quality_flag)


def test_refresh_and_apply_flags(micro):
    refreshed = {r.telemetry_key: r.is_anomaly for r in N.refresh_anomaly_flags(micro.fact).collect()}
    assert {k for k, v in refreshed.items() if v} == {8, 12} and refreshed[5] is False
    flags = N.composite_anomaly(micro.fact)
    applied = {r.telemetry_key: r.is_anomaly for r in N.apply_anomaly_flags(micro.fact, flags).collect()}
    assert applied == refreshed


def test_anomaly_summary(micro):
    s = N.anomaly_summary(micro.fact, micro.device, micro.store).collect()[0]
    assert (s.records_analyzed, s.anomalies_detected, s.zscore_flags, s.quality_flags) == (11, 2, 0, 2)
    assert s.worst_region == "POLAR" and s.worst_device == "D4"
    rep = N.anomaly_report(micro.fact, micro.device, micro.store)
    assert sorted(r.telemetry_key for r in rep.collect()) == [8, 12]


def test_dashboards(micro):
    flat = D.telemetry_export(micro.fact, micro.store, micro.device, micro.alert)
    assert flat.count() == 12 and len(flat.columns) == 30
    months = {r.month_number: (round(r.avg_temp, 2), round(r.avg_session_secs, 2))
              for r in D.monthly_operational_health(flat).collect()}
    assert months == {1: (Dec("225.17"), 374.29), 2: (Dec("221.00"), 420.0), 3: (Dec("193.33"), 913.33)}
    diffs = {r.store_name: round(r.store_vs_global_diff, 2) for r in D.store_vs_global(flat).collect()}
    assert diffs == {"Beta": Dec("7.61"), "Alpha": Dec("1.44"), "Gamma": Dec("-15.73")}
    by_key = {r.store_key: round(r.store_vs_global_diff, 2)
              for r in D.store_vs_global(flat, key="store_key").collect()}
    assert by_key == {2: Dec("7.61"), 1: Dec("4.52"), 3: Dec("-4.73"), 4: Dec("-15.73")}
    drill = D.country_city_drill(flat).collect()
    total = [r for r in drill if r.level == 3][0]
    assert total.readings == 12 and total.spikes == 5
    m = {r.city: r.store_name for r in D.spike_rate_map(flat).collect()}
    assert m["Paris"] == "Alpha"


def test_quality_rules(micro):
    assert [r.telemetry_key for r in Q.quality_flag_audit(micro.fact).collect()] == [5]
    cls = {r.telemetry_key: r.alert_type_key_derived for r in Q.classify_alert(micro.fact).collect()}
    assert (cls[3], cls[6], cls[7], cls[11], cls[5]) == (2, 1, 2, 1, 1)
    s = G.load_summary(micro.fact).collect()[0]
    assert (s.total_rows, s.thermal_spikes, s.dirty_records) == (12, 5, 3)
    d = {r.telemetry_key: r.temp_delta_derived for r in Q.temp_delta(micro.fact).collect()}
    assert d[1] is None and d[2] == Dec("21.00") and d[5] is None and d[6] is None and d[7] == Dec("-0.01")


def test_temp_delta_buckets_equal(micro):
    a = sorted(Q.temp_delta(micro.fact).select("telemetry_key", "temp_delta_derived").collect())
    b = sorted(Q.temp_delta(micro.fact, bucket_seconds=60).select("telemetry_key", "temp_delta_derived").collect())
    assert a == b


def test_gdpr_and_breakdown(micro):
    g = {r.store_name + r.region: r for r in G.gdpr_report(micro.fact, micro.device, micro.store).collect()}
    assert g["BetaAPAC"].masked_devices == 1 and g["BetaAPAC"].non_compliant == 0
    b = Q.quality_breakdown(micro.fact, micro.store, by="store").filter(F.col("store_key") == 2).collect()
    assert {r.data_quality_flag: r.share_pct for r in b} == {"MISSING": Dec("25.00"), "CLEAN": Dec("50.00"),
                                                            "NOISY": Dec("25.00")}
    assert Q.quality_breakdown(micro.fact, micro.store, by="month").count() > 0


def test_since_prunes_month_partitions(spark, micro, tmp_dir):
    from fleetstar.operators import dims as M

    M.write_star(micro, f"{tmp_dir}/star")
    star = M.read_star(spark, f"{tmp_dir}/star")
    df = A.critical_alerts_since(star.fact, star.device, star.store, star.alert,
                                 as_of="2025-03-01 08:10:00", minutes=15)
    assert [r.telemetry_key for r in df.collect()] == [11]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(reading_month" in plan and "2025-03" in plan


def test_batch_outbox_append(spark, micro, micro_routing, tmp_dir):
    routing, default = micro_routing
    routed = A.route_alerts(A.critical_alerts(micro.fact, micro.device, micro.store, micro.alert, k=None),
                            routing, default)
    rows = A.notification_outbox(routed.withColumn("event_day", F.to_date("event_timestamp")),
                                 "2025-04-01 00:00:00", keep=("event_day",))
    A.append_outbox(rows, f"{tmp_dir}/outbox", "nightly", 1)
    A.append_outbox(rows, f"{tmp_dir}/outbox", "nightly", 1)
    A.append_outbox(rows, f"{tmp_dir}/outbox", "nightly", 2)
    assert spark.read.parquet(f"{tmp_dir}/outbox").count() == 3


def test_zero_temperature_is_a_number(spark, micro, micro_routing):
    routing, default = micro_routing
    zero = micro.fact.filter("telemetry_key = 11").withColumn("temperature_celsius", F.lit(0).cast("decimal(5,2)"))
    routed = A.route_alerts(A.critical_alerts(zero, micro.device, micro.store, micro.alert, k=None), routing, default)
    card = json.loads(A.alert_cards(routed).collect()[0].card_json)
    facts = {f["title"]: f["value"] for f in card["attachments"][0]["content"]["body"][1]["facts"]}
    assert facts["Temperature"].startswith("0.00°C") and facts["Overage"].startswith("+-230.00")


def test_frozen_stats_match_live_detector(spark, micro):
    stats = N.frozen_stats(micro.fact)
    live = {r.telemetry_key: r.is_anomaly_detected for r in N.composite_anomaly(micro.fact).collect()}
    frozen = {r.telemetry_key: r.is_anomaly_detected
              for r in N.flag_with_stats(micro.fact, stats).collect() if r.is_anomaly_detected is not None}
    assert live == frozen
