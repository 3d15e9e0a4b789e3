"""Fleet queries on the hand-computed micro-fixture (FIXTURES.md section 2)."""

from decimal import Decimal as Dec

from fleetstar.operators import fleet


def rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]


def test_high_risk_stores(micro):
    got = {r["store_id"]: r for r in fleet.high_risk_stores(micro.fact, micro.store).collect()}
    assert set(got) == {"S1", "S2", "S4"}
    s2 = got["S2"]
    assert (s2.total_readings, s2.spike_count, s2.spike_rate_pct) == (4, 3, Dec("75.00"))
    assert round(s2.avg_temp, 2) == Dec("223.34") and s2.max_temp_recorded == Dec("245.01")
    assert (got["S4"].spike_rate_pct, got["S4"].avg_temp, got["S4"].max_temp_recorded) == (
        Dec("50.00"), Dec("200.000000"), Dec("250.00"))
    assert (got["S1"].spike_rate_pct, got["S1"].avg_temp) == (Dec("25.00"), Dec("220.252500"))


def test_store_spike_ranking(micro):
    got = rows(fleet.store_spike_ranking(micro.fact, micro.store), "store_name", "region", "global_rank",
               "regional_rank")
    assert got == [("Beta", "APAC", 1, 1), ("Gamma", "POLAR", 2, 1), ("Alpha", "EMEA", 3, 1),
                   ("Alpha", "LATAM", 4, 1)]
    assert fleet.store_spike_ranking(micro.fact, micro.store, k=2).count() == 2


def test_mom_trend_by_store_name(micro):
    got = rows(fleet.mom_temp_trend(micro.fact, micro.store), "store_name", "region", "month_name", "avg_temp",
               "prev_month_temp", "mom_temp_change", "trend_status")
    assert got == [
        ("Alpha", "LATAM", "January", Dec("210.00"), Dec("217.00"), Dec("-7.00"), "COOLING"),
        ("Alpha", "EMEA", "February", Dec("230.00"), Dec("210.00"), Dec("20.00"), "WARMING"),
        ("Alpha", "LATAM", "February", Dec("212.00"), Dec("230.00"), Dec("-18.00"), "COOLING"),
        ("Beta", "APAC", "March", Dec("180.00"), Dec("245.01"), Dec("-65.01"), "COOLING"),
    ]


def test_mom_trend_by_store_key(micro):
    got = rows(fleet.mom_temp_trend(micro.fact, micro.store, key="store_key"), "region", "mom_temp_change",
               "trend_status")
    assert ("LATAM", Dec("2.00"), "STABLE") in got


def test_early_warning(micro):
    df = fleet.next_session_early_warning(micro.fact, micro.device, micro.store, k=10)
    got = [(r.temp_jump, r.early_warning.split(" ")[0]) for r in df.collect()]
    every = fleet.next_session_early_warning(micro.fact, micro.device, micro.store, k=None).collect()
    assert sorted(every) == sorted(df.collect())
    assert got == [(Dec("21.00"), "HIGH"), (Dec("9.01"), "SPIKE"), (Dec("2.00"), "NORMAL"),
                   (Dec("-0.01"), "NORMAL"), (Dec("-0.01"), "SPIKE"), (Dec("-65.00"), "NORMAL"),
                   (Dec("-100.00"), "NORMAL")]
    assert fleet.next_session_early_warning(micro.fact, micro.device, micro.store, k=3).count() == 3


def test_early_warning_tiny_buckets_equal(micro):
    a = fleet.next_session_early_warning(micro.fact, micro.device, micro.store, k=None).collect()
    b = fleet.next_session_early_warning(micro.fact, micro.device, micro.store, k=None, bucket_seconds=60).collect()
    assert sorted(a) == sorted(b)


def test_cumulative_spikes(micro):
    got = {(r.region, str(r.full_date)): (r.daily_spikes, r.cumulative_spikes, r.rolling_7day_avg)
           for r in fleet.cumulative_spikes(micro.fact, micro.store).collect()}
    assert got[("APAC", "2025-01-10")] == (1, 1, Dec("1.00"))
    assert got[("APAC", "2025-01-11")] == (2, 3, Dec("1.50"))
    assert got[("APAC", "2025-03-05")] == (0, 3, Dec("1.00"))
    assert got[("EMEA", "2025-01-10")] == (0, 0, Dec("0.00"))
    assert got[("EMEA", "2025-01-12")] == (1, 1, Dec("0.50"))
    assert got[("EMEA", "2025-02-01")] == (0, 1, Dec("0.33"))
    assert got[("POLAR", "2025-03-01")] == (1, 1, Dec("1.00"))
    assert got[("LATAM", "2025-02-10")] == (0, 0, Dec("0.00"))


def test_calendar_rolling_avg(micro):
    got = {(r.region, str(r.full_date)): r.calendar_7day_avg
           for r in fleet.calendar_rolling_avg(micro.fact, micro.store).collect()}
    # APAC: 1 spike on 01-10, 2 on 01-11 -> (1 + 2) / 7 on 01-11; 03-05 window holds no spikes.
    assert got[("APAC", "2025-01-11")] == Dec("0.43")
    assert got[("APAC", "2025-03-05")] == Dec("0.00")


def test_device_risk_quartiles(micro):
    got = rows(fleet.device_risk_quartiles(micro.fact, micro.device, micro.store), "device_id", "total_sessions",
               "avg_temp", "total_spikes", "spike_rate_pct", "risk_quartile")
    assert got == [("D2", 3, Dec("223.34"), 2, Dec("66.67"), 1), ("D4", 2, Dec("200.00"), 1, Dec("50.00"), 2),
                   ("D1", 4, Dec("220.25"), 1, Dec("25.00"), 3), ("D3", 2, Dec("211.00"), 0, Dec("0.00"), 4)]


def test_firmware_compliance(micro):
    got = rows(fleet.firmware_compliance(micro.fact, micro.device), "compliance_rank", "firmware_version",
               "device_count", "total_readings", "avg_temp", "total_spikes", "spike_rate_pct", "avg_power_watts",
               "compliance_status")
    assert [g[:8] for g in got] == [
        (1, "FW-A", 2, 7, Dec("221.57"), 3, Dec("42.86"), Dec("1534.29")),
        (2, "FW-B", 2, 4, Dec("205.50"), 1, Dec("25.00"), Dec("1661.25"))]
    assert all(g[8].startswith("FAILED") for g in got)


def test_device_health(micro):
    got = {r.device_id: r for r in fleet.device_health(micro.fact, micro.device, micro.store).collect()}
    assert got["D2"].total_sessions == 4 and got["D2"].dirty_record_count == 2
    assert got["D4"].avg_session_secs == 1150.0


def test_all_null_temperatures_give_null_means(spark, micro):
    # ANSI mode raises on division by zero; means over no values must be NULL instead.
    from pyspark.sql import functions as F

    only_missing = micro.fact.filter(F.col("telemetry_key") == 5)
    got = fleet.device_health(only_missing, micro.device, micro.store).collect()
    assert len(got) == 1 and got[0].avg_temp is None and got[0].total_sessions == 1
    hr = fleet.high_risk_stores(only_missing, micro.store).collect()
    assert hr[0].avg_temp is None and hr[0].spike_rate_pct == Dec("100.00")
