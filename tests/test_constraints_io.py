"""Constraint violations, schema conformance, ingest and file round trips."""

import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from fleetstar import schemas as S
from fleetstar.operators import dashboards as D
from fleetstar.operators import dims as M
from fleetstar.operators import governance as G
from fleetstar.operators import quality as Q
from fleetstar.sources import files
from fleetstar.sources.profiles import Star

from tests.conftest import DEVICES, READINGS, STORES, fact_rows


def _violations(spark, star):
    rows = Q.check_constraints({"fact": star.fact, "store": star.store, "device": star.device,
                                "alert": star.alert}).collect()
    return {r.rule: r.violations for r in rows}


def test_clean_fixture_has_no_violations(spark, micro):
    v = _violations(spark, micro)
    assert v and all(n == 0 for n in v.values()), {k: n for k, n in v.items() if n}


def test_negative_inputs_are_reported(spark, micro):
    devices = DEVICES + [(5, "D1", 1, "v1", "FW-A", dt.date(2024, 6, 1), dt.date(2027, 6, 1), True, False)]
    facts = fact_rows(READINGS)
    bad_store = list(facts[0]); bad_store[0] = 100; bad_store[3] = 99          # unknown store
    moved = list(facts[1]); moved[0] = 101; moved[3] = 2                       # store differs from device's
    bad_flag = list(facts[2]); bad_flag[0] = 102; bad_flag[15] = "BAD"         # outside the domain
    no_ts = list(facts[3]); no_ts[0] = 103; no_ts[5] = None                    # NULL event time
    schema = S.FACT.__class__([f.__class__(f.name, f.dataType, True) for f in S.FACT.fields])
    fact = spark.createDataFrame(facts + [tuple(bad_store), tuple(moved), tuple(bad_flag), tuple(no_ts)], schema)
    star = Star(fact=fact, store=spark.createDataFrame(STORES, S.STORE),
                device=spark.createDataFrame(devices, S.DEVICE), alert=micro.alert)
    v = _violations(spark, star)
    assert v["device.duplicate.device_id"] == 1
    assert v["fact.orphan.store_key"] == 1
    assert v["fact.store_matches_device"] == 2
    assert v["fact.domain.data_quality_flag"] == 1
    assert v["fact.not_null.event_timestamp"] == 1


def test_conform_schema_widens_and_fails_loudly(spark):
    long_label = spark.createDataFrame([("FY2026-Q1-EXTRA",)], "fiscal_period string")
    assert Q.conform_schema(long_label, S.DATE).columns == [f.name for f in S.DATE.fields]
    big = spark.createDataFrame([(Decimal("1234.56"),)], "temperature_celsius decimal(10,2)")
    assert Q.conform_schema(big, S.FACT, safe=True).collect()[0].temperature_celsius is None
    with pytest.raises(Exception):
        Q.conform_schema(big, S.FACT).collect()
    long_fp = spark.createDataFrame([(1, "FY2026-Q1-EXTRA")], "date_key int, fiscal_period string")
    rules = Q.check_constraints({"date": long_fp}, [Q.Rule("max_length", "date", "fiscal_period", 12)]).collect()
    assert rules[0].violations == 1


def test_insert_if_absent_existing_wins(spark):
    target = spark.createDataFrame(STORES, S.STORE)
    changed = list(STORES[0]); changed[3] = "Lyon"
    new = (9, "S9", "Delta", "Oslo", None, "Norway", "EMEA", "Outlet", dt.date(2021, 1, 1), True)
    incoming = spark.createDataFrame([tuple(changed), new, new], S.STORE)
    out = M.insert_if_absent(target, incoming, "store_id")
    rows = {r.store_id: r.city for r in out.collect()}
    assert len(rows) == 5 and out.count() == 5 and rows["S1"] == "Paris" and rows["S9"] == "Oslo"


def test_surrogate_keys_dense_after_max(spark):
    new = spark.createDataFrame([("S9",), ("S7",), ("S8",)], "store_id string")
    keyed = M.assign_surrogate_keys(new, 4, "store_key", [("store_id", True)])
    assert sorted((r.store_id, r.store_key) for r in keyed.collect()) == [("S7", 5), ("S8", 6), ("S9", 7)]
    facts = M.assign_fact_keys(new, 1000)
    assert facts.select("telemetry_key").distinct().count() == 3


def test_date_dimension(spark):
    d = M.date_dimension(spark, "2024-01-01", "2026-12-31")
    assert d.count() == 1096
    r = {x.full_date: x for x in d.filter(F.col("full_date").isin(
        dt.date(2024, 12, 30), dt.date(2026, 1, 3))).collect()}
    assert r[dt.date(2024, 12, 30)].week_number == 1 and r[dt.date(2024, 12, 30)].day_number == 1
    assert r[dt.date(2026, 1, 3)].is_weekend and r[dt.date(2026, 1, 3)].fiscal_period == "FY2026-Q1"
    assert r[dt.date(2026, 1, 3)].date_key == 20260103 and r[dt.date(2026, 1, 3)].day_of_week == "Saturday"


def test_csv_round_trip_and_ingest(spark, micro, tmp_dir):
    flat = D.telemetry_export(micro.fact, micro.store, micro.device, micro.alert)
    files.write_csv(flat, f"{tmp_dir}/flat")
    back = files.read_csv(spark, f"{tmp_dir}/flat")
    assert back.count() == 12 and back.columns == S.FLAT_COLUMNS
    assert back.filter(F.col("alert_code").isNull()).count() == 7
    files.write_parquet(back, f"{tmp_dir}/extract", partition_by=["year"])   # columnar copy of the CSV
    assert spark.read.parquet(f"{tmp_dir}/extract").count() == 12

    path, rejects = f"{tmp_dir}/fact", f"{tmp_dir}/rejects"
    for _ in range(2):  # a load that is run again replaces itself
        M.append_facts(micro.fact, path, rejects, "monday", micro.device)
    stored = spark.read.parquet(path)
    assert stored.count() == 12 and "reading_month" in stored.columns
    assert stored.filter(F.col("ingestion_timestamp") == F.col("event_timestamp")).count() == 0


def test_append_keeps_every_rejected_row(spark, micro, tmp_dir):
    path, rejects = f"{tmp_dir}/fact", f"{tmp_dir}/rejects"
    M.append_facts(micro.fact.where("telemetry_key <= 3"), path, rejects, "first", micro.device)
    bad = (micro.fact.where("telemetry_key > 10").unionByName(micro.fact.where("telemetry_key = 12"))
           .unionByName(micro.fact.where("telemetry_key = 2"))
           .unionByName(micro.fact.where("telemetry_key = 4").withColumn("device_key", F.lit(99).cast("long")))
           .unionByName(micro.fact.where("telemetry_key = 5").withColumn("data_quality_flag", F.lit("ODD")))
           .unionByName(micro.fact.where("telemetry_key = 6").withColumn("event_timestamp", F.lit(None).cast("timestamp_ntz"))))
    M.append_facts(bad, path, rejects, "second", micro.device)
    assert spark.read.parquet(path).count() == 5
    reasons = sorted(r.reject_reason for r in spark.read.parquet(rejects).collect())
    assert reasons == ["duplicate key", "event_timestamp is null", "key already loaded", "unknown device", "unknown quality flag"]
    with pytest.raises(ValueError, match="absent"):
        M.append_facts(micro.fact.select("telemetry_key", "device_key"), path, rejects, "third")


def test_star_materialise_and_versions(spark, micro, tmp_dir):
    M.write_star(micro, f"{tmp_dir}/star")
    star = M.read_star(spark, f"{tmp_dir}/star")
    assert star.fact.count() == 12 and sorted(os.listdir(f"{tmp_dir}/star")) == ["alert", "date", "device", "fact", "store"]
    pruned = star.fact.filter(F.col("reading_month") == "2025-02")
    assert "PartitionFilters: [isnotnull(reading_month" in pruned._jdf.queryExecution().executedPlan().toString()
    from fleetstar.operators.anomaly import composite_anomaly
    from fleetstar.operators.versions import VersionedFact
    fact = VersionedFact(spark, f"{tmp_dir}/fact")
    fact.write(star.fact.drop("reading_month"))
    fact.update_flags(composite_anomaly(star.fact))
    assert fact.read().filter("is_anomaly").count() == 2


def test_catalog_listing_and_sql_access(spark, micro):
    G.register_star(micro, prefix="t_")
    names = [r.table_name for r in G.list_tables(spark).collect()]
    assert {"t_fact_device_telemetry", "t_dim_store", "t_dim_device", "t_dim_alert_type", "t_dim_date",
            "t_vw_high_risk_stores", "t_vw_device_health"} <= set(names)
    got = spark.sql("SELECT store_id FROM t_vw_high_risk_stores ORDER BY spike_rate_pct DESC").collect()
    assert [r.store_id for r in got] == ["S2", "S4", "S1"]
    n = spark.sql("""SELECT COUNT(*) AS n FROM t_fact_device_telemetry f
                     JOIN t_dim_date d ON f.date_key = d.date_key WHERE d.is_weekend""").collect()[0].n
    assert n == 6  # readings on 2025-01-11 (2), 01-12, 02-01, 03-01 (2)


def test_column_profile(spark, micro):
    prof = {r.column_name: r for r in Q.column_profile(micro.fact, exact=True).collect()}
    assert prof["temperature_celsius"].null_count == 1 and prof["device_key"].distinct_count == 4
    assert prof["data_quality_flag"].data_type == "string"
