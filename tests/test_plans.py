"""Physical plans: pushdown, pruning, no cartesian products, no row-at-a-time Python."""

import pytest

import __spark_entry__ as entry
from fleetstar.registry import QUERIES
from tests.conftest import SF_SMALL

SKIP = {"append_facts", "stream_alert_outbox", "stream_alert_window_counts"}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SKIP))
def test_no_cartesian_or_python_udf(spark, name):
    plan = _plan(entry.queries()[name](spark, SF_SMALL))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan, (name, bad)


def test_scan_prunes_columns_and_pushes_filters(spark):
    from fleetstar.operators import alerts as A
    from fleetstar.sources.profiles import event_star

    s = event_star(spark, SF_SMALL)
    df = A.critical_alerts_since(s.fact, s.device, s.store, s.alert, as_of="2024-01-20 00:00:00", minutes=60)
    plan = _plan(df)
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts," in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string,value:double" in plan


def test_dimension_joins_are_broadcast(spark):
    plan = _plan(entry.queries()["high_risk_stores"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


@pytest.mark.parametrize("name", ["mom_temp_trend", "cumulative_spikes", "calendar_rolling_avg"])
def test_windowed_reports_sort_without_extra_exchange(spark, name):
    df = entry.queries()[name](spark, SF_SMALL)
    plan = _plan(df)
    # One exchange of readings' partial sums by key, one of the small result by attributes, one for window and order.
    assert plan.count("rangepartitioning") == 1 and plan.count("hashpartitioning") == 2, plan
    rows = df.collect()
    key = (lambda r: (r.store_name, r.year)) if name == "mom_temp_trend" else (lambda r: (r.region, r.full_date))
    assert [key(r) for r in rows] == sorted(key(r) for r in rows)


@pytest.mark.parametrize("name", ["next_session_all", "temp_delta"])
def test_sequences_shuffle_readings_once_when_no_device_is_hot(spark, name):
    assert _plan(entry.queries()[name](spark, SF_SMALL)).count("hashpartitioning") == 1


@pytest.mark.parametrize("name", ["iqr_flags", "composite_anomaly", "anomaly_report", "apply_anomaly_flags"])
def test_exact_quartiles_gather_no_values(spark, name):
    assert "percentile(" not in _plan(entry.queries()[name](spark, SF_SMALL))


@pytest.mark.parametrize("name", ["spike_rate_map", "monthly_operational_health", "store_vs_global", "country_city_drill"])
def test_dashboards_read_no_alerts_and_keep_readings_in_place(spark, name):
    plan = _plan(entry.queries()[name](spark, SF_SMALL))
    assert "alert_code" not in plan and "c_mktsegment" not in plan


def test_size_checks_collect_no_rows(spark):
    from fleetstar.plans import joins

    df = spark.read.parquet(f"{SF_SMALL}/customer.parquet")
    assert joins.fits(df, 10**6) and not joins.fits(df, 10)
    assert ".limit(" not in open(joins.__file__).read()
