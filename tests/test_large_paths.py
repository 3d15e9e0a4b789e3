"""With every size check failing, the fallback plans still match the oracle.

``fleetstar.broadcast.maxRows=1`` makes every dimension "large" (sort-merge
joins, eager key aggregation); ``fleetstar.window.localMaxRows=1`` sends every
global RANK / DENSE_RANK / NTILE / ROW_NUMBER through the distributed path.
"""

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL
from tests.parity import compare, duck

NAMES = ["high_risk_stores", "device_health", "store_spike_ranking_all", "mom_temp_trend",
         "next_session_early_warning", "cumulative_spikes", "device_risk_quartiles", "firmware_compliance",
         "critical_alerts", "routed_alerts", "anomaly_summary", "telemetry_export", "check_constraints",
         "gdpr_report", "assign_surrogate_keys", "insert_if_absent"]


@pytest.fixture(scope="module")
def forced(spark):
    spark.conf.set("fleetstar.broadcast.maxRows", "1")
    spark.conf.set("fleetstar.window.localMaxRows", "1")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    yield spark
    from fleetstar import registry

    registry._stars.clear()  # plans built under the forced settings must not leak
    for k in ("fleetstar.broadcast.maxRows", "fleetstar.window.localMaxRows",
              "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.unset(k)


@pytest.mark.parametrize("name", NAMES)
def test_fallback_plans_match_oracle(forced, name):
    from fleetstar import registry

    registry._stars.clear()  # rebuild plans under the forced settings
    r = compare(forced, duck(SF_SMALL), name, entry.queries()[name], entry.oracle_sql()[name], SF_SMALL)
    assert "error" not in r and r["spark_rows"] == r["oracle_rows"] and r["exact"], r


def test_forced_settings_change_the_plan(forced):
    from fleetstar import registry

    registry._stars.clear()
    plan = entry.queries()["device_health"](forced, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
