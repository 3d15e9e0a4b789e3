"""Operators give the same answers on a materialised (month-partitioned) star."""

from pyspark.sql import functions as F

from fleetstar.operators import anomaly as N
from fleetstar.operators import dims as M
from fleetstar.operators import fleet
from fleetstar.registry import present
from fleetstar.session import cluster_settings
from fleetstar.sources.profiles import event_star, orderline_star

from tests.conftest import SF_SMALL


def _same(a, b):
    return sorted(present(a).collect()) == sorted(present(b).collect())


def test_queries_on_written_star_match_profile(spark, tmp_dir):
    p1, p2 = event_star(spark, SF_SMALL), orderline_star(spark, SF_SMALL)
    M.write_star(p1, f"{tmp_dir}/p1")
    M.write_star(p2, f"{tmp_dir}/p2")
    s1, s2 = M.read_star(spark, f"{tmp_dir}/p1"), M.read_star(spark, f"{tmp_dir}/p2")
    f1, f2 = s1.fact.drop("reading_month"), s2.fact.drop("reading_month")
    assert _same(fleet.high_risk_stores(p2.fact, p2.store), fleet.high_risk_stores(f2, s2.store))
    assert _same(fleet.mom_temp_trend(p2.fact, p2.store), fleet.mom_temp_trend(f2, s2.store))
    assert _same(fleet.next_session_early_warning(p1.fact, p1.device, p1.store, k=None),
                 fleet.next_session_early_warning(f1, s1.device, s1.store, k=None))
    assert _same(N.composite_anomaly(p1.fact), N.composite_anomaly(f1))
    months = [r[0] for r in s2.fact.select("reading_month").distinct().collect()]
    assert len(months) > 12 and all(len(m) == 7 for m in months)
    # A month filter on the stored star prunes partitions.
    one = s2.fact.filter(F.col("reading_month") == months[0])
    assert "PartitionFilters" in one._jdf.queryExecution().executedPlan().toString()


def test_cluster_settings_scale_with_input():
    small, big = cluster_settings(10 * 2**30), cluster_settings(100 * 2**40)
    assert int(small["spark.sql.shuffle.partitions"]) == 200
    assert int(big["spark.sql.shuffle.partitions"]) == 409600
    assert big["spark.sql.files.maxPartitionBytes"] == str(256 * 2**20)
