"""Load summary, GDPR compliance and catalog listing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetstar.functions.exprs import count_true, exact_pct
from fleetstar.plans.joins import join_dim


def load_summary(fact: DataFrame) -> DataFrame:
    """Totals of spikes, anomalies and dirty records, with percentages, in one pass."""
    one = fact.agg(F.count(F.lit(1)).alias("total_rows"),
                   count_true(F.col("is_thermal_spike")).alias("thermal_spikes"),
                   count_true(F.col("is_anomaly")).alias("anomalies"),
                   count_true(F.col("data_quality_flag") != "CLEAN").alias("dirty_records"))
    n = F.col("total_rows")
    return one.select("total_rows",
                      "thermal_spikes", exact_pct(F.col("thermal_spikes"), n, 1).alias("spike_pct"),
                      "anomalies", exact_pct(F.col("anomalies"), n, 1).alias("anomaly_pct"),
                      "dirty_records", exact_pct(F.col("dirty_records"), n, 1).alias("dirty_pct"))


def gdpr_report(fact: DataFrame, device: DataFrame, store: DataFrame, by: str = "store") -> DataFrame:
    """Non-compliant readings (count, rate) and masked devices, per store or per region.

    Every store (region) with a reading or a masked device has a row; without
    readings its rate is NULL.
    """
    per = (fact.groupBy("store_key")
           .agg(F.count(F.lit(1)).alias("total_readings"),
                count_true(~F.col("gdpr_compliant")).alias("non_compliant")))
    masked = device.groupBy("store_key").agg(count_true(F.col("gdpr_masked")).alias("masked_devices"))
    counts = ["total_readings", "non_compliant", "masked_devices"]
    both = per.join(masked, "store_key", "full").fillna(0, counts)
    per = join_dim(both, store.select("store_key", "store_name", "region"), "store_key")
    keys = ["store_name", "region"]
    if by == "region":
        keys = ["region"]
        per = per.groupBy("region").agg(*[F.sum(c).alias(c) for c in counts])
    rate = F.when(F.col("total_readings") > 0, exact_pct(F.col("non_compliant"), F.col("total_readings")))
    return per.where("total_readings > 0 or masked_devices > 0").select(
        *keys, "total_readings", "non_compliant", rate.alias("non_compliant_pct"),
        F.col("masked_devices").cast("long").alias("masked_devices"))


def register_star(star, prefix: str = "", with_views: bool = True) -> None:
    """Expose the star to SQL users under the model's table and view names.

    Registers the four tables, a calendar covering the fact's dates and, with
    ``with_views``, the two standing views (high-risk stores, device health)
    as lazy temporary views: each SQL query still plans from the files.
    """
    from fleetstar.operators.dims import date_dimension_covering
    from fleetstar.operators.fleet import device_health, high_risk_stores

    star.fact.createOrReplaceTempView(f"{prefix}fact_device_telemetry")
    star.store.createOrReplaceTempView(f"{prefix}dim_store")
    star.device.createOrReplaceTempView(f"{prefix}dim_device")
    star.alert.createOrReplaceTempView(f"{prefix}dim_alert_type")
    date_dimension_covering(star.fact).createOrReplaceTempView(f"{prefix}dim_date")
    if with_views:
        high_risk_stores(star.fact, star.store).createOrReplaceTempView(f"{prefix}vw_high_risk_stores")
        device_health(star.fact, star.device, star.store).createOrReplaceTempView(f"{prefix}vw_device_health")


def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Tables and views of a database (temporary views included), sorted by type then name."""
    rows = [(t.name, t.tableType) for t in spark.catalog.listTables(database)]
    return (spark.createDataFrame(rows, "table_name string, table_type string")
            .orderBy("table_type", "table_name"))
