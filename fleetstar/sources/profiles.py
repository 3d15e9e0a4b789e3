"""Shape the driver's tables into the telemetry star model.

Two profiles map generic tables onto the star:

* **events profile** (sequences, alerts, anomalies, streaming): each event is
  a reading; the user is the device, the user's nation the store, the
  nation's region the region.
* **order-line profile** (multi-year volume): each line item is a reading;
  the supplier is the store, the part the device, the part's brand the
  firmware.

Both are lazy DataFrame plans; the matching DuckDB text lives in
``fleetstar.oracle``. At scale a profile is materialised once with
``fleetstar.operators.dims.write_star`` and queries read the written star.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetstar import constants as C
from fleetstar import schemas as S
from fleetstar.functions.exprs import date_key
from fleetstar.plans.joins import bounded_broadcast


@dataclass
class Star:
    fact: DataFrame
    store: DataFrame
    device: DataFrame
    alert: DataFrame
    date: DataFrame | None = None   # the calendar; a written star always has it


# Declared schemas of the driver's tables: reading with them skips footer
# inference (one Spark job per table) and pins the types the profiles expect.
DRIVER_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in DRIVER_SCHEMAS:
        reader = reader.schema(DRIVER_SCHEMAS[name])
    return reader.parquet(f"{sf_dir}/{name}.parquet")


def literal_table(spark: SparkSession, rows, schema) -> DataFrame:
    """A small constant table as a literal plan (stable across calls, folded by the optimizer)."""
    structs = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(r, schema.fields)])
               for r in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def alert_dim(spark: SparkSession) -> DataFrame:
    return literal_table(spark, C.ALERT_TYPES, S.ALERT)


# Invented regional managers for the driver's region names; regions without a
# row (here MIDDLE EAST) are routed to the default contact.
ROUTING_ROWS = [
    ("AFRICA", "Amara Okafor", "amara.okafor@example.com", "@amara.okafor"),
    ("AMERICA", "Lucas Moreau", "lucas.moreau@example.com", "@lucas.moreau"),
    ("ASIA", "Mei Lin", "mei.lin@example.com", "@mei.lin"),
    ("EUROPE", "Jonas Berg", "jonas.berg@example.com", "@jonas.berg"),
]
ROUTING_DEFAULT = {"manager_name": "Fleet Operations Desk", "manager_email": "fleet.ops@example.com",
                   "manager_handle": "@fleet.ops"}


def routing_table(spark: SparkSession) -> tuple[DataFrame, dict]:
    """Routing rows (region -> manager) and the default contact."""
    return literal_table(spark, ROUTING_ROWS, S.ROUTING), dict(ROUTING_DEFAULT)


def _nation_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region")
    return (nation.join(region, nation.n_regionkey == region.r_regionkey)
            .select(F.col("n_nationkey").cast("long").alias("store_key"),
                    F.format_string("ST-%03d", F.col("n_nationkey")).alias("store_id"),
                    F.col("n_name").alias("store_name"),
                    F.col("n_name").alias("city"),
                    F.lit(None).cast("string").alias("state_province"),
                    F.col("r_name").alias("country"),
                    F.col("r_name").alias("region"),
                    F.lit("Standard").alias("store_tier"),
                    F.lit("2020-01-01").cast("date").alias("store_open_date"),
                    F.lit(True).alias("is_active")))


def _event_reading_columns(ev_id: Column, ts: Column, value: Column, etype: Column, props: Column,
                           store_key: Column, device_key: Column) -> list[Column]:
    """Star fact columns of one event reading (shared by batch and stream)."""
    phase = ev_id % 25
    temp = F.when(phase == 0, F.lit(None)).otherwise(value.cast("decimal(10,2)"))
    return [
        ev_id.alias("telemetry_key"),
        date_key(F.to_date(ts)).alias("date_key"),
        device_key.alias("device_key"),
        store_key.alias("store_key"),
        F.when(value > 150, 1).when(value > 100, 2)
         .when((etype == "error") & (ev_id % 10 == 0), 4).cast("int").alias("alert_type_key"),
        ts.alias("event_timestamp"),
        ts.alias("ingestion_timestamp"),
        temp.cast("decimal(10,2)").alias("temperature_celsius"),
        F.lit(100).cast("decimal(10,2)").alias("max_temp_threshold"),
        F.lit(0).cast("decimal(10,2)").alias("temp_delta"),
        (value > 100).alias("is_thermal_spike"),
        F.get_json_object(props, "$.k").cast("int").alias("session_duration_secs"),
        value.cast("decimal(10,2)").alias("power_draw_watts"),
        (F.lit(1) + ev_id % 5).cast("short").alias("airflow_speed"),
        (ev_id % 50 != 7).alias("gdpr_compliant"),
        F.when(phase == 0, "MISSING").when(phase == 1, "NOISY").when(phase == 2, "SPIKE")
         .otherwise("CLEAN").alias("data_quality_flag"),
        (ev_id % 20 == 5).alias("is_anomaly"),
        F.to_date(ts).alias("full_date"),
    ]


def event_devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = read_table(spark, sf_dir, "customer")
    return cust.select(
        F.col("c_custkey").alias("device_key"),
        F.col("c_name").alias("device_id"),
        F.col("c_nationkey").cast("long").alias("store_key"),
        F.concat(F.lit("v"), (F.col("c_custkey") % 2 + 1).cast("string")).alias("model_version"),
        F.col("c_mktsegment").alias("firmware_version"),
        F.lit("2023-06-01").cast("date").alias("install_date"),
        F.lit("2026-06-01").cast("date").alias("warranty_expiry"),
        F.lit(True).alias("is_active"),
        (F.col("c_custkey") % 10 == 0).alias("gdpr_masked"))


def events_to_fact(events: DataFrame, devices: DataFrame) -> DataFrame:
    """Readings from events: the device's store is looked up on the device dimension."""
    keys = bounded_broadcast(devices.select(F.col("device_key").alias("_dk"),
                                            F.col("store_key").alias("_sk")))
    joined = events.join(keys, events.user_id == keys._dk)
    return joined.select(*_event_reading_columns(
        F.col("event_id"), F.col("ts"), F.col("value"), F.col("event_type"), F.col("props"),
        F.col("_sk"), F.col("user_id")))


def event_star(spark: SparkSession, sf_dir: str) -> Star:
    devices = event_devices(spark, sf_dir)
    fact = events_to_fact(read_table(spark, sf_dir, "events"), devices)
    return Star(fact=fact, store=_nation_stores(spark, sf_dir), device=devices, alert=alert_dim(spark))


def orderline_star(spark: SparkSession, sf_dir: str) -> Star:
    li = read_table(spark, sf_dir, "lineitem")
    supplier = read_table(spark, sf_dir, "supplier")
    nation = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region")
    part = read_table(spark, sf_dir, "part")
    store = (supplier.join(nation, supplier.s_nationkey == nation.n_nationkey)
             .join(region, nation.n_regionkey == region.r_regionkey)
             .select(F.col("s_suppkey").alias("store_key"),
                     F.col("s_name").alias("store_id"),
                     F.col("s_name").alias("store_name"),
                     F.col("n_name").alias("city"),
                     F.lit(None).cast("string").alias("state_province"),
                     F.col("n_name").alias("country"),
                     F.col("r_name").alias("region"),
                     F.lit("Standard").alias("store_tier"),
                     F.lit("2020-01-01").cast("date").alias("store_open_date"),
                     F.lit(True).alias("is_active")))
    device = part.select(
        F.col("p_partkey").alias("device_key"),
        F.col("p_name").alias("device_id"),
        F.lit(None).cast("long").alias("store_key"),
        F.col("p_type").alias("model_version"),
        F.col("p_brand").alias("firmware_version"),
        F.lit("2023-06-01").cast("date").alias("install_date"),
        F.lit("2026-06-01").cast("date").alias("warranty_expiry"),
        F.lit(True).alias("is_active"),
        F.lit(False).alias("gdpr_masked"))
    qty = F.col("l_quantity")
    d = F.to_date(F.col("l_shipdate"))
    fact = li.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("telemetry_key"),
        date_key(d).alias("date_key"),
        F.col("l_partkey").alias("device_key"),
        F.col("l_suppkey").alias("store_key"),
        F.when(qty > 48, 1).when(qty > 45, 2).cast("int").alias("alert_type_key"),
        F.col("l_shipdate").alias("event_timestamp"),
        F.col("l_shipdate").alias("ingestion_timestamp"),
        qty.cast("decimal(10,2)").alias("temperature_celsius"),
        F.lit(45).cast("decimal(10,2)").alias("max_temp_threshold"),
        F.lit(0).cast("decimal(10,2)").alias("temp_delta"),
        (qty > 45).alias("is_thermal_spike"),
        (F.col("l_linenumber") * 60).cast("int").alias("session_duration_secs"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("power_draw_watts"),
        F.col("l_linenumber").cast("short").alias("airflow_speed"),
        (F.col("l_returnflag") != "R").alias("gdpr_compliant"),
        F.when(F.col("l_returnflag") == "R", "NOISY").otherwise("CLEAN").alias("data_quality_flag"),
        (F.col("l_tax") > 0.07).alias("is_anomaly"),
        d.alias("full_date"))
    return Star(fact=fact, store=store, device=device, alert=alert_dim(spark))
