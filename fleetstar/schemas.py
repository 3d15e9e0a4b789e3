"""Explicit schemas of the star model (final state after both schema patches)."""

from pyspark.sql import types as T

FACT = T.StructType([
    T.StructField("telemetry_key", T.LongType(), False),
    T.StructField("date_key", T.IntegerType(), False),
    T.StructField("device_key", T.LongType(), False),
    T.StructField("store_key", T.LongType(), False),
    T.StructField("alert_type_key", T.IntegerType(), True),
    T.StructField("event_timestamp", T.TimestampNTZType(), False),
    T.StructField("ingestion_timestamp", T.TimestampNTZType(), False),
    T.StructField("temperature_celsius", T.DecimalType(5, 2), True),
    T.StructField("max_temp_threshold", T.DecimalType(5, 2), False),
    T.StructField("temp_delta", T.DecimalType(5, 2), False),
    T.StructField("is_thermal_spike", T.BooleanType(), False),
    T.StructField("session_duration_secs", T.IntegerType(), False),
    T.StructField("power_draw_watts", T.DecimalType(6, 2), False),
    T.StructField("airflow_speed", T.ShortType(), False),
    T.StructField("gdpr_compliant", T.BooleanType(), False),
    T.StructField("data_quality_flag", T.StringType(), False),
    T.StructField("is_anomaly", T.BooleanType(), False),
])

FACT_COLUMNS = [f.name for f in FACT.fields]

STORE = T.StructType([
    T.StructField("store_key", T.LongType(), False),
    T.StructField("store_id", T.StringType(), False),
    T.StructField("store_name", T.StringType(), False),
    T.StructField("city", T.StringType(), False),
    T.StructField("state_province", T.StringType(), True),
    T.StructField("country", T.StringType(), False),
    T.StructField("region", T.StringType(), False),
    T.StructField("store_tier", T.StringType(), False),
    T.StructField("store_open_date", T.DateType(), False),
    T.StructField("is_active", T.BooleanType(), False),
])

DEVICE = T.StructType([
    T.StructField("device_key", T.LongType(), False),
    T.StructField("device_id", T.StringType(), False),
    T.StructField("store_key", T.LongType(), False),
    T.StructField("model_version", T.StringType(), False),
    T.StructField("firmware_version", T.StringType(), False),
    T.StructField("install_date", T.DateType(), False),
    T.StructField("warranty_expiry", T.DateType(), False),
    T.StructField("is_active", T.BooleanType(), False),
    T.StructField("gdpr_masked", T.BooleanType(), False),
])

DATE = T.StructType([
    T.StructField("date_key", T.IntegerType(), False),
    T.StructField("full_date", T.DateType(), False),
    T.StructField("day_of_week", T.StringType(), False),
    T.StructField("day_number", T.ShortType(), False),
    T.StructField("week_number", T.ShortType(), False),
    T.StructField("month_number", T.ShortType(), False),
    T.StructField("month_name", T.StringType(), False),
    T.StructField("quarter", T.ShortType(), False),
    T.StructField("year", T.ShortType(), False),
    T.StructField("is_weekend", T.BooleanType(), False),
    T.StructField("fiscal_period", T.StringType(), False),
])

ALERT = T.StructType([
    T.StructField("alert_type_key", T.IntegerType(), False),
    T.StructField("alert_code", T.StringType(), False),
    T.StructField("alert_category", T.StringType(), False),
    T.StructField("alert_name", T.StringType(), False),
    T.StructField("severity", T.StringType(), False),
    T.StructField("auto_shutoff", T.BooleanType(), False),
    T.StructField("notifies_regional", T.BooleanType(), False),
    T.StructField("sla_response_mins", T.ShortType(), False),
])

ROUTING = T.StructType([
    T.StructField("region", T.StringType(), False),
    T.StructField("manager_name", T.StringType(), False),
    T.StructField("manager_email", T.StringType(), False),
    T.StructField("manager_handle", T.StringType(), False),
])

OUTBOX = T.StructType([
    T.StructField("telemetry_key", T.LongType(), False),
    T.StructField("store", T.StringType(), False),
    T.StructField("device", T.StringType(), False),
    T.StructField("temperature", T.DecimalType(10, 2), True),
    T.StructField("region", T.StringType(), False),
    T.StructField("manager", T.StringType(), False),
    T.StructField("notified_at", T.TimestampNTZType(), False),
    T.StructField("status", T.StringType(), False),
])

# Maximum character lengths declared for the string columns (VARCHAR(n)).
VARCHAR_LIMITS = {
    "fact": {"data_quality_flag": 20},
    "store": {"store_id": 20, "store_name": 100, "city": 100, "state_province": 100,
              "country": 100, "region": 50, "store_tier": 20},
    "device": {"device_id": 50, "model_version": 20, "firmware_version": 20},
    "date": {"day_of_week": 10, "month_name": 10, "fiscal_period": 12},
    "alert": {"alert_code": 20, "alert_category": 50, "alert_name": 100, "severity": 20},
}

# Flat extract read by the dashboards: the fact columns, then these.
FLAT_EXTRA = ["store_name", "city", "country", "region", "device_id", "model_version",
              "firmware_version", "full_date", "month_name", "quarter", "year",
              "alert_code", "severity"]
FLAT_COLUMNS = FACT_COLUMNS + FLAT_EXTRA
