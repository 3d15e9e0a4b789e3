"""Reference SQL (DuckDB dialect) for every registered query.

Each statement re-derives the star from the driver's tables with the same
profile rules as ``fleetstar.sources.profiles`` and then states the query the
way the source model writes it (join, then group). Rounded values use exact
integer arithmetic (half-up on non-negative values) so both engines produce
bit-identical doubles.
"""

from __future__ import annotations

from fleetstar import constants as C

P1 = """
p1_store AS (
  SELECT CAST(n.n_nationkey AS BIGINT) AS store_key, printf('ST-%03d', n.n_nationkey) AS store_id,
         n.n_name AS store_name, n.n_name AS city, CAST(NULL AS VARCHAR) AS state_province,
         r.r_name AS country, r.r_name AS region, 'Standard' AS store_tier,
         DATE '2020-01-01' AS store_open_date, TRUE AS is_active
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey),
p1_device AS (
  SELECT c_custkey AS device_key, c_name AS device_id, CAST(c_nationkey AS BIGINT) AS store_key,
         'v' || CAST(c_custkey % 2 + 1 AS VARCHAR) AS model_version, c_mktsegment AS firmware_version,
         DATE '2023-06-01' AS install_date, DATE '2026-06-01' AS warranty_expiry, TRUE AS is_active,
         (c_custkey % 10 = 0) AS gdpr_masked
  FROM customer),
p1_fact AS (
  SELECT e.event_id AS telemetry_key,
         CAST(year(e.ts) * 10000 + month(e.ts) * 100 + day(e.ts) AS INTEGER) AS date_key,
         e.user_id AS device_key, CAST(c.c_nationkey AS BIGINT) AS store_key,
         CAST(CASE WHEN e.value > 150 THEN 1 WHEN e.value > 100 THEN 2
                   WHEN e.event_type = 'error' AND e.event_id % 10 = 0 THEN 4 END AS INTEGER) AS alert_type_key,
         e.ts AS event_timestamp, e.ts AS ingestion_timestamp,
         CASE WHEN e.event_id % 25 = 0 THEN NULL ELSE CAST(e.value AS DECIMAL(10,2)) END AS temperature_celsius,
         CAST(100 AS DECIMAL(10,2)) AS max_temp_threshold, CAST(0 AS DECIMAL(10,2)) AS temp_delta,
         e.value > 100 AS is_thermal_spike,
         CAST(json_extract_string(e.props, '$.k') AS INTEGER) AS session_duration_secs,
         CAST(e.value AS DECIMAL(10,2)) AS power_draw_watts,
         CAST(1 + e.event_id % 5 AS SMALLINT) AS airflow_speed,
         e.event_id % 50 <> 7 AS gdpr_compliant,
         CASE e.event_id % 25 WHEN 0 THEN 'MISSING' WHEN 1 THEN 'NOISY' WHEN 2 THEN 'SPIKE'
              ELSE 'CLEAN' END AS data_quality_flag,
         e.event_id % 20 = 5 AS is_anomaly,
         CAST(e.ts AS DATE) AS full_date
  FROM events e JOIN customer c ON e.user_id = c.c_custkey)"""

P2 = """
p2_store AS (
  SELECT s.s_suppkey AS store_key, s.s_name AS store_id, s.s_name AS store_name, n.n_name AS city,
         n.n_name AS country, r.r_name AS region
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey),
p2_device AS (
  SELECT p_partkey AS device_key, p_name AS device_id, p_type AS model_version, p_brand AS firmware_version
  FROM part),
p2_fact AS (
  SELECT l_orderkey * 8 + l_linenumber AS telemetry_key, l_partkey AS device_key, l_suppkey AS store_key,
         l_shipdate AS event_timestamp,
         CAST(l_quantity AS DECIMAL(10,2)) AS temperature_celsius,
         l_quantity > 45 AS is_thermal_spike,
         CAST(l_linenumber * 60 AS INTEGER) AS session_duration_secs,
         CAST(l_extendedprice AS DECIMAL(12,2)) AS power_draw_watts,
         CASE WHEN l_returnflag = 'R' THEN 'NOISY' ELSE 'CLEAN' END AS data_quality_flag,
         l_tax > 0.07 AS is_anomaly,
         CAST(l_shipdate AS DATE) AS full_date
  FROM lineitem)"""


def cents(x: str) -> str:
    return f"CAST(({x}) * 100 AS HUGEINT)"


def mean2(sum_cents: str, n: str) -> str:
    """Half-up mean rounded to 2 places, from a sum in cents."""
    return f"(CAST((2 * ({sum_cents}) + ({n})) // (2 * ({n})) AS DOUBLE) / 100)"


def mean6(sum_cents: str, n: str) -> str:
    """Mean rounded to 6 places (Spark's decimal AVG scale), from a sum in cents."""
    return f"(CAST((20000 * ({sum_cents}) + ({n})) // (2 * ({n})) AS DOUBLE) / 1000000)"


def pct2(k: str, n: str) -> str:
    """ROUND(100 * k / n, 2), half-up."""
    return f"(CAST((20000 * ({k}) + ({n})) // (2 * ({n})) AS DOUBLE) / 100)"


def pct1(k: str, n: str) -> str:
    return f"(CAST((2000 * ({k}) + ({n})) // (2 * ({n})) AS DOUBLE) / 10)"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes)


SPIKES = "COUNT(*) FILTER (WHERE f.is_thermal_spike)"

HIGH_RISK_STORES = with_(P2, f"""
agg AS (
  SELECT s.store_id, s.store_name, s.city, s.country, s.region, COUNT(*) AS total_readings,
         {SPIKES} AS spike_count,
         {pct2(SPIKES, 'COUNT(*)')} AS spike_rate_pct,
         {mean6('SUM(' + cents('f.temperature_celsius') + ')', 'COUNT(f.temperature_celsius)')} AS avg_temp,
         CAST(MAX(f.temperature_celsius) AS DOUBLE) AS max_temp_recorded
  FROM p2_fact f JOIN p2_store s ON f.store_key = s.store_key
  GROUP BY s.store_key, s.store_id, s.store_name, s.city, s.country, s.region)""") + """
SELECT * FROM agg WHERE spike_rate_pct > 10"""

DEVICE_HEALTH = with_(P1) + f"""
SELECT d.device_id, d.model_version, d.firmware_version, s.store_name, s.region,
       COUNT(*) AS total_sessions,
       {mean6('SUM(' + cents('f.temperature_celsius') + ')', 'COUNT(f.temperature_celsius)')} AS avg_temp,
       CAST(SUM(f.session_duration_secs) AS DOUBLE) / COUNT(f.session_duration_secs) AS avg_session_secs,
       {mean6('SUM(' + cents('f.power_draw_watts') + ')', 'COUNT(f.power_draw_watts)')} AS avg_power_watts,
       COUNT(*) FILTER (WHERE f.is_anomaly) AS anomaly_count,
       COUNT(*) FILTER (WHERE f.data_quality_flag <> 'CLEAN') AS dirty_record_count
FROM p1_fact f JOIN p1_device d ON f.device_key = d.device_key JOIN p1_store s ON f.store_key = s.store_key
GROUP BY d.device_key, d.device_id, d.model_version, d.firmware_version, s.store_name, s.region"""

STORE_SPIKE_RANKING = with_(P2, f"""
rates AS (
  SELECT s.store_key, s.store_name, s.city, s.country, s.region, COUNT(*) AS total_readings,
         {SPIKES} AS spike_count, {pct2(SPIKES, 'COUNT(*)')} AS spike_rate_pct
  FROM p2_fact f JOIN p2_store s ON f.store_key = s.store_key
  GROUP BY s.store_key, s.store_id, s.store_name, s.city, s.country, s.region)""", """
ranked AS (
  SELECT *, RANK() OVER (PARTITION BY region ORDER BY spike_rate_pct DESC) AS regional_rank,
         RANK() OVER (ORDER BY spike_rate_pct DESC) AS global_rank
  FROM rates)""") + """
SELECT CAST(global_rank AS BIGINT) AS global_rank, CAST(regional_rank AS BIGINT) AS regional_rank,
       store_name, city, country, region, total_readings, spike_count, spike_rate_pct
FROM ranked ORDER BY global_rank, store_key LIMIT 10"""
STORE_SPIKE_RANKING_ALL = STORE_SPIKE_RANKING.replace(" LIMIT 10", "")

MOM_TEMP_TREND = with_(P2, f"""
monthly AS (
  SELECT s.store_name, s.region, year(f.full_date) AS year, month(f.full_date) AS month_number,
         monthname(f.full_date) AS month_name,
         (2 * SUM({cents('f.temperature_celsius')}) + COUNT(f.temperature_celsius))
           // (2 * COUNT(f.temperature_celsius)) AS avg_c
  FROM p2_fact f JOIN p2_store s ON f.store_key = s.store_key
  WHERE f.temperature_celsius IS NOT NULL
  GROUP BY 1, 2, 3, 4, 5)""", """
trend AS (
  SELECT *, LAG(avg_c) OVER (PARTITION BY store_name ORDER BY year, month_number, region) AS prev_c
  FROM monthly)""") + """
SELECT store_name, region, CAST(year AS BIGINT) AS year, month_name,
       CAST(avg_c AS DOUBLE) / 100 AS avg_temp, CAST(prev_c AS DOUBLE) / 100 AS prev_month_temp,
       CAST(avg_c - prev_c AS DOUBLE) / 100 AS mom_temp_change,
       CASE WHEN avg_c - prev_c > 200 THEN 'WARMING' WHEN avg_c - prev_c < -200 THEN 'COOLING'
            ELSE 'STABLE' END AS trend_status
FROM trend WHERE prev_c IS NOT NULL"""


def early_warning(limit: int | None) -> str:
    tail = f"ORDER BY temp_jump DESC NULLS LAST, telemetry_key LIMIT {limit}" if limit else ""
    return with_(P1, """
seq AS (
  SELECT f.telemetry_key, d.device_id, s.store_name, f.event_timestamp, f.temperature_celsius,
         LEAD(f.temperature_celsius) OVER w AS nxt, LEAD(f.is_thermal_spike) OVER w AS nxt_spike
  FROM p1_fact f JOIN p1_device d ON f.device_key = d.device_key JOIN p1_store s ON f.store_key = s.store_key
  WHERE f.temperature_celsius IS NOT NULL
  WINDOW w AS (PARTITION BY f.device_key ORDER BY f.event_timestamp, f.telemetry_key))""", f"""
res AS (
  SELECT telemetry_key, device_id, store_name, event_timestamp,
         CAST(temperature_celsius AS DOUBLE) AS current_temp, CAST(nxt AS DOUBLE) AS next_session_temp,
         CAST(nxt - temperature_celsius AS DOUBLE) AS temp_jump, nxt_spike AS next_is_spike,
         CASE WHEN nxt - temperature_celsius > 20 THEN {q(C.EARLY_WARNING_LABELS[0])}
              WHEN nxt_spike THEN {q(C.EARLY_WARNING_LABELS[1])} ELSE {q(C.EARLY_WARNING_LABELS[2])} END
           AS early_warning
  FROM seq WHERE nxt IS NOT NULL {tail})""") + """
SELECT device_id, store_name, event_timestamp, current_temp, next_session_temp, temp_jump, next_is_spike,
       early_warning FROM res"""


def _daily(profile: str) -> str:
    return f"""
daily AS (
  SELECT s.region, f.full_date, {SPIKES} AS daily_spikes
  FROM {profile}_fact f JOIN {profile}_store s ON f.store_key = s.store_key
  GROUP BY s.region, f.full_date)"""


def cumulative_spikes(profile: str) -> str:
    return with_(P1 if profile == "p1" else P2, _daily(profile)) + """
SELECT region, full_date, daily_spikes,
       CAST(SUM(daily_spikes) OVER w1 AS BIGINT) AS cumulative_spikes,
       CAST((200 * SUM(daily_spikes) OVER w7 + COUNT(*) OVER w7) // (2 * COUNT(*) OVER w7) AS DOUBLE) / 100
         AS rolling_7day_avg
FROM daily
WINDOW w1 AS (PARTITION BY region ORDER BY full_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
       w7 AS (PARTITION BY region ORDER BY full_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"""


CALENDAR_ROLLING_AVG = with_(P2, _daily("p2"), """
spine AS (SELECT region, CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS full_date
          FROM (SELECT region, min(full_date) AS lo, max(full_date) AS hi FROM daily GROUP BY region))""", """
filled AS (SELECT p.region, p.full_date, COALESCE(d.daily_spikes, 0) AS daily_spikes
           FROM spine p LEFT JOIN daily d ON p.region = d.region AND p.full_date = d.full_date)""") + """
SELECT region, full_date, CAST(daily_spikes AS BIGINT) AS daily_spikes,
       CAST((200 * SUM(daily_spikes) OVER w + 7) // 14 AS DOUBLE) / 100 AS calendar_7day_avg
FROM filled
WINDOW w AS (PARTITION BY region ORDER BY full_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"""

DEVICE_RISK_QUARTILES = with_(P1, f"""
m AS (
  SELECT d.device_key, d.device_id, d.model_version, d.firmware_version, s.store_name, s.region,
         COUNT(*) AS total_sessions,
         {mean2('SUM(' + cents('f.temperature_celsius') + ')', 'COUNT(f.temperature_celsius)')} AS avg_temp,
         {SPIKES} AS total_spikes, {pct2(SPIKES, 'COUNT(*)')} AS spike_rate_pct
  FROM p1_fact f JOIN p1_device d ON f.device_key = d.device_key JOIN p1_store s ON f.store_key = s.store_key
  WHERE f.temperature_celsius IS NOT NULL
  GROUP BY d.device_key, d.device_id, d.model_version, d.firmware_version, s.store_name, s.region)""", """
qb AS (SELECT *, NTILE(4) OVER (ORDER BY spike_rate_pct DESC, device_id, device_key) AS risk_quartile FROM m)""") + f"""
SELECT device_id, store_name, region, model_version, firmware_version, total_sessions, avg_temp, total_spikes,
       spike_rate_pct, CAST(risk_quartile AS BIGINT) AS risk_quartile,
       CASE risk_quartile WHEN 1 THEN {q(C.MAINTENANCE_LABELS[1])} WHEN 2 THEN {q(C.MAINTENANCE_LABELS[2])}
            WHEN 3 THEN {q(C.MAINTENANCE_LABELS[3])} WHEN 4 THEN {q(C.MAINTENANCE_LABELS[4])} END
         AS maintenance_priority
FROM qb"""

FIRMWARE_COMPLIANCE = with_(P2, f"""
fw AS (
  SELECT d.firmware_version, COUNT(DISTINCT d.device_id) AS device_count, COUNT(*) AS total_readings,
         {mean2('SUM(' + cents('f.temperature_celsius') + ')', 'COUNT(f.temperature_celsius)')} AS avg_temp,
         {SPIKES} AS total_spikes, {pct2(SPIKES, 'COUNT(*)')} AS spike_rate_pct,
         {mean2('SUM(' + cents('f.power_draw_watts') + ')', 'COUNT(f.power_draw_watts)')} AS avg_power_watts
  FROM p2_fact f JOIN p2_device d ON f.device_key = d.device_key
  WHERE f.temperature_celsius IS NOT NULL
  GROUP BY d.firmware_version)""") + f"""
SELECT CAST(DENSE_RANK() OVER (ORDER BY spike_rate_pct DESC) AS BIGINT) AS compliance_rank, firmware_version,
       device_count, total_readings, avg_temp, total_spikes, spike_rate_pct, avg_power_watts,
       CASE WHEN spike_rate_pct > 10 THEN {q(C.FIRMWARE_LABELS[0])} WHEN spike_rate_pct > 7
            THEN {q(C.FIRMWARE_LABELS[1])} ELSE {q(C.FIRMWARE_LABELS[2])} END AS compliance_status
FROM fw"""

ORACLE: dict[str, str] = {
    "high_risk_stores": HIGH_RISK_STORES,
    "device_health": DEVICE_HEALTH,
    "store_spike_ranking": STORE_SPIKE_RANKING,
    "store_spike_ranking_all": STORE_SPIKE_RANKING_ALL,
    "mom_temp_trend": MOM_TEMP_TREND,
    "next_session_early_warning": early_warning(50),
    "next_session_all": early_warning(None),
    "cumulative_spikes": cumulative_spikes("p2"),
    "cumulative_spikes_events": cumulative_spikes("p1"),
    "calendar_rolling_avg": CALENDAR_ROLLING_AVG,
    "device_risk_quartiles": DEVICE_RISK_QUARTILES,
    "firmware_compliance": FIRMWARE_COMPLIANCE,
}


# ---------------------------------------------------------------------------
# Shared CTEs for alerts, anomalies and dashboards (events profile)
# ---------------------------------------------------------------------------

def _sql_lit(v) -> str:
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, (int, float)):
        return str(v)
    return q(str(v))


def _values(rows, cols) -> str:
    body = ", ".join("(" + ", ".join(_sql_lit(v) for v in r) + ")" for r in rows)
    return f"(VALUES {body}) t({', '.join(cols)})"


def _alert_cte() -> str:
    cols = ["alert_type_key", "alert_code", "alert_category", "alert_name", "severity", "auto_shutoff",
            "notifies_regional", "sla_response_mins"]
    return f"p1_alert AS (SELECT * FROM {_values(C.ALERT_TYPES, cols)})"


def _routing_cte() -> str:
    from fleetstar.sources.profiles import ROUTING_ROWS

    return f"routing AS (SELECT * FROM {_values(ROUTING_ROWS, ['region', 'manager_name', 'manager_email', 'manager_handle'])})"


ALERT_CTE = _alert_cte()
ROUTING_CTE = _routing_cte()

ALERTED = """
alerted AS (
  SELECT f.telemetry_key, f.event_timestamp, f.temperature_celsius, f.max_temp_threshold, f.temp_delta,
         f.session_duration_secs, d.device_id, d.model_version, d.firmware_version, s.store_id, s.store_name,
         s.city, s.country, s.region, a.alert_code, a.alert_name, a.severity, a.sla_response_mins
  FROM p1_fact f JOIN p1_device d ON f.device_key = d.device_key JOIN p1_store s ON f.store_key = s.store_key
       JOIN p1_alert a ON f.alert_type_key = a.alert_type_key
  WHERE a.alert_code = 'THERM-CRIT' AND a.notifies_regional)"""

ALERT_SELECT = """
SELECT telemetry_key, event_timestamp, CAST(temperature_celsius AS DOUBLE) AS temperature_celsius,
       CAST(max_temp_threshold AS DOUBLE) AS max_temp_threshold, CAST(temp_delta AS DOUBLE) AS temp_delta,
       CAST(session_duration_secs AS BIGINT) AS session_duration_secs, device_id, model_version, firmware_version,
       store_id, store_name, city, country, region, alert_code, alert_name, severity,
       CAST(sla_response_mins AS BIGINT) AS sla_response_mins
FROM alerted"""


def _routed() -> str:
    from fleetstar.sources.profiles import ROUTING_DEFAULT as D

    return f"""
routed AS (
  SELECT a.*, COALESCE(r.manager_name, {q(D['manager_name'])}) AS manager_name,
         COALESCE(r.manager_email, {q(D['manager_email'])}) AS manager_email,
         COALESCE(r.manager_handle, {q(D['manager_handle'])}) AS manager_handle
  FROM alerted a LEFT JOIN routing r ON a.region = r.region)"""


ROUTED = _routed()
ALERT_BASE = with_(P1, ALERT_CTE, ROUTING_CTE, ALERTED, ROUTED)

CRITICAL_ALERTS = ALERT_BASE + ALERT_SELECT + " ORDER BY temperature_celsius DESC NULLS LAST, telemetry_key LIMIT 20"
CRITICAL_ALERTS_ALL = ALERT_BASE + ALERT_SELECT
# The source database sorts NULL first on DESC: the report then opens with
# critical readings whose temperature is missing.
CRITICAL_ALERTS_NULLS_FIRST = (ALERT_BASE + ALERT_SELECT
                               + " ORDER BY temperature_celsius DESC NULLS FIRST, telemetry_key LIMIT 20")
SINCE_SELECT = """
SELECT telemetry_key, event_timestamp, CAST(temperature_celsius AS DOUBLE) AS temperature_celsius,
       CAST(max_temp_threshold AS DOUBLE) AS max_temp_threshold, device_id, firmware_version, store_name, city,
       country, region, alert_code, severity, CAST(sla_response_mins AS BIGINT) AS sla_response_mins
FROM alerted"""
CRITICAL_ALERTS_SINCE = ALERT_BASE + SINCE_SELECT + """
WHERE event_timestamp >= (SELECT max(event_timestamp) FROM p1_fact) - INTERVAL 7 DAY"""

ROUTED_ALERTS = ALERT_BASE + """
SELECT telemetry_key, event_timestamp, CAST(temperature_celsius AS DOUBLE) AS temperature_celsius,
       CAST(max_temp_threshold AS DOUBLE) AS max_temp_threshold, CAST(temp_delta AS DOUBLE) AS temp_delta,
       CAST(session_duration_secs AS BIGINT) AS session_duration_secs, device_id, model_version, firmware_version,
       store_id, store_name, city, country, region, alert_code, alert_name, severity,
       CAST(sla_response_mins AS BIGINT) AS sla_response_mins, manager_name, manager_email, manager_handle
FROM routed"""

_FACT_TEXT = {
    "Store": "store_name || ' (' || city || ', ' || country || ')'",
    "Device ID": "device_id",
    "Firmware": "firmware_version",
    "Temperature": "COALESCE(CAST(temperature_celsius AS VARCHAR), 'N/A') || '°C  (threshold: ' || "
                   "COALESCE(CAST(max_temp_threshold AS VARCHAR), 'N/A') || '°C)'",
    "Overage": "'+' || COALESCE(CAST(temperature_celsius - max_temp_threshold AS VARCHAR), 'N/A') "
               "|| '°C above safety limit'",
    "Alert Code": "alert_code",
    "Severity": "severity",
    "SLA": "'Response required within ' || CAST(sla_response_mins AS VARCHAR) || ' minutes'",
    "Timestamp": "strftime(event_timestamp, '%Y-%m-%d %H:%M:%S')",
    "Region": "region",
    "Assigned To": "manager_name || ' (' || manager_handle || ')'",
}
CARD_FACT_COLUMNS = ["fact_" + t.lower().replace(" ", "_") for t in C.CARD_FACT_TITLES]

ALERT_CARDS = ALERT_BASE + f"""
SELECT telemetry_key, 'message' AS message_type, {q(C.CARD_CONTENT_TYPE)} AS content_type, {q(C.CARD_SCHEMA)} AS card_schema,
       'AdaptiveCard' AS card_type, '1.4' AS card_version, {q(C.CARD_HEADLINE)} AS headline, 'Bolder' AS headline_weight,
       'Large' AS headline_size, 'Attention' AS headline_color, CAST({len(C.CARD_FACT_TITLES)} AS BIGINT) AS fact_count,
       {', '.join(f'{_FACT_TEXT[t]} AS {c}' for t, c in zip(C.CARD_FACT_TITLES, CARD_FACT_COLUMNS))},
       {q(C.CARD_SHUTOFF_TEXT)} AS shutoff_text, 'true' AS shutoff_wrap, 'Action.OpenUrl' AS action_type, manager_email
FROM routed"""

EMAIL_ROWS = ALERT_BASE + f"""
SELECT telemetry_key, manager_email AS recipient,
       '[CRITICAL] Thermal Alert — ' || store_name || ' — ' || device_id AS subject,
       {' || chr(10) || '.join(q(t + ': ') + ' || ' + _FACT_TEXT[t] for t in C.CARD_FACT_TITLES)} AS body
FROM routed"""

OUTBOX_RUN_TS = "2024-02-01 00:00:00"
NOTIFICATION_OUTBOX = ALERT_BASE + f"""
SELECT telemetry_key, store_name AS store, device_id AS device, CAST(temperature_celsius AS DOUBLE) AS temperature,
       region, manager_name AS manager, TIMESTAMP '{OUTBOX_RUN_TS}' AS notified_at, {q(C.OUTBOX_STATUS)} AS status
FROM routed"""

RETAIN_AS_OF = "2024-02-15 00:00:00"
RETAIN_ALERT_LOG = ALERT_BASE + ALERT_SELECT + f"""
WHERE event_timestamp >= TIMESTAMP '{RETAIN_AS_OF}' - INTERVAL 1 MONTH"""

ALERT_ACTIONS = with_(P1, ALERT_CTE) + """
SELECT f.telemetry_key, a.alert_code, a.severity, a.auto_shutoff, a.notifies_regional, f.event_timestamp,
       f.event_timestamp + to_minutes(CAST(a.sla_response_mins AS INTEGER)) AS sla_due_ts
FROM p1_fact f JOIN p1_alert a ON f.alert_type_key = a.alert_type_key"""

# ---------------------------------------------------------------------------
# Anomaly detector
# ---------------------------------------------------------------------------

_D = "CAST({} AS DOUBLE)"
FLAGS = with_(P1, """
an AS (SELECT * FROM p1_fact WHERE temperature_celsius IS NOT NULL)""", """
st AS (
  SELECT avg(CAST(temperature_celsius AS DOUBLE)) AS mu, stddev_samp(CAST(temperature_celsius AS DOUBLE)) AS sd,
         quantile_cont(CAST(power_draw_watts AS DOUBLE), 0.25) AS p1,
         quantile_cont(CAST(power_draw_watts AS DOUBLE), 0.75) AS p3,
         quantile_cont(CAST(session_duration_secs AS DOUBLE), 0.25) AS s1,
         quantile_cont(CAST(session_duration_secs AS DOUBLE), 0.75) AS s3
  FROM an)""", """
fl0 AS (
  SELECT an.*,
    COALESCE(abs((CAST(temperature_celsius AS DOUBLE) - mu) / sd) > 2.5, FALSE) AS z_flag,
    COALESCE(CAST(power_draw_watts AS DOUBLE) < p1 - 1.5 * (p3 - p1)
             OR CAST(power_draw_watts AS DOUBLE) > p3 + 1.5 * (p3 - p1), FALSE) AS iqr_power_flag,
    COALESCE(CAST(session_duration_secs AS DOUBLE) < s1 - 1.5 * (s3 - s1)
             OR CAST(session_duration_secs AS DOUBLE) > s3 + 1.5 * (s3 - s1), FALSE) AS iqr_session_flag,
    COALESCE(data_quality_flag <> 'CLEAN', FALSE) AS quality_flag
  FROM an CROSS JOIN st)""", """
fl AS (
  SELECT *, z_flag OR iqr_power_flag OR iqr_session_flag OR quality_flag AS is_anomaly_detected,
         concat_ws(',', CASE WHEN z_flag THEN 'ZSCORE' END, CASE WHEN iqr_power_flag THEN 'IQR_POWER' END,
                   CASE WHEN iqr_session_flag THEN 'IQR_SESSION' END, CASE WHEN quality_flag THEN 'QUALITY' END)
           AS anomaly_methods
  FROM fl0)""")

ZSCORE_FLAGS = FLAGS + " SELECT telemetry_key, CAST(temperature_celsius AS DOUBLE) AS temperature_celsius, z_flag FROM fl"
IQR_FLAGS = FLAGS + """ SELECT telemetry_key, iqr_power_flag AS iqr_power_draw_watts_flag,
  iqr_session_flag AS iqr_session_duration_secs_flag FROM fl"""
COMPOSITE_ANOMALY = FLAGS + """ SELECT telemetry_key, z_flag, iqr_power_flag, iqr_session_flag, quality_flag,
  is_anomaly_detected, anomaly_methods FROM fl"""
APPLY_ANOMALY_FLAGS = FLAGS + """
SELECT f.telemetry_key, COALESCE(fl.is_anomaly_detected, f.is_anomaly) AS is_anomaly
FROM p1_fact f LEFT JOIN fl ON f.telemetry_key = fl.telemetry_key"""
ANOMALY_REPORT = FLAGS + """
SELECT fl.telemetry_key, fl.event_timestamp, d.device_id, s.store_name, s.region,
       CAST(fl.temperature_celsius AS DOUBLE) AS temperature_celsius,
       CAST(fl.power_draw_watts AS DOUBLE) AS power_draw_watts,
       CAST(fl.session_duration_secs AS BIGINT) AS session_duration_secs, fl.data_quality_flag, fl.anomaly_methods
FROM fl JOIN p1_device d ON fl.device_key = d.device_key JOIN p1_store s ON fl.store_key = s.store_key
WHERE fl.is_anomaly_detected"""
_RATE = f"""COUNT(*) AS records_analyzed, COUNT(*) FILTER (WHERE is_anomaly_detected) AS anomalies,
       {pct2('COUNT(*) FILTER (WHERE is_anomaly_detected)', 'COUNT(*)')} AS anomaly_rate_pct"""
ANOMALY_RATE_BY_REGION = FLAGS + f"""
SELECT s.region, {_RATE} FROM fl JOIN p1_store s ON fl.store_key = s.store_key GROUP BY s.region"""
ANOMALY_RATE_BY_DEVICE = FLAGS + f"""
SELECT d.device_id, s.store_name, {_RATE}
FROM fl JOIN p1_device d ON fl.device_key = d.device_key JOIN p1_store s ON fl.store_key = s.store_key
GROUP BY d.device_key, d.device_id, s.store_name"""
ANOMALY_SUMMARY = FLAGS + f""",
reg AS (SELECT s.region, {_RATE} FROM fl JOIN p1_store s ON fl.store_key = s.store_key GROUP BY s.region),
dev AS (SELECT d.device_id, s.store_name, {_RATE}
        FROM fl JOIN p1_device d ON fl.device_key = d.device_key JOIN p1_store s ON fl.store_key = s.store_key
        GROUP BY d.device_key, d.device_id, s.store_name),
wr AS (SELECT region, anomaly_rate_pct FROM reg ORDER BY anomaly_rate_pct DESC, region LIMIT 1),
wd AS (SELECT device_id, store_name, anomaly_rate_pct FROM dev
       ORDER BY anomaly_rate_pct DESC, device_id, store_name LIMIT 1),
tot AS (SELECT COUNT(*) AS records_analyzed, COUNT(*) FILTER (WHERE is_anomaly_detected) AS anomalies_detected,
               COUNT(*) FILTER (WHERE z_flag) AS zscore_flags, COUNT(*) FILTER (WHERE iqr_power_flag) AS iqr_power_flags,
               COUNT(*) FILTER (WHERE iqr_session_flag) AS iqr_session_flags,
               COUNT(*) FILTER (WHERE quality_flag) AS quality_flags FROM fl)
SELECT records_analyzed, anomalies_detected, {pct1('anomalies_detected', 'records_analyzed')} AS anomaly_pct,
       zscore_flags, iqr_power_flags, iqr_session_flags, quality_flags,
       wr.region AS worst_region, wr.anomaly_rate_pct AS worst_region_pct,
       wd.device_id AS worst_device, wd.store_name AS worst_device_store, wd.anomaly_rate_pct AS worst_device_pct
FROM tot, wr, wd"""

# ---------------------------------------------------------------------------
# Flat extract and dashboards
# ---------------------------------------------------------------------------

FACT_COLS = ["telemetry_key", "date_key", "device_key", "store_key", "alert_type_key", "event_timestamp",
             "ingestion_timestamp", "temperature_celsius", "max_temp_threshold", "temp_delta", "is_thermal_spike",
             "session_duration_secs", "power_draw_watts", "airflow_speed", "gdpr_compliant", "data_quality_flag",
             "is_anomaly"]
_FACT_TYPED = {"date_key": "BIGINT", "alert_type_key": "BIGINT", "temperature_celsius": "DOUBLE",
               "max_temp_threshold": "DOUBLE", "temp_delta": "DOUBLE", "session_duration_secs": "BIGINT",
               "power_draw_watts": "DOUBLE", "airflow_speed": "BIGINT"}


def _typed(prefix: str, c: str) -> str:
    t = _FACT_TYPED.get(c)
    return f"CAST({prefix}{c} AS {t}) AS {c}" if t else f"{prefix}{c}"


FLAT = """
flat AS (
  SELECT f.*, s.store_name, s.city, s.country, s.region, d.device_id, d.model_version, d.firmware_version,
         monthname(f.full_date) AS month_name, quarter(f.full_date) AS quarter, year(f.full_date) AS year,
         a.alert_code, a.severity
  FROM p1_fact f JOIN p1_store s ON f.store_key = s.store_key JOIN p1_device d ON f.device_key = d.device_key
       LEFT JOIN p1_alert a ON f.alert_type_key = a.alert_type_key)"""

TELEMETRY_EXPORT = with_(P1, ALERT_CTE, FLAT) + f"""
SELECT {', '.join(_typed('', c) for c in FACT_COLS)}, store_name, city, country, region, device_id, model_version,
       firmware_version, full_date, month_name, CAST(quarter AS BIGINT) AS quarter, CAST(year AS BIGINT) AS year,
       alert_code, severity
FROM flat"""

_RATE_D = "(CAST(SUM(CAST(is_thermal_spike AS INTEGER)) AS DOUBLE) / COUNT(telemetry_key)) * 100.0"
SPIKE_RATE_MAP = with_(P1, ALERT_CTE, FLAT) + f"""
SELECT country, city, region, COUNT(telemetry_key) AS readings, {_RATE_D} AS spike_rate_pct,
       CASE WHEN MIN(store_name) = MAX(store_name) THEN MIN(store_name) ELSE '*' END AS store_name
FROM flat GROUP BY country, city, region"""

_AVG6 = mean6("SUM(" + cents("temperature_celsius") + ")", "COUNT(temperature_celsius)")
P2_FLAT = """
flat AS (SELECT f.* FROM p2_fact f JOIN p2_store s ON f.store_key = s.store_key
                 JOIN p2_device d ON f.device_key = d.device_key)"""


def monthly_health(by_year: bool) -> str:
    keys = "year(full_date), month(full_date)" if by_year else "month(full_date)"
    year = "CAST(year(full_date) AS BIGINT) AS year, " if by_year else ""
    return with_(P2, P2_FLAT) + f"""
SELECT {year}CAST(month(full_date) AS BIGINT) AS month_number, COUNT(telemetry_key) AS readings, {_AVG6} AS avg_temp,
       CAST(SUM(session_duration_secs) AS DOUBLE) / COUNT(session_duration_secs) AS avg_session_secs
FROM flat GROUP BY {keys}"""


STORE_VS_GLOBAL = with_(P1, ALERT_CTE, FLAT, f"""
g AS (SELECT SUM({cents('temperature_celsius')}) AS gs, COUNT(temperature_celsius) AS gn FROM flat)""", f"""
per AS (SELECT store_name, COUNT(telemetry_key) AS readings, SUM({cents('temperature_celsius')}) AS ts,
               COUNT(temperature_celsius) AS tn, {_RATE_D} AS spike_rate_pct FROM flat GROUP BY store_name)""") + """
SELECT store_name, readings, CAST((20000 * ts + tn) // (2 * tn) AS DOUBLE) / 1000000 AS avg_temp, spike_rate_pct,
       CAST((20000 * gs + gn) // (2 * gn) AS DOUBLE) / 1000000 AS global_avg_temp,
       round((CAST(ts AS DOUBLE) / tn - CAST(gs AS DOUBLE) / gn) / 100, 6) AS store_vs_global_diff
FROM per, g"""

COUNTRY_CITY_DRILL = with_(P1, ALERT_CTE, FLAT) + f"""
SELECT country, city, CAST(GROUPING(country, city) AS BIGINT) AS level, COUNT(telemetry_key) AS readings,
       CAST(SUM(CAST(is_thermal_spike AS INTEGER)) AS BIGINT) AS spikes, {_RATE_D} AS spike_rate_pct,
       {_AVG6} AS avg_temp
FROM flat GROUP BY ROLLUP (country, city)"""

# ---------------------------------------------------------------------------
# Quality, governance, dimensions
# ---------------------------------------------------------------------------

LOAD_SUMMARY = with_(P1) + f"""
SELECT COUNT(*) AS total_rows,
       COUNT(*) FILTER (WHERE is_thermal_spike) AS thermal_spikes,
       {pct1('COUNT(*) FILTER (WHERE is_thermal_spike)', 'COUNT(*)')} AS spike_pct,
       COUNT(*) FILTER (WHERE is_anomaly) AS anomalies,
       {pct1('COUNT(*) FILTER (WHERE is_anomaly)', 'COUNT(*)')} AS anomaly_pct,
       COUNT(*) FILTER (WHERE data_quality_flag <> 'CLEAN') AS dirty_records,
       {pct1("COUNT(*) FILTER (WHERE data_quality_flag <> 'CLEAN')", 'COUNT(*)')} AS dirty_pct
FROM p1_fact"""

CLASSIFY_ALERTS = with_(P1) + """
SELECT telemetry_key, COALESCE(temperature_celsius > max_temp_threshold, FALSE) AS spike_recomputed,
       CAST(CASE WHEN temperature_celsius IS NULL THEN alert_type_key
                 WHEN is_thermal_spike AND temperature_celsius > 150 THEN 1
                 WHEN is_thermal_spike THEN 2 ELSE alert_type_key END AS BIGINT) AS alert_type_key_derived
FROM p1_fact"""

QUALITY_FLAG_AUDIT = with_(P1) + """
SELECT telemetry_key, data_quality_flag, is_thermal_spike, spike_recomputed,
       concat_ws(',', CASE WHEN is_thermal_spike <> spike_recomputed THEN 'SPIKE_FLAG_MISMATCH' END,
                 CASE WHEN (data_quality_flag = 'MISSING') <> (temperature_celsius IS NULL)
                      THEN 'MISSING_FLAG_MISMATCH' END) AS reason
FROM (SELECT *, COALESCE(temperature_celsius > max_temp_threshold, FALSE) AS spike_recomputed FROM p1_fact)
WHERE is_thermal_spike <> spike_recomputed OR (data_quality_flag = 'MISSING') <> (temperature_celsius IS NULL)"""

TEMP_DELTA = with_(P1) + """
SELECT telemetry_key,
       CAST(temperature_celsius - LAST_VALUE(temperature_celsius IGNORE NULLS) OVER (
              PARTITION BY device_key ORDER BY event_timestamp, telemetry_key
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS DOUBLE) AS temp_delta_derived
FROM p1_fact"""

_CONFORM = {"temperature_celsius": "DECIMAL(5,2)", "max_temp_threshold": "DECIMAL(5,2)",
            "temp_delta": "DECIMAL(5,2)", "power_draw_watts": "DECIMAL(6,2)"}
CONFORM_FACT = with_(P1) + " SELECT " + ", ".join(
    (f"CAST(CAST({c} AS {_CONFORM[c]}) AS DOUBLE) AS {c}" if c in _CONFORM else _typed('', c)) for c in FACT_COLS
) + " FROM p1_fact"

COLUMN_PROFILE = with_(P1) + "\n" + "\nUNION ALL\n".join(
    f"SELECT {q(c)} AS column_name, COUNT({c}) AS non_null_count, COUNT(*) FILTER (WHERE {c} IS NULL) AS null_count, "
    f"COUNT(DISTINCT {c}) AS distinct_count FROM p1_fact" for c in FACT_COLS)

QUALITY_BREAKDOWN = with_(P1, """
per AS (SELECT s.store_key, s.store_name, s.region, f.data_quality_flag, COUNT(*) AS readings
        FROM p1_fact f JOIN p1_store s ON f.store_key = s.store_key
        GROUP BY s.store_key, s.store_name, s.region, f.data_quality_flag)""") + f"""
SELECT store_key, store_name, region, data_quality_flag, readings,
       {pct2('readings', 'SUM(readings) OVER (PARTITION BY store_key)')} AS share_pct
FROM per"""

QUALITY_BREAKDOWN_FIRMWARE = with_(P1, """
per AS (SELECT d.firmware_version, f.data_quality_flag, COUNT(*) AS readings
        FROM p1_fact f JOIN p1_device d ON f.device_key = d.device_key
        GROUP BY d.firmware_version, f.data_quality_flag)""") + f"""
SELECT firmware_version, data_quality_flag, readings,
       {pct2('readings', 'SUM(readings) OVER (PARTITION BY firmware_version)')} AS share_pct
FROM per"""

QUALITY_BREAKDOWN_DEVICE = with_(P1, """
per AS (SELECT d.device_key, d.device_id, d.firmware_version, f.data_quality_flag, COUNT(*) AS readings
        FROM p1_fact f JOIN p1_device d ON f.device_key = d.device_key
        GROUP BY d.device_key, d.device_id, d.firmware_version, f.data_quality_flag)""") + f"""
SELECT device_key, device_id, firmware_version, data_quality_flag, readings,
       {pct2('readings', 'SUM(readings) OVER (PARTITION BY device_key)')} AS share_pct
FROM per"""

QUALITY_BREAKDOWN_MONTH = with_(P2, """
per AS (SELECT year(full_date) AS year, month(full_date) AS month_number, data_quality_flag, COUNT(*) AS readings
        FROM p2_fact GROUP BY 1, 2, 3)""") + f"""
SELECT CAST(year AS BIGINT) AS year, CAST(month_number AS BIGINT) AS month_number, data_quality_flag, readings,
       {pct2('readings', 'SUM(readings) OVER (PARTITION BY year, month_number)')} AS share_pct
FROM per"""

_GDPR_STORES = with_(P1, """
per AS (SELECT store_key, COUNT(*) AS total_readings, COUNT(*) FILTER (WHERE NOT gdpr_compliant) AS non_compliant
        FROM p1_fact GROUP BY store_key)""", """
masked AS (SELECT store_key, COUNT(*) FILTER (WHERE gdpr_masked) AS masked_devices FROM p1_device GROUP BY store_key)""", """
stores AS (SELECT s.store_name, s.region, COALESCE(per.total_readings, 0) AS total_readings,
                  COALESCE(per.non_compliant, 0) AS non_compliant, COALESCE(masked.masked_devices, 0) AS masked_devices
           FROM p1_store s LEFT JOIN per ON per.store_key = s.store_key LEFT JOIN masked ON masked.store_key = s.store_key)""")

_GDPR_RATE = f"CASE WHEN total_readings > 0 THEN {pct2('non_compliant', 'total_readings')} END AS non_compliant_pct"

GDPR_REPORT = _GDPR_STORES + f"""
SELECT store_name, region, total_readings, non_compliant, {_GDPR_RATE}, masked_devices
FROM stores WHERE total_readings > 0 OR masked_devices > 0"""

GDPR_REPORT_BY_REGION = _GDPR_STORES + f"""
SELECT *, {_GDPR_RATE} FROM (
  SELECT region, CAST(SUM(total_readings) AS BIGINT) AS total_readings, CAST(SUM(non_compliant) AS BIGINT) AS non_compliant,
         CAST(SUM(masked_devices) AS BIGINT) AS masked_devices
  FROM stores GROUP BY region) WHERE total_readings > 0 OR masked_devices > 0"""


def _rule_sql(r, table_of) -> str:
    t = table_of[r.table]
    if r.kind == "not_null":
        expr, src = f"COUNT(*) FILTER (WHERE {r.column} IS NULL)", t
    elif r.kind == "max_length":
        expr, src = f"COUNT(*) FILTER (WHERE length({r.column}) > {r.arg})", t
    elif r.kind == "domain":
        vals = ", ".join(q(v) for v in r.arg)
        expr, src = f"COUNT(*) FILTER (WHERE {r.column} NOT IN ({vals}))", t
    elif r.kind == "missing_iff_null":
        expr, src = "COUNT(*) FILTER (WHERE (data_quality_flag = 'MISSING') <> (temperature_celsius IS NULL))", t
    elif r.kind == "duplicate":
        expr = "COALESCE(SUM(n - 1), 0)"
        src = f"(SELECT {r.column}, COUNT(*) AS n FROM {t} GROUP BY {r.column} HAVING COUNT(*) > 1)"
    elif r.kind == "orphan":
        parent, pcol = r.arg
        expr = "COUNT(*)"
        src = (f"{t} c WHERE c.{r.column} IS NOT NULL AND NOT EXISTS "
               f"(SELECT 1 FROM {table_of[parent]} p WHERE p.{pcol} = c.{r.column})")
    elif r.kind == "store_matches_device":
        expr = "COUNT(*)"
        src = (f"{t} f JOIN {table_of['device']} d ON f.device_key = d.device_key "
               "WHERE f.store_key IS DISTINCT FROM d.store_key")
    else:
        raise ValueError(r.kind)
    return f"SELECT {q(r.name)} AS rule, {q(r.table)} AS table_name, CAST({expr} AS BIGINT) AS violations FROM {src}"


_CALENDAR = """
p1_date AS (SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS BIGINT) AS date_key, d AS full_date,
                   dayname(d) AS day_of_week, isodow(d) AS day_number, weekofyear(d) AS week_number, month(d) AS month_number,
                   monthname(d) AS month_name, quarter(d) AS quarter, year(d) AS year, isodow(d) >= 6 AS is_weekend,
                   'FY' || year(d) || '-Q' || quarter(d) AS fiscal_period
            FROM (SELECT CAST(unnest(generate_series({lo}, {hi}, INTERVAL 1 DAY)) AS DATE) AS d {src}))"""


def _check_constraints(broken: bool = False) -> str:
    from fleetstar import schemas as S
    from fleetstar.operators.quality import default_rules

    cols = {"fact": S.FACT_COLUMNS + ["full_date"], "store": [f.name for f in S.STORE.fields],
            "device": [f.name for f in S.DEVICE.fields], "alert": [f.name for f in S.ALERT.fields],
            "date": [f.name for f in S.DATE.fields]}
    table_of = {"fact": "p1_fact", "store": "p1_store", "device": "p1_device", "alert": "p1_alert", "date": "p1_date"}
    rules, more = default_rules(cols), []
    if broken:  # accounts in good standing, each once per order-free copy, and a calendar that ends too early
        table_of["device"] = "good_device"
        more = ["good_device AS (SELECT d.* FROM p1_device d JOIN customer c ON c.c_custkey = d.device_key WHERE c.c_acctbal >= 0 "
                "UNION ALL SELECT d.* FROM p1_device d JOIN customer c ON c.c_custkey = d.device_key WHERE c.c_acctbal >= 9000)",
                _CALENDAR.format(lo="TIMESTAMP '2024-01-01'", hi="TIMESTAMP '2024-01-15'", src="")]
    else:
        more = [_CALENDAR.format(lo="CAST(lo AS TIMESTAMP)", hi="CAST(hi AS TIMESTAMP)",
                                 src="FROM (SELECT min(full_date) AS lo, max(full_date) AS hi FROM p1_fact)")]
    return with_(P1, ALERT_CTE, *more) + "\n" + "\nUNION ALL\n".join(_rule_sql(r, table_of) for r in rules)


CHECK_CONSTRAINTS = _check_constraints()
CHECK_CONSTRAINTS_BROKEN = _check_constraints(broken=True)

APPEND_FACTS = with_(P1, """
j AS (SELECT f.telemetry_key, c.c_custkey IS NOT NULL AS known FROM p1_fact f
      LEFT JOIN customer c ON c.c_custkey = f.device_key AND c.c_acctbal >= 0)""") + """
SELECT 'load-1' AS load, CASE WHEN known THEN 'valid' ELSE 'unknown device' END AS outcome, COUNT(*) AS readings FROM j GROUP BY ALL
UNION ALL
SELECT 'load-2' AS load, CASE WHEN known THEN 'key already loaded' ELSE 'unknown device' END AS outcome, COUNT(*) AS readings
FROM j GROUP BY ALL"""

DATE_DIMENSION = with_(P2, """
days AS (SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d
         FROM (SELECT min(full_date) AS lo, max(full_date) AS hi FROM p2_fact))""") + """
SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS BIGINT) AS date_key, d AS full_date,
       dayname(d) AS day_of_week, CAST(isodow(d) AS BIGINT) AS day_number, CAST(weekofyear(d) AS BIGINT) AS week_number,
       CAST(month(d) AS BIGINT) AS month_number, monthname(d) AS month_name, CAST(quarter(d) AS BIGINT) AS quarter,
       CAST(year(d) AS BIGINT) AS year, isodow(d) >= 6 AS is_weekend,
       'FY' || CAST(year(d) AS VARCHAR) || '-Q' || CAST(quarter(d) AS VARCHAR) AS fiscal_period
FROM days"""

_DEV_COLS = "device_key, device_id, store_key, model_version, firmware_version, gdpr_masked"
DEVICE_UPSERT = with_(P1, f"""
target AS (SELECT {_DEV_COLS} FROM p1_device WHERE device_key IN (SELECT user_id FROM events))""", f"""
incoming AS (SELECT {_DEV_COLS} FROM p1_device)""", """
fresh AS (SELECT DISTINCT * FROM incoming WHERE device_id NOT IN (SELECT device_id FROM target))""")
INSERT_IF_ABSENT = DEVICE_UPSERT + " SELECT * FROM target UNION ALL SELECT * FROM fresh"
ASSIGN_SURROGATE_KEYS = DEVICE_UPSERT + """
SELECT device_id, (SELECT max(device_key) FROM target) + ROW_NUMBER() OVER (ORDER BY device_id, device_key)
         AS new_device_key
FROM fresh"""

ORACLE.update({
    "critical_alerts": CRITICAL_ALERTS,
    "critical_alerts_all": CRITICAL_ALERTS_ALL,
    "critical_alerts_nulls_first": CRITICAL_ALERTS_NULLS_FIRST,
    "critical_alerts_since": CRITICAL_ALERTS_SINCE,
    "routed_alerts": ROUTED_ALERTS,
    "alert_cards": ALERT_CARDS,
    "email_rows": EMAIL_ROWS,
    "notification_outbox": NOTIFICATION_OUTBOX,
    "retain_alert_log": RETAIN_ALERT_LOG,
    "alert_actions": ALERT_ACTIONS,
    "zscore_flags": ZSCORE_FLAGS,
    "iqr_flags": IQR_FLAGS,
    "composite_anomaly": COMPOSITE_ANOMALY,
    "refresh_anomaly_flags": APPLY_ANOMALY_FLAGS,
    "apply_anomaly_flags": APPLY_ANOMALY_FLAGS,
    "anomaly_report": ANOMALY_REPORT,
    "anomaly_report_csv": ANOMALY_REPORT,
    "anomaly_rate_by_region": ANOMALY_RATE_BY_REGION,
    "anomaly_rate_by_device": ANOMALY_RATE_BY_DEVICE,
    "anomaly_summary": ANOMALY_SUMMARY,
    "telemetry_export": TELEMETRY_EXPORT,
    "telemetry_export_csv": TELEMETRY_EXPORT,
    "spike_rate_map": SPIKE_RATE_MAP,
    "monthly_operational_health": monthly_health(False),
    "monthly_operational_health_by_year": monthly_health(True),
    "store_vs_global": STORE_VS_GLOBAL,
    "country_city_drill": COUNTRY_CITY_DRILL,
    "load_summary": LOAD_SUMMARY,
    "classify_alerts": CLASSIFY_ALERTS,
    "quality_flag_audit": QUALITY_FLAG_AUDIT,
    "temp_delta": TEMP_DELTA,
    "conform_fact": CONFORM_FACT,
    "column_profile": COLUMN_PROFILE,
    "quality_breakdown": QUALITY_BREAKDOWN,
    "quality_breakdown_device": QUALITY_BREAKDOWN_DEVICE,
    "quality_breakdown_firmware": QUALITY_BREAKDOWN_FIRMWARE,
    "quality_breakdown_month": QUALITY_BREAKDOWN_MONTH,
    "gdpr_report": GDPR_REPORT,
    "gdpr_report_by_region": GDPR_REPORT_BY_REGION,
    "check_constraints": CHECK_CONSTRAINTS,
    "check_constraints_broken": CHECK_CONSTRAINTS_BROKEN,
    "append_facts": APPEND_FACTS,
    "date_dimension": DATE_DIMENSION,
    "insert_if_absent": INSERT_IF_ABSENT,
    "assign_surrogate_keys": ASSIGN_SURROGATE_KEYS,
})

# ---------------------------------------------------------------------------
# Streaming (the stream runs to completion; its sink is read back)
# ---------------------------------------------------------------------------

STREAM_ALERT_OUTBOX = ALERT_BASE + f"""
SELECT telemetry_key, store_name AS store, device_id AS device, CAST(temperature_celsius AS DOUBLE) AS temperature,
       region, manager_name AS manager, {q(C.OUTBOX_STATUS)} AS status
FROM routed"""

STREAM_ALERT_WINDOW_COUNTS = with_(P1, ALERT_CTE, ALERTED) + """
SELECT time_bucket(INTERVAL 15 MINUTE, event_timestamp) AS window_start,
       time_bucket(INTERVAL 15 MINUTE, event_timestamp) + INTERVAL 15 MINUTE AS window_end,
       COUNT(*) AS alerts
FROM alerted
GROUP BY 1, 2"""

ORACLE.update({
    "stream_alert_outbox": STREAM_ALERT_OUTBOX,
    "stream_alert_window_counts": STREAM_ALERT_WINDOW_COUNTS,
})

# ---------------------------------------------------------------------------
# Kept current load by load: the answer is that of one pass over everything
# ---------------------------------------------------------------------------

FISCAL_PERIOD_HEALTH = with_(P2, f"""
f AS (SELECT 'FY' || year(full_date) || '-Q' || quarter(full_date) AS fiscal_period, isodow(full_date) >= 6 AS is_weekend, * FROM p2_fact)""") + f"""
SELECT fiscal_period, is_weekend, COUNT(*) AS total_readings, {SPIKES} AS spike_count,
       {mean2('SUM(' + cents('f.temperature_celsius') + ')', 'COUNT(f.temperature_celsius)')} AS avg_temp,
       {pct2(SPIKES, 'COUNT(*)')} AS spike_rate_pct
FROM f GROUP BY fiscal_period, is_weekend"""
COLUMN_SKETCHES = "SELECT *, TRUE AS within_error FROM (" + COLUMN_PROFILE + ")"
QUANTILE_SKETCHES = """
SELECT column_name, CAST(prob AS DOUBLE) AS prob, TRUE AS within_error
FROM (VALUES ('temperature_celsius'), ('power_draw_watts'), ('session_duration_secs')) c(column_name), (VALUES (0.25), (0.5), (0.75)) p(prob)"""
CSV_QUARANTINE = with_(P1) + """
SELECT CASE f.telemetry_key % 40 WHEN 3 THEN 'too few fields' WHEN 7 THEN 'temperature_celsius is no decimal(5,2)'
            WHEN 11 THEN 'too many fields' ELSE 'valid' END AS outcome, COUNT(*) AS lines
FROM p1_fact f JOIN p1_store s ON f.store_key = s.store_key JOIN p1_device d ON f.device_key = d.device_key GROUP BY 1"""

ORACLE.update({
    "poll_alerts": ALERT_BASE + SINCE_SELECT,
    "anomaly_flags_versioned": APPLY_ANOMALY_FLAGS,
    "temp_delta_loads": TEMP_DELTA,
    "column_sketches": COLUMN_SKETCHES,
    "quantile_sketches": QUANTILE_SKETCHES,
    "csv_quarantine": CSV_QUARANTINE,
    "fiscal_period_health": FISCAL_PERIOD_HEALTH,
    "spike_rate_map_loads": SPIKE_RATE_MAP,
    "store_vs_global_loads": STORE_VS_GLOBAL,
    "country_city_drill_loads": COUNTRY_CITY_DRILL,
    "monthly_operational_health_loads": monthly_health(False),
    "stream_window_counts_late": STREAM_ALERT_WINDOW_COUNTS,
})
