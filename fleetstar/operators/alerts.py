"""Critical-alert selection, routing, cards, e-mail rows and the outbox.

The alert dimension is pre-filtered to the notifying codes (a handful of
rows) and broadcast, so only alerted readings reach the device/store joins.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetstar import constants as C
from fleetstar.operators.common import fact_date
from fleetstar.plans.joins import bounded_broadcast, join_dim

ALERT_COLUMNS = ["telemetry_key", "event_timestamp", "temperature_celsius", "max_temp_threshold", "temp_delta",
                 "session_duration_secs", "device_id", "model_version", "firmware_version", "store_id",
                 "store_name", "city", "country", "region", "alert_code", "alert_name", "severity",
                 "sla_response_mins"]
SINCE_COLUMNS = ["telemetry_key", "event_timestamp", "temperature_celsius", "max_temp_threshold", "device_id",
                 "firmware_version", "store_name", "city", "country", "region", "alert_code", "severity",
                 "sla_response_mins"]


def notifying_alerts(alert: DataFrame, codes=(C.ALERT_TYPES[0][1],)) -> DataFrame:
    """Alert types that notify the region; ``codes=None`` keeps every such code."""
    a = alert.filter(F.col("notifies_regional"))
    if codes is not None:
        a = a.filter(F.col("alert_code").isin(list(codes)))
    return a.select("alert_type_key", "alert_code", "alert_name", "severity", "sla_response_mins")


def _alerted(fact: DataFrame, device: DataFrame, store: DataFrame, alert: DataFrame, codes) -> DataFrame:
    x = join_dim(fact, notifying_alerts(alert, codes), "alert_type_key")
    x = join_dim(x, device.select("device_key", "device_id", "model_version", "firmware_version"), "device_key")
    return join_dim(x, store.select("store_key", "store_id", "store_name", "city", "country", "region"),
                    "store_key")


def critical_alerts(fact: DataFrame, device: DataFrame, store: DataFrame, alert: DataFrame,
                    codes=(C.ALERT_TYPES[0][1],), k: int | None = 20, nulls: str = "last") -> DataFrame:
    """Notifying alerts with device and store context, hottest ``k`` first.

    ``nulls='first'`` reproduces a database that sorts NULL temperatures
    first on DESC; the default lists measured temperatures first.
    """
    x = _alerted(fact, device, store, alert, codes)
    if k is None:
        # Every alert (input to routing, cards, e-mail, outbox): no report
        # order to honour, so no global sort of a fact-sized result.
        return x.select(*ALERT_COLUMNS)
    temp = F.desc_nulls_first("temperature_celsius") if nulls == "first" else F.desc_nulls_last("temperature_celsius")
    return x.orderBy(temp, F.asc("telemetry_key")).limit(k).select(*ALERT_COLUMNS)


def critical_alerts_since(fact: DataFrame, device: DataFrame, store: DataFrame, alert: DataFrame,
                          as_of=None, minutes: int = 15, codes=(C.ALERT_TYPES[0][1],)) -> DataFrame:
    """Notifying alerts whose event time lies in the ``minutes`` before ``as_of``.

    ``as_of`` is a datetime, a string, a Column, or ``None`` for now (UTC
    session clock). With a literal ``as_of`` the bound also prunes the
    ``reading_month`` partitions of a materialised fact and row groups by date.
    """
    if as_of is None:
        as_of = F.localtimestamp()
    if isinstance(as_of, (dt.datetime, str)):
        start_value = (dt.datetime.fromisoformat(str(as_of)) - dt.timedelta(minutes=int(minutes)))
        start = F.lit(start_value).cast("timestamp_ntz")
        fact = fact.filter(fact_date(fact) >= F.lit(start_value.date()))
        if "reading_month" in fact.columns:
            fact = fact.filter(F.col("reading_month") >= F.lit(start_value.strftime("%Y-%m")))
    else:
        start = as_of - F.expr(f"INTERVAL {int(minutes)} MINUTES")
    recent = fact.filter(F.col("event_timestamp") >= start)
    return _alerted(recent, device, store, alert, codes).select(*SINCE_COLUMNS)


def route_alerts(alerts: DataFrame, routing: DataFrame, default: dict) -> DataFrame:
    """Attach the regional manager; regions without one get the default contact."""
    r = routing.select(F.col("region").alias("_route_region"), "manager_name", "manager_email", "manager_handle")
    x = alerts.join(bounded_broadcast(r), alerts["region"] == r["_route_region"], "left").drop("_route_region")
    for c in ("manager_name", "manager_email", "manager_handle"):
        x = x.withColumn(c, F.coalesce(F.col(c), F.lit(default[c])))
    return x


def _dec_text(c: Column) -> Column:
    return c.cast("string")


def card_facts(routed: DataFrame) -> Column:
    """The card's 11 (title, value) facts in fixed order."""
    temp, thr = F.col("temperature_celsius"), F.col("max_temp_threshold")
    overage = F.coalesce(_dec_text(F.round(temp - thr, 2)), F.lit("N/A"))
    values = [
        F.format_string("%s (%s, %s)", "store_name", "city", "country"),
        F.col("device_id").cast("string"),
        F.col("firmware_version").cast("string"),
        F.concat(F.coalesce(_dec_text(temp), F.lit("N/A")), F.lit("°C  (threshold: "),
                 F.coalesce(_dec_text(thr), F.lit("N/A")), F.lit("°C)")),
        F.concat(F.lit("+"), overage, F.lit("°C above safety limit")),
        F.col("alert_code").cast("string"),
        F.col("severity").cast("string"),
        F.concat(F.lit("Response required within "), F.col("sla_response_mins").cast("string"), F.lit(" minutes")),
        F.date_format("event_timestamp", "yyyy-MM-dd HH:mm:ss"),
        F.col("region").cast("string"),
        F.concat(F.col("manager_name"), F.lit(" ("), F.col("manager_handle"), F.lit(")")),
    ]
    return F.array(*[F.struct(F.lit(t).alias("title"), v.alias("value"))
                     for t, v in zip(C.CARD_FACT_TITLES, values)])


def alert_cards(routed: DataFrame, dashboard_url: str = "https://example.com/dashboard") -> DataFrame:
    """One JSON message card per routed alert (headline, facts, shut-off note, action)."""
    text, flag, facts = "string", "boolean", "array<struct<title:string,value:string>>"

    def block(**fields):
        """A body element; properties that it lacks are left out of the JSON."""
        kinds = {"type": text, "text": text, "weight": text, "size": text, "color": text, "wrap": flag, "facts": facts}
        return F.struct(*[(fields[n] if n == "facts" and n in fields else F.lit(fields.get(n)).cast(k)).alias(n)
                          for n, k in kinds.items()])

    body = F.array(
        block(type="TextBlock", text=C.CARD_HEADLINE, weight="Bolder", size="Large", color="Attention"),
        block(type="FactSet", facts=card_facts(routed)),
        block(type="TextBlock", text=C.CARD_SHUTOFF_TEXT, wrap=True, color="Attention"))
    content = F.struct(
        F.lit(C.CARD_SCHEMA).alias("$schema"), F.lit("AdaptiveCard").alias("type"), F.lit("1.4").alias("version"),
        body.alias("body"),
        F.array(F.struct(F.lit("Action.OpenUrl").alias("type"), F.lit(C.CARD_ACTION_TITLE).alias("title"),
                         F.lit(dashboard_url).alias("url"))).alias("actions"))
    card = F.struct(F.lit("message").alias("type"), F.array(F.struct(
        F.lit(C.CARD_CONTENT_TYPE).alias("contentType"), content.alias("content"))).alias("attachments"))
    return routed.select("telemetry_key", "region", "manager_email", F.to_json(card).alias("card_json"))


def email_rows(routed: DataFrame) -> DataFrame:
    """Backup e-mail: recipient, subject and a body listing the card's facts."""
    body = F.array_join(F.transform(card_facts(routed), lambda f: F.concat(f["title"], F.lit(": "), f["value"])),
                        "\n")
    return routed.select("telemetry_key",
                         F.col("manager_email").alias("recipient"),
                         F.format_string(C.EMAIL_SUBJECT, F.col("store_name"), F.col("device_id")).alias("subject"),
                         body.alias("body"))


def notification_outbox(routed: DataFrame, run_ts, keep=()) -> DataFrame:
    """Audit rows for the outbox: one per alert, status PENDING (plus ``keep`` columns)."""
    ts = run_ts if isinstance(run_ts, Column) else F.lit(run_ts).cast("timestamp_ntz")
    return routed.select(*keep,
        "telemetry_key",
        F.col("store_name").alias("store"),
        F.col("device_id").alias("device"),
        F.col("temperature_celsius").alias("temperature"),
        "region",
        F.col("manager_name").alias("manager"),
        ts.alias("notified_at"),
        F.lit(C.OUTBOX_STATUS).alias("status"))


def append_outbox(rows: DataFrame, outbox_path: str, run_id: str, batch_id: int = 0) -> None:
    """Batch append to the audit outbox with the streaming sink's exactly-once rules.

    ``rows`` is ``notification_outbox(..., keep=("event_day",))`` with
    ``event_day`` the reading's date; re-running the same ``run_id`` and
    ``batch_id`` replaces that batch and nothing else.
    """
    from fleetstar.streaming.alerts import OutboxWriter

    OutboxWriter(outbox_path, run_id)(rows, batch_id)


def retain(log: DataFrame, ts_col: str = "notified_at", months: int = 12, as_of=None) -> DataFrame:
    """Rows younger than ``months`` months before ``as_of`` (default: now)."""
    now = F.localtimestamp() if as_of is None else (
        as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp_ntz"))
    cutoff = now - F.make_ym_interval(F.lit(0), F.lit(months))
    return log.filter(F.col(ts_col) >= cutoff)


def alert_actions(fact: DataFrame, alert: DataFrame) -> DataFrame:
    """Per alerted reading: shut-off and notification duties and the SLA deadline."""
    a = alert.select("alert_type_key", "alert_code", "severity", "auto_shutoff", "notifies_regional",
                     "sla_response_mins")
    x = join_dim(fact.filter(F.col("alert_type_key").isNotNull()), a, "alert_type_key")
    return x.select("telemetry_key", "alert_code", "severity", "auto_shutoff", "notifies_regional",
                    "event_timestamp",
                    F.timestamp_add("MINUTE", F.col("sla_response_mins"), F.col("event_timestamp"))
                    .alias("sla_due_ts"))
