"""Structured Streaming jobs."""

from fleetstar.streaming.alerts import (  # noqa: F401
    OutboxWriter, alert_window_counts, compact_outbox, compact_window_counts, critical_alert_stream,
    reconcile_window_counts, run_alert_outbox, run_alert_window_counts, window_counts,
)
