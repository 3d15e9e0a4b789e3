"""Fleet telemetry governance on Spark.

A star model of device readings (fact + store, device, calendar and alert
dimensions) with fleet-health analytics, data-quality checks, a statistical
anomaly detector and an alert outbox, all expressed as DataFrame plans.
"""

from fleetstar.session import build_session, checkpoint_base

__all__ = ["build_session", "checkpoint_base"]
