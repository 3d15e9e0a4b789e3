"""Polling for critical alerts without gaps: a committed position per poll.

Each poll reads the readings that arrived since the last committed position,
less an overlap for writers whose clocks or commits lag, leaves out the keys
that earlier polls delivered in that overlap, and writes its alerts to its own
partition. Only then is the new position committed. A poll that dies between
the two is made again from the old position and replaces its own partition,
so no alert is lost or delivered twice.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetstar import constants as C
from fleetstar.operators.alerts import SINCE_COLUMNS, _alerted
from fleetstar.sources.files import overwrite_partitions, read_existing


class AlertPoll:
    """Polls of one consumer (``run``) under ``path``: ``alerts`` and ``cursor``.

    The position is on ``arrival``, the time a reading was stored, so readings
    of an earlier event time that arrive late are delivered too.
    """

    CURSOR = "upto timestamp_ntz, run string, poll bigint"

    def __init__(self, spark: SparkSession, path: str, run: str, overlap_minutes: int = 15,
                 arrival: str = "ingestion_timestamp", codes=(C.ALERT_TYPES[0][1],)):
        self.spark, self.path, self.run = spark, path, run
        self.overlap, self.arrival, self.codes = dt.timedelta(minutes=overlap_minutes), arrival, codes

    def position(self) -> tuple[int, dt.datetime | None]:
        """(number of the next poll, time up to which arrivals are delivered)."""
        cursor = read_existing(self.spark, f"{self.path}/cursor", self.CURSOR)
        last = None if cursor is None else cursor.where(F.col("run") == self.run).agg(F.max(F.struct("poll", "upto")).alias("m")).first()["m"]
        return (0, None) if last is None else (last["poll"] + 1, last["upto"])

    def collect(self, fact: DataFrame, device: DataFrame, store: DataFrame, alert: DataFrame, upto: dt.datetime) -> None:
        """Write the alerts that arrived before ``upto`` and since the committed position."""
        poll, since = self.position()
        at = F.col(self.arrival)
        recent = fact.where(at < F.lit(upto).cast("timestamp_ntz"))
        if since is not None:
            recent = recent.where(at >= F.lit(since - self.overlap).cast("timestamp_ntz"))
        columns = SINCE_COLUMNS + ([self.arrival] if self.arrival not in SINCE_COLUMNS else [])
        alerts = _alerted(recent, device, store, alert, self.codes).select(*columns)
        if since is not None:
            prior = self.delivered()
            seen = prior.where((F.col("poll") != poll) & (at >= F.lit(since - self.overlap).cast("timestamp_ntz"))).select("telemetry_key")
            alerts = alerts.join(seen, "telemetry_key", "left_anti")
        rows = alerts.dropDuplicates(["telemetry_key"]).withColumns({"run": F.lit(self.run), "poll": F.lit(poll).cast("long")})
        overwrite_partitions(rows, f"{self.path}/alerts", "run", "poll")

    def commit(self, upto: dt.datetime) -> None:
        """Move the position: arrivals before ``upto`` are delivered."""
        poll, since = self.position()
        if since is not None and upto < since:
            raise ValueError(f"position {since} is past {upto}")
        row = self.spark.range(1).select(F.lit(upto).cast("timestamp_ntz").alias("upto"), F.lit(self.run).alias("run"),
                                         F.lit(poll).cast("long").alias("poll"))
        overwrite_partitions(row, f"{self.path}/cursor", "run", "poll")

    def poll(self, fact: DataFrame, device: DataFrame, store: DataFrame, alert: DataFrame, upto: dt.datetime) -> None:
        self.collect(fact, device, store, alert, upto)
        self.commit(upto)

    def delivered(self) -> DataFrame:
        """Alerts of this run's polls, those of an uncommitted last poll included."""
        return self.spark.read.parquet(f"{self.path}/alerts").where(F.col("run") == self.run)
