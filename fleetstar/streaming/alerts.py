"""Continuous critical-alert notification with Structured Streaming.

Readings arrive as files. Each micro-batch reads the dimensions afresh, keeps
notifying alerts, routes them and appends them to the outbox exactly once per
``telemetry_key``; readings of unknown devices go to a rejects table beside
it. Both are written in partitions of their own run (the streaming query's
id, or the caller's) and batch, replaced by a re-run of that batch and by
nothing else. A key that any other run or batch has written, on whatever day,
is left out by an anti-join with the whole outbox's keys, narrowed by the
batch's least and greatest key, which row-group statistics answer.

Late readings are not dropped: there is no watermark on this path, so a
critical reading that arrives months late is still notified. A separate
query counts alerts per event-time window behind a watermark, which bounds its
state to the open windows; a corrections job adds the alerts that came later.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetstar import constants as C
from fleetstar.operators.alerts import _alerted, notification_outbox, retain, route_alerts
from fleetstar.plans.joins import bounded_broadcast
from fleetstar.session import checkpoint_base
from fleetstar.sources.profiles import (alert_dim, _nation_stores, event_devices, events_to_fact,
                                        routing_table)
from fleetstar.sources.files import read_existing

EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])
MAX_FILES = 1000  # files of one micro-batch, so that a backlog is taken in steps


def _source(spark: SparkSession, events_dir: str, glob: str | None, max_files: int | None) -> DataFrame:
    reader = spark.readStream.schema(EVENTS_SCHEMA).option("maxFilesPerTrigger", max_files or MAX_FILES)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(events_dir)


def routed_alerts_of(events: DataFrame, dims_dir: str, codes=(C.ALERT_TYPES[0][1],),
                     routing: DataFrame | None = None, default: dict | None = None) -> DataFrame:
    """Outbox rows (with the event's day) of the notifying alerts among ``events``, batch or streaming."""
    spark = events.sparkSession
    devices = event_devices(spark, dims_dir)
    alerts = _alerted(events_to_fact(events, devices), devices, _nation_stores(spark, dims_dir), alert_dim(spark), codes)
    if routing is None:
        routing, default = routing_table(spark)
    routed = (route_alerts(alerts, routing, default).withColumn("_now", F.localtimestamp())
              .withColumn("event_day", F.to_date("event_timestamp")))
    return notification_outbox(routed, F.col("_now"), keep=("event_day",))


def critical_alert_stream(spark: SparkSession, events_dir: str, dims_dir: str, glob: str | None = None,
                          codes=(C.ALERT_TYPES[0][1],), max_files: int | None = None,
                          routing: DataFrame | None = None, default: dict | None = None) -> DataFrame:
    """Streaming DataFrame of routed notifying alerts (dimensions as of the query's start)."""
    return routed_alerts_of(_source(spark, events_dir, glob, max_files), dims_dir, codes, routing, default)


def unknown_devices_of(events: DataFrame, dims_dir: str) -> DataFrame:
    """Readings whose device is not in the device dimension (the inner join would drop them)."""
    keys = bounded_broadcast(event_devices(events.sparkSession, dims_dir).select(F.col("device_key").alias("_dk")))
    return events.join(keys, events.user_id == keys._dk, "left_anti")


def stream_run_id(spark: SparkSession) -> str | None:
    """The id of the streaming query whose batch is being processed; kept by its checkpoint."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId")


def _overwrite(rows: DataFrame, path: str, run: str, batch_id: int) -> None:
    """Write the partition of one run and batch, replacing only an earlier attempt at it."""
    (rows.withColumn("run", F.lit(run)).withColumn("batch", F.lit(batch_id).cast("long"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("run", "batch").parquet(path))


class OutboxWriter:
    """``foreachBatch`` sink, or batch sink with a caller's run id: one outbox row per telemetry key."""

    # Outbox rows as written: the audit columns plus the two partition columns.
    SCHEMA = ("event_day date, telemetry_key bigint, store string, device string, temperature decimal(10,2), "
              "region string, manager string, notified_at timestamp_ntz, status string, run string, batch bigint")

    def __init__(self, outbox_path: str, run_id: str | None = None):
        self.path, self.run_id = outbox_path, run_id

    def existing(self, spark: SparkSession) -> DataFrame | None:
        """The outbox; None only if there is no such folder yet."""
        try:
            return spark.read.schema(self.SCHEMA).parquet(self.path)
        except AnalysisException as exc:
            if exc.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        run = self.run_id or stream_run_id(spark)
        if not run:
            raise ValueError("a batch outside of a streaming query needs a run id")
        # Of rows with one key the least by its other columns stays, on every attempt.
        others = [c for c in batch.columns if c not in ("telemetry_key", "notified_at")]
        rows = (batch.groupBy("telemetry_key").agg(F.min(F.struct(*others)).alias("r"), F.max("notified_at").alias("notified_at"))
                .select("telemetry_key", "r.*", "notified_at").select(*batch.columns))
        prior = self.existing(spark)
        if prior is None:  # first write: nothing to compare with, one action
            _overwrite(rows, self.path, run, batch_id)
            return
        cached = rows.persist()
        try:
            span = cached.agg(F.min("telemetry_key").alias("lo"), F.max("telemetry_key").alias("hi")).first()
            if span["lo"] is not None:
                own = (F.col("run") == run) & (F.col("batch") == batch_id)
                seen = prior.where(F.col("telemetry_key").between(span["lo"], span["hi"]) & ~own).select("telemetry_key")
                cached = cached.join(seen, "telemetry_key", "left_anti").select(*batch.columns)
            _overwrite(cached, self.path, run, batch_id)
        finally:
            rows.unpersist()


def run_alert_outbox(spark: SparkSession, events_dir: str, dims_dir: str, outbox_path: str, checkpoint: str,
                     glob: str | None = None, available_now: bool = True, interval: str = "5 minutes",
                     max_files: int | None = None, rejects_path: str | None = None):
    """Start (and with ``available_now`` drain) the outbox stream; returns its query.

    Readings of unknown devices go to ``rejects_path`` (default: beside the
    outbox), so they can be replayed once the dimension catches up. Both
    tables are written by the one query that is returned.
    """
    writer = OutboxWriter(outbox_path)
    rejects = rejects_path or outbox_path.rstrip("/") + "-rejects"

    def process(batch: DataFrame, batch_id: int) -> None:
        # The dimensions are read here, so a device added since the start is known.
        _overwrite(unknown_devices_of(batch, dims_dir), rejects, stream_run_id(batch.sparkSession), batch_id)
        writer(routed_alerts_of(batch, dims_dir), batch_id)

    stream = _source(spark, events_dir, glob, max_files).writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    q = (stream.trigger(availableNow=True) if available_now else stream.trigger(processingTime=interval)).start()
    if available_now:
        q.awaitTermination()
    return q


def compact_outbox(spark: SparkSession, outbox_path: str, target_path: str, months: int | None = None, as_of=None) -> int:
    """Copy the outbox to a new folder in few files, without rows older than ``months``; returns the rows kept.

    The writers go on with the new folder. A key that retention removes could be notified again by a
    replay from before then, so ``months`` must exceed the age of any replay.
    """
    rows = OutboxWriter(outbox_path).existing(spark)
    if rows is None:
        raise FileNotFoundError(outbox_path)
    if months is not None:
        rows = retain(rows, months=months, as_of=as_of)
    once = Window.partitionBy("telemetry_key").orderBy("notified_at", "run", "batch")
    kept = rows.withColumn("_n", F.row_number().over(once)).where("_n = 1").drop("_n", "run", "batch")
    _overwrite(kept.hint("rebalance"), target_path, f"compacted-{uuid.uuid4().hex[:12]}", 0)
    return OutboxWriter(target_path).existing(spark).count()


def _alert_times(events: DataFrame, dims_dir: str, codes) -> DataFrame:
    """Event time of every notifying alert among ``events``, as an instant."""
    spark = events.sparkSession
    devices = event_devices(spark, dims_dir)
    alerts = _alerted(events_to_fact(events, devices), devices, _nation_stores(spark, dims_dir), alert_dim(spark), codes)
    return alerts.select(F.col("event_timestamp").cast("timestamp").alias("at"))


def _per_window(alerts: DataFrame, window: str, delay: str | None = None) -> DataFrame:
    """Alerts by window; with ``delay`` also the time up to which they close windows."""
    more = [] if delay is None else [(F.max("at") - F.expr(f"INTERVAL {delay}")).cast("timestamp_ntz").alias("horizon")]
    return (alerts.groupBy(F.window("at", window).alias("w")).agg(F.count(F.lit(1)).alias("alerts"), *more)
            .withColumns({f"window_{edge}": F.col(f"w.{edge}").cast("timestamp_ntz") for edge in ("start", "end")})
            .select("window_start", "window_end", "alerts", *(["horizon"] if more else [])))


def alert_window_counts(spark: SparkSession, events_dir: str, dims_dir: str, glob: str | None = None,
                        window: str = "15 minutes", codes=(C.ALERT_TYPES[0][1],),
                        max_files: int | None = None, delay: str = "1 hour") -> DataFrame:
    """Streaming count of notifying alerts per tumbling event-time window, given out once, when it closes.

    The watermark follows the latest alert by ``delay``; windows behind it leave
    the state, so the state holds open windows only. Alerts later than that are
    not counted here: ``reconcile_window_counts`` adds them.
    """
    alerts = _alert_times(_source(spark, events_dir, glob, max_files), dims_dir, codes)
    return _per_window(alerts.withWatermark("at", delay), window)


def run_alert_window_counts(spark: SparkSession, events_dir: str, dims_dir: str, out_path: str, checkpoint: str,
                            glob: str | None = None, window: str = "15 minutes", max_files: int | None = None,
                            codes=(C.ALERT_TYPES[0][1],), delay: str = "1 hour"):
    """Drain the source once; returns the finished counting query.

    ``closed`` receives every window's count when it closes, ``arrivals`` what each
    batch brought, by window and without state: one row per batch and window.
    Both are partitioned by run (the first query's id, kept by its checkpoint) and batch.
    """
    counts = alert_window_counts(spark, events_dir, dims_dir, glob, window, codes, max_files, delay)

    def start(rows: DataFrame, name: str, process, mode: str):
        q = (rows.writeStream.outputMode(mode).option("checkpointLocation", f"{checkpoint}/{name}").trigger(availableNow=True)
             .foreachBatch(process).start())
        q.awaitTermination()
        return q

    counted = start(counts, "closed", lambda b, i: _overwrite(b, f"{out_path}/closed", stream_run_id(b.sparkSession), i), "append")
    run = str(counted.id)

    def arrived(batch: DataFrame, batch_id: int) -> None:
        _overwrite(_per_window(batch, window, delay), f"{out_path}/arrivals", run, batch_id)

    start(_alert_times(_source(spark, events_dir, glob, max_files), dims_dir, codes), "arrivals", arrived, "append")
    return counted


_COUNTS = "window_start timestamp_ntz, window_end timestamp_ntz, alerts bigint"
_KEYS = ["run", "window_start", "window_end"]


def _counted(spark: SparkSession, out_path: str, table: str) -> DataFrame:
    """Counts of a table by run and window."""
    rows = read_existing(spark, f"{out_path}/{table}", f"{_COUNTS}, run string, batch bigint")
    if rows is None:
        return spark.createDataFrame([], f"run string, {_COUNTS}")
    return rows.groupBy(*_KEYS).agg(F.sum("alerts").alias("alerts"))


def _arrived(spark: SparkSession, out_path: str) -> DataFrame:
    """Alerts that came, by run and window, and whether the run has closed that window."""
    rows = spark.read.schema(f"{_COUNTS}, horizon timestamp_ntz, run string, batch bigint").parquet(f"{out_path}/arrivals")
    upto = rows.groupBy(F.col("run").alias("_run")).agg(F.max("horizon").alias("upto"))  # one row per run
    per = rows.groupBy(*_KEYS).agg(F.sum("alerts").alias("came"))
    return per.join(upto, per["run"] == upto["_run"]).withColumn("is_closed", F.col("window_end") <= F.col("upto")).drop("_run", "upto")


def reconcile_window_counts(spark: SparkSession, out_path: str) -> None:
    """The corrections job: alerts of closed windows that came too late to be counted, by run and window.

    What came less what was counted; each run's corrections are replaced, so the job may be run at any time and again.
    """
    closed = _counted(spark, out_path, "closed").withColumnRenamed("alerts", "counted")
    late = (_arrived(spark, out_path).where("is_closed").join(closed, _KEYS, "left")
            .withColumn("alerts", F.col("came") - F.coalesce("counted", F.lit(0))))
    checkpoint_base(spark)
    rows = late.where("alerts <> 0").select("window_start", "window_end", "alerts", "run").checkpoint(eager=True)
    rows.withColumn("batch", F.lit(0).cast("long")).write.mode("overwrite").partitionBy("run", "batch").parquet(f"{out_path}/corrections")


def window_counts(spark: SparkSession, out_path: str) -> DataFrame:
    """Alerts of every window over all runs: closed counts, their corrections, and what open windows hold so far."""
    still_open = _arrived(spark, out_path).where("not is_closed").select(*_KEYS, F.col("came").alias("alerts"))
    parts = still_open.unionByName(_counted(spark, out_path, "closed")).unionByName(_counted(spark, out_path, "corrections"))
    return parts.groupBy("window_start", "window_end").agg(F.sum("alerts").alias("alerts"))


def compact_window_counts(spark: SparkSession, out_path: str, target_path: str) -> None:
    """Copy counts and arrivals to a new folder with one batch per run; the streams may go on with it."""
    for table, extra in (("closed", ""), ("arrivals", ", horizon timestamp_ntz")):
        rows = read_existing(spark, f"{out_path}/{table}", f"{_COUNTS}{extra}, run string, batch bigint")
        if rows is None:
            continue
        last = rows.groupBy(F.col("run").alias("_run")).agg(F.max("batch").alias("batch"))
        sums = [F.sum("alerts").alias("alerts")] + ([F.max("horizon").alias("horizon")] if extra else [])
        merged = rows.groupBy(*_KEYS).agg(*sums)
        (merged.join(last, merged["run"] == last["_run"]).drop("_run").hint("rebalance", "run")
         .write.mode("overwrite").partitionBy("run", "batch").parquet(f"{target_path}/{table}"))
