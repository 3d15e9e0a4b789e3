"""Outbox stream: replay, duplicate files, late rows and batch re-runs add nothing twice."""

import os

from pyspark.sql import functions as F

from fleetstar.streaming import OutboxWriter, run_alert_outbox
from fleetstar.streaming.alerts import EVENTS_SCHEMA

from tests.conftest import SF_SMALL


def _outbox(spark, path):
    return spark.read.parquet(path)


def _split_events(spark, src_dir, dst):
    ev = spark.read.parquet(f"{src_dir}/events.parquet")
    bounds = ev.approxQuantile("event_id", [1 / 3, 2 / 3], 0.0)
    parts = [ev.filter(F.col("event_id") < bounds[0]),
             ev.filter((F.col("event_id") >= bounds[0]) & (F.col("event_id") < bounds[1])),
             ev.filter(F.col("event_id") >= bounds[1])]
    for i, p in enumerate(parts):
        p.coalesce(1).write.parquet(f"{dst}/part{i}")
    return parts


def _drop_file(spark, df, landing, name):
    df.coalesce(1).write.parquet(f"{landing}/_{name}")
    f = [x for x in os.listdir(f"{landing}/_{name}") if x.endswith(".parquet")][0]
    os.link(f"{landing}/_{name}/{f}", f"{landing}/{name}.parquet")


def test_outbox_exactly_once(spark, tmp_dir):
    staged = f"{tmp_dir}/staged"
    landing = f"{tmp_dir}/landing"
    os.makedirs(landing)
    parts = _split_events(spark, SF_SMALL, staged)
    outbox, ckpt = f"{tmp_dir}/outbox", f"{tmp_dir}/ckpt"
    expected = 0
    for i, p in enumerate(parts):
        _drop_file(spark, p, landing, f"events{i}")
        run_alert_outbox(spark, landing, SF_SMALL, outbox, ckpt, glob="events*.parquet")
    total = _outbox(spark, outbox)
    expected = total.count()
    assert expected > 0 and total.select("telemetry_key").distinct().count() == expected

    # Replay with the same checkpoint: nothing new.
    run_alert_outbox(spark, landing, SF_SMALL, outbox, ckpt, glob="events*.parquet")
    assert _outbox(spark, outbox).count() == expected

    # The second file again under another name: new file, but no new outbox rows.
    _drop_file(spark, parts[1], landing, "events1_copy")
    run_alert_outbox(spark, landing, SF_SMALL, outbox, ckpt, glob="events*.parquet")
    assert _outbox(spark, outbox).count() == expected

    # A critical reading three months late still reaches the outbox, once.
    late = (parts[0].filter(F.col("value") > 150).limit(1)
            .withColumn("event_id", F.col("event_id") + F.lit(10_000_000))
            .withColumn("ts", F.col("ts") + F.expr("INTERVAL 90 DAYS")))
    _drop_file(spark, late, landing, "events_late")
    run_alert_outbox(spark, landing, SF_SMALL, outbox, ckpt, glob="events*.parquet")
    run_alert_outbox(spark, landing, SF_SMALL, outbox, ckpt, glob="events*.parquet")
    assert _outbox(spark, outbox).count() == expected + 1


def test_batch_rerun_is_idempotent(spark, tmp_dir):
    outbox = f"{tmp_dir}/outbox"
    writer = OutboxWriter(outbox, "nightly")
    from fleetstar.operators.alerts import notification_outbox, route_alerts, critical_alerts
    from fleetstar.sources.profiles import event_star, routing_table

    s = event_star(spark, SF_SMALL)
    routing, default = routing_table(spark)
    routed = route_alerts(critical_alerts(s.fact, s.device, s.store, s.alert, k=None), routing, default)
    batch = notification_outbox(routed.withColumn("event_day", F.to_date("event_timestamp")),
                                "2024-02-01 00:00:00", keep=("event_day",))
    writer(batch, 7)
    n = _outbox(spark, outbox).count()
    writer(batch, 7)   # the same batch id again (recovery after a failure)
    assert _outbox(spark, outbox).count() == n
    writer(batch, 8)   # a later batch carrying the same keys adds nothing
    assert _outbox(spark, outbox).count() == n


def test_events_schema_is_explicit():
    assert [f.name for f in EVENTS_SCHEMA.fields] == ["event_id", "ts", "user_id", "event_type", "value", "props"]


def test_unknown_devices_go_to_rejects(spark, tmp_dir):
    landing = f"{tmp_dir}/landing"
    os.makedirs(landing)
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    stray = (ev.filter(F.col("value") > 150).limit(3).withColumn("user_id", F.col("user_id") + F.lit(10**9))
             .withColumn("event_id", F.col("event_id") + F.lit(10**9)))
    _drop_file(spark, ev, landing, "events0")
    _drop_file(spark, stray, landing, "events1")
    outbox, ckpt, rejects = f"{tmp_dir}/outbox", f"{tmp_dir}/ckpt", f"{tmp_dir}/rejects"
    run_alert_outbox(spark, landing, SF_SMALL, outbox, ckpt, glob="events*.parquet", rejects_path=rejects)
    run_alert_outbox(spark, landing, SF_SMALL, outbox, ckpt, glob="events*.parquet", rejects_path=rejects)
    assert spark.read.parquet(rejects).count() == 3
    strays = {r.event_id for r in stray.collect()}
    assert not strays & {r.telemetry_key for r in spark.read.parquet(outbox).collect()}


def _rows(spark, keys, day="2024-01-01", temp="260.00"):
    rows = spark.createDataFrame([(day, k, "s", "d", temp, "EMEA", "m", "PENDING") for k in keys],
                                 "event_day string, telemetry_key bigint, store string, device string, temperature string, "
                                 "region string, manager string, status string")
    return rows.select(F.to_date("event_day").alias("event_day"), "telemetry_key", "store", "device",
                       F.col("temperature").cast("decimal(10,2)").alias("temperature"), "region", "manager",
                       F.lit("2024-02-01 00:00:00").cast("timestamp_ntz").alias("notified_at"), "status")


def _keys(spark, path):
    return sorted(r.telemetry_key for r in _outbox(spark, path).collect())


def test_a_new_run_overwrites_no_other(spark, tmp_dir):
    path = f"{tmp_dir}/outbox"
    OutboxWriter(path, "one")(_rows(spark, [1, 2]), 0)
    OutboxWriter(path, "two")(_rows(spark, [3]), 0)   # a new checkpoint starts at batch 0 again
    assert _keys(spark, path) == [1, 2, 3]


def test_a_key_is_notified_once_whatever_its_day(spark, tmp_dir):
    path = f"{tmp_dir}/outbox"
    OutboxWriter(path, "one")(_rows(spark, [1, 2]), 0)
    OutboxWriter(path, "one")(_rows(spark, [1, 5], day="2024-03-09"), 1)
    assert _keys(spark, path) == [1, 2, 5]


def test_a_retry_picks_the_same_rows(spark, tmp_dir):
    path = f"{tmp_dir}/outbox"
    batch = _rows(spark, [1, 2], day="2024-01-02").unionByName(_rows(spark, [1], day="2024-01-01"))
    OutboxWriter(path, "one")(batch.where("telemetry_key = 2"), 0)      # a first attempt that wrote a part
    OutboxWriter(path, "one")(batch.repartition(3), 0)
    OutboxWriter(path, "one")(batch.coalesce(1), 0)
    days = {r.telemetry_key: str(r.event_day) for r in _outbox(spark, path).collect()}
    assert days == {1: "2024-01-01", 2: "2024-01-02"} and len(_keys(spark, path)) == 2


def test_other_read_errors_are_not_taken_for_an_empty_outbox(spark, tmp_dir):
    import pytest

    os.makedirs(f"{tmp_dir}/outbox/run=a/batch=0")
    with open(f"{tmp_dir}/outbox/run=a/batch=0/part-0.parquet", "w") as f:
        f.write("not parquet")
    with pytest.raises(Exception):
        OutboxWriter(f"{tmp_dir}/outbox", "one")(_rows(spark, [1]), 0)


def test_compaction_keeps_one_row_a_key_and_retention_applies(spark, tmp_dir):
    from fleetstar.streaming import compact_outbox

    path, target = f"{tmp_dir}/outbox", f"{tmp_dir}/compacted"
    for i in range(4):
        OutboxWriter(path, "one")(_rows(spark, [i, i + 10]), i)
    assert compact_outbox(spark, path, target) == 8
    files = [f for _, _, names in os.walk(target) for f in names if f.endswith(".parquet")]
    assert len(files) == 1
    OutboxWriter(target, "one")(_rows(spark, [3, 99]), 9)
    assert _keys(spark, target) == sorted([*range(4), *range(10, 14), 99])
    assert compact_outbox(spark, path, f"{tmp_dir}/old", months=1, as_of="2024-06-01 00:00:00") == 0


def test_devices_added_later_are_known_to_a_running_stream(spark, tmp_dir):
    landing, dims = f"{tmp_dir}/landing", f"{tmp_dir}/dims"
    os.makedirs(landing)
    os.makedirs(dims)
    for name in os.listdir(SF_SMALL):
        if name != "customer.parquet":
            os.symlink(f"{SF_SMALL}/{name}", f"{dims}/{name}")
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    customers = spark.read.parquet(f"{SF_SMALL}/customer.parquet")
    hot = ev.filter(F.col("value") > 150)
    stray = hot.limit(1).withColumn("user_id", F.lit(10**9).cast("long"))
    customers.write.parquet(f"{dims}/customer.parquet")
    outbox, ckpt = f"{tmp_dir}/outbox", f"{tmp_dir}/ckpt"
    _drop_file(spark, stray, landing, "events0")
    run_alert_outbox(spark, landing, dims, outbox, ckpt, glob="events*.parquet")
    assert spark.read.parquet(outbox + "-rejects").count() == 1
    customers.limit(1).withColumn("c_custkey", F.lit(10**9).cast("long")).write.mode("append").parquet(f"{dims}/customer.parquet")
    again = stray.withColumn("event_id", F.col("event_id") + 10**9)
    _drop_file(spark, again, landing, "events1")
    run_alert_outbox(spark, landing, dims, outbox, ckpt, glob="events*.parquet")
    assert _keys(spark, outbox) == [again.first().event_id]
