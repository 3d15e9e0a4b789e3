"""Results kept current by loads, polls and versions equal one pass; what dies half-way leaves no trace."""

import datetime as dt
import os
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from fleetstar.operators import dashboards as D
from fleetstar.operators import fleet
from fleetstar.operators import quality as Q
from fleetstar.operators.alerts import critical_alerts
from fleetstar.operators.carried import CarriedDeltas, ExtractState
from fleetstar.operators.dims import append_facts, read_star, write_star
from fleetstar.operators.key_index import KeyIndex
from fleetstar.operators.polling import AlertPoll
from fleetstar.operators.sketches import (HLL_ERROR, KLL_RANK_ERROR, merged_profile, merged_quantiles, rank_errors,
                                          store_column_sketches, store_quantile_sketches)
from fleetstar.operators.versions import VersionedFact
from fleetstar.sources import files
from fleetstar.sources.profiles import event_star, orderline_star

from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def stars(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stars"))
    for name, star in (("p1", event_star(spark, SF_SMALL)), ("p2", orderline_star(spark, SF_SMALL))):
        write_star(star, f"{path}/{name}")
    return {name: read_star(spark, f"{path}/{name}") for name in ("p1", "p2")}


def _files(folder):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet")}


def _keys(df):
    return sorted(r["telemetry_key"] for r in df.select("telemetry_key").collect())


# --- polling --------------------------------------------------------------------------------------

def _polls(stars):
    s = stars["p1"]
    lo, hi = s.fact.agg(F.min("ingestion_timestamp"), F.max("ingestion_timestamp")).first()
    return s, [lo + (hi - lo) * k / 4 for k in (1, 2, 3)] + [hi + dt.timedelta(seconds=1)], _keys(critical_alerts(s.fact, s.device, s.store, s.alert, k=None))


def test_polls_deliver_every_alert_once(spark, stars, tmp_dir):
    s, steps, every = _polls(stars)
    consumer = AlertPoll(spark, tmp_dir, "desk", overlap_minutes=3 * 24 * 60)
    for upto in steps:
        consumer.poll(s.fact, s.device, s.store, s.alert, upto)
    consumer.poll(s.fact, s.device, s.store, s.alert, steps[-1])  # nothing new
    assert _keys(consumer.delivered()) == every and len(every) > 4
    with pytest.raises(ValueError):
        consumer.commit(steps[0])


def test_a_poll_that_dies_before_its_commit_is_made_again(spark, stars, tmp_dir):
    s, steps, every = _polls(stars)
    consumer = AlertPoll(spark, tmp_dir, "desk")
    consumer.poll(s.fact, s.device, s.store, s.alert, steps[0])
    consumer.collect(s.fact, s.device, s.store, s.alert, steps[2])   # written, never committed
    assert consumer.position()[0] == 1
    other = AlertPoll(spark, tmp_dir, "desk")                        # the consumer that takes over
    for upto in steps[1:]:
        other.poll(s.fact, s.device, s.store, s.alert, upto)
    assert _keys(other.delivered()) == every
    assert AlertPoll(spark, tmp_dir, "another").position() == (0, None)


def test_late_arrivals_and_slow_writers_are_delivered(spark, stars, tmp_dir):
    s, steps, every = _polls(stars)
    one = s.fact.where(F.col("alert_type_key") == 1).limit(1)
    missing = one.first()["telemetry_key"]
    early = s.fact.where(F.col("telemetry_key") != missing)
    consumer = AlertPoll(spark, tmp_dir, "desk", overlap_minutes=60)
    consumer.poll(early, s.device, s.store, s.alert, steps[-1])
    # The reading of long ago is stored half an hour before the position, by a writer that committed late.
    late = early.unionByName(one.withColumn("ingestion_timestamp", F.lit(steps[-1] - dt.timedelta(minutes=30)).cast("timestamp_ntz")))
    consumer.poll(late, s.device, s.store, s.alert, steps[-1] + dt.timedelta(minutes=15))
    assert _keys(consumer.delivered()) == every


# --- versions -------------------------------------------------------------------------------------

def test_update_rewrites_changed_parts_only(spark, stars, tmp_dir):
    fact = VersionedFact(spark, tmp_dir, parts="yyyy-MM-dd")
    fact.write(stars["p1"].fact.drop("reading_month"))
    before, months = _files(f"{tmp_dir}/data"), fact.manifest()
    assert len(months) > 12 and len(before) == len(months)           # one file a part
    target = sorted(months)[3]
    some = fact.read(only=[target]).select("telemetry_key", (~F.col("is_anomaly")).alias("is_anomaly_detected"))
    same = fact.read(only=[sorted(months)[5]]).select("telemetry_key", F.col("is_anomaly").alias("is_anomaly_detected"))
    assert fact.update_flags(some.unionByName(same)) == [target]
    after = _files(f"{tmp_dir}/data")
    assert {f: t for f, t in after.items() if f in before} == before and len(after) == len(before) + 1
    old, new = (fact.read(v).select("telemetry_key", "is_anomaly", "part") for v in (0, 1))
    differ = old.exceptAll(new)
    assert {r["part"] for r in differ.select("part").distinct().collect()} == {target}
    assert differ.count() == some.count() and new.count() == stars["p1"].fact.count()
    assert fact.update_flags(some) == [] and fact.version() == 1


def test_a_half_written_version_is_invisible(spark, stars, tmp_dir, monkeypatch):
    fact = VersionedFact(spark, tmp_dir, parts="yyyy-MM-dd")
    fact.write(stars["p1"].fact.drop("reading_month"))
    flags = stars["p1"].fact.select("telemetry_key", (~F.col("is_anomaly")).alias("is_anomaly_detected"))
    rows = sorted(map(tuple, fact.read().select("telemetry_key", "is_anomaly").collect()))

    def dies(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(VersionedFact, "_publish", dies)
        with pytest.raises(RuntimeError):
            fact.update_flags(flags)
    assert fact.version() == 0 and sorted(map(tuple, fact.read().select("telemetry_key", "is_anomaly").collect())) == rows
    fact.update_flags(flags)                                         # made again
    assert sorted(map(tuple, fact.read().select("telemetry_key", "is_anomaly").collect())) == [(k, not v) for k, v in rows]


# --- key index ------------------------------------------------------------------------------------

def test_membership_moves_no_history(spark, tmp_dir):
    index = KeyIndex(spark, f"{tmp_dir}/keys", buckets=8)
    for i in range(3):
        index.add(spark.range(i * 1000, i * 1000 + 1000).select(F.col("id").alias("telemetry_key")), f"load-{i}")
    index.add(spark.range(0, 1000).select(F.col("id").alias("telemetry_key")), "load-0")  # the load again
    assert index.keys().count() == 3000 and index.keys("load-2").count() == 2000
    rows = spark.range(2990, 3010).select(F.col("id").alias("telemetry_key"))
    marked = index.mark_known(rows)
    assert sorted((r["telemetry_key"], r["known"]) for r in marked.collect()) == [(k, k < 3000) for k in range(2990, 3010)]
    plan = marked._jdf.queryExecution().executedPlan().toString()
    initial = plan.split("Initial Plan")[-1]
    history = initial[initial.index("HashAggregate" if "HashAggregate" in initial else "FileScan parquet"):]
    assert "Bucketed: true" in plan and "BroadcastExchange" not in plan
    assert "Exchange" not in history, plan
    assert KeyIndex(spark, f"{tmp_dir}/keys", buckets=8).keys("load-0").count() == 2000


def test_loads_reject_keys_of_other_loads(spark, stars, tmp_dir):
    s = stars["p1"]
    path, rejects = f"{tmp_dir}/fact", f"{tmp_dir}/rejects"
    half = s.fact.where("telemetry_key % 2 = 0")
    for load, rows in (("a", half), ("b", s.fact), ("a", half)):
        append_facts(rows, path, rejects, load, s.device)
    stored = spark.read.parquet(path)
    assert stored.count() == s.fact.count() == stored.select("telemetry_key").distinct().count()
    assert spark.read.parquet(rejects).groupBy("load", "reject_reason").count().collect() == [("b", "key already loaded", half.count())]


# --- carried deltas -------------------------------------------------------------------------------

@pytest.mark.parametrize("order", ["time", "random", "reverse"])
def test_deltas_of_many_loads_equal_one(spark, tmp_dir, order):
    rng = random.Random(order)
    rows = [(k, rng.randrange(4), dt.datetime(2024, 1, 1) + dt.timedelta(minutes=rng.randrange(400)),
             None if rng.random() < 0.25 else round(rng.uniform(0, 99), 2)) for k in range(400)]
    rows.sort(key=lambda r: (r[2], r[0]), reverse=order == "reverse")
    if order == "random":
        rng.shuffle(rows)
    fact = spark.createDataFrame([(*r, i * 6 // len(rows)) for i, r in enumerate(rows)],
                                 "telemetry_key long, device_key long, event_timestamp timestamp_ntz, t double, load int").withColumn(
        "temperature_celsius", F.col("t").cast("decimal(10,2)")).drop("t")
    deltas = CarriedDeltas(spark, tmp_dir)
    for load in (0, 1, 2, 2, 3, 4, 5):
        deltas.add(fact.where(F.col("load") == load), load)
    want = {r["telemetry_key"]: r["temp_delta_derived"] for r in Q.temp_delta(fact).collect()}
    assert {r["telemetry_key"]: r["temp_delta_derived"] for r in deltas.read().collect()} == want
    if order == "time":  # nothing is written twice when nothing is late
        assert spark.read.parquet(f"{tmp_dir}/deltas").count() == 400


# --- dashboards' sums -----------------------------------------------------------------------------

def test_dashboards_from_loads_equal_the_full_computation(spark, stars, tmp_dir):
    s = stars["p1"]
    state = ExtractState(spark, tmp_dir)
    for i in (0, 1, 1, 2):
        state.add(s.fact.where(F.col("telemetry_key") % 3 == i), f"load-{i}")
    full, kept = D.store_totals(s.fact, s.store), state.store_totals(s.store)
    for board in (D.spike_rate_map, D.store_vs_global, D.country_city_drill):
        assert sorted(map(str, board(kept).collect())) == sorted(map(str, board(full).collect()))
    for by_year in (False, True):
        assert sorted(map(str, state.monthly_health(by_year).collect())) == sorted(
            map(str, D.monthly_operational_health(D.with_date(s.fact), by_year).collect()))


def test_sums_of_a_load_are_not_gathered_in_one_task(spark, stars, tmp_dir):
    fact, conf = stars["p2"].fact, {"spark.sql.shuffle.partitions": "5", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    state = ExtractState(spark, tmp_dir)
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        for _ in range(2):  # again: the files of the first attempt go
            state.add(fact, "a")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(list(Path(tmp_dir).glob("load=a/*.parquet"))) == 5
    rows = state._rows()
    assert rows.count() == rows.select("reading_month", "store_key").distinct().count()
    assert rows.agg(F.sum("readings")).first()[0] == fact.count()


# --- sketches -------------------------------------------------------------------------------------

def test_sketches_unite_within_their_errors(spark, stars, tmp_dir):
    fact = stars["p2"].fact
    columns = ["telemetry_key", "device_key", "temperature_celsius", "data_quality_flag", "alert_type_key"]
    rows, part = fact.select(*columns, "reading_month"), F.col("reading_month")
    store_column_sketches(rows, part, f"{tmp_dir}/c")
    once = {r["column_name"]: r for r in merged_profile(spark, f"{tmp_dir}/c").collect()}
    store_column_sketches(rows.where("reading_month < '1997-01'"), part, f"{tmp_dir}/c")   # some months loaded again
    assert {r["column_name"]: r for r in merged_profile(spark, f"{tmp_dir}/c").collect()} == once
    for r in Q.column_profile(fact.select(*columns), exact=True).collect():
        got = once[r["column_name"]]
        assert (got["non_null_count"], got["null_count"]) == (r["non_null_count"], r["null_count"])
        assert abs(got["distinct_estimate"] - r["distinct_count"]) <= HLL_ERROR * r["distinct_count"]
    values = ["temperature_celsius", "power_draw_watts"]
    store_quantile_sketches(fact, values, part, f"{tmp_dir}/q")
    errors = rank_errors(fact, merged_quantiles(spark, f"{tmp_dir}/q", (0.01, 0.25, 0.5, 0.75)), values).collect()
    assert len(errors) == 8 and all(r["rank_error"] <= KLL_RANK_ERROR for r in errors)


# --- calendar -------------------------------------------------------------------------------------

def test_calendar_filter_prunes_months(spark, stars):
    s = stars["p2"]
    df = fleet.fiscal_period_health(s.fact, s.date, where=(F.col("year") == 1998) & (F.col("quarter") == 2))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower(), plan
    got = df.collect()
    assert {r["fiscal_period"] for r in got} == {"FY1998-Q2"}
    want = s.fact.where("reading_month between '1998-04' and '1998-06'").count()
    assert sum(r["total_readings"] for r in got) == want


def test_spine_has_a_row_for_every_day(spark, micro):
    got = {(r["region"], str(r["full_date"])): (r["daily_spikes"], str(r["calendar_7day_avg"]))
           for r in fleet.calendar_rolling_avg(micro.fact, micro.store).collect()}
    assert sum(k[0] == "APAC" for k in got) == 55                    # 10 January to 5 March
    assert got["APAC", "2025-01-12"] == (0, "0.43") and got["APAC", "2025-01-18"] == (0, "0.00")


# --- CSV quarantine -------------------------------------------------------------------------------

def test_broken_lines_are_kept_with_a_reason(spark, tmp_dir):
    lines = ["id,name,amount,day", "1,ann,2.50,2024-01-01", "2,\"b, o\",3.00,2024-01-02", "x,cy,1.00,2024-01-03", "4,di,1.00",
             "5,ed,1.00,2024-01-05,more", "6,fy,ten,2024-01-06", "7,,,"]
    os.makedirs(f"{tmp_dir}/in")
    with open(f"{tmp_dir}/in/a.csv", "w") as f:
        f.write("\n".join(lines) + "\n")
    schema = spark.createDataFrame([], "id int, name string, amount decimal(5,2), day date").schema
    rows, rejects = files.read_csv_quarantined(spark, f"{tmp_dir}/in", schema)
    assert sorted(r["id"] for r in rows.collect()) == [1, 2, 7]
    assert sorted((r["line"][0], r["reason"]) for r in rejects.collect()) == [
        ("4", "too few fields"), ("5", "too many fields"), ("6", "amount is no decimal(5,2)"), ("x", "id is no int")]


# --- window counts --------------------------------------------------------------------------------

def test_window_state_is_bounded_and_late_alerts_are_added(spark, tmp_dir):
    from fleetstar.streaming import compact_window_counts, reconcile_window_counts, run_alert_window_counts, window_counts

    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    lo, hi = events.agg(F.min("ts"), F.max("ts")).first()
    half = F.lit(lo + (hi - lo) / 2).cast("timestamp_ntz")
    codes = ("THERM-CRIT",)
    landing, out, ckpt = (f"{tmp_dir}/{n}" for n in ("landing", "out", "ckpt"))
    alerts = critical_alerts(*(lambda s: (s.fact, s.device, s.store, s.alert))(event_star(spark, SF_SMALL)), k=None)
    total = alerts.count()
    events.where(F.col("ts") >= half).coalesce(1).write.mode("append").parquet(landing)
    first = run_alert_window_counts(spark, landing, SF_SMALL, out, ckpt, codes=codes)
    state = [o.numRowsTotal for p in first.recentProgress for o in p.stateOperators][-1]
    assert state <= 5 < window_counts(spark, out).count()            # an hour of quarter-hour windows
    events.where(F.col("ts") < half).coalesce(1).write.mode("append").parquet(landing)
    run_alert_window_counts(spark, landing, SF_SMALL, out, ckpt, codes=codes)
    before = window_counts(spark, out).agg(F.sum("alerts")).first()[0]
    reconcile_window_counts(spark, out)
    reconcile_window_counts(spark, out)                              # again: nothing twice
    assert before < window_counts(spark, out).agg(F.sum("alerts")).first()[0] == total
    # Another run over the same folder, with a checkpoint of its own, counts its own arrivals.
    compact_window_counts(spark, out, f"{tmp_dir}/compacted")
    reconcile_window_counts(spark, f"{tmp_dir}/compacted")
    assert sorted(map(tuple, window_counts(spark, f"{tmp_dir}/compacted").collect())) == sorted(map(tuple, window_counts(spark, out).collect()))


def test_runs_over_different_folders_add_up(spark, tmp_dir):
    from fleetstar.streaming import reconcile_window_counts, run_alert_window_counts, window_counts

    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    for i in range(2):
        events.where(F.pmod("event_id", F.lit(2)) == i).coalesce(1).write.parquet(f"{tmp_dir}/in{i}")
        run_alert_window_counts(spark, f"{tmp_dir}/in{i}", SF_SMALL, f"{tmp_dir}/out", f"{tmp_dir}/ckpt{i}")
    reconcile_window_counts(spark, f"{tmp_dir}/out")
    s = event_star(spark, SF_SMALL)
    assert window_counts(spark, f"{tmp_dir}/out").agg(F.sum("alerts")).first()[0] == critical_alerts(s.fact, s.device, s.store, s.alert, k=None).count()
