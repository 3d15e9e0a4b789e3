"""The distributed code paths give the same answers as the simple ones."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from fleetstar.plans.joins import bounded_broadcast, fits
from fleetstar.plans.ordinal import global_rank
from fleetstar.plans.sequence import next_in_sequence, previous_non_null
from fleetstar.sources.profiles import event_star, orderline_star

from tests.conftest import SF_SMALL


def _rates(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    return (li.groupBy("l_partkey").agg(F.round(F.avg("l_quantity"), 0).alias("q"))
            .withColumnRenamed("l_partkey", "k"))


def test_ranks_distributed_equal_local(spark):
    df = _rates(spark)
    order, tie = [("q", False)], [("k", True)]
    for kind in ("rank", "dense_rank", "ntile", "row_number"):
        local = global_rank(df, kind, order, "r", tiebreak=tie, buckets=4)
        dist = global_rank(df.repartition(5), kind, order, "r", tiebreak=tie, buckets=4, local_max_rows=10)
        assert sorted(local.select("k", "r").collect()) == sorted(dist.select("k", "r").collect()), kind


def test_ntile_sizes_differ_by_at_most_one(spark):
    df = _rates(spark)
    dist = global_rank(df, "ntile", [("q", False)], "r", tiebreak=[("k", True)], buckets=7, local_max_rows=10)
    sizes = [r["count"] for r in dist.groupBy("r").count().collect()]
    assert len(sizes) == 7 and max(sizes) - min(sizes) <= 1


def test_sequence_matches_plain_window(spark):
    fact = event_star(spark, SF_SMALL).fact.select("telemetry_key", "device_key", "event_timestamp",
                                                   "temperature_celsius")
    w = Window.partitionBy("device_key").orderBy("event_timestamp", "telemetry_key")
    plain = fact.select("telemetry_key", F.lead("temperature_celsius").over(w).alias("n"),
                        F.last("temperature_celsius", ignorenulls=True).over(
                            w.rowsBetween(Window.unboundedPreceding, -1)).alias("p"))
    for bucket in (60, 3600, 86400 * 40):
        nxt = next_in_sequence(fact, "device_key", "event_timestamp", "telemetry_key", ["temperature_celsius"],
                               bucket_seconds=bucket, hot_rows=0).select("telemetry_key", F.col("next_temperature_celsius").alias("n"))
        prv = previous_non_null(fact, "device_key", "event_timestamp", "telemetry_key", "temperature_celsius", "p",
                                bucket_seconds=bucket, hot_rows=0).select("telemetry_key", "p")
        got = nxt.join(prv, "telemetry_key").select("telemetry_key", "n", "p")
        assert sorted(got.collect()) == sorted(plain.collect()), bucket


def test_hot_device_spreads_over_buckets(spark):
    # One device holding every reading still yields one task per time bucket.
    fact = orderline_star(spark, SF_SMALL).fact.withColumn("device_key", F.lit(1))
    fact = fact.dropDuplicates(["telemetry_key"]).select("telemetry_key", "device_key", "event_timestamp",
                                                         "temperature_celsius")
    out = next_in_sequence(fact, "device_key", "event_timestamp", "telemetry_key", ["temperature_celsius"],
                           bucket_seconds=86400 * 30, hot_rows=0)
    w = Window.partitionBy("device_key").orderBy("event_timestamp", "telemetry_key")
    plain = fact.select("telemetry_key", F.lead("temperature_celsius").over(w).alias("n"))
    assert sorted(out.select("telemetry_key", F.col("next_temperature_celsius").alias("n")).collect()) == sorted(
        plain.collect())


def test_broadcast_only_when_proven_small(spark):
    df = spark.range(100)
    assert fits(df, 100) and not fits(df, 99)
    plan_small = spark.range(1000).join(bounded_broadcast(df, 1000), "id")
    plan_big = spark.range(1000).join(bounded_broadcast(df, 10), "id")
    assert "broadcast" in plan_small._jdf.queryExecution().analyzed().toString().lower()
    assert "broadcast" not in plan_big._jdf.queryExecution().analyzed().toString().lower()


def test_attribute_aggregation_paths_agree(spark):
    from fleetstar.functions.exprs import count_true, sum_cents
    from fleetstar.plans.joins import aggregate_by_attributes

    s = orderline_star(spark, SF_SMALL)
    fact = s.fact.withColumn("year", F.year("full_date"))
    aggs = {"spikes": (count_true(F.col("is_thermal_spike")), F.sum),
            "t": (sum_cents(F.col("temperature_celsius")), F.sum),
            "hi": (F.max("temperature_celsius"), F.max)}
    small = aggregate_by_attributes(fact, s.store, "store_key", ["region"], aggs, extra_keys=["year"])
    large = aggregate_by_attributes(fact, s.store, "store_key", ["region"], aggs, extra_keys=["year"], max_rows=1)
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
    assert sorted(small.collect()) == sorted(large.collect())


def test_auto_bucket_width(spark):
    from fleetstar.plans.sequence import auto_bucket_seconds

    fact = orderline_star(spark, SF_SMALL).fact.dropDuplicates(["telemetry_key"])
    hot = fact.withColumn("device_key", F.lit(1))
    wide = auto_bucket_seconds(fact, "device_key", "event_timestamp")
    narrow = auto_bucket_seconds(hot, "device_key", "event_timestamp", target_rows=100)
    assert narrow < wide
    w = Window.partitionBy("device_key").orderBy("event_timestamp", "telemetry_key")
    plain = hot.select("telemetry_key", F.lead("temperature_celsius").over(w).alias("n"))
    out = next_in_sequence(hot, "device_key", "event_timestamp", "telemetry_key", ["temperature_celsius"],
                           bucket_seconds=narrow, hot_rows=100)
    assert sorted(out.select("telemetry_key", F.col("next_temperature_celsius").alias("n")).collect()) == sorted(
        plain.collect())


def test_partitioned_rank_distributed_equals_window(spark):
    df = _rates(spark).withColumn("grp", F.col("k") % 3)
    local = global_rank(df, "rank", [("q", False)], "r", tiebreak=[("k", True)], partition_by=["grp"])
    dist = global_rank(df.repartition(5), "rank", [("q", False)], "r", tiebreak=[("k", True)],
                       partition_by=["grp"], local_max_rows=10)
    w = Window.partitionBy("grp").orderBy(F.desc("q"))
    plain = df.withColumn("r", F.rank().over(w))
    expect = sorted(plain.select("k", "r").collect())
    assert sorted(local.select("k", "r").collect()) == expect
    assert sorted(dist.select("k", "r").collect()) == expect


def test_sequences_agree_whoever_is_hot(spark):
    from fleetstar.plans.sequence import previous_non_null, split_hot

    fact = orderline_star(spark, SF_SMALL).fact.dropDuplicates(["telemetry_key"])
    busiest = fact.groupBy("device_key").count().agg(F.max("count")).first()[0]
    assert split_hot(fact, "device_key", busiest)[1] is None
    w = Window.partitionBy("device_key").orderBy("event_timestamp", "telemetry_key")
    t = F.col("temperature_celsius")
    want = sorted(fact.select("telemetry_key", F.lead(t).over(w).alias("n"), F.last(t, ignorenulls=True).over(
        w.rowsBetween(Window.unboundedPreceding, -1)).alias("p")).collect(), key=lambda r: r.telemetry_key)
    for hot_rows in (busiest, busiest - 1, 0):  # none, some, all
        got = next_in_sequence(fact, "device_key", "event_timestamp", "telemetry_key", ["temperature_celsius"], hot_rows=hot_rows)
        got = previous_non_null(got, "device_key", "event_timestamp", "telemetry_key", "temperature_celsius", "p", hot_rows=hot_rows)
        rows = sorted(got.select("telemetry_key", F.col("next_temperature_celsius").alias("n"), "p").collect(), key=lambda r: r.telemetry_key)
        assert rows == want


def test_quantiles_match_numpy(spark):
    import numpy as np

    from fleetstar.operators.anomaly import exact_quantiles

    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 40, 501).astype(float), rng.normal(size=501)
    df = spark.createDataFrame([(float(x), float(y) if i % 5 else None) for i, (x, y) in enumerate(zip(a, b))], "a double, b double")
    got = exact_quantiles(df.repartition(7), ["a", "b"], (0.0, 0.25, 0.5, 0.9, 1.0))
    kept = [y for i, y in enumerate(b) if i % 5]
    for found, values in zip(got, (a, kept)):
        assert np.allclose(found, np.quantile(values, [0.0, 0.25, 0.5, 0.9, 1.0]))
    assert exact_quantiles(df.where("a < 0"), ["a"]) == [[None, None]]


def test_checkpoint_folder_must_be_named_off_one_machine():
    from fleetstar.session import is_local_master

    assert is_local_master("local") and is_local_master("local[*]") and is_local_master("local[4]")
    assert not is_local_master("local-cluster[2,1,1024]") and not is_local_master("spark://host:7077") and not is_local_master("yarn")
