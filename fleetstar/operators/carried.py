"""Results kept current load by load: temperature deltas and dashboard sums.

Both write a partition per load, so a load that is made again replaces its own
rows and nothing is counted twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetstar.functions.exprs import mean_from_cents
from fleetstar.operators.common import fact_date
from fleetstar.operators.dashboards import _STORE, _sums
from fleetstar.plans.joins import join_dim
from fleetstar.plans.sequence import previous_non_null
from fleetstar.session import checkpoint_base
from fleetstar.sources.files import overwrite_partitions, read_existing

_PLACE = ["event_timestamp", "telemetry_key"]
_READING = ["device_key", *_PLACE, "temperature_celsius"]


class CarriedDeltas:
    """``temp_delta_derived`` of every reading (O37), kept current under ``path`` by numbered loads.

    ``state`` holds each device's last non-NULL reading, ``deltas`` the readings
    of each load. A load on time needs the state only. Readings that come late
    are placed among their device's earlier ones, between the last value before
    and the first value after them; the few stored deltas that change there are
    written again by this load, and readers take the latest.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    STATE = "device_key bigint, event_timestamp timestamp_ntz, telemetry_key bigint, temperature_celsius decimal(10,2), load bigint"
    DELTAS = ("device_key bigint, event_timestamp timestamp_ntz, telemetry_key bigint, temperature_celsius decimal(10,2), "
              "temp_delta_derived decimal(12,2), load bigint")

    def add(self, fact: DataFrame, load: int) -> None:
        """Take in one load; loads are numbered upwards, the same number again replaces it."""
        checkpoint_base(self.spark)
        rows = fact.select(*[F.col(c).cast(t) for c, t in zip(_READING, ("long", "timestamp_ntz", "long", "decimal(10,2)"))]).checkpoint(eager=True)
        state = self._state(load)
        place = F.struct(*_PLACE)
        if state is None:
            joined = rows.withColumn("_fresh", F.lit(True)).withColumn("_late", F.lit(False))
        else:
            last = state.select(F.col("device_key").alias("_d"), F.struct(*_PLACE).alias("_last"))
            late = (rows.join(last, rows["device_key"] == last["_d"]).where(place < F.col("_last")).groupBy("device_key")
                    .agg(F.min(place).alias("_from"), F.max(place).alias("_to")).checkpoint(eager=True))
            known = self._between(load, late) if not late.isEmpty() else None
            carry = state.select(*_READING)
            if known is not None:
                carry = carry.join(known.select("telemetry_key"), "telemetry_key", "left_anti").select(*_READING).unionByName(known.select(*_READING))
            joined = rows.withColumn("_fresh", F.lit(True)).unionByName(carry.withColumn("_fresh", F.lit(False)))
        found = previous_non_null(joined, "device_key", "event_timestamp", "telemetry_key", "temperature_celsius", "_prev", bucket_seconds="auto")
        found = found.withColumn("temp_delta_derived", (F.col("temperature_celsius") - F.col("_prev")).cast("decimal(12,2)"))
        out = found.where("_fresh").select(*_READING, "temp_delta_derived")
        if state is not None and known is not None:
            # Stored readings beside a late one: those whose delta changed, save the first of a stretch, which only gives its value.
            before = known.select(F.col("telemetry_key").alias("_k"), F.col("temp_delta_derived").alias("_was"), "_anchor")
            again = (found.where(~F.col("_fresh")).join(before, F.col("telemetry_key") == F.col("_k"))
                     .where(~F.col("_anchor") & ~F.col("temp_delta_derived").eqNullSafe(F.col("_was"))))
            out = out.unionByName(again.select(*out.columns))
        overwrite_partitions(out.withColumn("load", F.lit(load).cast("long")), f"{self.path}/deltas", "load")
        newest = rows.where(F.col("temperature_celsius").isNotNull()).select(*_READING)
        if state is not None:
            newest = newest.unionByName(state.select(*_READING))
        top = newest.groupBy("device_key").agg(F.max(F.struct(*_PLACE, "temperature_celsius")).alias("m")).select("device_key", "m.*")
        overwrite_partitions(top.withColumn("load", F.lit(load).cast("long")), f"{self.path}/state", "load")

    def _state(self, load: int) -> DataFrame | None:
        held = read_existing(self.spark, f"{self.path}/state", self.STATE)
        if held is None:
            return None
        last = held.where(F.col("load") < load).agg(F.max("load")).first()[0]
        return None if last is None else held.where(F.col("load") == last)

    def _stored(self, load: int | None) -> DataFrame:
        held = read_existing(self.spark, f"{self.path}/deltas", self.DELTAS)
        if load is not None:
            held = held.where(F.col("load") < load)
        return held

    def _between(self, load: int, late: DataFrame) -> DataFrame:
        """Stored readings of the late devices from the last value before their first late reading
        (``_anchor``) to the first value after their last one."""
        place = F.struct(*_PLACE)
        own = self._stored(load).join(late, "device_key")
        value = F.col("temperature_celsius").isNotNull()
        edges = own.groupBy("device_key").agg(
            F.max(F.when(value & (place < F.col("_from")), place)).alias("_low"),
            F.min(F.when(value & (place > F.col("_to")), place)).alias("_high"))
        kept = (own.join(edges, "device_key").where((F.col("_low").isNull() | (place >= F.col("_low")))
                                                    & (F.col("_high").isNull() | (place <= F.col("_high")))))
        latest = kept.groupBy("telemetry_key").agg(F.max_by(F.struct(*[c for c in _READING if c != "telemetry_key"], "temp_delta_derived", "_low"), "load").alias("r"))
        return (latest.select("telemetry_key", "r.*").withColumn("_anchor", F.coalesce(place <= F.col("_low"), F.lit(False))).drop("_low")
                .checkpoint(eager=True))

    def read(self) -> DataFrame:
        """telemetry_key and its delta after all loads."""
        return (self._stored(None).groupBy("telemetry_key").agg(F.max_by("temp_delta_derived", "load").alias("temp_delta_derived")))


class ExtractState:
    """Sums per load, month and store under ``path``, from which the dashboards O16 to O19 are read.

    A load sends one row per store and month; dashboards add those up, so a
    refresh reads the new load and never the history of readings.
    """

    SCHEMA = ("reading_month string, store_key bigint, readings bigint, spikes bigint, cents bigint, temps bigint, "
              "session_secs bigint, sessions bigint, load string")

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def add(self, fact: DataFrame, load: str) -> None:
        """Take in one load; the same name again replaces it. Every task of the sums writes its own file, few for a small load."""
        secs = F.col("session_duration_secs")
        sums = (fact.withColumn("reading_month", F.date_format(fact_date(fact), "yyyy-MM")).groupBy("reading_month", "store_key")
                .agg(*_sums(), F.sum(secs).alias("session_secs"), F.count(secs).alias("sessions")))
        overwrite_partitions(sums.withColumn("load", F.lit(load)), self.path, "load")

    def _rows(self) -> DataFrame:
        return self.spark.read.schema(self.SCHEMA).parquet(self.path)

    def store_totals(self, store: DataFrame) -> DataFrame:
        """The frame that ``dashboards.spike_rate_map``, ``store_vs_global`` and ``country_city_drill`` take."""
        sums = [F.sum(c).alias(c) for c in ("readings", "spikes", "cents", "temps")]
        return join_dim(self._rows().groupBy("store_key").agg(*sums), store.select(*_STORE), "store_key")

    def monthly_health(self, by_year: bool = False) -> DataFrame:
        """``dashboards.monthly_operational_health`` from the sums."""
        month = F.to_date(F.concat("reading_month", F.lit("-01")))
        keys = ([F.year(month).alias("year")] if by_year else []) + [F.month(month).alias("month_number")]
        return (self._rows().groupBy(*keys).agg(
            F.sum("readings").alias("readings"), F.round(mean_from_cents(F.sum("cents"), F.sum("temps")), 6).alias("avg_temp"),
            F.try_divide(F.sum("session_secs").cast("double"), F.sum("sessions").cast("double")).alias("avg_session_secs")))


