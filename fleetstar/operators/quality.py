"""Data-quality rules: flags, constraint checks, schema conformance, profiling."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetstar import constants as C
from fleetstar.functions.exprs import count_true, exact_pct
from fleetstar.operators.common import fact_date
from fleetstar.plans.joins import bounded_broadcast, join_dim
from fleetstar.plans.sequence import previous_non_null
from fleetstar.session import checkpoint_base



def spike_flag(fact: DataFrame) -> DataFrame:
    """Recomputed spike flag: temperature strictly above the device ceiling; NULL -> FALSE."""
    return fact.withColumn("spike_recomputed",
                           F.coalesce(F.col("temperature_celsius") > F.col("max_temp_threshold"), F.lit(False)))


def classify_alert(fact: DataFrame, crit: float = C.CRITICAL_TEMP) -> DataFrame:
    """Alert class from the reading: critical above ``crit``, warning for other spikes.

    Readings without a temperature keep the upstream alert (the class was
    assigned before the value went missing); non-spikes keep theirs too.
    """
    spike = F.col("is_thermal_spike")
    derived = (F.when(F.col("temperature_celsius").isNull(), F.col("alert_type_key"))
               .when(spike & (F.col("temperature_celsius") > F.lit(crit)), F.lit(C.THERM_CRIT_KEY))
               .when(spike, F.lit(C.THERM_WARN_KEY))
               .otherwise(F.col("alert_type_key")))
    return fact.withColumn("alert_type_key_derived", derived.cast("int"))


def quality_flag_audit(fact: DataFrame) -> DataFrame:
    """Readings whose stored flags contradict their values."""
    d = spike_flag(fact)
    spike_bad = F.col("is_thermal_spike") != F.col("spike_recomputed")
    missing_bad = (F.col("data_quality_flag") == "MISSING") != F.col("temperature_celsius").isNull()
    reason = F.concat_ws(",", F.when(spike_bad, F.lit("SPIKE_FLAG_MISMATCH")),
                         F.when(missing_bad, F.lit("MISSING_FLAG_MISMATCH")))
    return (d.filter(spike_bad | missing_bad)
            .select("telemetry_key", "data_quality_flag", "is_thermal_spike", "spike_recomputed",
                    reason.alias("reason")))


def temp_delta(fact: DataFrame, bucket_seconds: int = 3600) -> DataFrame:
    """``temp_delta_derived`` = reading minus the device's previous non-NULL reading."""
    d = previous_non_null(fact, "device_key", "event_timestamp", "telemetry_key", "temperature_celsius",
                          "_prev_temp", bucket_seconds=bucket_seconds)
    return d.withColumn("temp_delta_derived", F.col("temperature_celsius") - F.col("_prev_temp")).drop("_prev_temp")


def conform_schema(df: DataFrame, target: T.StructType, safe: bool = False) -> DataFrame:
    """Cast to the target schema: widen/narrow types, add missing columns as NULL, drop extras.

    With ``safe=True`` values that do not fit become NULL instead of failing.
    """
    cols = []
    for f in target.fields:
        if f.name in df.columns:
            c = F.col(f.name)
            c = c.try_cast(f.dataType) if safe else c.cast(f.dataType)
        else:
            c = F.lit(None).cast(f.dataType)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def column_profile(df: DataFrame, exact: bool = False) -> DataFrame:
    """Per column: type, non-NULL count, NULL count and distinct count.

    Counts are one aggregate pass. Distinct counts are HyperLogLog sketches
    in that same pass by default; ``exact=True`` counts distinct (column,
    value) pairs instead: one more pass and one shuffle for all columns,
    de-duplicated map-side.
    """
    aggs = []
    for i, c in enumerate(df.columns):
        col = F.col(f"`{c}`")
        aggs += [F.count(col).alias(f"n{i}"), count_true(col.isNull()).alias(f"z{i}")]
        if not exact:
            aggs.append(F.approx_count_distinct(col).alias(f"d{i}"))
    one = df.agg(*aggs)
    types = dict(df.dtypes)
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(types[c]).alias("data_type"),
                              F.col(f"n{i}").cast("long").alias("non_null_count"),
                              F.col(f"z{i}").cast("long").alias("null_count"),
                              (F.lit(None) if exact else F.col(f"d{i}")).cast("long").alias("distinct_count"))
                     for i, c in enumerate(df.columns)])
    prof = one.select(F.explode(rows).alias("p")).select("p.*")
    if not exact:
        return prof
    pairs = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("v"))
                                          for c in df.columns])).alias("p")).select("p.*")
    distinct = (pairs.where("v is not null").distinct().groupBy("column_name").agg(F.count(F.lit(1)).alias("distinct_count")))
    return (prof.drop("distinct_count").join(distinct, "column_name", "left")
            .select("column_name", "data_type", "non_null_count", "null_count",
                    F.coalesce("distinct_count", F.lit(0)).cast("long").alias("distinct_count")))


def quality_breakdown(fact: DataFrame, store: DataFrame, device: DataFrame | None = None,
                      by: str = "store") -> DataFrame:
    """Count and share of each quality flag per store, device, firmware or month."""
    flag = "data_quality_flag"
    if by == "month":
        d = fact_date(fact)
        per = fact.groupBy(F.year(d).alias("year"), F.month(d).alias("month_number"), flag).agg(
            F.count(F.lit(1)).alias("readings"))
        keys = ["year", "month_number"]
    elif by in ("store", "device", "firmware"):
        fk = "store_key" if by == "store" else "device_key"
        per = fact.groupBy(fk, flag).agg(F.count(F.lit(1)).alias("readings"))
        if by == "store":
            per = join_dim(per, store.select("store_key", "store_name", "region"), "store_key")
            keys = ["store_key", "store_name", "region"]
        else:
            per = join_dim(per, device.select("device_key", "device_id", "firmware_version"), "device_key")
            if by == "firmware":
                per = per.groupBy("firmware_version", flag).agg(F.sum("readings").alias("readings"))
                keys = ["firmware_version"]
            else:
                keys = ["device_key", "device_id", "firmware_version"]
    else:
        raise ValueError(by)
    total = F.sum("readings").over(Window.partitionBy(*keys))
    return per.withColumn("share_pct", exact_pct(F.col("readings"), total)).select(
        *keys, flag, "readings", "share_pct")


# ---------------------------------------------------------------------------
# Constraint checks
# ---------------------------------------------------------------------------

@dataclass(frozen=True)
class Rule:
    kind: str          # not_null | max_length | domain | duplicate | orphan | store_matches_device | missing_iff_null
    table: str
    column: str = ""
    arg: object = None  # length, allowed values, or (parent table, parent column)

    @property
    def name(self) -> str:
        return f"{self.table}.{self.kind}" + (f".{self.column}" if self.column else "")


def default_rules(tables: dict) -> list[Rule]:
    """Keys, NOT NULL, lengths, domains and references of the star model.

    ``tables`` maps table name -> DataFrame or list of its column names.
    """
    from fleetstar import schemas as S

    rules: list[Rule] = []
    declared = {"fact": S.FACT, "store": S.STORE, "device": S.DEVICE, "alert": S.ALERT, "date": S.DATE}
    for t, schema in declared.items():
        if t not in tables:
            continue
        cols = tables[t]
        present = set(cols if isinstance(cols, (list, tuple, set)) else cols.columns)
        rules += [Rule("not_null", t, f.name) for f in schema.fields if not f.nullable and f.name in present]
        rules += [Rule("max_length", t, c, n) for c, n in S.VARCHAR_LIMITS.get(t, {}).items() if c in present]
    pk = {"fact": "telemetry_key", "store": "store_key", "device": "device_key", "alert": "alert_type_key",
          "date": "date_key"}
    unique = {"store": "store_id", "device": "device_id", "alert": "alert_code", "date": "full_date"}
    for t in tables:
        if t in pk:
            rules.append(Rule("duplicate", t, pk[t]))
        if t in unique:
            rules.append(Rule("duplicate", t, unique[t]))
    if "fact" in tables:
        rules.append(Rule("domain", "fact", "data_quality_flag", tuple(C.QUALITY_FLAGS)))
        rules.append(Rule("missing_iff_null", "fact"))
        for child_col, parent, parent_col in [("store_key", "store", "store_key"),
                                              ("device_key", "device", "device_key"),
                                              ("alert_type_key", "alert", "alert_type_key"),
                                              ("date_key", "date", "date_key")]:
            if parent in tables:
                rules.append(Rule("orphan", "fact", child_col, (parent, parent_col)))
        if "device" in tables:
            rules.append(Rule("store_matches_device", "fact"))
    if "device" in tables and "store" in tables:
        rules.append(Rule("orphan", "device", "store_key", ("store", "store_key")))
    if "alert" in tables:
        rules.append(Rule("domain", "alert", "severity", ("Critical", "High", "Medium", "Low")))
    return rules


def _row_rule(r: Rule):
    c = F.col(r.column) if r.column else None
    if r.kind == "not_null":
        return count_true(c.isNull())
    if r.kind == "max_length":
        return count_true(F.length(c) > F.lit(r.arg))
    if r.kind == "domain":
        return count_true(~c.isin(list(r.arg)))
    if r.kind == "missing_iff_null":
        return count_true((F.col("data_quality_flag") == "MISSING") != F.col("temperature_celsius").isNull())
    return None


def check_constraints(tables: dict[str, DataFrame], rules: list[Rule] | None = None) -> DataFrame:
    """One row per rule: (rule, table_name, violations).

    * Row-level rules are one aggregate pass per table, without distinct counts.
    * Duplicate keys are grouped counts of the key alone: one pass for all
      dimension keys together, one for the fact's.
    * Reference rules on the fact run on the fact pre-aggregated by its
      foreign keys (map-side partial counts, so a hot key costs one row per
      task), then anti-join the parent's keys (broadcast when proven small).
    """
    rules = rules if rules is not None else default_rules(tables)
    parts: list[DataFrame] = []
    by_table: dict[str, list[Rule]] = {}
    for r in rules:
        if _row_rule(r) is not None:
            by_table.setdefault(r.table, []).append(r)
    for t, rs in by_table.items():
        one = tables[t].agg(*[_row_rule(r).alias(f"r{i}") for i, r in enumerate(rs)])
        rows = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(r.table).alias("table_name"),
                                  F.col(f"r{i}").cast("long").alias("violations")) for i, r in enumerate(rs)])
        parts.append(one.select(F.explode(rows).alias("x")).select("x.*"))

    keyed = [r for r in rules if r.kind == "duplicate" and r.table != "fact"]
    if keyed:
        keys = reduce(DataFrame.unionByName, [tables[r.table].select(
            F.lit(r.name).alias("rule"), F.lit(r.table).alias("table_name"), F.col(r.column).cast("string").alias("k")) for r in keyed])
        per_key = keys.groupBy("rule", "table_name", "k").agg((F.count(F.lit(1)) - 1).alias("more"))
        extra = per_key.groupBy("rule", "table_name").agg(F.sum("more").cast("long").alias("violations"))
        names = keys.sparkSession.createDataFrame([(r.name, r.table) for r in keyed], "rule string, table_name string")
        parts.append(names.join(extra, ["rule", "table_name"], "left").select(
            "rule", "table_name", F.coalesce("violations", F.lit(0)).cast("long").alias("violations")))

    ref_rules = [r for r in rules if r.kind in ("orphan", "store_matches_device")]
    fk_cols = sorted({r.column for r in ref_rules if r.kind == "orphan" and r.table == "fact"}
                     | ({"device_key", "store_key"} if any(r.kind == "store_matches_device" for r in ref_rules)
                        else set()))
    fk = None
    if fk_cols and "fact" in tables:
        # Readings per foreign-key combination: far fewer rows than the fact,
        # materialised once for the reference rules that all read it.
        checkpoint_base(tables["fact"].sparkSession)
        fk = tables["fact"].groupBy(*fk_cols).agg(F.count(F.lit(1)).alias("n")).checkpoint(eager=True)
    for r in rules:
        if r.kind == "duplicate" and r.table == "fact":
            counts = tables[r.table].groupBy(r.column).agg(F.count(F.lit(1)).alias("n"))
            v = counts.agg(F.sum(F.when(F.col("n") > 1, F.col("n") - 1).otherwise(0)).alias("v"))
        elif r.kind == "orphan":
            parent, pcol = r.arg
            keys = tables[parent].select(F.col(pcol).alias("_pk")).distinct()
            if r.table == "fact":
                child, weight = fk.filter(F.col(r.column).isNotNull()), F.col("n")
            else:
                child, weight = tables[r.table].filter(F.col(r.column).isNotNull()), F.lit(1)
            v = (child.join(bounded_broadcast(keys), child[r.column] == keys["_pk"], "left_anti")
                 .agg(F.sum(weight).alias("v")))
        elif r.kind == "store_matches_device":
            dev = tables["device"].select("device_key", F.col("store_key").alias("_dev_store"))
            v = (join_dim(fk, dev, "device_key")
                 .agg(F.sum(F.when(~F.col("store_key").eqNullSafe(F.col("_dev_store")), F.col("n"))
                            .otherwise(0)).alias("v")))
        else:
            continue
        parts.append(v.select(F.lit(r.name).alias("rule"), F.lit(r.table).alias("table_name"),
                              F.coalesce(F.col("v"), F.lit(0)).cast("long").alias("violations")))
    return reduce(DataFrame.unionByName, parts)
