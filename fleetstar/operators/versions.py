"""Fact versions by copy-on-write: only partitions with a change are rewritten.

The fact lies in ``data/stored=<n>/part=<p>`` folders. A version is a manifest,
one row per part naming the folder that holds it; readers take the highest
complete manifest. An update writes the parts that change under its own
number and then publishes a manifest that points to them and, for all other
parts, to where they were. Until that one small file is committed nobody sees
the new folders, so an update that dies is simply made again. One writer at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetstar.operators.common import fact_date
from fleetstar.sources.files import read_existing


class VersionedFact:
    """``parts`` is the date pattern of a part (a month by default)."""

    MANIFEST = "part string, stored bigint, version bigint"

    def __init__(self, spark: SparkSession, base: str, parts: str = "yyyy-MM"):
        self.spark, self.base, self.parts = spark, base, parts

    def manifest(self, version: int | None = None) -> dict[str, int]:
        """{part: folder number} of a version (default: the latest). One entry per calendar part."""
        rows = read_existing(self.spark, f"{self.base}/manifest", self.MANIFEST)
        if rows is None:
            return {}
        at = rows.agg(F.max("version")).first()[0] if version is None else version
        return {r["part"]: r["stored"] for r in rows.where(F.col("version") == at).collect()}

    def version(self) -> int:
        """The latest published version; -1 before the first."""
        rows = read_existing(self.spark, f"{self.base}/manifest", self.MANIFEST)
        return -1 if rows is None else rows.agg(F.coalesce(F.max("version"), F.lit(-1))).first()[0]

    def write(self, fact: DataFrame) -> None:
        """Publish all of ``fact`` as the next version."""
        number = self.version() + 1
        self._store(fact.withColumn("part", F.date_format(fact_date(fact), self.parts)), number)
        self._publish(number, {p: number for p in self._parts_of(number)})

    def read(self, version: int | None = None, only: list[str] | None = None) -> DataFrame:
        """The fact as of a version, with its ``part``; ``only`` limits it to some parts."""
        held = self.manifest(version)
        paths = [f"{self.base}/data/stored={n}/part={p}" for p, n in sorted(held.items()) if only is None or p in only]
        if not paths:
            raise FileNotFoundError(f"{self.base}: no such version or part")
        some = self.spark.read.parquet(f"{self.base}/data/stored={next(iter(held.values()))}").drop("part")
        return (self.spark.read.option("basePath", f"{self.base}/data").schema(f"{_ddl(some)}, stored bigint, part string")
                .parquet(*paths).drop("stored"))

    def update_flags(self, flags: DataFrame, flag: str = "is_anomaly_detected", column: str = "is_anomaly",
                     key: str = "telemetry_key") -> list[str]:
        """Replace ``column`` by ``flag`` where ``flags`` has the key; returns the parts rewritten.

        Parts without a changed value keep their files. The parts' names, at
        most one per calendar part, are all that reaches the driver.
        """
        new = flags.select(F.col(key).alias("_key"), F.col(flag).alias("_new"))
        joined = lambda fact: fact.join(new, fact[key] == new["_key"], "left")
        differs = F.col("_new").isNotNull() & ~F.col("_new").eqNullSafe(F.col(column))
        changed = sorted(r["part"] for r in joined(self.read().select(key, column, "part")).where(differs).select("part").distinct().collect())
        if not changed:
            return []
        number = self.version() + 1
        fact = self.read(only=changed)
        self._store(joined(fact).withColumn(column, F.coalesce("_new", column)).select(*fact.columns), number)
        self._publish(number, self.manifest() | {p: number for p in changed})
        return changed

    def _store(self, rows: DataFrame, number: int) -> None:
        """Few files: rows are rebalanced by part, a large part over several tasks."""
        (rows.hint("rebalance", "part").sortWithinPartitions("part", "device_key", "event_timestamp")
         .write.mode("overwrite").partitionBy("part").parquet(f"{self.base}/data/stored={number}"))

    def _parts_of(self, number: int) -> list[str]:
        rows = self.spark.read.schema("part string").parquet(f"{self.base}/data/stored={number}")
        return [r["part"] for r in rows.distinct().collect()]

    def _publish(self, number: int, held: dict[str, int]) -> None:
        rows = self.spark.createDataFrame(sorted(held.items()), "part string, stored bigint").coalesce(1)
        rows.write.mode("overwrite").parquet(f"{self.base}/manifest/version={number}")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
