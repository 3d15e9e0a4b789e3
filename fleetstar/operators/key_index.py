"""Keys of a fact, bucketed beside it: membership without shuffling history.

A load's keys are written into the index's hash buckets, sorted, one partition
per load. A join with the index on the key then moves only the incoming rows,
into the index's buckets; history is read where it lies.
"""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetstar.sources.files import read_existing


class KeyIndex:
    """The index at ``path``; ``buckets`` is fixed when it is first written."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64, key: str = "telemetry_key"):
        self.spark, self.path, self.buckets, self.key = spark, path, buckets, key
        self.table = f"key_index_{zlib.crc32(path.encode()):08x}"

    def _open(self) -> None:
        """Name the folder in the session's catalog (a session forgets it) with the partitions it has now."""
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.table} ({self.key} BIGINT, load STRING) USING parquet "
                       f"PARTITIONED BY (load) CLUSTERED BY ({self.key}) SORTED BY ({self.key}) INTO {self.buckets} BUCKETS "
                       f"LOCATION '{self.path}'")
        if read_existing(self.spark, self.path, f"{self.key} bigint, load string") is not None:
            self.spark.sql(f"ALTER TABLE {self.table} RECOVER PARTITIONS")
            self.spark.sql(f"REFRESH TABLE {self.table}")

    def keys(self, but_load: str | None = None) -> DataFrame:
        """All keys, without those that only ``but_load`` has written."""
        self._open()
        rows = self.spark.table(self.table)
        return (rows if but_load is None else rows.where(F.col("load") != but_load)).select(self.key)

    def add(self, keys: DataFrame, load: str) -> None:
        """Write one load's keys, replacing an earlier attempt at that load."""
        self._open()
        before = self.spark.conf.get("spark.sql.sources.partitionOverwriteMode")
        self.spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        try:
            (keys.select(self.key, F.lit(load).alias("load")).repartition(self.buckets, self.key)
             .write.mode("overwrite").insertInto(self.table))
        finally:
            self.spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)

    def mark_known(self, rows: DataFrame, but_load: str | None = None, out: str = "known") -> DataFrame:
        """``rows`` with a boolean: the index has the row's key. The merge join keeps history in its buckets at any size."""
        held = self.keys(but_load).select(F.col(self.key).alias("_held")).distinct()
        return (rows.join(held.hint("merge"), rows[self.key] == held["_held"], "left")
                .withColumn(out, F.col("_held").isNotNull()).drop("_held"))
