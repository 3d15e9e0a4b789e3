"""File sources and sinks with explicit schemas (never inferred)."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetstar import schemas as S
from fleetstar.session import checkpoint_base

# The flat extract as the dashboard declares it: 30 typed columns.
FLAT_CSV_SCHEMA = T.StructType(
    [f for f in S.FACT.fields]
    + [T.StructField(c, T.StringType(), c in ("alert_code", "severity")) for c in
       ["store_name", "city", "country", "region", "device_id", "model_version", "firmware_version"]]
    + [T.StructField("full_date", T.DateType()), T.StructField("month_name", T.StringType()),
       T.StructField("quarter", T.ShortType()), T.StructField("year", T.ShortType()),
       T.StructField("alert_code", T.StringType(), True), T.StructField("severity", T.StringType(), True)])


def read_csv(spark: SparkSession, path: str, schema: T.StructType = FLAT_CSV_SCHEMA) -> DataFrame:
    """UTF-8, comma-separated, header row, explicit schema; malformed rows fail."""
    return (spark.read.schema(schema).option("header", True).option("encoding", "UTF-8")
            .option("mode", "FAILFAST").option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss[.SSSSSS]")
            .csv(path))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header row, written in parallel (one file per task)."""
    (df.write.mode(mode).option("header", True).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss[.SSSSSS]")
     .csv(path))


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite") -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def read_csv_quarantined(spark: SparkSession, path: str, schema: T.StructType = FLAT_CSV_SCHEMA,
                         header: bool = True) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects): every line is one or the other, none fails the read.

    Lines that do not fit the schema become rejects with the line itself and a
    reason: the number of fields, or the first column whose value has not its
    type. The lines are parsed once, into the shared checkpoint folder.
    """
    fields = [T.StructField(f.name, f.dataType) for f in schema.fields]
    corrupt = "_corrupt_line"
    checkpoint_base(spark)
    parsed = (spark.read.schema(T.StructType([*fields, T.StructField(corrupt, T.StringType())]))
              .option("header", header).option("encoding", "UTF-8").option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", corrupt).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss[.SSSSSS]")
              .csv(path).checkpoint(eager=True))
    texts = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(fields) + 1)])
    broken = (parsed.where(F.col(corrupt).isNotNull()).select(F.col(corrupt).alias("line"))
              .withColumn("t", F.from_csv("line", texts.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "))))
    n = F.size(F.split("line", ",", -1))  # separators inside quotes only matter where the count is right without them
    reason = F.when(F.col(f"t.c{len(fields)}").isNotNull(), "too many fields").when(n < len(fields), "too few fields")
    for i, f in enumerate(fields):
        value = F.col(f"t.c{i}")
        reason = reason.when(value.isNotNull() & (value != "") & value.try_cast(f.dataType).isNull(), f"{f.name} is no {f.dataType.simpleString()}")
    return (parsed.where(F.col(corrupt).isNull()).drop(corrupt),
            broken.select("line", reason.otherwise("malformed line").alias("reason")))


def read_existing(spark: SparkSession, path: str, schema) -> DataFrame | None:
    """The table at ``path``; None only if there is no such folder yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def overwrite_partitions(rows: DataFrame, path: str, *parts: str) -> None:
    """Write the partitions that occur in ``rows``, replacing an earlier attempt at them and nothing else."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path)
