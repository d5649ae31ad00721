"""Sources and sinks."""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.config import CORRUPT, INGEST

# Declared schema of the transaction columns the pipeline uses.
TRANSACTION_SCHEMA = T.StructType([
    T.StructField("TransactionID", T.LongType()),
    T.StructField("isFraud", T.IntegerType()),
    T.StructField("TransactionDT", T.LongType()),
    T.StructField("TransactionAmt", T.DoubleType()),
    T.StructField("ProductCD", T.StringType()),
    T.StructField("card1", T.LongType()),
    T.StructField("card2", T.DoubleType()),
    T.StructField("card3", T.DoubleType()),
    T.StructField("card5", T.DoubleType()),
    T.StructField("addr1", T.DoubleType()),
    T.StructField("addr2", T.DoubleType()),
    T.StructField("P_emaildomain", T.StringType()),
    T.StructField("R_emaildomain", T.StringType()),
])
IDENTITY_SCHEMA = T.StructType([
    T.StructField("TransactionID", T.LongType()),
    T.StructField("DeviceType", T.StringType()),
    T.StructField("DeviceInfo", T.StringType()),
])


@dataclass(frozen=True)
class DataPaths:
    """One frozen layout with URI roots."""
    raw: str = "data/raw"
    interim: str = "data/interim"
    processed: str = "data/processed"
    outputs: str = "data/outputs"
    reports: str = "reports"
    models: str = "models"

    def path(self, area: str, name: str) -> str:
        return os.path.join(getattr(self, area), name)


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None, ingest_order: bool = False,
             keep_corrupt: bool = False, **options) -> DataFrame:
    """Header CSV with an explicit schema (no inference pass over the data).

    ``ingest_order`` adds ``_ingest``, see :func:`with_ingest_order`. ``keep_corrupt`` (with a schema) adds
    ``_corrupt_record``, the text of a line that doesn't parse as the schema says and null otherwise;
    :func:`tidewatch.operators.schema.split_valid` sends such rows to quarantine. Other ``options`` go to Spark's reader.
    """
    r = spark.read.option("header", True).option("mode", "PERMISSIVE").options(**options)
    if schema is not None:
        if keep_corrupt:
            schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
            r = r.option("columnNameOfCorruptRecord", CORRUPT).option("enforceSchema", False)
        r = r.schema(schema)
    df = r.csv(path)
    return with_ingest_order(df) if ingest_order else df


def with_ingest_order(scan: DataFrame) -> DataFrame:
    """Add ``_ingest`` to a file scan: (file, first byte of the split, row number). The row number ascends within a split, so
    the struct orders rows as they stand in their files, files by name, without a shuffle. Take it at the scan, before any
    other operation."""
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("row"))
    return scan.select("*", place.alias(INGEST))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet scan; projection and filters are pushed by Catalyst."""
    return spark.read.parquet(path)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """S3: overwrite, parents created by the writer; optional partition columns."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def json_safe(df: DataFrame) -> DataFrame:
    """S4 rule: NaN / +-inf -> null in every floating column."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.when(F.isnan(c) | (F.abs(c) == F.lit(float("inf"))), F.lit(None)).otherwise(c)
        out.append(c.alias(f.name))
    return df.select(*out)


def write_json_report(df: DataFrame, path: str) -> None:
    """A (small, aggregated) metrics DataFrame as JSON lines."""
    json_safe(df).coalesce(1).write.mode("overwrite").json(path)


def load_temperature(path: str, strict: bool = True) -> float | None:
    """Absent file -> None; ``strict`` also maps missing / <= 0 to None (else 1.0). Read by Spark, so that the
    path can be in any store its executors see."""
    spark = SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()
    try:
        row = spark.read.schema("temperature double").option("multiLine", True).json(path).first()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        row = None
    t = row["temperature"] if row is not None else None
    if t is None or t <= 0:
        return None if strict else 1.0
    return float(t)

