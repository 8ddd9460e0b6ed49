"""Readers with explicit schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tramflow import schemas
from tramflow.functions.keys import null_literal

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def flatten_pings(snapshots: DataFrame) -> DataFrame:
    """GPS snapshot rows (``result`` array) to one typed row per ping.

    ``Time`` text becomes a timestamp (NULL when malformed); ``CurrTramTime``
    and ``Date`` are the text halves kept for display.
    """
    flat = snapshots.select(F.inline("result"))
    parts = F.split(F.trim(F.col("Time")), " ")
    return flat.select(
        "Lines", "Lon", "Lat", "VehicleNumber", "Brigade",
        F.try_to_timestamp(F.col("Time"), F.lit(TIME_FORMAT)).cast("timestamp_ntz").alias("Time"),
        F.try_element_at(parts, F.lit(2)).alias("CurrTramTime"),
        F.try_element_at(parts, F.lit(1)).alias("DateText"),
    )


def read_pings(spark: SparkSession, path_glob: str) -> DataFrame:
    """Scan GPS snapshot files (one multi-line JSON object each)."""
    raw = spark.read.schema(schemas.GPS_SNAPSHOT).option("multiLine", True).json(path_glob)
    return flatten_pings(raw)


def read_collection(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | None = None, **options
) -> DataFrame:
    """Scan a document collection stored as ``fmt``.

    The format is an argument, so a deployment can name a document-store
    connector here; parquet and JSON are the tested ones.
    """
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def parse_stops(feed: DataFrame) -> DataFrame:
    """Stops feed ``result[].values[i].value`` read by position.

    The text ``'null'`` is NULL; numbers and the timestamp use try-casts, and
    each field is NULL-tested on its own slot.
    """
    rows = feed.select(F.explode("result").alias("r")).select(F.col("r.values").alias("v"))

    def slot(i: int):
        return null_literal(F.try_element_at(F.col("v"), F.lit(i + 1)).getField("value"))

    return rows.select(
        slot(0).alias("unit"),
        slot(1).alias("post"),
        slot(2).alias("unit_name"),
        slot(3).try_cast("int").alias("street_id"),
        slot(4).try_cast("double").alias("latitude"),
        slot(5).try_cast("double").alias("longitude"),
        slot(6).alias("direction"),
        F.try_to_timestamp(slot(7), F.lit("yyyy-MM-dd HH:mm:ss.SSSSSS")).cast("timestamp_ntz").alias("valid_from"),
    )


def read_stops_feed(spark: SparkSession, path: str) -> DataFrame:
    return parse_stops(spark.read.schema(schemas.STOPS_FEED).option("multiLine", True).json(path))


def ensure_partitions(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Spread a scan that yields fewer partitions than the cluster has cores.

    A small file with one row group scans as one task, which would run every
    narrow step before the first shuffle on one core.  Large inputs already
    arrive in many splits, so this is a no-op at scale.
    """
    try:
        want = min_partitions or df.sparkSession.sparkContext.defaultParallelism
        have = df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001 - no RDD view (e.g. a remote session)
        return df
    return df.repartition(want) if have < want else df


def read_parquet(spark: SparkSession, path: str, min_partitions: int | None = None) -> DataFrame:
    """Parquet scan with at least ``min_partitions`` (default: cores) partitions."""
    return ensure_partitions(spark.read.parquet(path), min_partitions)
